import math

import numpy as np
from pyspark.sql import functions as F

from heatline.llm import quality
from heatline.llm.common import held_out, unpack
from heatline.llm.ngrams import FACTORS, FINISH

MASK = 2 ** 32 - 1


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = quality.classify(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = np.array([r.quality for r in rows])
    hit = np.array([r.predicted for r in rows]) == good
    assert hit[good == 1].mean() > 0.98 and hit[good == 0].mean() > 0.9


def test_edge_cases(spark):
    rows = [(k, "plain words in a row", "x") for k in range(30)] + [(k, "$$$ ### $$$ ###", "x") for k in range(30, 60)]
    rows += [(60, None, None), (61, "", "x"), (None, "plain words", "x"), (62, "plain " * 200_000, "x"), (0, "$$$ ###", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    marks = spark.createDataFrame([(k, int(k < 30), None) for k in range(60)] + [(None, 1, None), (1, None, None), (2, 7, None)],
                                  "doc_id long, quality int, text string")
    got = quality.classify(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r for r in got}
    assert by[62].predicted == 1 and by[40].predicted == 0 and by[60].score == by[61].score
    none = quality.classify(docs, marks.where("false")).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}
    assert quality.classify(docs.where("false"), marks).count() == 0


def test_repeated_words_share_a_bucket():
    a, b = (set(quality.features(t).tolist()) for t in ("foo foo foo", "bar bar bar"))
    c = set(quality.features("foo bar baz").tolist())
    assert (a & b) - c


def slow_word(word):
    """The 32-bit code of one word, from whole numbers of Python."""
    total = 0
    for k, c in enumerate(word):
        mixed = (ord(c) + 7) * (2 * k + 1) * int(FACTORS[0]) & MASK
        mixed ^= mixed >> 13
        total += mixed * (int(FACTORS[1]) + 4 * k & MASK) & MASK
    total &= MASK
    return total ^ total >> 16


def slow_gram(part):
    total = len(part) * 40503 + sum(ord(c) * int(FACTORS[k]) for k, c in enumerate(part)) & MASK
    total ^= total >> 15
    return (total * int(FINISH) & MASK) >> (33 - quality.BITS)


def slow_buckets(text):
    words, run = [], ""
    for c in text + " ":
        if ord(c) > 32:
            run += c
        elif run:
            words.append(slow_word(run))
            run = ""
    small = lambda code: (code * int(FINISH) & MASK) >> (33 - quality.BITS)
    body, half = f" {text} ", 1 << (quality.BITS - 1)
    return [*map(small, words), *(small(a ^ b) for a, b in zip(words, words[1:])),
            *(half + slow_gram(body[i:i + n]) for n in quality.ORDERS for i in range(len(body) - n + 1))]


def test_scores_equal_brute_force(spark, tables):
    """Averaged vectors and softmax of the fitted model, one occurrence at a time."""
    docs, labels = (spark.read.parquet(f"{tables}/{n}.parquet") for n in ("documents", "labels"))
    model = unpack(quality.fit(docs, labels.where(~held_out(F.col("doc_id")))))
    table, bias = model["table"].astype(float).tolist(), model["bias"].tolist()
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in quality.classify(docs, labels).collect():
        at = slow_buckets(texts[r.doc_id])
        z = [sum(table[b][k] for b in at) / max(1, len(at)) + bias[k] for k in (0, 1)]
        want = 1 / (1 + math.exp(z[0] - z[1]))
        assert abs(r.score - want) < 1e-6 and r.predicted == int(r.score >= 0.5)
