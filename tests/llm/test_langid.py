import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from heatline.llm import langid
from heatline.llm.common import held_out, unpack
from heatline.llm.ngrams import FACTORS, FINISH


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    tested = [r for r in rows if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in tested]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_calibration_beats_the_raw_scores():
    rng = np.random.default_rng(0)
    labels = rng.integers(0, 3, 4000)
    logits = np.eye(3)[labels] * 6 + rng.normal(0, 4, (4000, 3))
    warm = langid.temperature(logits, labels)

    def loss(t):
        return -np.log(langid.softmax(logits / t)[np.arange(4000), labels]).mean()

    assert loss(warm) <= min(loss(t) for t in (0.5, 1.0, 2.0, 4.0)) + 1e-6


def test_lasso_keeps_weights_sparse():
    model = langid.Ftrl(10, 2)
    for k in range(200):
        model.learn(np.array([0, 1 + k % 9]), np.array([1.0, 1e-6]), k % 2)
    assert (model.weights()[1:] == 0).all()


def test_edge_cases(spark):
    rows = [(k, "the cat and the hat " * 5, "en", 1.0) for k in range(20)]
    rows += [(k, "der hund und das haus " * 5, "de", 1.0) for k in range(20, 40)]
    rows += [(40, None, "en", None), (41, "", "en", None), (42, "123 !!", "de", None), (None, "und das haus", None, 0.0),
             (43, "the cat " * 200_000, None, None), (44, "und das", "de", 0.0), (44, "und das", "de", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = langid.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (40, 41, 42)] == ["und"] * 3
    assert by[43].lang_pred == "en" and by[44].lang_pred == "de" and by[None].lang_pred == "de"
    assert langid.identify(docs.where("false")).count() == 0
    bare = langid.identify(docs.withColumn("lang", docs.lang.substr(0, 0)).where("doc_id > 39"))
    assert bare.count() == 6
    blank = langid.identify(docs.selectExpr("doc_id", "text", "cast(null as string) as lang"))
    assert {r.lang_pred for r in blank.collect()} == {"und"}


def slow_gram(part):
    """The bucket of one n-gram, from whole numbers of Python."""
    total = len(part) * 40503
    for k, c in enumerate(part):
        total += ord(c) * int(FACTORS[k])
    total %= 2 ** 32
    total ^= total >> 15
    return (total * int(FINISH)) % 2 ** 32 >> (32 - langid.BITS)


def slow_counts(text):
    body = "".join(c if c.isalpha() else " " for c in text.lower())
    if not body.strip():
        return None
    body = f" {body} "
    return Counter(slow_gram(body[i:i + n]) for n in langid.ORDERS for i in range(len(body) - n + 1))


def test_predictions_equal_brute_force(spark, tables):
    """Document frequencies, TF-IDF and softmax of the fitted model, with dictionaries and one text at a time."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    learned = docs.where(~held_out(F.col("doc_id"))).where("text rlike '\\\\p{L}'")
    model = unpack(langid.fit(learned))
    found = {r.doc_id: slow_counts(r.text) for r in docs.collect()}
    own = [r.doc_id for r in learned.select("doc_id").collect()]
    df = Counter(g for i in own for g in found[i])
    idf = {g: math.log((1 + len(own)) / (1 + df[g])) + 1 for c in found.values() if c for g in c}
    assert all(abs(model["idf"][g] - v) < 1e-5 for g, v in idf.items())
    w, names = model["w"].astype(float), model["names"].tolist()
    got = {r.doc_id: r for r in langid.identify(docs).collect()}
    for i, c in found.items():
        if c is None:
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        x = {g: n * idf[g] for g, n in c.items()}
        length = math.sqrt(sum(v * v for v in x.values()))
        z = [sum(v * w[g, k] for g, v in x.items()) / length / float(model["warm"]) + model["b"][k] for k in range(len(names))]
        e = [math.exp(v - max(z)) for v in z]
        assert got[i].lang_pred == names[z.index(max(z))] and abs(got[i].score - max(e) / sum(e)) < 1e-4
