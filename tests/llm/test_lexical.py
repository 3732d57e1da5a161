import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from heatline.llm import lexical

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(docs, items, best=10):
    held = [(doc, Counter(terms(text))) for doc, text in docs if terms(text)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    queries = {}
    for item, text in items:
        queries.setdefault(item, set()).update(terms(text))
    out = []
    for item, wanted in queries.items():
        scored = []
        for doc, count in held:
            m = 10 + 90 * sum(count.values()) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * count[t] // (1000 * count[t] + 8 * m))
                        for t in wanted if t in count)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort(key=lambda s: s[:3])
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(scored[:best])]
    return sorted(out, key=str)


def run(spark, docs, items):
    got = lexical.search(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["été", "Été", "a", "aa", "a1", "日本"]
    said = lambda k: rng.choice([" ", ", ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(k))
    return [(i, said(rng.randrange(0, 40))) for i in range(n)], [(i, said(rng.randrange(1, 12))) for i in range(25)]


def test_equals_brute_force(spark):
    docs, items = corpus(2, 300)
    assert run(spark, docs, items) == brute(docs, items)


def test_blocks_of_items_change_nothing(spark, monkeypatch):
    docs, items = corpus(3, 120)
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 6)
    monkeypatch.setattr(lexical, "CELLS", 16)
    assert run(spark, docs, items) == brute(docs, items)


def test_only_whole_terms(spark):
    docs = [(1, "cart car_cart CAR"), (2, "carcar scar car7 cär"), (3, "car.car car"), (4, "é car\x00car é")]
    items = [(1, "car"), (2, "Car-cart"), (3, "É é"), (4, "absent"), (5, "...")]
    assert run(spark, docs, items) == brute(docs, items)


def test_many_copies_rank_by_id(spark):
    docs = [(i, "alpha beta") for i in range(500, 0, -1)] + [(1000 + i, f"gamma word{i} x") for i in range(500)]
    items = [(1, "alpha"), (2, "gamma beta")]
    assert run(spark, docs, items) == brute(docs, items)


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    docs = [(1, None), (2, ""), (None, "alpha beta"), (3, "alpha beta"), (3, "alpha beta"), (4, "alpha " * 300000), (5, "--"), (None, "beta")]
    items = [(None, "alpha"), (7, "beta"), (7, "alpha"), (8, None), (9, "")]
    names = ("term", "n", "tf", "item", "score", "rank", "task")
    got = lexical.search(spark.createDataFrame(docs, DOCS).withColumns({c: F.lit("1") for c in names}),
                         spark.createDataFrame(items, ITEMS).withColumns({c: F.lit(1) for c in names}))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


@pytest.mark.parametrize("docs, items", [([], []), ([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == []
