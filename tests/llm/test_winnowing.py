import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from heatline.llm import winnowing

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + m]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, names = words(text), set(), set()
        for span, own in windows.items():
            for i in range(len(w) - len(span) + 1):
                if tuple(w[i:i + len(span)]) == span:
                    hit |= set(range(i, i + len(span)))
                    names |= own
        listed = sorted(str(n) for n in names if n is not None)
        out.append((doc, len(w), len(hit), len(listed), hashlib.sha256(",".join(listed).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items):
    got = winnowing.contaminated(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_equals_brute_force_with_few_words(spark):
    """Seven words only, so that windows overlap, repeat, and share k-grams; items from one word up."""
    rng = random.Random(5)
    said = lambda n, k=2: " ".join(rng.choice("abcdefg"[:k]) for _ in range(n))
    items = [(i, said(n)) for i, n in enumerate([11, 14, 10, 25, 12, 13])] + [(20, said(9, 3)), (21, said(4, 5)), (22, "g")]
    docs = [(i, said(rng.randrange(0, 60), rng.choice([2, 3, 5, 6]))) for i in range(40)]
    assert run(spark, docs, items) == brute(docs, items)


def test_shared_beginnings_and_copies(spark):
    """Many items begin alike, many documents hold that beginning; copies of items and documents."""
    start = "please answer the following question with one word only now and here"
    items = [(i, f"{start} w{i} x{i} y{i} z{i}") for i in range(60)] + [(100 + i, f"{start} w3 x3 y3 z3") for i in range(5)]
    docs = [(i, f"intro {i} {start} w{i % 7} x{i % 7} none") for i in range(30)] + [(50, start.upper()), (51, start), (51, start)]
    assert run(spark, docs, items) == brute(docs, items)


def test_words_and_case(spark):
    passage = "One1 two-TWO three été ÉTÉ Straße ΑΣ.Α six seven eight nine ten"
    items = [(7, passage), (8, "!!! ,")]
    docs = [(1, "x " + passage.replace(" ", "\x00\n")), (2, passage.lower()), (3, passage.upper()), (4, passage.replace("-", "")),
            (5, "pre" + passage), (6, passage + "post")]
    assert run(spark, docs, items) == brute(docs, items)


def test_long_text(spark):
    rng = random.Random(1)
    passage = " ".join(f"p{k}" for k in range(40))
    filler = " ".join(f"f{rng.randrange(5000)}" for _ in range(60000))
    docs = [(1, filler + " " + passage + " " + filler), (2, " ".join(["same"] * 30000))]
    items = [(1, passage), (2, "same " * 12)]
    got = run(spark, docs, items)
    assert [(r[0], r[2], r[3]) for r in got] == [(1, 40, 1), (2, 30000, 1)]


def test_nulls_repeats_and_clashing_columns(spark):
    passage = "a b c d e f g h i j k"
    docs = [(1, None), (2, ""), (None, passage), (3, passage), (3, passage), (4, "a b c d e f g h i x")]
    items = [(None, passage), (5, None), (6, ""), (9, passage), (9, passage), (10, passage)]
    names = ("key", "marks", "window", "code", "said", "seen", "n_words", "bits")
    got = winnowing.contaminated(spark.createDataFrame(docs, DOCS).withColumns({c: F.lit(1) for c in names}),
                                 spark.createDataFrame(items, ITEMS).withColumns({c: F.lit(1) for c in (*names, "found", "m", "item")}))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items)


@pytest.mark.parametrize("docs, items", [([], []), ([], [(1, "a b c")]), ([(1, "a b c"), (2, None)], []), ([(1, "a b c")], [(1, None)])])
def test_empty_tables(spark, docs, items):
    assert run(spark, docs, items) == brute(docs, items)


def test_no_python_in_the_plan(spark, tables, capsys):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    winnowing.contaminated(docs, spark.read.parquet(f"{tables}/benchmark.parquet")).explain()
    assert "Python" not in capsys.readouterr().out
