import math
import re
from collections import Counter, defaultdict

import compare
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from heatline.llm import mixing


@pytest.fixture(scope="module")
def skewed(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    return docs.where("doc_id % 5 = 0 or source = 'src0'").limit(1500).withColumn(
        "source", F.expr("case when doc_id % 3 = 0 then 'src0' when doc_id % 7 = 0 then null else source end"))


def brute_exponent(tokens, entropy, most):
    total, n = sum(tokens.values()), len(tokens)

    def flat(a):
        p = [t / total for t in tokens.values()]
        z = sum(x ** a for x in p)
        h = -sum(x ** a / z * math.log(x ** a / z) for x in p)
        return h > entropy * math.log(n) or (max(p) / min(p)) ** (1 - a) > most

    low, high = 0.0, 1.0
    for _ in range(42):
        mid = (low + high) / 2
        low, high = (mid, high) if flat(mid) else (low, mid)
    return high


@pytest.mark.parametrize("entropy,most", [(0.9995, 2.0), (0.95, 50.0), (1.5, 3.5)])
def test_weights_and_uses(spark, skewed, entropy, most):
    rows = skewed.collect()
    tokens, own = Counter(), defaultdict(list)
    for r in rows:
        n = max(1, len(re.findall(r"[^\x20\x09-\x0D]+", r.text)))
        tokens[r.source or ""] += n
        own[r.source or ""].append((r.doc_id, n))
    alpha = brute_exponent(tokens, entropy, most)
    got = mixing.mix(skewed, entropy=entropy, most_epochs=most, block_tokens=4096).collect()
    used = defaultdict(Counter)
    for r in got:
        used[r.source][r.doc_id] += 1
    biggest = max(tokens.values())
    for src, t in tokens.items():
        budget = t * (biggest / t) ** (1 - alpha)
        assert set(used[src]) == {d for d, _ in own[src]}
        assert max(used[src].values()) - min(used[src].values()) <= 1
        longest = max(n for _, n in own[src])
        spent = sum(r.tokens for r in got if r.source == src)
        assert budget - 1 <= spent <= budget + longest + 1
        assert max(used[src].values()) <= math.ceil(most + 1e-9)
    places = defaultdict(list)
    for r in got:
        places[r.block].append(r.place)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    copies = Counter(r.doc_id for r in mixing.repeat(skewed, entropy=entropy, most_epochs=most).collect())
    assert copies == Counter(r.doc_id for r in got)


def test_small_buckets_change_nothing(spark, skewed, monkeypatch):
    key = ["doc_id", "epoch", "block", "place"]
    whole = sorted(tuple(r[k] for k in key) for r in mixing.mix(skewed, block_tokens=4096).collect())
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    assert sorted(tuple(r[k] for k in key) for r in mixing.mix(skewed, block_tokens=4096).collect()) == whole


def test_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    text, _, n = compare.differences(entry.queries()["op1_mixing"](spark, folder), compare.connect(folder),
                                     entry.oracle_sql()["op1_mixing"])
    assert not text and n >= 1000


def test_edge_cases(spark):
    rows = [(1, None, None, 5), (2, "", "a", 5), (2, "", "a", 5), (None, "x y", "a", 5), (3, "w " * 100_000, "b", 5), (4, "x", "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, block int")
    got = mixing.mix(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r.doc_id for r in mixing.repeat(docs).collect())
    assert {r.doc_id for r in got} == {1, 2, 3, 4, None}
    assert mixing.repeat(docs).columns == docs.columns
    assert mixing.mix(docs.where("false")).count() == 0 and mixing.repeat(docs.where("false")).count() == 0


def test_no_python_in_the_plan(skewed):
    for df in (mixing.mix(skewed), mixing.repeat(skewed)):
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().toString())


def test_ties_stay_within_the_budget(spark):
    """Sources whose rows share id, source and number of tokens, and in two of them the text too."""
    kinds = {"none": (lambda i: None, lambda i: "one two"), "texts": (lambda i: None, lambda i: f"a{i} b"), "seven": (lambda i: 7, lambda i: "one two")}
    rows = [(ids(i), texts(i), name, {"k": i}) for name, (ids, texts) in kinds.items() for i in range(300)]
    rows += [(10_000 + i, "one two", "large", {}) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra map<string,int>")
    mixed = Counter(r.source for r in mixing.mix(docs, entropy=0.97).select("source").collect())
    got = mixing.repeat(docs, entropy=0.97).select("text", "source").collect()
    assert Counter(r.source for r in got) == mixed and all(mixed[name] not in (300, 600) for name in kinds)
    assert {tuple(r) for r in got} == {(r[1], r[2]) for r in rows}
