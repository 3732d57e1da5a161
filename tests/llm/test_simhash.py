import numpy as np
import pytest
import xxhash

from heatline.llm import simhash


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=4):
    """prints: {id: fingerprint}; smallest id reachable."""
    ids = np.array(sorted(prints))
    fp = np.array([prints[i] for i in ids.tolist()], np.uint64)
    label = np.arange(len(ids))
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= distance
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            return dict(zip(ids.tolist(), ids[label].tolist()))
        label = new


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    want = {r.doc_id: brute_fingerprint(r.text) for r in docs.select("doc_id", "text").collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == want
    assert {i: r.component_id for i, r in got.items()} == brute_components(want)


def test_every_link_is_found_whatever_the_bucket_sizes(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    rows = {}
    for k, c in enumerate(centres.tolist()):
        for j in range(400 if k == 0 else 4):
            x = c
            for b in rng.integers(0, 64, rng.integers(0, 6)).tolist():
                x ^= 1 << b
            rows[len(rows)] = x
    unique = {}
    for i, x in rows.items():
        unique.setdefault(x, i)
    signed = [(int(np.uint64(x).view(np.int64)), i) for x, i in unique.items()]
    from heatline.llm.graph import components
    links = simhash.links(spark.createDataFrame(signed, "fp long, rep long"))
    got = {i: i for i in unique.values()} | {r.node: r.component for r in components(links).collect()}
    assert got == brute_components({i: x for x, i in unique.items()})


def test_ring_covers_every_pattern_of_four_bits():
    ring = simhash.Ring(4)
    rng = np.random.default_rng(0)
    for _ in range(3000):
        x = 0
        for b in rng.choice(64, rng.integers(0, 5), replace=False).tolist():
            x |= 1 << b
        found = False
        for t, (i, j) in enumerate(ring.tables):
            if not x & (ring.masks[i] | ring.masks[j]):
                found |= bool(ring.linked(np.array([x], np.uint64), t)[0])
        assert found


def test_edge_cases(spark):
    long = "w" * 300_000 + " x y z"
    rows = [(1, None, 5), (2, "", 5), (3, " \t\n", 5), (4, "One Two", 5), (5, "one two", 5), (5, "one two", 5),
            (None, "one two", 5), (6, long, 5), (7, long, 5), (8, "É é", 5), (9, "é É", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int").withColumnRenamed("fp", "fingerprint")
    got = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    assert by[1].fingerprint == "0" * 16 and by[3].component_id == 1
    assert by[5].component_id == 4 and by[7].component_id == 6
    assert by[None].component_id is None and by[8].fingerprint != by[9].fingerprint
    assert simhash.near_duplicates(docs.where("false")).count() == 0


@pytest.mark.parametrize("text", ["a b c d e", "A\x0bB\x1cC", "x", "ÀB c d"])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) & (2**64 - 1) == brute_fingerprint(text)


def kept(spark, rows, schema="doc_id long, text string"):
    return sorted((tuple(r)[:2] for r in simhash.keep_one(spark.createDataFrame(rows, schema)).collect()), key=str)


def test_one_row_of_each_group_stays(spark):
    a, b = (" ".join(f"{p}{k}" for k in range(60)) for p in "ab")
    assert kept(spark, [(5, a), (5, b), (2, a), (9, b)]) == [(2, a), (5, b)]
    assert kept(spark, [(5, a), (5, b)]) == [(5, a), (5, b)]
    assert kept(spark, [(5, a), (5, a), (6, a)]) == [(5, a)]
    assert kept(spark, [(1, a), (2, b), (3, a), (4, None), (7, ""), (None, a), (None, a)]) == sorted(
        [(1, a), (2, b), (4, None), (None, a), (None, a)], key=str)
    assert kept(spark, []) == []


def test_kept_rows_keep_any_column(spark):
    text = "some words that are said here and again"
    schema = "doc_id long, text string, extra map<string,int>, id int, fp string, several int, root array<int>, c0 int"
    rows = [(i, text if i < 4 else f"other {i}", {"k": i}, 7, "f", 8, [i], 9) for i in (1, 2, 2, 3, 4)]
    got = simhash.keep_one(spark.createDataFrame(rows, schema))
    assert got.schema.simpleString() == spark.createDataFrame(rows, schema).schema.simpleString()
    assert sorted(tuple(r) for r in got.collect()) == [rows[0], rows[4]]
    again = simhash.keep_one(spark.createDataFrame([rows[1], rows[2], rows[4]], schema))
    assert sorted(tuple(r) for r in again.collect()) == [rows[1], rows[4]]
