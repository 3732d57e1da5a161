import numpy as np
import pytest

from heatline.llm import neighbours


def brute(rows, cosine=0.93):
    """rows: [(vec_id, vector, label)] with distinct ids and usable vectors; {id: (n_links, component)}."""
    ids = np.array([r[0] for r in rows])
    v = np.array([r[1] for r in rows], np.float64)
    v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
    label = np.array([r[2] for r in rows])
    near = (v @ v.T >= cosine) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    component = ids.copy()
    while True:
        new = np.array([min(component[i], component[near[i]].min(initial=component[i])) for i in range(len(ids))])
        if (new == component).all():
            break
        component = new
    return {int(i): (int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1), component)}, near


def planted(rng, n, noise, dim=64):
    rows = []
    for k in range(n):
        base, size = rng.normal(size=dim), int(rng.integers(1, 8))
        rows += [(len(rows) + j, (base + rng.normal(size=dim) * noise * j / 4).astype(np.float32).tolist(), k % 3)
                 for j in range(size)]
    base = rng.normal(size=dim)
    rows += [(len(rows) + j, (base + rng.normal(size=dim) * 0.05).astype(np.float32).tolist(), 1) for j in range(150)]
    rows += [(len(rows) + j, base.astype(np.float32).tolist(), 1) for j in range(80)]
    return rows


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_links_are_right_and_nearly_all_found(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "PART", 32)
    rows = planted(np.random.default_rng(1), 250, 0.25)
    want, near = brute(rows)
    got = {r.vec_id: r for r in neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == len(rows)
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    found = sum(r.n_links for r in got.values())
    assert found >= 0.95 * near.sum()
    assert np.mean([got[i].component_id == c for i, (_, c) in want.items()]) > 0.95
    assert all(got[i].component_id >= c for i, (_, c) in want.items())


def test_close_copies_are_all_found(spark):
    rows = planted(np.random.default_rng(2), 100, 0.05)
    want, _ = brute(rows)
    got = neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_on_the_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()]
    want, near = brute(rows, 0.4)
    got = neighbours.near_duplicates(spark.createDataFrame(rows, SCHEMA), cosine=0.4, recall=0.95).collect()
    assert near.sum() > 100 and sum(r.n_links for r in got) >= 0.9 * near.sum()


def test_edge_cases(spark):
    one, nan, inf = [1.0, 2.0], float("nan"), float("inf")
    rows = [(1, one, 1, 0), (2, [2.0, 4.0], 1, 0), (2, [2.0, 4.0], 1, 0), (3, one, 2, 0), (4, one, None, 0), (5, None, 1, 0),
            (6, [], 1, 0), (7, [0.0, 0.0], 1, 0), (8, [1.0, nan], 1, 0), (9, [1.0, inf], 1, 0), (10, [1.0, None], 1, 0),
            (None, one, 1, 0), (11, [1.0, 2.0, 0.0], 1, 0), (12, one, 1, 0), (13, [1e38, 2e38], 1, 0)]
    df = spark.createDataFrame(rows, SCHEMA + ", component_id int")
    got = neighbours.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got}
    assert by[1] == (3, 1, True) and by[2] == (3, 1, False) and by[12] == (3, 1, False) and by[13] == (3, 1, False)
    for i in (3, 4, 5, 6, 7, 8, 9, 10, 11):
        assert by[i] == (0, i, True)
    assert by[None] == (0, None, True)
    assert neighbours.near_duplicates(df.where("false")).count() == 0


@pytest.mark.parametrize("distance", [0.2, 0.374, 1.3])
def test_collision_chance(distance):
    rng = np.random.default_rng(0)
    a, b = rng.normal(size=200_000) * distance, rng.uniform(0, 2, 200_000)
    seen = (np.floor(b / 2) == np.floor((a + b) / 2)).mean()
    assert abs(seen - neighbours.collision(distance)) < 0.01
