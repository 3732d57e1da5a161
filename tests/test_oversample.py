import numpy as np
import pytest

from heatline.operators import oversample as O

SCHEMA = "id long, label int, vec array<double>"


def brute(vecs, k):
    far = ((vecs[:, None, :] - vecs[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(far, np.inf)
    return np.argsort(far, axis=1, kind="stable")[:, :k]


def test_small_classes_are_searched_exactly(spark):
    rng = np.random.default_rng(0)
    vecs = rng.normal(size=(300, 8))
    got = {r.id: r.near for r in O.nearest(spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(vecs)], SCHEMA)).collect()}
    assert got == {i: n.tolist() for i, n in enumerate(brute(vecs, 5))}


def test_recall_of_large_classes(spark):
    """Five thousand rows around two hundred centres, and as many spread evenly, in one class each."""
    rng = np.random.default_rng(1)
    clustered = rng.normal(size=(200, 16))[rng.integers(0, 200, 5000)] * 4 + rng.normal(size=(5000, 16)) * 0.3
    spread = rng.normal(size=(5000, 16))
    rows = [(i, 0, v.tolist()) for i, v in enumerate(clustered)] + [(10_000 + i, 1, v.tolist()) for i, v in enumerate(spread)]
    got = {r.id: set(r.near) for r in O.nearest(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(got) == 10_000
    for first, vecs in ((0, clustered), (10_000, spread)):
        want = brute(vecs, 5) + first
        assert np.mean([len(got[first + i] & set(n.tolist())) / 5 for i, n in enumerate(want)]) >= 0.9


def test_no_place_is_large(spark):
    """Copies share every projection; they are dealt out by their ids."""
    rows = [(i, 0, [1.0, 2.0]) for i in range(6000)] + [(10_000 + i, 0, [float(i), 0.5]) for i in range(500)]
    places = O.buckets(spark.createDataFrame(rows, SCHEMA), 6500).groupBy("place").count().collect()
    assert max(r["count"] for r in places) < 1.3 * O.MEET


def test_classes_become_equal_and_rows_lie_between(spark):
    rng = np.random.default_rng(2)
    vecs = {i: rng.normal(size=4) for i in range(70)}
    label = {i: 0 if i < 50 else 1 if i < 63 else 2 for i in vecs}
    rows = [(i, label[i], v.tolist(), "x") for i, v in vecs.items()] + [
        (100, None, [1.0] * 4, "x"), (None, 2, [1.0] * 4, "x"), (101, 2, None, "x"), (102, 2, [1.0, None, 0.0, 0.0], "x"), (103, 2, [float("nan")] * 4, "x"),
        (104, 7, [9.0] * 4, "x")]
    got = O.oversample(spark.createDataFrame(rows, "key long, kind int, v array<double>, copy string"), "key", "v", "kind").collect()
    made = {}
    for r in got:
        made[r.label] = made.get(r.label, 0) + 1
        if r.label != 7:
            at = vecs[r.id] + r.weight * (vecs[r.neighbour] - vecs[r.id])
            assert np.allclose(r.vec, at) and 0 <= r.weight < 1 and label[r.neighbour] == r.label and r.neighbour != r.id
    assert made == {1: 37, 2: 43, 7: 49}
    assert all(r.vec == [9.0] * 4 and r.neighbour == 104 for r in got if r.label == 7)
    copies = [sum(1 for r in got if r.id == i) for i in range(50, 63)]
    assert max(copies) - min(copies) <= 1
    assert O.oversample(spark.createDataFrame([], "key long, kind int, v array<float>"), "key", "v", "kind").count() == 0


@pytest.mark.parametrize("n", [1, 2])
def test_equal_classes_need_nothing(spark, n):
    rows = [(i, i % 2, [float(i)]) for i in range(2 * n)]
    assert O.oversample(spark.createDataFrame(rows, SCHEMA), "id", "vec", "label").count() == 0
