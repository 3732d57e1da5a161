import numpy as np
import pytest
from pyspark.sql import functions as F

from heatline.llm import whitening
from heatline.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(vectors, most=16):
    """Right singular vectors of the distinct, centred integer vectors, all in one place."""
    x = np.array([[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in vectors])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    _, spread, w = np.linalg.svd(centred, full_matrices=False)
    e, w = spread ** 2 / n, w.T
    real = np.flatnonzero(e > 1e-12 * e[0])[:most]
    return n, ((n * x - sums) ** 2).sum(axis=1), (n * x - sums) / n @ w[:, real] / np.sqrt(e[real]), e[real] / e.sum()


def check(got, vectors, ids, loose=1e-7):
    n, deviation, whitened, explained = brute(vectors)
    k = whitened.shape[1]
    assert len(got) == k * len(vectors)
    found = {}
    for r in got:
        found.setdefault(r.vec_id, {})[r.component] = r
    for c in range(k):
        ours = np.array([found[i][c + 1].whitened for i in ids])
        sign = np.sign(ours @ whitened[:, c])
        assert np.allclose(ours * sign, whitened[:, c], atol=loose)
    for i, dev in zip(ids, deviation):
        for c, row in found[i].items():
            assert (row.n, row.deviation) == (n, dev)
            assert abs(row.explained / explained[c - 1] - 1) < 1e-9 and row.identity_error < 1e-9


def test_whole_table_equals_numpy(spark, tables):
    rows = spark.read.parquet(f"{tables}/embeddings.parquet").orderBy("vec_id").collect()
    got = QUERIES["op11_whitening"](spark, tables).collect()
    check(got, [r.embedding for r in rows], [r.vec_id for r in rows])


def test_ill_conditioned_columns(spark):
    """Spreads from a few units to a hundred thousand, and nearly equal columns."""
    rng = np.random.default_rng(3)
    v = rng.normal(size=(400, 6)) * np.array([1e3, 1e2, 10, 1, 0.1, 0.1])
    v[:, 5] = v[:, 0] + v[:, 5]
    v = v.astype(np.float32).astype(float)
    got = whitening.whiten(spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(v)], SCHEMA)).collect()
    check(got, v, range(len(v)), loose=1e-6)


def test_constant_and_dependent_dimensions_have_no_component(spark):
    rng = np.random.default_rng(4)
    a = rng.integers(-50, 50, size=(100, 2))
    v = np.column_stack([a, a[:, 0] + a[:, 1], np.full(100, 7)]).astype(float)
    got = whitening.whiten(spark.createDataFrame([(i, r.tolist(), 0) for i, r in enumerate(v)], SCHEMA)).collect()
    assert {r.component for r in got} == {1, 2}
    check(got, v, range(len(v)))


def test_unusable_rows_repeats_and_clashing_columns(spark):
    good = [[1.0, 2.0], [2.0, -1.0], [0.5, 0.25], [2.0, -1.0]]
    bad = [None, [], [1.0, None], [float("nan"), 1.0], [float("inf"), 0.0], [3e38, 0.0], [1.0, 2.0, 3.0]]
    data = [(i, v, 0) for i, v in enumerate(good)] + [(None, good[0], 0)] + [(100 + i, v, 1) for i, v in enumerate(bad)]
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit(1) for c in ("x", "n", "component", "vec", "d")})
    got = whitening.whiten(df).collect()
    assert sorted({r.vec_id for r in got if r.vec_id is not None}) == [0, 1, 2, 3] and len(got) == 10
    assert {r.n for r in got} == {3}
    by = {(r.vec_id, r.component): r.whitened for r in got}
    assert by[1, 1] == by[3, 1] and by[None, 2] == by[0, 2]
    check([r for r in got if r.vec_id is not None], good, range(4))


@pytest.mark.parametrize("data", [[], [(1, [1.0, 2.0], 0)], [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], [(1, None, 0)]])
def test_nothing_varies(spark, data):
    assert whitening.whiten(spark.createDataFrame(data, SCHEMA)).collect() == []


def test_sums_beyond_a_long_stay_exact(spark):
    big = float(1 << 50)
    data = [(0, [big, 1.0]), (1, [-big, 2.0]), (2, [0.0, 4.0])]
    got = whitening.whiten(spark.createDataFrame(data, "vec_id long, embedding array<double>")).collect()
    assert {r.deviation for r in got if r.vec_id == 0} == {None} and {r.n for r in got} == {3}
    assert {r.deviation for r in got if r.vec_id == 2} == {(3 * 256 - 64 * 7) ** 2}
