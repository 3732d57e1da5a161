import numpy as np
import pytest
from pyspark.sql import functions as F

from heatline.operators import anomaly
from heatline.plans.catalog import QUERIES

SCHEMA = "step bigint, series string, prediction double"


def rows(spark, values, series="a"):
    return spark.createDataFrame([(i, series, float(v)) for i, v in enumerate(values)], SCHEMA)


def flags(df, **options):
    tagged = anomaly.tag_anomalies(df, **options).orderBy("step").collect()
    return np.array([r.isAnomaly for r in tagged])


def brute_force(values, radii):
    """Straight from the definition, on the values themselves."""
    values = np.asarray(values, float)
    gap = np.abs(values[:, None] - values[None, :])
    flagged = np.zeros(len(values), bool)
    for r in radii:
        na = (gap <= 0.5 * r).sum(axis=1)
        for i in range(len(values)):
            around = na[gap[i] <= r]
            m, s = around.mean(), around.std()
            flagged[i] |= m >= 20 and m - na[i] > 3 * s * (1 + 1e-12) + 1e-9
    return flagged


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(11)
    return np.concatenate([rng.normal(30, 4, 300).clip(0, 100), [71, 72, 95, 99, 2]])


def every_radius(x):
    gaps = np.unique(np.abs(x[:, None] - x[None, :]))
    return np.unique(np.concatenate([gaps, 2 * gaps]))[1:]


@pytest.mark.parametrize("resolution", [0.5, 2.0])
def test_equals_the_definition_at_every_radius(spark, values, resolution):
    x = np.floor(values / resolution)
    want = brute_force(x, every_radius(x))
    assert want.sum() > 0
    assert (flags(rows(spark, values), resolution=resolution) == want).all()


def test_bins_come_close_to_the_values_themselves(spark, values):
    got = flags(rows(spark, values))
    assert (got == brute_force(values, every_radius(values)[::40])).mean() > 0.97 and got[-5:-1].all()


def test_finest_bins_give_the_flags_of_the_values(spark, tables):
    """Against the definition on the unbinned values, at every distance of two of them and twice that."""
    got = {}
    for r in QUERIES["anomalies_finest"](spark, tables).collect():
        got.setdefault(r.series, []).append((r.prediction, r.isAnomaly))
    total = 0
    for pairs in got.values():
        values, flags = map(np.array, zip(*pairs))
        gap = np.abs(values[:, None] - values[None, :])
        radii, want = np.unique(np.round(np.concatenate([gap.ravel(), 2 * gap.ravel()]), 9))[1:], np.zeros(len(values), bool)
        order = np.sort(values)
        for r in radii + 1e-7:
            na = np.searchsorted(order, order + r / 2, "right") - np.searchsorted(order, order - r / 2, "left")
            low, high = np.searchsorted(order, order - r, "left"), np.searchsorted(order, order + r, "right")
            run1, run2 = np.concatenate(([0], np.cumsum(na))), np.concatenate(([0], np.cumsum(na * na)))
            n, s1, s2 = high - low, run1[high] - run1[low], run2[high] - run2[low]
            want |= (s1 >= 20 * n) & (s1 > na * n) & ((s1 - na * n) ** 2 > 9 * (s2 * n - s1 * s1))
        assert (flags == want[np.searchsorted(order, values)]).all()
        total += want.sum()
    assert total == 65


def test_a_table_of_the_axis_and_a_search_give_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(-5000, 5000, 700))
    table = anomaly.Neighbourhoods(x)
    search = anomaly.Neighbourhoods(x)
    search.table = None
    for reach in (0, 1, 17, 4000, 9999, 30000):
        assert all((a == b).all() for a, b in zip(table.edges(reach), search.edges(reach)))
    assert table.table is not None and anomaly.Neighbourhoods(np.array([0, 1, 10**12])).table is None
    far = np.array([0, 3, 10**9])
    dealt = sorted(r for b in range(3) for r in anomaly.radii_of(far, 0.5, b, 3))
    assert dealt == anomaly.critical_radii(far).tolist()


def test_few_radii_are_summed_and_the_flags_are_those_of_all(monkeypatch):
    """Fine bins, also with so many rows that fourth and third powers of them pass 64 bits."""
    rng, summed, real = np.random.default_rng(8), [], anomaly.Counts.at
    monkeypatch.setattr(anomaly.Counts, "at", lambda self, r: summed.append(r) or real(self, r))
    x, c = np.unique(np.floor(np.concatenate([rng.exponential(20, 900), [230, 231, 400]]) / 0.05).astype(int), return_counts=True)
    for copies in (1, 100, 3000):
        summed.clear()
        radii = anomaly.radii_of(x, 0.5, 0, 1)
        got = anomaly.flagged_bins(x, c * copies, radii)
        assert len(summed) < len(radii) / 5 and 0 < got.sum() < len(x)
        want = np.zeros(len(x), bool)
        for r in radii:
            near = [np.searchsorted(x, x + s * w, side) for w in (r // 2, r) for s, side in ((1, "right"), (-1, "left"))]
            na = anomaly.within(c * copies, *near[:2])
            n, s1, s2 = (anomaly.within(v, *near[2:]) for v in (c * copies, c * copies * na, (c * copies * na).astype(object) * na))
            gap = (s1 - na * n).astype(object)
            want |= ((s1 >= 20 * n) & (gap > 0) & (gap * gap > 9 * (s2 * n - s1.astype(object) ** 2))).astype(bool)
        assert (got == want).all()


def test_a_far_stray_hides_no_other(spark, values):
    alone, joined = flags(rows(spark, values)), flags(rows(spark, np.append(values, 1e6)))
    assert joined[-1] == 1 and (joined[:-1] >= alone).mean() > 0.99 and joined[:-1].sum() >= alone.sum() - 3


def test_no_value_or_no_number(spark):
    df = spark.createDataFrame([(i, "a", v) for i, v in enumerate([5.0, None, float("nan"), float("inf"), -3.0])], SCHEMA)
    got = {r.step: r.isAnomaly for r in anomaly.tag_anomalies(df).collect()}
    assert got == {0: 0, 1: None, 2: None, 3: None, 4: 0}


def counted(spark, values, copies):
    """Flag of each value, all of its copies alike."""
    df = rows(spark, values).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    got = anomaly.tag_anomalies(df, resolution=1.0).groupBy("step").agg(
        F.min("isAnomaly").alias("low"), F.max("isAnomaly").alias("high")).orderBy("step").collect()
    assert len(got) == len(values) and all(r.low == r.high for r in got)
    return [bool(r.high) for r in got]


@pytest.mark.parametrize("copies", [1, 60, 200])
def test_one_rule_at_all_sizes(spark, values, copies):
    # 305, 18,300 and 61,000 rows: below and beyond what 64 bits hold
    x = np.floor(values)
    assert counted(spark, values, copies) == list(brute_force_weighted(x, copies, every_radius(x)))


def brute_force_weighted(x, copies, radii):
    gap = np.abs(x[:, None] - x[None, :])
    flagged = np.zeros(len(x), bool)
    for r in radii:
        na = (gap <= 0.5 * r).sum(axis=1) * copies
        for i in range(len(x)):
            around = na[gap[i] <= r]
            m, s = around.mean(), around.std()
            flagged[i] |= m >= 20 and m - na[i] > 3 * s * (1 + 1e-12) + 1e-9
    return flagged


def test_critical_radii():
    x = np.array([0, 1, 5, 1_000_000])
    assert anomaly.critical_radii(x).tolist() == sorted(
        {1, 4, 5, 999_995, 999_999, 1_000_000} | {2, 8, 10, 1_999_990, 1_999_998, 2_000_000})


def test_quiet_series_have_no_outliers(spark):
    assert flags(rows(spark, [5.0] * 50)).sum() == 0
    assert flags(rows(spark, [1, 2, 90])).sum() == 0        # fewer than 20 neighbours
    assert flags(rows(spark, [5.0])).sum() == 0


def test_series_do_not_mix(spark, values):
    both = rows(spark, values).unionAll(rows(spark, values + 500, "b").withColumn(
        "step", F.col("step") + 1000))
    alone = flags(rows(spark, values))
    assert (flags(both) == np.concatenate([alone, alone])).all()


@pytest.mark.parametrize("width", [24, 4096])
def test_sharp_rises(spark, width):
    y = np.random.default_rng(2).normal(20, 1, 200)
    y[150] = 40
    df = spark.createDataFrame([(i, "a", float(v)) for i, v in enumerate(y)],
                               "idx bigint, series string, y double")
    got = anomaly.sharp_rises(df, width=width).orderBy("idx").collect()
    assert [r.idx for r in got] == list(range(24, 200))
    want = [int(y[i] > y[i - 24:i].mean() + 3 * y[i - 24:i].std()) for i in range(24, 200)]
    assert [r.rise for r in got] == want and want[150 - 24] == 1
