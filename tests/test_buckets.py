import datetime as dt

import pytest
from pyspark.sql import functions as F

from heatline.operators import buckets

START = dt.datetime(2024, 1, 1)


def messages(spark, rows):
    return spark.createDataFrame(rows, "timestamp timestamp_ntz, series string, prediction double")


def hourly(spark, n, series="a", gap=None):
    rows = [(START + dt.timedelta(hours=i), series, float(i)) for i in range(n) if i != gap]
    return buckets.bucket_sums(messages(spark, rows), "timestamp", "prediction", 3600)


def test_hour_mean_is_the_weighted_mean_of_minutes(spark):
    rows = [(START + dt.timedelta(seconds=s), "a", v)
            for s, v in [(1, 10.0), (2, 20.0), (70, 90.0), (3700, 5.0)]]
    rows += [(None, "a", 1.0), (START, "a", None), (START, "a", float("nan"))]
    minutes = buckets.bucket_sums(messages(spark, rows), "timestamp", "prediction", 60)
    got = buckets.bucket_means(buckets.coarser(minutes, 60), 3600).orderBy("timestamp").collect()
    assert [(r.prediction, r.n) for r in got] == [(40.0, 3), (5.0, 1)]


@pytest.mark.parametrize("values,mean", [
    ([1e13, 2.0], 5_000_000_000_001.0), ([1e-9, 3e-9], 2e-9), ([5e12, 6e12], 5.5e12), ([1e300, 1e300], 1e300)])
def test_no_value_is_too_large_or_too_small(spark, values, mean):
    df = messages(spark, [(START, "a", v) for v in values])
    got = buckets.bucket_means(buckets.bucket_sums(df, "timestamp", "prediction", 60), 60).first()
    assert got.prediction == pytest.approx(mean, rel=1e-12) and got.n == len(values)


def test_rejected_rows_are_counted(spark):
    rows = [(None, "a", 1.0), (START, "a", None), (START, "a", float("nan")), (START, "a", float("inf")), (START, "a", 2.0)]
    assert tuple(buckets.rejected(messages(spark, rows), "timestamp", "prediction").first()) == ("a", 1, 1, 2)


@pytest.mark.parametrize("fill,expected", [
    ("forward", [0.0, 1.0, 1.0, 3.0]), ("zero", [0.0, 1.0, 0.0, 3.0]),
    ("null", [0.0, 1.0, None, 3.0]), ("none", [0.0, 1.0, 3.0])])
def test_dense_series(spark, fill, expected):
    got = buckets.dense_series(hourly(spark, 4, gap=2), fill).orderBy("idx").collect()
    assert [r.y for r in got] == expected
    assert [r.idx for r in got] == list(range(len(expected)))


def test_grid_crosses_blocks(spark):
    n = buckets.GRID_BLOCK * 2 + 5
    spans = spark.createDataFrame([("a", 4090, 4090 + n - 1)],
                                  "series string, first bigint, last bigint")
    got = buckets.grid(spans).agg(F.min("step"), F.max("step"), F.count("*"), F.count_distinct("step"))
    assert tuple(got.first()) == (4090, 4090 + n - 1, n, n)


def test_dense_series_over_a_long_gap(spark):
    n = buckets.GRID_BLOCK * 2 + 5
    sums = spark.createDataFrame(
        [("a", 4000, 4.0, 2), ("a", 4000 + n, 5.0, 1), (None, 7, 1.0, 1)],
        "series string, step bigint, total double, n bigint")
    got = buckets.dense_series(sums).orderBy(F.col("series").desc(), "idx").collect()
    assert [tuple(r) for r in got] == [("a", i, 4000 + i, 2.0 if i < n else 5.0)
                                       for i in range(n + 1)] + [(None, 0, 7, 1.0)]


@pytest.mark.parametrize("n", [1, 7, 8, 25, 26, 30])
def test_holdout_is_contiguous_and_complete(spark, n):
    parts = buckets.holdout(buckets.dense_series(hourly(spark, n))).orderBy("idx").collect()
    test = int(n * 0.25)
    assert [r.part for r in parts] == ["train"] * (n - test) + ["test"] * test
    assert [r.h for r in parts if r.part == "test"] == list(range(1, test + 1))


@pytest.mark.parametrize("n,horizon", [(4, 0), (7, 0), (8, 2), (26, 6)])
def test_forecast_axis_offsets_every_row(spark, n, horizon):
    ends = buckets.series_ends(buckets.dense_series(hourly(spark, n)))
    got = buckets.forecast_axis(ends).orderBy("h").collect()
    last = START + dt.timedelta(hours=n - 1)
    assert [r.timestamp for r in got] == [last + dt.timedelta(hours=h)
                                          for h in range(1, horizon + 1)]


def test_synthetic_axis_of_hashed_ids(spark):
    df = spark.range(3000).select(F.xxhash64("id").alias("doc_id"))
    got = [r.doc_id for r in buckets.synthetic_axis(df, "doc_id").orderBy("timestamp").collect()]
    assert got == sorted(got) and len(got) == 3000


def test_synthetic_axis_offsets_every_row(spark):
    df = spark.createDataFrame([(5, "a"), (9, "b"), (700_000, "c")], "doc_id bigint, text string")
    got = buckets.synthetic_axis(df, "doc_id").orderBy("doc_id").collect()
    begin = dt.datetime(2018, 4, 13, 10, 31, 30)
    assert [r.timestamp for r in got] == [begin + dt.timedelta(hours=i) for i in (1, 2, 3)]
