"""Means per minute, hour or any fixed step, and regular time grids."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatline.constants import FORECAST_SHARE, SYNTHETIC_AXIS_START
from heatline.functions.values import finite, plain_timestamp, step_of, step_start
from heatline.operators.slices import neighbours, row_index, sized

MINUTE, HOUR, DAY = 60, 3600, 86_400
GRID_BLOCK = 4096


def bucket_sums(df: DataFrame, ts: str, value: str, seconds: int, series="series") -> DataFrame:
    """(series, step, total, n): partial sums that can be added up to coarser steps.

    `total` is a double, so no value is too large or too small for it; how partial sums meet decides
    its last bits. NULL times, NULL and non-finite values are dropped before grouping (`rejected`
    counts them).
    """
    return (df.where(F.col(ts).isNotNull())
            .select(F.col(series), step_of(F.col(ts), seconds).alias("step"), finite(F.col(value)).alias("_value"))
            .where(F.col("_value").isNotNull())
            .groupBy(series, "step")
            .agg(F.sum("_value").alias("total"), F.count("*").alias("n")))


def rejected(df: DataFrame, ts: str, value: str, series="series") -> DataFrame:
    """(series, no_time, no_value, not_finite): rows that `bucket_sums` leaves out, by reason."""
    known = F.col(value).isNotNull()
    return (df.groupBy(series).agg(
        F.count_if(F.col(ts).isNull()).alias("no_time"), F.count_if(F.col(ts).isNotNull() & ~known).alias("no_value"),
        F.count_if(F.col(ts).isNotNull() & known & finite(F.col(value)).isNull()).alias("not_finite")))


def coarser(sums: DataFrame, factor: int, series="series") -> DataFrame:
    """Add partial sums up to steps `factor` times as long."""
    return (sums.withColumn("step", F.floor(F.col("step") / factor).cast("bigint"))
            .groupBy(series, "step")
            .agg(F.sum("total").alias("total"), F.sum("n").alias("n")))


def mean_of(total="total", n="n") -> Column:
    return F.col(total) / F.col(n)


def bucket_means(sums: DataFrame, seconds: int, series="series") -> DataFrame:
    """(series, timestamp, prediction, n) from partial sums."""
    return sums.select(series, step_start(F.col("step"), seconds).alias("timestamp"),
                       mean_of().alias("prediction"), "n")


def step_series(sums: DataFrame, series="series") -> DataFrame:
    """(series, idx, step, y): the steps that have data, numbered in order.

    Empty steps are absent, so neighbours may be more than one step apart.
    """
    return row_index(sums.select(series, "step", mean_of().alias("y")), [series], "step")


def grid(spans: DataFrame) -> DataFrame:
    """Replace `first`, `last` of each row in `spans` by every `step` between them.

    In blocks of steps, so that no row holds a long list.
    """
    block = F.sequence(F.floor(F.col("first") / GRID_BLOCK), F.floor(F.col("last") / GRID_BLOCK))
    start = F.col("_block") * GRID_BLOCK
    steps = F.sequence(F.greatest("first", start), F.least("last", start + GRID_BLOCK - 1))
    return (spans.withColumn("_block", F.explode(block)).withColumn("step", F.explode(steps))
            .drop("_block", "first", "last"))


def dense_series(sums: DataFrame, fill="forward", series="series") -> DataFrame:
    """(series, idx, step, y) with a row for every step between the first and the last one.

    fill: `forward` repeats the latest mean, `zero` puts 0, `null` leaves gaps empty and `none`
    leaves the empty steps out altogether. Each step with data emits itself and the empty steps
    after it, so only steps with data are shuffled.
    """
    if fill == "none":
        return step_series(sums, series)
    if fill not in ("forward", "zero", "null"):
        raise ValueError(f"unknown fill {fill!r}")
    rows = sums.select(series, F.col("step").alias("first"), mean_of().alias("y"))
    spans = (neighbours(rows, [series], "first")
             .withColumn("last", F.coalesce(F.col("next") - 1, F.col("first")))
             .select(series, "first", "last", "origin", "y", F.col("first").alias("_has")))
    y = F.col("y")
    if fill != "forward":
        y = F.when(F.col("step") == F.col("_has"), y).otherwise(
            F.lit(0.0 if fill == "zero" else None).cast("double"))
    return grid(spans).select(series, (F.col("step") - F.col("origin")).alias("idx"), "step",
                              y.alias("y"))


def synthetic_axis(messages: DataFrame, key: str, start=SYNTHETIC_AXIS_START) -> DataFrame:
    """Row i (0-based, by key) gets `start` + (i + 1) hours, the last row too."""
    begin = F.unix_seconds(F.lit(start).cast("timestamp"))
    return (row_index(messages, [], key, levels=3)
            .withColumn("timestamp", plain_timestamp(
                F.timestamp_seconds(begin + (F.col("idx") + 1) * HOUR))))


def series_ends(rows: DataFrame, share=FORECAST_SHARE, series="series") -> DataFrame:
    """(series, n, horizon, last_step, last_y): length, forecast horizon and last observation."""
    return (rows.groupBy(series)
            .agg(F.count("*").alias("n"), F.max("step").alias("last_step"),
                 F.max_by("y", "step").alias("last_y"))
            .withColumn("horizon", F.floor(F.col("n") * share).cast("bigint")))


def forecast_axis(ends: DataFrame, seconds=HOUR, minimum=2, series="series") -> DataFrame:
    """(series, h, timestamp): h = 1..horizon after the last step, where the horizon is worth it."""
    spans = (ends.where(F.col("horizon") >= minimum)
             .select(series, "last_step", F.lit(1).cast("bigint").alias("first"),
                     F.col("horizon").alias("last")))
    when = step_start(F.col("last_step") + F.col("step"), seconds)
    return grid(spans).select(series, F.col("step").alias("h"), when.alias("timestamp"))


def holdout(rows: DataFrame, share=FORECAST_SHARE, series="series") -> DataFrame:
    """Mark the last floor(n * share) rows of each series `test`, all others `train`."""
    test = F.col("idx") >= F.col("n") - F.col("horizon")
    return (sized(rows, [series], "idx")
            .withColumn("horizon", F.floor(F.col("n") * share).cast("bigint"))
            .withColumn("part", F.when(test, "test").otherwise("train"))
            .withColumn("h", F.when(test, F.col("idx") - (F.col("n") - F.col("horizon")) + 1)))
