"""Window operators over long series.

A window partitioned by series alone runs a whole series in one task. Here every series is cut into
slices of an integer axis that is unique within the series, so a slice holds a bounded number of
rows however large the series is. Windows run inside slices. What must cross a slice edge travels
as extra rows of the slice: copies of the rows before the edge (`lagged`), or one row with what the
other slices contribute (`running_totals`, `neighbours`). Rows are shuffled once, by series and
slice, and never joined, so a NULL series is a series like any other.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE = 4096
KEY_SLICE = 65_536


def slice_of(axis: Column, width: int) -> Column:
    return F.floor(axis / width).cast("bigint")


def _open_slices(cut: DataFrame, starts: DataFrame, series: list[str], name: str, idx: str):
    """Rows with one start row ahead of each slice, and the window order in which it comes first."""
    stacked = cut.withColumn("_own", F.lit(True)).unionByName(
        starts.withColumn("_own", F.lit(False)), allowMissingColumns=True)
    return stacked, W.partitionBy(*series, name).orderBy("_own", idx)


def running_totals(df: DataFrame, series: list[str], idx: str, columns: list[str], width=SLICE,
                   levels=1) -> DataFrame:
    """Replace each column by its total over the strictly earlier rows of the series.

    Where `idx` is sparse most slices hold few rows and there are many slices; `levels` > 1 adds
    those up in slices too. With slices of 2^16, two levels bound every window for an axis up to
    2^48, three for any axis.
    """
    name = f"_slice{levels}"
    cut = df.withColumn(name, slice_of(F.col(idx), width))
    totals = cut.groupBy(*series, name).agg(*[F.sum(c).alias(c) for c in columns])
    if levels > 1:
        starts = running_totals(totals, series, name, columns, width, levels - 1)
    else:
        earlier = W.partitionBy(*series).orderBy(name).rowsBetween(W.unboundedPreceding, -1)
        starts = totals.select(*series, name, *[F.sum(c).over(earlier).alias(c) for c in columns])
    stacked, order = _open_slices(cut, starts, series, name, idx)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    kept = [c for c in df.columns if c not in columns]
    zero = {c: F.lit(0).cast(t) for c, t in totals.dtypes}
    return (stacked.select("_own", *kept, *[F.coalesce(F.sum(c).over(before), zero[c]).alias(c)
                                            for c in columns])
            .where("_own").select(*df.columns))


def row_index(df: DataFrame, series: list[str], key: str, width=KEY_SLICE, levels=1,
              name="idx") -> DataFrame:
    """0-based position of each row in its series, by the integer `key` (unique in the series)."""
    counted = df.withColumn(name, F.lit(1).cast("bigint"))
    return running_totals(counted, series, key, [name], width, levels)


def neighbours(df: DataFrame, series: list[str], idx: str, width=SLICE) -> DataFrame:
    """Add `next`, the `idx` of the following row (NULL at the end), and `origin`, the first one."""
    cut = df.withColumn("_slice", slice_of(F.col(idx), width))
    whole = W.partitionBy(*series).orderBy("_slice")
    starts = (cut.groupBy(*series, "_slice").agg(F.min(idx).alias("_first"))
              .select(*series, "_slice", F.lead("_first").over(whole).alias("next"),
                      F.first("_first").over(whole).alias("origin")))
    stacked, order = _open_slices(cut, starts, series, "_slice", idx)
    opened = order.rowsBetween(W.unboundedPreceding, 0)
    following = F.coalesce(F.lead(idx).over(order), F.first("next").over(opened))
    return (stacked.select("_own", *df.columns, following.alias("next"),
                           F.first("origin").over(opened).alias("origin"))
            .where("_own").drop("_own"))


def sized(df: DataFrame, series: list[str], idx: str, width=SLICE) -> DataFrame:
    """Add `n`, the number of rows of the series."""
    cut = df.withColumn("_slice", slice_of(F.col(idx), width))
    starts = (cut.groupBy(*series, "_slice").agg(F.count("*").alias("n"))
              .withColumn("n", F.sum("n").over(W.partitionBy(*series))))
    stacked, order = _open_slices(cut, starts, series, "_slice", idx)
    opened = order.rowsBetween(W.unboundedPreceding, 0)
    return (stacked.select("_own", *df.columns, F.first("n").over(opened).alias("n"))
            .where("_own").drop("_own"))


def lagged(df: DataFrame, series: list[str], idx: str, lags: dict, width=SLICE) -> DataFrame:
    """Add columns {name: (column, k)}: the value k rows earlier in the series.

    `idx` must be gapless (`row_index` or a regular grid). The last rows of each slice are copied
    into the next one, so the only shuffle is on (series, slice).
    """
    cut, order = _overlapping(df, series, idx, max(k for _, k in lags.values()), width)
    return (cut.select("*", *[F.lag(c, k).over(order).alias(n) for n, (c, k) in lags.items()])
            .where(F.col("_slice") == F.col("_home"))
            .drop("_slice", "_home"))


def previous(df: DataFrame, series: list[str], idx: str, column: str, depth: int, width=SLICE,
             name="before") -> DataFrame:
    """Add the array of up to `depth` values before the row, the nearest first, as `lagged` does.

    For more lags than columns are good for. Slices are at least `depth` wide.
    """
    cut, order = _overlapping(df, series, idx, depth, max(width, depth))
    rows = F.collect_list(F.struct(F.col(column).alias("value"))).over(order.rowsBetween(-depth, -1))
    return (cut.withColumn(name, F.reverse(rows)["value"])
            .where(F.col("_slice") == F.col("_home")).drop("_slice", "_home"))


def _overlapping(df: DataFrame, series: list[str], idx: str, depth: int, width: int):
    """Rows in slices that begin with copies of the `depth` rows before, and the order inside."""
    if depth > width:
        raise ValueError(f"a lag of {depth} rows does not fit slices of {width}")
    home = slice_of(F.col(idx), width)
    near_end = F.pmod(F.col(idx), F.lit(width)) >= width - depth
    homes = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    cut = df.withColumn("_home", home).withColumn("_slice", F.explode(homes))
    return cut, W.partitionBy(*series, "_slice").orderBy(idx)


def overlapping(df: DataFrame, series: list[str], idx: str, depth: int, width=SLICE) -> DataFrame:
    """Rows by `_slice`, each slice led by copies of the `depth` rows before it; `_home` is a row's own slice.

    For work on whole slices, by (series, _slice). Slices are at least `depth` wide.
    """
    return _overlapping(df, series, idx, depth, max(width, depth))[0]


def last_rows(df: DataFrame, series: list[str], idx: str, n: int) -> DataFrame:
    """The n latest rows of each series. Spark keeps n per task before it shuffles."""
    latest = W.partitionBy(*series).orderBy(F.col(idx).desc())
    return (df.withColumn("_rank", F.row_number().over(latest))
            .where(F.col("_rank") <= n).drop("_rank"))
