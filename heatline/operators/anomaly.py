"""Outliers among the values of a series, and sharp rises in time.

The outlier test is the local correlation integral (Papadimitriou et al., ICDE 2003). For a value x
and a radius r, na(x) counts the values within alpha*r of x; over the values within r of x, let N be
their number and m, s the mean and standard deviation of their na. x is an outlier if for some r
m >= 20 and 1 - na/m > 3 s/m. Time plays no part. Values are binned first, in units of the value; on
the bins the test is exact: every radius at which a count can change is tried, in whole numbers.
"""

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heatline.constants import LOCI_ALPHA, LOCI_K, LOCI_MIN_NEIGHBOURS

RESOLUTION = 0.5
#: Bins times radii that one task takes, and the most tasks of a series.
BLOCK_WORK, MOST_BLOCKS = 1 << 28, 1 << 16


def critical_radii(x: np.ndarray, alpha=LOCI_ALPHA) -> np.ndarray:
    """Radii, in bins, at which some neighbourhood of the sorted filled bins x grows.

    N changes at the distances between bins, na where alpha*r reaches one. Distances are gathered
    bin by bin, so a few far strays add their own and no more.
    """
    seen = [np.zeros(0, np.int64)]
    for i in range(1, len(x)):
        seen.append(x[i:] - x[:-i])
        if len(seen) > 256:
            seen = [np.unique(np.concatenate(seen))]
    gaps = np.unique(np.concatenate(seen))
    return np.unique(np.concatenate([gaps, np.ceil(gaps / alpha).astype(np.int64)]))


def radii_of(x: np.ndarray, alpha: float, block: int, blocks: int) -> Sequence[int]:
    """The block's share, radii in a row, of those that cover every change of a neighbourhood of the sorted filled bins x.

    Between two critical radii nothing changes, so more radii do no harm: where the bins lie close all
    whole numbers up to the last critical one are taken, without gathering distances.
    """
    last = int(np.ceil((x[-1] - x[0]) / alpha)) if len(x) else 0
    if last <= max(len(x) ** 2, 1 << 12):
        return range(1 + last * block // blocks, 1 + last * (block + 1) // blocks)
    radii = critical_radii(x, alpha)
    return radii[len(radii) * block // blocks:len(radii) * (block + 1) // blocks].tolist()


class Neighbourhoods:
    """Places in the sorted bins x between which the bins within a reach of each bin lie.

    Looked up in a table of the axis where that is not much longer than x, else searched for.
    """

    def __init__(self, x: np.ndarray):
        self.x, self.span = x, int(x[-1] - x[0]) if len(x) else 0
        self.at = x - x[0] if len(x) else x
        self.table = None
        if self.span <= max(64 * len(x), 1 << 16):
            self.table = np.concatenate(([0], np.cumsum(np.bincount(self.at, minlength=self.span + 1)))).astype(np.int32)

    def edges(self, reach: int) -> tuple[np.ndarray, np.ndarray]:
        if self.table is None:
            return np.searchsorted(self.x, self.x + reach, "right"), np.searchsorted(self.x, self.x - reach, "left")
        return self.table[np.minimum(self.at + reach, self.span) + 1], self.table[np.maximum(self.at - reach, 0)]


def within(values: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Sums of values[lower:upper]."""
    run = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=run[1:])
    return run[upper] - run[lower]


class Counts:
    """Neighbourhood sums over the sorted filled bins x with counts c, in whole numbers.

    Sums grow like the third power of the rows; they are kept in 64 bits where these hold them and in
    unbounded whole numbers elsewhere, with equal results.
    """

    def __init__(self, x: np.ndarray, c: np.ndarray, alpha: float):
        self.near, self.alpha, self.rows = Neighbourhoods(x), alpha, int(c.sum())
        self.c = c.astype(np.int64 if self.rows ** 3 < 2 ** 63 else object)

    def at(self, r: int) -> tuple:
        """Edges of the radius, na, and over the neighbourhood the number n and the sums of na and its square."""
        edges, na = self.near.edges(r), within(self.c, *self.near.edges(int(self.alpha * r)))
        weighted = self.c * na
        return edges, na, within(self.c, *edges), within(weighted, *edges), within(weighted * na, *edges)


def ruled_out(sums: Counts, low: tuple, high: tuple, k: float, minimum: int) -> np.ndarray:
    """Bins that no radius between two flags, judged by the sums of these two (see `Counts.at`).

    Neighbourhoods grow with the radius: between the two m is at most s1(high) / n(low), na at least
    na(low), and s at least sqrt(n(low) / n(high)) times the deviation of na over the neighbourhood of
    `low`. That is the deviation of na(low) less the most by which the growth of na can deviate.
    """
    edges, na, n, s1, s2 = low
    grown = high[1] - na
    d1, d2 = within(sums.c * grown, *edges), within(sums.c * grown * grown, *edges)
    n, n_high = n.astype(float), high[2].astype(float)
    mean, square, d1, d2, most = (part.astype(float) / n for part in (s1, s2, d1, d2, high[3]))
    most = most * (1 + 1e-9)
    spread = np.sqrt(np.maximum(square - mean * mean - 1e-12 * square, 0.0))
    growth = (np.sqrt(d2) + np.sqrt(np.maximum(d2 - d1 * d1, 0.0) + 1e-12 * d2)) / 2
    least = np.maximum(spread - np.minimum(growth, np.sqrt(d2)) * (1 + 1e-9), 0.0) * np.sqrt(n / n_high) * (1 - 1e-9)
    return (most < minimum) | (most - na.astype(float) <= k * least)


def flags_at(sums: Counts, found: tuple, left: np.ndarray, k: int, minimum: int) -> np.ndarray:
    """Which of the bins `left` (places) the radius flags: m >= minimum and m - na > k s, multiplied by n.

    Fourth powers of the rows beyond 64 bits are compared in floating point where that is certain.
    """
    na, n, s1, s2 = (part[left] for part in found[1:])
    gap = s1 - na * n
    flagged = ((s1 >= minimum * n) & (gap > 0)).astype(bool)
    open_ = np.flatnonzero(flagged)
    gap, n, s1, s2 = gap[open_], n[open_], s1[open_], s2[open_]
    if k * k * sums.rows ** 4 < 2 ** 63:
        flagged[open_] = gap * gap > k * k * (s2 * n - s1 * s1)
        return flagged
    far, own, rest = gap.astype(float) ** 2, s2.astype(float) * n.astype(float), s1.astype(float) ** 2
    over = far - k * k * (own - rest)
    sure = np.abs(over) > 1e-12 * (far + k * k * (own + rest))
    flagged[open_] = over > 0
    gap, n, s1, s2 = (part[~sure].astype(object) for part in (gap, n, s1, s2))
    flagged[open_[~sure]] = (gap * gap > k * k * (s2 * n - s1 * s1)).astype(bool)
    return flagged


def flagged_bins(x: np.ndarray, c: np.ndarray, radii: Sequence[int], alpha=LOCI_ALPHA, k=LOCI_K,
                 minimum=LOCI_MIN_NEIGHBOURS) -> np.ndarray:
    """Whether any of the ascending radii flags each of the sorted filled bins x with counts c.

    An interval of radii whose ends rule a bin out is not looked into for it; one that leaves bins open is
    halved, down to single radii. So most radii are never summed, with the same flags as if all were.
    """
    sums = Counts(x, c, alpha)
    flagged = np.zeros(len(x), bool)
    if not len(radii) or not len(x):
        return flagged

    def test(found: tuple, left: np.ndarray) -> np.ndarray:
        left = left[~flagged[left]]
        flagged[left] = flags_at(sums, found, left, k, minimum)
        return left[~flagged[left]]

    every = np.arange(len(x))
    first, last = sums.at(radii[0]), sums.at(radii[-1])
    test(first, every)
    test(last, every)
    work = [(0, first, len(radii) - 1, last, every)]
    while work:
        a, low, b, high, left = work.pop()
        left = left[~flagged[left]]
        if b - a < 2 or not len(left):
            continue
        left = left[~ruled_out(sums, low, high, k, minimum)[left]]
        if not len(left):
            continue
        middle = (a + b) // 2
        found = sums.at(radii[middle])
        left = test(found, left)
        work += [(a, low, middle, found, left), (middle, found, b, high, left)]
    return flagged


def loci_bins(binned: DataFrame, series: str, alpha=LOCI_ALPHA, k=LOCI_K, minimum=LOCI_MIN_NEIGHBOURS) -> DataFrame:
    """(series, x, flagged) for each bin that holds a value.

    A series of any length collapses to the counts of its filled bins, before the shuffle.
    """
    return loci_counts(binned.groupBy(series, "x").agg(F.count("*").alias("c")), series, alpha, k, minimum)


def loci_counts(filled: DataFrame, series: str, alpha=LOCI_ALPHA, k=LOCI_K, minimum=LOCI_MIN_NEIGHBOURS) -> DataFrame:
    """(series, x, flagged) for each bin of (series, x, c), the counts of filled bins.

    The radii of a series are dealt out to as many tasks as it has work for. Neighbourhood sums are
    differences of running sums: the cost per radius is linear in the filled bins, and a task holds a few
    arrays of their length. Radii between which no bin can be flagged are not summed (see `flagged_bins`).
    """
    work = (filled.groupBy(series).agg(F.count("*").alias("_bins"), (F.max("x") - F.min("x")).alias("_range"))
            .select(F.col(series).alias("_series"), F.greatest(F.lit(1), F.least(F.lit(MOST_BLOCKS), F.ceil(
                F.col("_bins") * F.least(F.col("_range") * 2, F.col("_bins").cast("decimal(20,0)") * F.col("_bins")) / BLOCK_WORK))).cast("int").alias("_blocks")))
    counts = (filled.join(work, F.col(series).eqNullSafe(F.col("_series"))).drop("_series")
              .withColumn("_block", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))))

    def test(frame):
        frame = frame.sort_values("x")
        x, c = frame["x"].to_numpy(np.int64), frame["c"].to_numpy(np.int64)
        radii = radii_of(x, alpha, int(frame["_block"].iloc[0]), int(frame["_blocks"].iloc[0]))
        return frame[[series, "x"]].assign(flagged=flagged_bins(x, c, radii, alpha, k, minimum))

    kind = dict(filled.dtypes)[series]
    return (counts.groupBy(series, "_block")
            .applyInPandas(test, f"`{series}` {kind}, x bigint, flagged boolean")
            .groupBy(series, "x").agg(F.bool_or("flagged").alias("flagged")))


def bin_of(value: Column, resolution=RESOLUTION) -> Column:
    """The bin that a finite value falls into."""
    return F.when(F.abs(value) < F.lit(float("inf")), F.floor(value / F.lit(float(resolution)))).cast("bigint")


def tag_anomalies(rows: DataFrame, value="prediction", series="series", resolution=RESOLUTION) -> DataFrame:
    """Add `isAnomaly` (0 or 1) to every row by the values of its series.

    `resolution` is the width of a bin in units of the value: values in one bin are alike. Rows whose
    value is NULL or no finite number are in no bin and get NULL.
    """
    binned = rows.withColumn("x", bin_of(F.col(value), resolution))
    flags = loci_bins(binned.where("x is not null"), series).select(
        F.col(series).alias("_series"), F.col("x").alias("_x"), F.col("flagged").cast("int").alias("isAnomaly"))
    same = F.col(series).eqNullSafe(F.col("_series")) & (F.col("x") == F.col("_x"))
    return binned.join(flags, same, "left").drop("_series", "_x", "x")


def sharp_rises(rows: DataFrame, series="series", idx="idx", value="y", trailing=24, k=3.0,
                width=4096) -> DataFrame:
    """Rows above the mean of the `trailing` rows before them by more than k standard deviations.

    The edge of each slice carries the trailing rows of the one before (see `slices.lagged`).
    """
    home = F.floor(F.col(idx) / width)
    near_end = F.pmod(F.col(idx), F.lit(width)) >= width - trailing
    homes = F.when(near_end, F.array(home, home + 1)).otherwise(F.array(home))
    before = (W.partitionBy(series, "_slice").orderBy(idx).rowsBetween(-trailing, -1))
    return (rows.withColumn("_home", home).withColumn("_slice", F.explode(homes))
            .withColumn("trailing_mean", F.avg(value).over(before))
            .withColumn("trailing_std", F.stddev_pop(value).over(before))
            .withColumn("seen", F.count(value).over(before))
            .where((F.col("_slice") == F.col("_home")) & (F.col("seen") == trailing))
            .withColumn("rise", (F.col(value) > F.col("trailing_mean")
                                 + k * F.col("trailing_std")).cast("int"))
            .drop("_home", "_slice", "seen"))
