"""GARCH(1,1) volatility of many series.

var(t+1) = omega + alpha e(t)^2 + beta var(t), omega = s2 (1 - alpha - beta) with s2 the sample
variance, so that only alpha and beta are open. Their posterior under a flat prior is taken on a
lattice: the likelihood of every lattice point is summed slice by slice, and the variance entering
a slice is carried over by the affine map of the slices before it.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heatline.operators import folds
from heatline.operators.slices import SLICE, lagged, slice_of


def lattice(alphas=None, betas=None) -> list[tuple]:
    """(alpha, beta) points with alpha + beta < 1."""
    alphas = [round(0.02 * i, 2) for i in range(0, 16)] if alphas is None else alphas
    betas = [round(0.06 * i, 2) for i in range(0, 17)] if betas is None else betas
    return [(a, b) for a in alphas for b in betas if a + b < 0.9999]


def log_returns(rows: DataFrame, series="series", idx="idx", value="y") -> DataFrame:
    """(series, idx, r): change of the logarithm, one row less than the series."""
    wide = lagged(rows, [series], idx, {"_before": (value, 1)})
    return (wide.where(F.col("_before").isNotNull())
            .select(series, (F.col(idx) - 1).alias(idx),
                    (F.log(value) - F.log("_before")).alias("r")))


def residuals(returns: DataFrame, series="series", idx="idx", value="r") -> DataFrame:
    """(series, idx, e, s2): deviation from the mean return, and the variance of the series."""
    level = returns.groupBy(series).agg(F.avg(value).alias("_mean"),
                                        F.var_pop(value).alias("s2"))
    level = level.withColumnRenamed(series, "_series")
    return (returns.join(level, F.col(series).eqNullSafe(F.col("_series")))
            .select(series, idx, (F.col(value) - F.col("_mean")).alias("e"), "s2"))


def _recursion(points, e, s2, start):
    """Variances (rows x points) that follow `start`, and the one after the last row.

    The map of a row is affine, so the rows are cut into as many blocks as a block has rows, all blocks
    run side by side from zero, and what enters a block is added to it, decayed.
    """
    alpha, beta = np.array(points).T
    omega = s2 * (1 - alpha - beta)
    length = int(np.sqrt(len(e))) + 1
    blocks = -(-(len(e) + 1) // length)
    squares = np.zeros(blocks * length)
    squares[:len(e)] = e * e
    squares = squares.reshape(blocks, length, 1)
    path, now = np.empty((blocks, length, len(points))), np.zeros((blocks, len(points)))
    for i in range(length):
        path[:, i] = now
        now = omega + alpha * squares[:, i] + beta * now
    decay, over = beta ** np.arange(length)[:, None], beta ** length
    entering = np.asarray(start, float)
    for k in range(blocks):
        path[k] += decay * entering
        entering = now[k] + over * entering
    path = path.reshape(blocks * length, -1)
    return path[:len(e)], path[len(e)]


def _entering(rows: DataFrame, points, series: str, idx: str, width: int):
    """Rows cut into slices, and the variance at which each slice but the first begins."""
    kind = dict(rows.dtypes)[series]
    beta = np.array(points)[:, 1]
    cut = rows.select(series, F.col(idx).cast("bigint").alias(idx), "e", "s2").withColumn(
        "_slice", slice_of(F.col(idx), width))

    def shift(key, frame):
        if len(frame) < width:      # idx has no gaps, so nothing follows this slice
            return pd.DataFrame(columns=[series, "_slice", "parts"], dtype=object)
        frame = frame.sort_values(idx)
        s2 = float(frame["s2"].iloc[0])
        _, added = _recursion(points, frame["e"].to_numpy(float), s2, np.zeros(len(points)))
        return pd.DataFrame({series: [key[0]], "_slice": [key[1]], "parts": [np.append(s2, added)]})

    def apply(state, parts, slices):
        return parts[1:] + beta ** (width * slices) * state

    def reduce(parts):
        total = np.zeros(len(beta))
        for p in parts:
            total = apply(total, p, 1)
        return np.append(parts[0][0], total)

    summaries = cut.groupBy(series, "_slice").applyInPandas(
        shift, f"`{series}` {kind}, _slice bigint, parts array<double>")
    starts = folds.starts(summaries, lambda parts: np.full(len(beta), parts[0]), apply, reduce, series)
    return cut.groupBy(series, "_slice").cogroup(starts.groupBy(series, "_slice"))


def _start(points, frame, start):
    if len(start):
        return np.asarray(start["start"].iloc[0], float)
    return np.full(len(points), float(frame["s2"].iloc[0]))


def garch_path(rows: DataFrame, alpha: float, beta: float, series="series", idx="idx",
               width=SLICE) -> DataFrame:
    """(series, idx, e, variance): the variance expected for each row at fixed alpha and beta."""
    points = [(alpha, beta)]

    def run(key, frame, start):
        if frame.empty:
            return pd.DataFrame(columns=[series, idx, "e", "variance"], dtype=object)
        frame = frame.sort_values(idx)
        path, _ = _recursion(points, frame["e"].to_numpy(float), float(frame["s2"].iloc[0]),
                             _start(points, frame, start))
        return frame[[series, idx, "e"]].assign(variance=path[:, 0])

    kind = dict(rows.dtypes)[series]
    return _entering(rows, points, series, idx, width).applyInPandas(
        run, f"`{series}` {kind}, {idx} bigint, e double, variance double")


def garch_likelihood(rows: DataFrame, points, series="series", idx="idx",
                     width=SLICE) -> DataFrame:
    """(series, alpha, beta, s2, loglik, next_variance) for every lattice point."""
    points = list(points)

    def run(key, frame, start):
        names = [series, "_slice", "s2", "alpha", "beta", "loglik", "next_variance"]
        if frame.empty:
            return pd.DataFrame(columns=names, dtype=object)
        frame = frame.sort_values(idx)
        e, s2 = frame["e"].to_numpy(float), float(frame["s2"].iloc[0])
        if not s2 > 0:
            return pd.DataFrame(columns=names, dtype=object)
        path, after = _recursion(points, e, s2, _start(points, frame, start))
        loglik = -0.5 * (np.log(2 * np.pi * path) + (e * e)[:, None] / path).sum(axis=0)
        alpha, beta = np.array(points).T
        return pd.DataFrame({series: key[0], "_slice": key[1], "s2": s2, "alpha": alpha,
                             "beta": beta, "loglik": loglik, "next_variance": after})

    kind = dict(rows.dtypes)[series]
    parts = _entering(rows, points, series, idx, width).applyInPandas(
        run, f"`{series}` {kind}, _slice bigint, s2 double, alpha double, beta double, "
             "loglik double, next_variance double")
    return parts.groupBy(series, "alpha", "beta").agg(
        F.max("s2").alias("s2"), F.sum("loglik").alias("loglik"),
        F.max_by("next_variance", "_slice").alias("next_variance"))


def garch_fit(rows: DataFrame, points=None, series="series", idx="idx", width=SLICE) -> DataFrame:
    """(series, alpha, beta, s2, next_variance): posterior means."""
    scored = garch_likelihood(rows, points or lattice(), series, idx, width)
    best = F.max("loglik").over(W.partitionBy(series))
    weighted = scored.withColumn("_w", F.exp(F.col("loglik") - best))

    def mean(name):
        return (F.sum(F.col("_w") * F.col(name)) / F.sum("_w")).alias(name)

    return weighted.groupBy(series).agg(mean("alpha"), mean("beta"), F.max("s2").alias("s2"),
                                        mean("next_variance"))


def garch_forecast(fits: DataFrame, steps: int, series="series") -> DataFrame:
    """(series, h, variance): decays from the next variance to that of the whole series."""
    k = F.col("h") - 1
    return (fits.withColumn("h", F.explode(F.expr(f"sequence(1L, {steps}L)")))
            .select(series, "h",
                    (F.col("s2") + F.pow(F.col("alpha") + F.col("beta"), k)
                     * (F.col("next_variance") - F.col("s2"))).alias("variance")))
