"""Scores of predictions, regression lines, autocorrelation, best candidate."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatline.constants import FIT_BAND
from heatline.functions.values import finite
from heatline.operators.relational import between_open
from heatline.operators.slices import lagged, previous
from heatline.session import settle

ACF_SLICE = 1 << 14


def mse(label: Column, prediction: Column) -> Column:
    gap = prediction - label
    return F.avg(gap * gap)


def rmse(label: Column, prediction: Column) -> Column:
    return F.sqrt(mse(label, prediction))


def mape(actual: Column, prediction: Column) -> Column:
    """Mean absolute percentage error, half-even to 2 digits; zero actuals do not count."""
    share = F.abs((actual - prediction) / F.nullif(actual, F.lit(0.0)))
    return F.bround(F.avg(share) * 100, 2)


def zero_actuals(actual: Column) -> Column:
    """How many rows `mape` leaves out."""
    return F.count_if(actual == 0)


def abs_corr(actual: Column, prediction: Column) -> Column:
    return F.abs(F.corr(actual, prediction))


def t_statistic(r: Column, n: Column) -> Column:
    """Student t of a correlation, for its significance; NULL where r is exactly 1 or -1."""
    return F.try_divide(r * F.sqrt(n - 2), F.sqrt(F.greatest(1 - r * r, F.lit(0.0))))


def _beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function, by its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(b, a, 1 - x)
    front = math.exp(a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b)
                     - math.lgamma(a) - math.lgamma(b)) / a
    tiny, c, d = 1e-300, 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > tiny else tiny)
    total = d
    for m in range(1, 10_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
                     -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / (d if abs(d) > tiny else tiny), c if abs(c) > tiny else tiny
            total *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return front * total


def p_value(r: Column, n: Column) -> Column:
    """Two-sided significance of a correlation r over n rows; for one row per group."""
    @F.pandas_udf("double")
    def run(rs: pd.Series, ns: pd.Series) -> pd.Series:
        return pd.Series([
            _beta_share(k / 2 - 1, 0.5, 1 - min(v * v, 1.0)) if k > 2 and v == v else None
            for v, k in zip(rs.astype(float), ns)], dtype="float64")
    return run(r, n)


def line_fit(x: Column, y: Column) -> list[Column]:
    """Least squares line y = slope * x + intercept."""
    return [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept")]


def evaluate(scored: DataFrame, group: list[str], label="label", prediction="prediction") -> DataFrame:
    """n, mean label, RMSE, MSE, Pearson r, its t and its p per group."""
    y, p = F.col(label), F.col(prediction)
    return (scored.groupBy(*group)
            .agg(F.count("*").alias("n"), F.avg(y).alias("mean_label"), rmse(y, p).alias("rmse"),
                 mse(y, p).alias("mse"), F.corr(p, y).alias("r"))
            .withColumn("t", t_statistic(F.col("r"), F.col("n")))
            .withColumn("p", p_value(F.col("r"), F.col("n"))))


def evaluate_band(scored: DataFrame, group: list[str], label="label", prediction="prediction",
                  band=FIT_BAND) -> DataFrame:
    """Line through, and correlation of, the predictions strictly inside the band."""
    y, p = F.col(label), F.col(prediction)
    return (scored.where(between_open(p, *band)).groupBy(*group)
            .agg(F.count("*").alias("n"), *line_fit(y, p), F.corr(p, y).alias("r")))


def lag_corr(rows: DataFrame, series="series", idx="idx", value="y", lag=1) -> DataFrame:
    """Correlation of each series with itself `lag` rows earlier."""
    return (lagged(rows, [series], idx, {"_p": (value, lag)})
            .groupBy(series).agg(F.corr("_p", value).alias("r")))


def acf(rows: DataFrame, max_lag: int, series="series", idx="idx", value="y") -> DataFrame:
    """(series, lag, r) for lag = 1..max_lag, around the mean of the whole series.

    r(k) needs sum(y_t y_{t-k}) and the sums of the rows that take part on either side, all of which
    are partial sums. The pairs of a row and its lags are added up where they arise; what is shuffled
    is one row per task, series and lag.
    """
    y, before = F.col(value), F.col("before")
    pairs = (previous(rows, [series], idx, value, max_lag)
             .select(series, value, F.posexplode("before").alias("pos", "before")))
    cross = pairs.where(before.isNotNull() & y.isNotNull()).groupBy(series, (F.col("pos") + 1).alias("lag")).agg(
        F.sum(y * before).alias("p"), F.sum(y).alias("u"), F.sum(before).alias("v"))
    level = rows.groupBy(F.col(series).alias("_series")).agg(
        F.count("*").alias("n"), F.sum(y).alias("s"), F.sum(y * y).alias("s2"))
    mean = F.col("s") / F.col("n")
    spread = F.col("s2") - F.col("n") * mean * mean
    top = F.col("p") - mean * (F.col("u") + F.col("v")) + (F.col("n") - F.col("lag")) * mean * mean
    return (cross.join(level, F.col(series).eqNullSafe(F.col("_series")))
            .select(series, "lag", F.try_divide(top, F.nullif(spread, F.lit(0.0))).alias("r"))
            .where(F.col("r").isNotNull()))


def acf_all(rows: DataFrame, max_lag: int | None = None, series="series", idx="idx", value="y", width=ACF_SLICE) -> DataFrame:
    """(series, lag, r) for every lag of a series, 1..n-1 (or to `max_lag`), around its mean.

    Products of two slices of a series add up to all lags between them in one Fourier transform, so a
    pair of slices costs width * log(width) and not a row per value and lag. Pairs of slices of the same
    distance are added up as spectra, 32 at a time, and transformed back once. `idx` is gapless; a NULL or
    non-finite value takes part in no product. A constant series has no rows.
    """
    y = finite(F.col(value))
    level = settle(rows.groupBy(F.col(series).alias("_series")).agg(F.avg(y).alias("mean"), F.min(idx).alias("first"), F.max(idx).alias("last"))
                   .where("mean is not null"))
    kind = dict(rows.dtypes)[series]
    cut = (rows.select(series, F.col(idx).alias("_idx"), y.alias("_y")).join(level, F.col(series).eqNullSafe(F.col("_series")))
           .select(series, ((F.col("_idx") - F.col("first")) / width).cast("bigint").alias("s"),
                   F.pmod(F.col("_idx") - F.col("first"), F.lit(width)).cast("int").alias("at"), (F.col("_y") - F.col("mean")).alias("v"),
                   F.floor((F.col("last") - F.col("first")) / width).alias("slices")))

    def packed(frame):
        values = np.zeros(width)
        values[frame["at"].to_numpy()] = frame["v"].fillna(0.0).to_numpy()
        return pd.DataFrame({series: frame[series].iloc[:1].to_numpy(), "s": frame["s"].iloc[:1].to_numpy(), "ys": [values],
                             "slices": frame["slices"].iloc[:1].to_numpy()})

    slices = settle(cut.groupBy(series, "s").applyInPandas(packed, f"`{series}` {kind}, s bigint, ys array<double>, slices bigint"))
    farthest = F.col("slices") - F.col("s")
    if max_lag is not None:
        farthest = F.least(farthest, F.lit(max_lag // width + 1).cast("bigint"))
    earlier = slices.select(series, "s", F.col("ys").alias("before"), F.explode(F.sequence(F.lit(0).cast("bigint"), farthest)).alias("m"))
    later = slices.select(F.col(series).alias("_series"), F.col("s").alias("_s"), "ys")
    pairs = (earlier.join(later, F.col(series).eqNullSafe(F.col("_series")) & (F.col("s") + F.col("m") == F.col("_s")))
             .select(series, "m", F.floor(F.col("s") / 32).alias("some"), "before", "ys"))

    def products(frame):
        total = np.zeros(width + 1, complex)
        for before, ys in zip(frame["before"], frame["ys"]):
            total += np.fft.rfft(ys, 2 * width) * np.conj(np.fft.rfft(before, 2 * width))
        back, m = np.fft.irfft(total, 2 * width), int(frame["m"].iloc[0])
        # Places 0..width-1 are lags from m * width on, places width+1.. those below it.
        parts = [(m, back[:width])] + ([(m - 1, np.concatenate([[0.0], back[width + 1:]]))] if m else [])
        return pd.DataFrame({series: [frame[series].iloc[0]] * len(parts), "block": [b for b, _ in parts], "p": [p for _, p in parts]})

    def added(frame):
        return pd.DataFrame({series: frame[series].iloc[:1].to_numpy(), "block": frame["block"].iloc[:1].to_numpy(),
                             "p": [np.sum(np.stack(frame["p"].to_list()), axis=0)]})

    schema = f"`{series}` {kind}, block bigint, p array<double>"
    sums = settle(pairs.groupBy(series, "m", "some").applyInPandas(products, schema).groupBy(series, "block").applyInPandas(added, schema))
    zero = sums.where("block = 0").select(F.col(series).alias("_series"), F.get("p", F.lit(0)).alias("spread"))
    ends = level.select(F.col("_series").alias("_end"), (F.col("last") - F.col("first")).alias("longest"))
    return (sums.select(series, "block", F.posexplode("p").alias("at", "p")).join(zero, F.col(series).eqNullSafe(F.col("_series")))
            .join(ends, F.col(series).eqNullSafe(F.col("_end")))
            .withColumn("lag", F.col("block") * width + F.col("at"))
            .where(F.col("lag").between(1, F.col("longest") if max_lag is None else F.least(F.col("longest"), F.lit(max_lag))) & (F.col("spread") > 0))
            .select(series, "lag", (F.col("p") / F.col("spread")).alias("r")))



def best_positive(candidates: DataFrame, group: list[str], aic="aic") -> DataFrame:
    """The candidate with the smallest positive AIC of each group, with all its columns.

    A group without a positive AIC keeps its row, all other columns NULL.
    """
    others = [c for c in candidates.columns if c not in group]
    positive = F.when(F.col(aic) > 0, F.col(aic))
    best = candidates.groupBy(*group).agg(F.min_by(F.struct(*others), positive).alias("_best"))
    return best.select(*group, "_best.*")
