"""Autoregressive models of many series at once, fitted from sums of products.

Everything a least-squares fit needs of a series is a small matrix of sums, so each fit is one
partially aggregated pass over the lagged rows followed by arithmetic on one row per series.
Estimates are conditional least squares, not the exact state-space likelihood.
"""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatline.constants import FORECAST_SHARE, SEASON
from heatline.operators import metrics
from heatline.operators.buckets import holdout
from heatline.operators.recurrence import extend
from heatline.operators.slices import lagged, last_rows, running_totals

ROUNDS = 50
SETTLED = 1e-6
MIN_EQUATIONS = 3


def gram(rows: DataFrame, group: list[str], columns: list[str]) -> DataFrame:
    """Sums of all pairwise products as `g_i_j` (i <= j, positions in `columns`), with their number.

    `n` counts all rows, `equations` those with a value in the first column.
    """
    pairs = itertools.combinations_with_replacement(range(len(columns)), 2)
    return rows.groupBy(*group).agg(
        F.count("*").alias("n"), F.count(columns[0]).alias("equations"),
        *[F.sum(F.col(columns[i]) * F.col(columns[j])).alias(f"g_{i}_{j}") for i, j in pairs])


def differenced(column: str, earlier: str) -> Column:
    """Difference with a lagged value."""
    return F.col(column) - F.col(earlier)


# -- seasonal model (1,0,0)(1,1,0)_s -------------------------------------------------------------

def seasonal_lags(rows: DataFrame, season=SEASON, series="series", idx="idx",
                  value="y", keep=()) -> DataFrame:
    """Seasonal difference w and its lags 1, s, s+1 as w0, w1, ws, wt; NULL unless all exist.

    Other columns go, but for those to `keep`."""
    lags = {"_1": (value, 1), "_s": (value, season), "_t": (value, season + 1),
            "_2s": (value, 2 * season), "_2t": (value, 2 * season + 1)}
    parts = {"w0": (value, "_s"), "w1": ("_1", "_t"), "ws": ("_s", "_2s"), "wt": ("_t", "_2t")}
    complete = F.col("_2t").isNotNull()
    return lagged(rows, [series], idx, lags).select(
        series, idx, *keep, *[F.when(complete, differenced(a, b)).alias(w) for w, (a, b) in parts.items()])


def seasonal_gram(rows: DataFrame, season=SEASON, series="series", idx="idx",
                  value="y") -> DataFrame:
    """The ten sums the seasonal fit is made of: (series, n, equations, g_0_0 .. g_3_3)."""
    return gram(seasonal_lags(rows, season, series, idx, value), [series], ["w0", "w1", "ws", "wt"])


def _ratio(above: Column, below: Column, limit) -> Column:
    value = F.when(below > 0, above / below).otherwise(F.lit(0.0))
    return value if limit is None else F.greatest(F.least(value, F.lit(limit)), F.lit(-limit))


def seasonal_fit(rows: DataFrame, season=SEASON, series="series", idx="idx", value="y",
                 rounds=ROUNDS, stationary=False) -> DataFrame:
    """(series, n, equations, phi, seasonal_phi, css, aic, change, status) of each series."""
    return seasonal_solve(seasonal_gram(rows, season, series, idx, value), series, rounds, stationary)


def seasonal_solve(sums: DataFrame, series="series", rounds=ROUNDS, stationary=False) -> DataFrame:
    """The fit from its sums (`seasonal_gram`), wherever they were added up.

    Residual w0 - phi w1 - Phi ws + phi Phi wt: with either coefficient fixed the other has a closed
    form, so they are updated in turn. Series with fewer than 3 equations are `too_short`; one whose
    last round still changed a coefficient by more than 1e-6 (`change`) is `not_converged`.
    `stationary` keeps both inside (-1, 1).
    """
    limit = 0.999 if stationary else None
    g = {(i, j): F.col(f"g_{i}_{j}") for i in range(4) for j in range(i, 4)}
    mixed = g[1, 2] + g[0, 3]

    def update(state):
        big = state["seasonal_phi"]
        phi = _ratio(g[0, 1] - big * mixed + big * big * g[2, 3],
                     g[1, 1] - 2 * big * g[1, 3] + big * big * g[3, 3], limit)
        return F.struct(phi.alias("phi"), big.alias("seasonal_phi"), F.abs(phi - state["phi"]).alias("change"))

    def update_seasonal(state):
        phi = state["phi"]
        big = _ratio(g[0, 2] - phi * mixed + phi * phi * g[1, 3],
                     g[2, 2] - 2 * phi * g[2, 3] + phi * phi * g[3, 3], limit)
        return F.struct(phi.alias("phi"), big.alias("seasonal_phi"),
                        F.greatest(state["change"], F.abs(big - state["seasonal_phi"])).alias("change"))

    start = F.struct(*[F.lit(0.0).alias(c) for c in ("phi", "seasonal_phi", "change")])
    fit = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start,
                      lambda state, i: update_seasonal(update(state)))
    c = [F.lit(1.0), -F.col("phi"), -F.col("seasonal_phi"), F.col("phi") * F.col("seasonal_phi")]
    css = sum((c[i] * c[j] * g[min(i, j), max(i, j)] for i in range(4) for j in range(4)),
              F.lit(0.0))
    m = F.col("equations")
    enough = m >= MIN_EQUATIONS
    return (sums.withColumn("_fit", F.when(enough, fit))
            .select("*", "_fit.phi", "_fit.seasonal_phi", "_fit.change")
            .withColumn("css", F.when(enough, F.greatest(css, F.lit(0.0))))
            .withColumn("aic", F.when(F.col("css") > 0, m * F.log(F.col("css") / m) + 4))
            .withColumn("status", F.when(~enough, "too_short").when(F.col("change") > SETTLED, "not_converged")
                        .otherwise("ok"))
            .select(series, "n", "equations", "phi", "seasonal_phi", "css", "aic", "change", "status"))


def seasonal_forecast(rows: DataFrame, season=SEASON, share=FORECAST_SHARE, series="series",
                      idx="idx", value="y", stationary=False, horizon=None) -> DataFrame:
    """(series, h, forecast) for h = 1..floor(n * share), or 1..horizon.

    Multiplied out, the model is a linear rule of the last 2s+1 values.
    """
    fits = seasonal_fit(rows, season, series, idx, value, stationary=stationary)
    models = seasonal_rule(fits, season, share, series, horizon)
    return extend(_with_tail(models, rows, series, idx, value, 2 * season + 1), series)


def seasonal_rule(fits: DataFrame, season=SEASON, share=FORECAST_SHARE, series="series", horizon=None) -> DataFrame:
    """(series, coef, const, steps): each fit as a linear rule of the last 2s+1 values; short series go."""
    fits = fits.where(F.col("status") != "too_short")
    steps = F.floor(F.col("n") * share) if horizon is None else F.lit(horizon)
    phi, big = F.col("phi"), F.col("seasonal_phi")
    at = {1: phi, season: 1 + big, season + 1: -phi * (1 + big), 2 * season: -big,
          2 * season + 1: phi * big}
    coef = F.array(*[at.get(k, F.lit(0.0)) for k in range(1, 2 * season + 2)])
    return fits.select(series, coef.alias("coef"), F.lit(0.0).alias("const"),
                       steps.cast("bigint").alias("steps"))


def _with_tail(models: DataFrame, rows: DataFrame, series: str, idx: str, value: str,
               n: int) -> DataFrame:
    """Add `tail`, the last n values of each series in order."""
    pairs = F.sort_array(F.collect_list(F.struct(idx, value)))
    tails = (last_rows(rows.select(series, idx, value), [series], idx, n)
             .groupBy(series).agg(pairs[value].alias("tail"))
             .withColumnRenamed(series, "_series"))
    return models.join(tails, F.col(series).eqNullSafe(F.col("_series"))).drop("_series")


def score_holdout(rows: DataFrame, forecast, share=FORECAST_SHARE, series="series") -> DataFrame:
    """Fit on the first part of each series, forecast the rest: (series, n_test, corr, mape).

    `forecast(train, test_share)` returns (series, h, forecast) for at least the held-out steps.
    """
    parts = holdout(rows, share, series)
    # the horizon is a share of the whole series; relative to the training part it is s / (1 - s)
    predicted = forecast(parts.where(F.col("part") == "train").select(series, "idx", "step", "y"),
                         share / (1 - share) + 1e-9)
    actual = parts.where(F.col("part") == "test").select(series, "h", "y")
    both = actual.join(predicted, [series, "h"])
    y, p = F.col("y"), F.col("forecast")
    return both.groupBy(series).agg(
        F.count("*").alias("n_test"), metrics.abs_corr(y, p).alias("corr"),
        metrics.mape(y, p).alias("mape"), metrics.zero_actuals(y).alias("zero_actuals"))


# -- ARIMA(p, d, 0) ------------------------------------------------------------------------------

def _changes(rows: DataFrame, p: int, d: int, series: str, idx: str, value: str) -> DataFrame:
    """z0 and its lags z1..zp, z being the value (d=0) or its first difference (d=1)."""
    if d not in (0, 1):
        raise ValueError("d must be 0 or 1")
    wide = lagged(rows, [series], idx, {f"_{k}": (value, k) for k in range(1, p + d + 1)})
    names = [value] + [f"_{k}" for k in range(1, p + d + 1)]
    z = [F.col(a) - F.col(b) for a, b in zip(names, names[1:])] if d else [F.col(a) for a in names]
    kept = [c for c in rows.columns]
    return wide.select(*kept, F.lit(1.0).alias("one"),
                       *[z[k].alias(f"z{k}") for k in range(p + 1)])


def _matrix(frame: pd.DataFrame, size: int) -> np.ndarray:
    """Symmetric matrices, one per row, from the columns g_i_j."""
    out = np.empty((len(frame), size, size))
    for i in range(size):
        for j in range(i, size):
            out[:, i, j] = out[:, j, i] = frame[f"g_{i}_{j}"].to_numpy(float)
    return out


def _solve(matrix: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Least-squares solutions, tolerating singular matrices."""
    return np.einsum("bij,bj->bi", np.linalg.pinv(matrix, rcond=1e-12, hermitian=True), right)


def ar_fit(rows: DataFrame, p: int, d=1, series="series", idx="idx", value="y") -> DataFrame:
    """(series, equations, const, phi array, css, aic) of z_t = const + sum phi_k z_{t-k}."""
    wide = _changes(rows, p, d, series, idx, value).where(F.col(f"z{p}").isNotNull())
    names = ["one"] + [f"z{k}" for k in range(1, p + 1)] + ["z0"]
    sums = gram(wide, [series], names).where(F.col("equations") > p + 1)
    schema = (f"`{series}` {dict(sums.dtypes)[series]}, equations bigint, const double, "
              "phi array<double>, css double, aic double")

    def solve(batches):
        for frame in batches:
            if frame.empty:
                continue
            g = _matrix(frame, p + 2)
            coef = _solve(g[:, :-1, :-1], g[:, :-1, -1])
            css = np.maximum(g[:, -1, -1] - np.einsum("bi,bi->b", coef, g[:, :-1, -1]), 0.0)
            m = frame["equations"].to_numpy(float)
            with np.errstate(divide="ignore"):
                aic = np.where(css > 0, m * np.log(css / m) + 2 * (p + 2), np.nan)
            yield pd.DataFrame({series: frame[series], "equations": frame["equations"],
                                "const": coef[:, 0], "phi": list(coef[:, 1:]), "css": css,
                                "aic": aic})
    return sums.mapInPandas(solve, schema)


def ar_forecast(rows: DataFrame, p: int, steps: int, d=1, series="series", idx="idx",
                value="y") -> DataFrame:
    """(series, h, forecast), h = 1..steps, from the last p + d values of each series."""
    fits = ar_fit(rows, p, d, series, idx, value)
    phi = [F.get("phi", F.lit(k)) for k in range(p)]
    if d:
        phi = [1 + phi[0], *[phi[k] - phi[k - 1] for k in range(1, p)], -phi[-1]]
    models = fits.select(series, F.array(*phi).alias("coef"), "const",
                         F.lit(steps).cast("bigint").alias("steps"))
    return extend(_with_tail(models, rows, series, idx, value, p + d), series)


def walk_forward(rows: DataFrame, p: int, d=1, series="series", idx="idx", value="y",
                 warmup=None) -> DataFrame:
    """(series, idx, y, forecast): each row predicted from a fit on the strictly earlier ones.

    The sums of an expanding window are running totals, so all refits are one pass and a batch of
    small solves; a refit per row never rereads the past.
    """
    warmup = 2 * (p + 1) if warmup is None else warmup
    names = ["one"] + [f"z{k}" for k in range(1, p + 1)] + ["z0"]
    wide = _changes(rows.select(series, idx, value), p, d, series, idx, value)
    wide = wide.where(F.col(f"z{p}").isNotNull())
    pairs = [(i, j) for i in range(p + 2) for j in range(i, p + 2) if (i, j) != (p + 1, p + 1)]
    products = wide.select(series, idx, value, *[F.col(n).alias(f"_{n}") for n in names],
                           *[(F.col(names[i]) * F.col(names[j])).alias(f"g_{i}_{j}")
                             for i, j in pairs])
    sums = running_totals(products, [series], idx, [f"g_{i}_{j}" for i, j in pairs])
    sums = sums.where(F.col("g_0_0") >= warmup).withColumn(f"g_{p + 1}_{p + 1}", F.lit(0.0))
    schema = f"`{series}` {dict(rows.dtypes)[series]}, {idx} bigint, {value} double, forecast double"

    def predict(batches):
        for frame in batches:
            if frame.empty:
                continue
            g = _matrix(frame, p + 2)
            coef = _solve(g[:, :-1, :-1], g[:, :-1, -1])
            x = frame[[f"_{n}" for n in names[:-1]]].to_numpy(float)
            change = np.einsum("bi,bi->b", coef, x)
            level = frame[value].to_numpy(float) - frame["_z0"].to_numpy(float)
            yield pd.DataFrame({series: frame[series], idx: frame[idx], value: frame[value],
                                "forecast": change + (level if d else 0.0)})
    return sums.mapInPandas(predict, schema)


def lag_candidates(rows: DataFrame, max_lag: int, series="series", idx="idx",
                   value="y") -> DataFrame:
    """(series, lag, n, slope, aic) of the regressions of y on its value `lag` rows earlier."""
    wide = lagged(rows, [series], idx, {f"_{k}": (value, k) for k in range(1, max_lag + 1)})
    y = F.col(value)
    fits = wide.groupBy(series).agg(*[
        F.struct(F.lit(k).cast("bigint").alias("lag"), F.regr_count(y, f"_{k}").alias("n"),
                 F.regr_slope(y, f"_{k}").alias("slope"),
                 (F.regr_syy(y, f"_{k}") * (1 - F.regr_r2(y, f"_{k}"))).alias("css")).alias(f"f{k}")
        for k in range(1, max_lag + 1)])
    listed = F.array(*[F.col(f"f{k}") for k in range(1, max_lag + 1)])
    return (fits.select(series, F.inline(listed))
            .withColumn("aic", F.when(F.col("css") > 0,
                                      F.col("n") * F.log(F.col("css") / F.col("n")) + 6))
            .select(series, "lag", "n", "slope", "aic"))
