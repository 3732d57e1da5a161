"""Order search over seasonal ARIMA(p,d,q)(P,D,Q)s with every order 0 or 1.

Moving-average terms are estimated in two regressions (Hannan and Rissanen, 1982): a long
autoregression gives estimated shocks, then each candidate is least squares on lagged values and
lagged shocks. Both steps need only sums of products, so all 64 candidates of a series come out of
one matrix of lagged products and no candidate rereads the series.
"""

import itertools

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.constants import SEASON
from heatline.operators.metrics import best_positive
from heatline.operators.slices import SLICE, overlapping

ROUNDS = 30
SETTLED = 1e-6


def lag_products(rows: DataFrame, lags: int, series: str, idx: str, value: str, width=SLICE) -> DataFrame:
    """(series, n, level, head, products): sums of products of a constant and the lags 0..lags of each series.

    `level` is the first value; it is taken off before products are formed, so that a high level costs
    no digits. `products` is the matrix, row by row, over the `n` rows that have all lags; `head` are the
    first values. The series must be gapless. Rows are shuffled once, by (series, slice), and a slice
    gives one row.
    """
    kind = dict(rows.dtypes)[series]
    first = rows.groupBy(F.col(series).alias("_series")).agg(F.min_by(value, idx).alias("level"))
    cut = overlapping(rows.select(series, F.col(idx).alias("_idx"), F.col(value).alias("_y")), [series], "_idx", lags, width)
    cut = cut.join(first, F.col(series).eqNullSafe(F.col("_series"))).drop("_series")

    def of_slice(frame):
        frame = frame.sort_values("_idx")
        y, at = frame["_y"].to_numpy(float) - frame["level"].iloc[0], frame["_idx"].to_numpy(np.int64)
        total, n = np.zeros((lags + 2, lags + 2)), max(0, len(y) - lags)
        for lo in range(0, n, 1024):
            part = np.lib.stride_tricks.sliding_window_view(y[lo:lo + 1024 + lags], lags + 1)[:, ::-1]
            seen = np.concatenate([np.ones((len(part), 1)), part], axis=1)
            total += seen.T @ seen
        head = y[:lags].tolist() if at[0] == 0 else []
        return pd.DataFrame({series: frame[series].iloc[:1].to_numpy(), "n": [n], "level": [frame["level"].iloc[0]],
                             "head": [head], "products": [total.ravel()]})

    def of_series(frame):
        head = max(frame["head"], key=len)
        return pd.DataFrame({series: frame[series].iloc[:1].to_numpy(), "n": [int(frame["n"].sum())], "level": [frame["level"].iloc[0]],
                             "head": [head], "products": [np.sum([np.asarray(p) for p in frame["products"]], axis=0)]})

    schema = f"`{series}` {kind}, n bigint, level double, head array<double>, products array<double>"
    parts = cut.groupBy(series, "_slice").applyInPandas(lambda frame: of_slice(frame), schema)
    # Two levels: a very long series has many slices.
    near = parts.withColumn("_some", F.pmod(F.monotonically_increasing_id(), F.lit(64))).groupBy(series, "_some")
    return near.applyInPandas(of_series, schema).groupBy(series).applyInPandas(of_series, schema)


def lag_polynomial(d: int, sd: int, season: int) -> np.ndarray:
    """Weights of the lags of y that make the differenced z."""
    weights = np.zeros(season + 2)
    for a in range(d + 1):
        for b in range(sd + 1):
            weights[a + b * season] += (-1.0) ** (a + b)
    return weights


def long_products(g: np.ndarray, head: np.ndarray, level: float, weights: np.ndarray, long: int, lags: int, n: int) -> np.ndarray:
    """Sums of z(t) z(t-k), k = 0..long, over all t that have both: those of the rows in `g`, and the first
    rows of the series, which lack a lag and are worked out from its head."""
    first = np.flatnonzero(weights)[-1]
    shifts = np.array([on_lags(weights, k, level, lags) for k in range(long + 1)])
    sums = shifts @ (g @ shifts[0])
    y = head[:lags] + level
    z = np.convolve(y, weights[:first + 1])[first:len(y)]
    return sums + [z[k:] @ z[:len(z) - k] if len(z) > k else 0.0 for k in range(long + 1)]


def on_lags(weights: np.ndarray, shift: int, level: float, lags: int) -> np.ndarray:
    """z(t - shift) as a combination of the constant and the lags of y less its level."""
    out = np.zeros(lags + 2)
    out[0] = level * weights.sum()
    out[1 + shift:1 + shift + len(weights)] = weights
    return out


def _alternate(g: np.ndarray, has) -> tuple:
    """Coefficients (phi, Phi, theta, Theta), sum of squares and last change for each matrix of a batch.

    The residual is linear in (phi, theta) for fixed seasonal coefficients and the other way round;
    variables are z, z lag 1, s, s+1 and shocks lag 1, s, s+1.
    """
    n = len(g)
    coef = np.zeros((n, 4))
    directions = {0: ((1, -1.0), (3, 1)), 1: ((2, -1.0), (3, 0)),
                  2: ((4, -1.0), (6, 3)), 3: ((5, -1.0), (6, 2))}

    def vectors(free):
        """Residual = base + sum over free coefficients of coefficient * direction."""
        base, ways = np.zeros((n, 7)), []
        base[:, 0] = 1.0
        for k in range(4):
            (own, sign), (joint, partner) = directions[k]
            if k in free:
                way = np.zeros((n, 7))
                way[:, own] = sign
                way[:, joint] = coef[:, partner] * (1.0 if joint == 3 else -1.0)
                ways.append(way)
            else:
                base[:, own] = sign * coef[:, k]
        return base, ways

    for _ in range(ROUNDS):
        before = coef.copy()
        for free in ([k for k in (0, 2) if has[k]], [k for k in (1, 3) if has[k]]):
            if not free:
                continue
            base, ways = vectors(free)
            u = np.stack(ways, axis=1)
            ug = u @ g
            left = ug @ u.transpose(0, 2, 1)
            right = -np.einsum("bij,bj->bi", ug, base)
            coef[:, free] = np.einsum(
                "bij,bj->bi", np.linalg.pinv(left, rcond=1e-12, hermitian=True), right)
    base, _ = vectors([])
    base[:, 3] = coef[:, 0] * coef[:, 1]
    base[:, 6] = -coef[:, 2] * coef[:, 3]
    return coef, np.maximum(np.einsum("bi,bij,bj->b", base, g, base), 0.0), np.abs(coef - before).max(axis=1)


def order_search(rows: DataFrame, season=SEASON, series="series", idx="idx",
                 value="y") -> DataFrame:
    """(series, p, d, q, sp, sd, sq, n, phi, seasonal_phi, theta, seasonal_theta, aic, change, status),
    64 per series.

    The status is `not_converged` where the last round still changed a coefficient by more than 1e-6.
    All candidates of a series are scored on the same rows, those from position 4s+3 on.

    Differences and shocks are linear in the lags of the series, so both regressions of every candidate
    follow from one matrix of products of 4s+4 lags: the series is read once.
    """
    long, lags = 2 * season + 1, 4 * season + 3
    kind = dict(rows.dtypes)[series]
    known = lag_products(rows, lags, series, idx, value).where("n > 0")

    def candidates(frame):
        """The seven variables' sums of products per series and kind of difference."""
        out = []
        for _, r in frame.iterrows():
            g, head = np.asarray(r["products"]).reshape(lags + 2, lags + 2), np.asarray(r["head"])
            for d, sd in itertools.product((0, 1), repeat=2):
                weights = lag_polynomial(d, sd, season)
                s = long_products(g, head, r["level"], weights, long, lags, r["n"])
                lag = np.abs(np.subtract.outer(np.arange(long), np.arange(long)))
                coef = np.linalg.pinv(s[lag] + 1e-9 * s[0] * np.eye(long), hermitian=True) @ s[1:]
                z = [on_lags(weights, k, r["level"], lags) for k in range(long + season + 2)]
                e = {k: z[k] - sum(c * z[k + j + 1] for j, c in enumerate(coef)) for k in (1, season, season + 1)}
                ways = np.array([z[0], z[1], z[season], z[season + 1], e[1], e[season], e[season + 1]])
                out.append({series: r[series], "d": d, "sd": sd, "equations": r["n"], "g": ways @ g @ ways.T})
        return pd.DataFrame(out)

    def score(batches):
        for frame in batches:
            frame = frame[frame["n"] > 6]
            if frame.empty:
                continue
            frame = candidates(frame)
            g, n = np.stack(frame["g"].to_list()), frame["equations"].to_numpy(float)
            for p, q, sp, sq in itertools.product((0, 1), repeat=4):
                coef, css, change = _alternate(g, (p, sp, q, sq))
                with np.errstate(divide="ignore"):
                    aic = np.where(css > 0, n * (np.log(2 * np.pi * css / n) + 1)
                                   + 2 * (p + q + sp + sq + 1), np.nan)
                yield pd.DataFrame({
                    series: frame[series], "p": p, "d": frame["d"], "q": q, "sp": sp,
                    "sd": frame["sd"], "sq": sq, "n": frame["equations"], "phi": coef[:, 0],
                    "seasonal_phi": coef[:, 1], "theta": coef[:, 2],
                    "seasonal_theta": coef[:, 3], "aic": aic, "change": change,
                    "status": np.where(change > SETTLED, "not_converged", "ok")})

    return known.mapInPandas(
        score, f"`{series}` {kind}, p int, d int, q int, sp int, sd int, sq int, n bigint, "
               "phi double, seasonal_phi double, theta double, seasonal_theta double, aic double, "
               "change double, status string")


def best_order(rows: DataFrame, season=SEASON, series="series", idx="idx", value="y") -> DataFrame:
    """The candidate with the smallest positive AIC of each series."""
    return best_positive(order_search(rows, season, series, idx, value)
                         .where(~F.isnan("aic")), [series])
