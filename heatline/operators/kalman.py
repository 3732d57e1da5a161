"""Kalman filters over many, possibly very long, series.

A filter is sequential, but what a stretch of observations does to any starting state can be
summarised and such summaries combine associatively (Sarkka and Garcia-Fernandez, 2021). So every
slice is summarised on its own, the few summaries of a series are folded into the state at the
start of each slice, and then all slices are filtered side by side. Only full slices that another
one follows need a summary: a series that fits one slice is filtered directly.
"""

from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heatline.constants import (
    ACCELERATION_DT, ACCELERATION_Q, ACCELERATION_R, VELOCITY_NOISE, VELOCITY_R, VELOCITY_START)
from heatline.operators import folds
from heatline.operators.slices import SLICE, last_rows, slice_of


class StateModel(NamedTuple):
    """x' = F x + noise(Q), z = H x + noise(R), starting at x0 with covariance P0."""
    F: np.ndarray
    H: np.ndarray
    Q: np.ndarray
    R: float
    P0: np.ndarray
    x0: np.ndarray
    dt: float


def state_model(F, H, Q=None, R=1.0, P0=None, x0=None, dt=1.0) -> StateModel:
    """Matrices left out are identities, the start is zero."""
    F = np.asarray(F, float)
    n = len(F)
    return StateModel(F, np.asarray(H, float).reshape(n),
                      np.eye(n) if Q is None else np.asarray(Q, float), float(R),
                      np.eye(n) if P0 is None else np.asarray(P0, float),
                      np.zeros(n) if x0 is None else np.asarray(x0, float), float(dt))


def acceleration_model(dt=ACCELERATION_DT) -> StateModel:
    """Level, slope and acceleration."""
    return state_model(np.eye(3) + dt * np.eye(3, k=1), [1, 0, 0], Q=ACCELERATION_Q,
                       R=ACCELERATION_R, dt=dt)


def velocity_model(noise_dt=ACCELERATION_DT, variance=VELOCITY_NOISE) -> StateModel:
    """Level and slope with discrete white noise, vague start."""
    push = np.array([noise_dt ** 2 / 2, noise_dt])
    return state_model(np.eye(2) + np.eye(2, k=1), [1, 0], Q=variance * np.outer(push, push),
                       R=VELOCITY_R, P0=VELOCITY_START * np.eye(2))


def advance(model: StateModel, x, p, values):
    """Filter values from state (x, p): one-step predictions, states after each, last covariance.

    A missing value (NaN) moves the state without correcting it. The values are cut into as many blocks as
    a block has values: what each block does to any state is summarised for all blocks at once, the state
    is carried from block to block, and then all blocks are filtered side by side. So there are some three
    times as many steps as the root of the length, each over arrays.
    """
    values = np.asarray(values, float)
    length = max(1, int(np.sqrt(len(values))))
    blocks = -(-len(values) // length)
    z = np.full(blocks * length, np.nan)
    z[:len(values)] = values
    z = z.reshape(blocks, length)
    xs, ps = np.empty((blocks, len(x))), np.empty((blocks, len(x), len(x)))
    whole = _together(_elements(model, z.T)) if blocks > 1 else None
    zero, none = np.zeros((len(x), len(x))), np.zeros(len(x))
    for b in range(blocks):
        xs[b], ps[b] = x, p
        if b + 1 < blocks:
            _, x, p, _, _ = _combine((zero, np.asarray(x, float), np.asarray(p, float), none, zero), tuple(w[b] for w in whole))
    return _side_by_side(model, xs, ps, z, len(values))


def _side_by_side(model: StateModel, x, p, z, count: int):
    """`advance` of one block a row, each from its own state; only the first `count` values are real."""
    blocks, length = z.shape
    predicted, states = np.empty((blocks, length)), np.empty((blocks, length, x.shape[1]))
    one, last = np.eye(x.shape[1]), (count - 1) % length if count else -1
    ending = p[-1] if blocks else p
    for i in range(length if blocks else 0):
        x = x @ model.F.T
        p = model.F @ p @ model.F.T + model.Q
        predicted[:, i] = x @ model.H
        there = ~np.isnan(z[:, i])
        gain = p @ model.H
        gain = np.where(there[:, None], gain / (model.R + gain @ model.H)[:, None], 0.0)
        x = x + gain * np.where(there, z[:, i] - predicted[:, i], 0.0)[:, None]
        keep = one - gain[:, :, None] * model.H
        p = keep @ p @ np.swapaxes(keep, 1, 2) + model.R * gain[:, :, None] * gain[:, None, :]
        states[:, i] = x
        if i == last:
            ending = p[-1]
    return predicted.ravel()[:count], states.reshape(blocks * length, -1)[:count], ending


def _summary(model: StateModel, values):
    """Summary (A, b, C, eta, J) of a stretch of observations, for any state before it.

    One element per observation, all stacked, then combined pairwise: as many steps as the logarithm
    of the length.
    """
    return _together(_elements(model, values))


def _elements(model: StateModel, values):
    """The summary of each single observation, stacked like the values."""
    n, one = len(model.x0), np.eye(len(model.x0))
    spread = model.R + model.H @ model.Q @ model.H
    gain = model.Q @ model.H / spread
    seen = model.F.T @ model.H / spread
    keep = one - np.outer(gain, model.H)
    z = np.where(np.isnan(values), 0.0, values)[..., None]
    there = ~np.isnan(values)[..., None]
    wide = there[..., None]
    return (np.where(wide, keep @ model.F, model.F), np.where(there, gain * z, 0.0),
            np.where(wide, keep @ model.Q, model.Q), np.where(there, seen * z, 0.0),
            np.where(wide, np.outer(model.F.T @ model.H, seen), np.zeros((n, n))))


def _together(parts):
    """One summary of stacked ones, neighbours pairwise."""
    while len(parts[0]) > 1:
        odd = len(parts[0]) % 2
        joined = _combine(tuple(p[:len(p) - odd:2] for p in parts), tuple(p[1:len(p):2] for p in parts))
        parts = tuple(np.concatenate([j, p[len(p) - odd:]]) for j, p in zip(joined, parts))
    return tuple(p[0] for p in parts)


def _flat(parts) -> np.ndarray:
    return np.concatenate([np.ravel(p) for p in parts])


def _unflat(flat: np.ndarray, n: int) -> tuple:
    """The parts of one summary, or of several stacked ones."""
    a, b, c, e, j = np.split(flat, np.cumsum([n * n, n, n * n, n]), axis=-1)
    square = (*flat.shape[:-1], n, n)
    return a.reshape(square), b, c.reshape(square), e, j.reshape(square)


def _times(matrix, vector):
    return np.einsum("...ij,...j->...i", matrix, vector)


def _combine(first, then):
    """Summaries of neighbouring stretches, single or stacked."""
    a1, b1, c1, e1, j1 = first
    a2, b2, c2, e2, j2 = then
    one = np.eye(b1.shape[-1])
    forward = a2 @ np.linalg.inv(one + c1 @ j2)
    back = np.swapaxes(a1, -1, -2) @ np.linalg.inv(one + j2 @ c1)
    return (forward @ a1, _times(forward, b1 + _times(c1, e2)) + b2,
            forward @ c1 @ np.swapaxes(a2, -1, -2) + c2,
            _times(back, e2 - _times(j2, b1)) + e1, back @ j2 @ a1 + j1)


def kalman_filter(rows: DataFrame, model: StateModel, series="series", idx="idx", value="y",
                  width=SLICE) -> DataFrame:
    """(series, idx, y, predicted, state): prediction before, and state after, each observation."""
    kind, n = dict(rows.dtypes)[series], len(model.x0)
    cut = rows.select(series, F.col(idx).cast("bigint").alias(idx),
                      F.col(value).cast("double").alias(value)).withColumn(
        "_slice", slice_of(F.col(idx), width))

    def summarise(key, frame):
        if len(frame) < width:      # idx has no gaps, so nothing follows this slice
            return pd.DataFrame(columns=[series, "_slice", "parts"], dtype=object)
        values = frame.sort_values(idx)[value].to_numpy(float)
        return pd.DataFrame({series: [key[0]], "_slice": [key[1]], "parts": [_flat(_summary(model, values))]})

    def first(parts):
        return np.concatenate([model.x0, np.ravel(model.P0)])

    def apply(state, parts, slices):
        zero = np.zeros((n, n))
        after = _combine((zero, state[:n], state[n:].reshape(n, n), np.zeros(n), zero), _unflat(parts, n))
        return np.concatenate([after[1], np.ravel(after[2])])

    def reduce(parts):
        return _flat(_together(_unflat(np.stack(parts), n)))

    def run(key, frame, start):
        # a start may exist for a slice that has no rows, when the last slice is exactly full
        if frame.empty:
            return pd.DataFrame(columns=[series, idx, value, "predicted", "state"], dtype=object)
        x, p = model.x0, model.P0
        if len(start):
            flat = np.asarray(start["start"].iloc[0])
            x, p = flat[:n], flat[n:].reshape(n, n)
        frame = frame.sort_values(idx)
        predicted, states, _ = advance(model, x, p, frame[value].to_numpy(float))
        return pd.DataFrame({series: frame[series], idx: frame[idx], value: frame[value],
                             "predicted": predicted, "state": list(states)})

    summaries = cut.groupBy(series, "_slice").applyInPandas(
        summarise, f"`{series}` {kind}, _slice bigint, parts array<double>")
    starts = folds.starts(summaries, first, apply, reduce, series)
    out = f"`{series}` {kind}, {idx} bigint, {value} double, predicted double, state array<double>"
    return (cut.groupBy(series, "_slice").cogroup(starts.groupBy(series, "_slice"))
            .applyInPandas(run, out))


def final_states(filtered: DataFrame, series="series", idx="idx") -> DataFrame:
    """(series, last_idx, state) after the last observation of each series."""
    return last_rows(filtered, [series], idx, 1).select(
        series, F.col(idx).alias("last_idx"), "state")


def _ahead(state: Column, k: Column, size: int, dt: float) -> Column:
    """First component of F^k x for a chain of integrators: sum of C(k, j) dt^j x_j."""
    total, choose = F.get(state, F.lit(0)), F.lit(1.0)
    for j in range(1, size):
        choose = choose * (k - (j - 1)) / j
        total = total + choose * (dt ** j) * F.get(state, F.lit(j))
    return total


def kalman_forecast(states: DataFrame, model: StateModel, steps: int,
                    series="series") -> DataFrame:
    """(series, h, forecast), h = 1..steps.

    Feeding a prediction back as an observation has no innovation, so the mean is H F^h x exactly.
    """
    size = len(model.x0)
    chain = np.eye(size) + model.dt * np.eye(size, k=1)
    if not np.allclose(model.F, chain):
        raise ValueError("closed-form forecasts need F = I + dt * shift")
    return (states.withColumn("h", F.explode(F.expr(f"sequence(1L, {steps}L)")))
            .select(series, "h", _ahead(F.col("state"), F.col("h"), size, model.dt)
                    .alias("forecast")))
