"""A Kalman filter whose state lives on between micro-batches."""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupStateTimeout

from heatline.operators.kalman import StateModel, advance

STATE = "last bigint, x array<double>, p array<double>"


def stream_kalman(stream: DataFrame, model: StateModel, series="series", idx="idx",
                  value="y") -> DataFrame:
    """(series, idx, y, predicted): one-step predictions of each new observation.

    Rows of one batch are ordered by `idx`. Between batches they must arrive in order: an observation
    at or before the last one of an earlier batch is an error, as no prediction for it would be right.
    The state of a series is its last `idx`, mean and covariance, whatever the number of observations
    before. Choose batches (`maxFilesPerTrigger`) so that the rows of one series in one batch fit a
    Python worker; only their `idx` and value are held.
    """
    kind = dict(stream.dtypes)[series]
    size = len(model.x0)

    def update(key, frames, state):
        parts = [(f[idx].to_numpy(np.int64), f[value].to_numpy(float)) for f in frames]
        at, y = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(at, kind="stable")
        at, y = at[order], y[order]
        x, p = model.x0, model.P0
        if state.exists:
            last, x, p = state.get
            if at[0] <= last:
                raise ValueError(f"{series} {key[0]}: {idx} {at[0]} came after {last}")
            x, p = np.asarray(x, float), np.asarray(p, float).reshape(size, size)
        predicted, states, p = advance(model, x, p, y)
        state.update((int(at[-1]), list(map(float, states[-1])), list(map(float, np.ravel(p)))))
        yield pd.DataFrame({series: key[0], idx: at, value: y, "predicted": predicted})

    return (stream.select(series, idx, value).groupBy(series)
            .applyInPandasWithState(
                update, f"`{series}` {kind}, {idx} bigint, {value} double, predicted double",
                STATE, "append", GroupStateTimeout.NoTimeout))
