"""Forecasts that continue a series by a fixed linear rule of its last values.

y(h) = const + sum of coef_k y(h-k). Blocks of a long horizon are computed side by side: the values
before a block follow from the last known ones by a power of the rule's matrix.
"""

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
TOGETHER = 256


def _before(state: np.ndarray, coef: np.ndarray, const: float, steps: int) -> np.ndarray:
    """The values (oldest first) that precede step `steps` + 1."""
    n = len(state)
    rule = np.zeros((n + 1, n + 1))
    rule[:n - 1, 1:n] = np.eye(n - 1)
    rule[n - 1, :n] = coef[::-1]
    rule[n - 1, n] = const
    rule[n, n] = 1.0
    return (np.linalg.matrix_power(rule, steps) @ np.append(state, 1.0))[:n]


def extend(models: DataFrame, series="series", block=BLOCK) -> DataFrame:
    """(series, h, forecast) for h = 1..steps from (series, coef, const, tail, steps).

    `coef` starts with lag 1, `tail` is as long and ends with the latest value.
    """
    schema = f"`{series}` {dict(models.dtypes)[series]}, h bigint, forecast double"
    last = F.floor((F.col("steps") - 1) / block)
    blocks = (models.where(F.col("steps") > 0)
              .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
              .repartition(series, "_block")
              .select(series, "coef", "const", "tail", "steps", "_block"))

    def run(batches):
        for frame in batches:
            sizes = frame["coef"].map(len)
            for known in sorted(sizes.unique()):
                same = frame[sizes == known]
                for at in range(0, len(same), TOGETHER):
                    yield continued(same.iloc[at:at + TOGETHER], known)

    def continued(frame, known):
        """The blocks of many models, step by step for all of them."""
        coef = np.stack([np.asarray(c, float)[::-1] for c in frame["coef"]])
        const, first = frame["const"].to_numpy(float), frame["_block"].to_numpy(np.int64) * block
        length = np.minimum(block, frame["steps"].to_numpy(np.int64) - first)
        path = np.empty((len(frame), known + int(length.max())))
        path[:, :known] = [_before(np.asarray(t, float), c[::-1], k, f)
                           for t, c, k, f in zip(frame["tail"], coef, const, first.tolist())]
        for i in range(known, path.shape[1]):
            path[:, i] = const + np.einsum("mk,mk->m", coef, path[:, i - known:i])
        row = np.repeat(np.arange(len(frame)), length)
        step = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
        return pd.DataFrame({series: frame[series].to_numpy()[row], "h": first[row] + step + 1,
                             "forecast": path[row, known + step]})
    return blocks.mapInPandas(run, schema)
