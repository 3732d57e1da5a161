"""States at the start of each slice of a long series, from summaries of the slices before it.

A filter or a recursion is sequential, but what a slice does to any state before it can be summarised.
Here the summaries of a series are carried on from slice to slice. They too are cut into blocks, so
that no task holds all of them: each block is summarised as one, the few block summaries are carried
on, and then the slices of all blocks side by side.
"""

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024


def starts(summaries: DataFrame, first: Callable, apply: Callable, reduce: Callable, series="series",
           block=BLOCK) -> DataFrame:
    """(series, _slice, start): the state at which every slice but the first begins.

    `summaries` has (series, _slice, parts), one row per full slice, without gaps. `first(parts)` is
    the state before the series, `apply(state, parts, slices)` the state after a stretch of so many
    slices, and `reduce(list of parts)` the summary of neighbouring slices.
    """
    kind = dict(summaries.dtypes)[series]
    cut = summaries.withColumn("_block", F.floor(F.col("_slice") / block).cast("bigint"))

    def whole(key, frame):
        if len(frame) < block:      # nothing follows a block that is not full
            return pd.DataFrame(columns=[series, "_block", "parts"], dtype=object)
        parts = [np.asarray(p, float) for p in frame.sort_values("_slice")["parts"]]
        return pd.DataFrame({series: [key[0]], "_block": [key[1]], "parts": [reduce(parts)]})

    def carry(parts, state, slices):
        out = []
        for p in parts:
            p = np.asarray(p, float)
            state = apply(first(p) if state is None else state, p, slices)
            out.append(state)
        return out

    def over_blocks(key, frame):
        frame = frame.sort_values("_block")
        return pd.DataFrame({series: key[0], "_block": frame["_block"] + 1, "start": carry(frame["parts"], None, block)})

    def inside(key, frame, before):
        if frame.empty:
            return pd.DataFrame(columns=[series, "_slice", "start"], dtype=object)
        frame = frame.sort_values("_slice")
        state = np.asarray(before["start"].iloc[0], float) if len(before) else None
        return pd.DataFrame({series: key[0], "_slice": frame["_slice"] + 1, "start": carry(frame["parts"], state, 1)})

    blocks = (cut.groupBy(series, "_block").applyInPandas(whole, f"`{series}` {kind}, _block bigint, parts array<double>")
              .groupBy(series).applyInPandas(over_blocks, f"`{series}` {kind}, _block bigint, start array<double>"))
    return (cut.groupBy(series, "_block").cogroup(blocks.groupBy(series, "_block"))
            .applyInPandas(inside, f"`{series}` {kind}, _slice bigint, start array<double>"))
