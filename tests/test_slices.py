"""Sliced windows against plain pandas, with slices so narrow that every edge case occurs."""

import numpy as np
import pandas as pd
import pytest

from heatline.operators import slices


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    parts = []
    for series, n in [("hot", 97), ("b", 16), ("c", 1), (None, 9)]:
        keys = np.sort(rng.choice(1000, n, replace=False))
        y = np.where(rng.random(n) < 0.3, np.nan, rng.normal(size=n))
        parts.append(pd.DataFrame({"series": series, "key": keys, "idx": np.arange(n), "y": y}))
    pdf = pd.concat(parts, ignore_index=True)
    rows = [(s, int(k), int(i), None if np.isnan(y) else float(y))
            for s, k, i, y in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "series string, key bigint, idx bigint, y double"), pdf


def grouped(pdf):
    return pdf.groupby("series", dropna=False)


def sorted_pandas(df):
    return (df.toPandas().sort_values(["series", "idx"], na_position="last").reset_index(drop=True))


def expect(pdf, **columns):
    return (pdf.assign(**columns).sort_values(["series", "idx"], na_position="last")
            .reset_index(drop=True))


@pytest.mark.parametrize("width,levels", [(5, 1), (64, 1), (5, 3), (64, 2), (100_000, 3)])
def test_row_index(frame, width, levels):
    df, pdf = frame
    got = sorted_pandas(slices.row_index(df.drop("idx"), ["series"], "key", width, levels))
    assert list(got["idx"]) == list(expect(pdf)["idx"])
    overall = slices.row_index(df.where("series = 'hot'").drop("idx"), [], "key", width, levels)
    assert [r.idx for r in overall.orderBy("key").collect()] == list(range(97))


@pytest.mark.parametrize("width", [13, 16, 4096])
def test_lagged(frame, width):
    df, pdf = frame
    got = sorted_pandas(slices.lagged(df, ["series"], "idx", {"a": ("y", 1), "b": ("y", 13)}, width))
    by = grouped(pdf)["y"]
    want = expect(pdf, a=by.shift(1), b=by.shift(13))
    pd.testing.assert_frame_equal(got[["idx", "a", "b"]], want[["idx", "a", "b"]],
                                  check_dtype=False)


def test_lag_deeper_than_a_slice_is_refused(frame):
    with pytest.raises(ValueError):
        slices.lagged(frame[0], ["series"], "idx", {"a": ("y", 14)}, 13)


@pytest.mark.parametrize("width,levels", [(4, 1), (4, 3), (4096, 1)])
def test_running_totals(frame, width, levels):
    df, pdf = frame
    got = sorted_pandas(slices.running_totals(df, ["series"], "idx", ["y"], width, levels))
    filled = pdf.assign(y=pdf["y"].fillna(0.0))
    want = expect(pdf, t=grouped(filled)["y"].cumsum() - filled["y"])
    np.testing.assert_allclose(got["y"], want["t"], atol=1e-12)


@pytest.mark.parametrize("width", [4, 50, 100_000])
def test_neighbours(frame, width):
    df, pdf = frame
    got = (slices.neighbours(df.select("series", "key"), ["series"], "key", width).toPandas()
           .sort_values(["series", "key"], na_position="last"))
    pdf = pdf.sort_values(["series", "key"], na_position="last")
    np.testing.assert_allclose(got["next"], grouped(pdf)["key"].shift(-1))
    assert list(got["origin"]) == list(grouped(pdf)["key"].transform("min"))


@pytest.mark.parametrize("width", [4, 100_000])
def test_sized(frame, width):
    got = slices.sized(frame[0], ["series"], "idx", width).groupBy("series").agg({"n": "min", "*": "count"})
    assert all(r["min(n)"] == r["count(1)"] for r in got.collect()) and got.count() == 4


def test_last_rows(frame):
    df, _ = frame
    got = {}
    for r in slices.last_rows(df, ["series"], "idx", 3).collect():
        got.setdefault(r.series, set()).add(r.idx)
    assert got == {"hot": {94, 95, 96}, "b": {13, 14, 15}, "c": {0}, None: {6, 7, 8}}
