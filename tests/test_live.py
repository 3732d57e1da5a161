import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from heatline.operators import anomaly, autoreg, buckets
from heatline.streaming import live

START = dt.datetime(2024, 1, 1)
SCHEMA = "timestamp timestamp_ntz, series string, prediction double"


def from_scratch(spark, rows, series="series"):
    """Flags and forecasts from all rows at once."""
    sums = buckets.bucket_sums(spark.createDataFrame(rows, SCHEMA), "timestamp", "prediction", 60)
    tagged = anomaly.tag_anomalies(buckets.bucket_means(sums, 60))
    hours = buckets.dense_series(buckets.coarser(sums, 60), "none")
    ends = {r.series: r.last_step for r in buckets.series_ends(hours).collect()}
    flags = {(r.series, r.timestamp): (r.prediction, r.isAnomaly) for r in tagged.collect()}
    ahead = {(r.series, dt.datetime(1970, 1, 1) + dt.timedelta(hours=ends[r.series] + r.h)): r.forecast
             for r in autoreg.seasonal_forecast(hours).collect()}
    return flags, ahead


def made(rng, name, first, count, step=20):
    return [(START + dt.timedelta(minutes=first + step * i), name, float(rng.normal(30, 5) + (200 if rng.random() < 0.02 else 0)))
            for i in range(count)]


def test_batches_equal_one_pass_over_all_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(live, "MERGE_EVERY", 3)
    monkeypatch.setattr(live, "OPEN_HOURS", 12)
    rng, folder = np.random.default_rng(2), str(tmp_path)
    batches = [made(rng, "a", 0, 150) + made(rng, None, 0, 120),            # 50 and 40 hours
               made(rng, "a", 2990, 60) + made(rng, "b", 0, 10),            # goes on, within the last minute's hour too
               made(rng, None, 2400, 90),
               made(rng, "a", 4200, 90) + [(START, "b", None)],
               made(rng, "a", 305, 4, 7) + made(rng, "b", 200, 100),        # hours that were closed change
               made(rng, "a", 9000, 40) + made(rng, None, 4200, 3)]         # after a gap
    seen = []
    for k, batch in enumerate(batches):
        for _ in range(2 if k in (2, 4) else 1):                            # two replays, one of them of a merging batch
            live.signal_batch(spark.createDataFrame(batch, SCHEMA), k, folder)
        seen += batch
        if k in (0, 3):
            continue
        flags, ahead = from_scratch(spark, seen)
        touched = {(name, t.replace(second=0)) for t, name, v in batch if v is not None}
        wrote = spark.read.parquet(f"{folder}/time_series").where(F.col("batch_id") == k).collect()
        assert {(r.series, r.times) for r in wrote} == touched
        for r in wrote:
            assert (pytest.approx(r.prediction), r.isAnomaly) == flags[r.series, r.times]
        got = {(r.series, r.times): r.prediction for r in live.current_forecast(spark, folder).collect()}
        assert got.keys() == ahead.keys()
        assert all(got[key] == pytest.approx(ahead[key], rel=1e-6) for key in ahead)
    now = live.current_minutes(spark, folder).collect()
    assert len(now) == len(flags) and all(r.prediction == pytest.approx(flags[r.series, r.times][0]) for r in now)
    assert len([n for n in os.listdir(f"{folder}/state/bins") if n.startswith("whole")]) <= 2


def test_what_a_batch_reads_does_not_grow(spark, tmp_path, monkeypatch):
    """Bytes of minutes and state that a batch reads, over 14 batches with merges between."""
    read, folder = [], str(tmp_path)

    def measured(function):
        def run(*args, **named):
            df = function(*args, **named)
            if df is not None:
                read.append(sum(os.path.getsize(f.removeprefix("file://")) for f in df.inputFiles()))
            return df
        return run

    monkeypatch.setattr(live, "MERGE_EVERY", 4)
    monkeypatch.setattr(live.StateTable, "read", measured(live.StateTable.read))
    monkeypatch.setattr(live, "stored_minutes", measured(live.stored_minutes))
    monkeypatch.setattr(live, "loci_counts", lambda own, series: own.select(series, "x", F.lit(False).alias("flagged")))
    monkeypatch.setattr(live, "forecasts", lambda state, series: state.select(series, F.lit(START).alias("timestamp"), F.lit(0.0).alias("forecast")))
    sizes, rng = {}, np.random.default_rng(1)
    for k in range(14):
        read.clear()
        # Seven hours a batch; the first holds as many hours as the state keeps.
        first, hours = (0, 80) if k == 0 else (80 + 7 * (k - 1), 7)
        live.signal_batch(spark.createDataFrame(made(rng, "a", first * 60, hours * 6, 10), SCHEMA), k, folder)
        sizes[k] = max(sum(read), 1)
    assert max(sizes[k] for k in range(10, 14)) < 2 * max(sizes[k] for k in (2, 3, 4, 5))


def test_a_batch_of_many_hours_leaves_few_folders(spark, tmp_path, monkeypatch):
    """Minutes spread over more hours than folders, then a batch of few hours among them, twice."""
    monkeypatch.setattr(live, "MOST_FOLDERS", 8)
    monkeypatch.setattr(live, "loci_counts", lambda own, series: own.select(series, "x", F.lit(False).alias("flagged")))
    monkeypatch.setattr(live, "forecasts", lambda state, series: state.select(series, F.lit(START).alias("timestamp"), F.lit(0.0).alias("forecast")))
    rng, folder = np.random.default_rng(4), str(tmp_path)
    batches = [made(rng, "a", 0, 60, 150), made(rng, "a", 300, 5, 30)]
    for k in (0, 1, 1):
        live.signal_batch(spark.createDataFrame(batches[k], SCHEMA), k, folder)
    left = [n for n in os.listdir(f"{folder}/minute_sums") if n.startswith("hours=")]
    assert len(left) <= 2 * 8 and any(not n.startswith("hours=1x") for n in left)
    values = {}
    for t, _, v in batches[0] + batches[1]:
        values.setdefault(t, []).append(v)
    now = live.current_minutes(spark, folder).collect()
    assert {r.times: r.prediction for r in now} == {t: pytest.approx(sum(v) / len(v)) for t, v in values.items()}
    assert any(len(v) > 1 for v in values.values())


def test_late_rows_are_set_aside_and_counted(spark, tmp_path):
    """One row inside the delay, one outside, one without a time; the batch comes twice."""
    def at(minute):
        return START + dt.timedelta(minutes=minute)

    batches = [[(at(0), "a", 1.0), (at(100), "a", 2.0)], [(at(95), "a", 3.0), (at(89), "b", 4.0), (None, "c", 5.0)], [(at(300), "a", 6.0)],
               [(at(250), "a", 7.0)]]
    kept = {}
    for k, batch in enumerate(batches):
        for _ in range(2 if k == 1 else 1):
            df = live.set_late_aside(spark.createDataFrame(batch, SCHEMA), k, str(tmp_path), 600)
            kept[k] = sorted(r.prediction for r in df.collect())
    assert kept == {0: [1.0, 2.0], 1: [3.0, 5.0], 2: [6.0], 3: []}
    late = spark.read.parquet(f"{tmp_path}/late").collect()
    assert sorted((r.prediction, r.batch_id) for r in late) == [(4.0, 1), (7.0, 3)]


def test_first_arrivals_over_any_history(spark, tmp_path, monkeypatch):
    """Copies within a batch, in later batches and much later; NULL keys and times; a replay."""
    schema, looked = "timestamp timestamp_ntz, id bigint, name string", []
    day = [START + dt.timedelta(days=d) for d in range(40)]
    batches = [[(day[0], 1, "a"), (day[0], 1, "a"), (day[0], 2, None)], [(day[1], 3, "b"), (day[0], 1, "a"), (None, 9, "z")],
               [(day[30], 4, "c")], [(day[0], 2, None), (day[0], 2, "x"), (None, 9, "z"), (day[30], 5, "c")]]
    real = live.folder_names
    monkeypatch.setattr(live, "folder_names", lambda *a: looked.append(a) or real(*a))
    kept = {}
    for k, batch in enumerate(batches):
        for _ in range(2 if k in (1, 3) else 1):
            got = live.first_arrivals(spark.createDataFrame(batch, schema), k, str(tmp_path), ["id", "name"])
            kept[k] = sorted((r.id, r.name) for r in got.collect())
    assert kept == {0: [(1, "a"), (2, None)], 1: [(3, "b"), (9, "z")], 2: [(4, "c")], 3: [(2, "x"), (5, "c")]}
    assert sorted(os.listdir(tmp_path / "arrivals"))[-1].startswith("_step=") and looked
