"""The live tables, kept up from what each batch changes.

A batch reads the minutes of the hours it touches, and per series the counts of filled bins, the sums of
lagged products and the last hours: sizes that do not grow with the history.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heatline.constants import FORECAST_SHARE, SEASON
from heatline.functions.text import clean_text
from heatline.functions.values import plain_timestamp, step_start
from heatline.operators.anomaly import RESOLUTION, bin_of, loci_counts
from heatline.operators.autoreg import seasonal_lags, seasonal_rule, seasonal_solve
from heatline.operators.buckets import DAY, HOUR, MINUTE, bucket_sums, coarser, mean_of
from heatline.operators.recurrence import extend
from heatline.operators.slices import row_index, sized
from heatline.schemas import FORECAST_COLUMNS, MESSAGE_COLUMNS, TIME_SERIES_COLUMNS
from heatline.session import drop_folder, folder_names, settle
from heatline.sources.tables import read_table, write_batch
from heatline.streaming.flow import latest_rows, signals

#: Parts of a state table after which they are merged into one.
MERGE_EVERY = 16
#: Hours at the end of a series that may still change without its sums being made anew.
OPEN_HOURS = 48
#: Folders of minute sums that a batch leaves at most, and how much wider they get where there would be more.
MOST_FOLDERS, WIDER = 256, 16
LAGGED = ["w0", "w1", "ws", "wt"]
PAIRS = [(i, j) for i in range(4) for j in range(i, 4)]


class StateTable:
    """Rows that batches leave for later ones: a part per batch, merged from time to time.

    Batch b reads what batches before it left, so a replayed batch finds the same state again and replaces
    its own part. `merge` makes one state of any parts.
    """

    def __init__(self, spark: SparkSession, path: str, merge):
        self.spark, self.path, self.merge = spark, path, merge

    def numbers(self, kind: str) -> list[int]:
        return sorted(int(n.split("-")[1]) for n in folder_names(self.spark, self.path) if n.startswith(f"{kind}-"))

    def read(self, before: int) -> DataFrame | None:
        whole = max((k for k in self.numbers("whole") if k < before), default=-1)
        paths = [f"{self.path}/whole-{whole}"] * (whole >= 0) + [f"{self.path}/part-{k}" for k in self.numbers("part") if whole < k < before]
        return self.merge(self.spark.read.parquet(*paths)) if paths else None

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/part-{batch_id}")
        if batch_id % MERGE_EVERY == MERGE_EVERY - 1:
            self.read(batch_id + 1).write.mode("overwrite").parquet(f"{self.path}/whole-{batch_id}")
            # A replay of this batch still needs the merge before it and the parts since.
            kept = max((k for k in self.numbers("whole") if k < batch_id), default=-1)
            for kind in ("whole", "part"):
                for k in self.numbers(kind):
                    if k < kept or (kind == "part" and k <= kept):
                        drop_folder(self.spark, f"{self.path}/{kind}-{k}")


def of(left: DataFrame, right: DataFrame, series: str, how: str, *keys: str) -> DataFrame:
    """Join by series, NULL included, and other keys; columns of the right side other than these are added."""
    renamed = right.withColumnsRenamed({c: f"_{c}" for c in (series, *keys)})
    on = F.col(series).eqNullSafe(F.col(f"_{series}"))
    for c in keys:
        on = on & (F.col(c) == F.col(f"_{c}"))
    joined = left.join(renamed, on, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_{c}" for c in (series, *keys)])


def folders_of(hours: DataFrame) -> tuple[int, list[int]]:
    """(width, blocks): the fewest hours to a folder that put these hours into `MOST_FOLDERS` folders at most."""
    width = 1
    while True:
        blocks = [r[0] for r in hours.select(F.floor(F.col("hour") / width)).distinct().limit(MOST_FOLDERS + 1).collect()]
        if len(blocks) <= MOST_FOLDERS:
            return width, blocks
        width *= WIDER


def stored_minutes(spark: SparkSession, folder: str, batch_id: int, touched: tuple[int, list[int]] | None) -> DataFrame | None:
    """Minute sums of earlier batches: those in folders with hours of the given ones (see `folders_of`), or all."""
    path = f"{folder}/minute_sums"
    there = [n for n in folder_names(spark, path) if n.startswith("hours=")]

    def meets(name: str) -> bool:
        own, block = map(int, name.removeprefix("hours=").split("x"))
        wide = max(own, touched[0])
        return block * own // wide in {b * touched[0] // wide for b in touched[1]}

    paths = [f"{path}/{n}" for n in sorted(there) if touched is None or meets(n)]
    if not paths:
        return None
    return spark.read.option("basePath", path).parquet(*paths).where(F.col("batch_id") < batch_id)


def changed_minutes(new: DataFrame, old: DataFrame | None, series: str) -> DataFrame:
    """(series, step, total, n, was_total, was_n): minutes of the batch with their sums now and before."""
    nothing = {"was_total": F.lit(None).cast("double"), "was_n": F.lit(None).cast("bigint")}
    if old is None:
        return new.withColumns(nothing)
    before = old.groupBy(series, "step").agg(F.sum("total").alias("was_total"), F.sum("n").alias("was_n"))
    return of(new, before, series, "left", "step").withColumns({
        "total": F.col("total") + F.coalesce("was_total", F.lit(0.0)), "n": F.col("n") + F.coalesce("was_n", F.lit(0))})


def merged_bins(parts: DataFrame, series: str) -> DataFrame:
    return parts.groupBy(series, "x").agg(F.sum("c").alias("c")).where("c <> 0")


def bin_changes(minutes: DataFrame, series: str, resolution: float) -> DataFrame:
    """(series, x, c): a minute leaves the bin of its mean before and enters that of its mean now."""
    now = minutes.select(series, bin_of(mean_of(), resolution).alias("x"), F.lit(1).cast("bigint").alias("c"))
    was = minutes.where("was_n is not null").select(
        series, bin_of(mean_of("was_total", "was_n"), resolution).alias("x"), F.lit(-1).cast("bigint").alias("c"))
    return merged_bins(now.unionByName(was).where("x is not null"), series)


def latest_state(parts: DataFrame, series: str) -> DataFrame:
    """Of the rows that batches left of a series the last one."""
    rest = [c for c in parts.columns if c != series]
    return parts.groupBy(series).agg(F.max_by(F.struct(*rest), "batch_id").alias("s")).select(series, *[f"s.{c}" for c in rest])


def hour_state(touched: DataFrame, old: DataFrame | None, history, batch_id: int, series: str, season=SEASON) -> DataFrame:
    """The state of the touched series after this batch.

    (series, batch_id, dropped, frozen, closed, g_i_j..., all, a_i_j..., tail): `tail` are the last hours
    with their sums, `dropped` counts the hours before it. `g_i_j` are the sums of lagged products over the
    `closed` equations of hours up to `frozen`, which may change no more; `a_i_j` over all hours, as
    `autoreg.seasonal_gram` gives them. Where an hour up to `frozen` changes after all, the series starts
    again from `history()`, all its hours.
    """
    kept = 2 * season + 1 + OPEN_HOURS
    hours = touched.select(series, "step", "total", F.col("n").alias("c"))
    if old is None:
        region, known = hours, None
    else:
        own = of(old, touched.select(series).distinct(), series, "left_semi")
        firsts = touched.groupBy(series).agg(F.min("step").alias("first"))
        late = settle(of(own, firsts, series, "inner").where("first <= frozen").select(series))
        known = of(own, late, series, "left_anti")
        tails = known.select(series, F.explode("tail").alias("t")).select(series, "t.*")
        region = of(hours, late, series, "left_anti").unionByName(tails)
        if late.take(1):
            region = region.unionByName(of(history(), late, series, "left_semi").select(series, "step", "total", F.col("n").alias("c")))
    region = region.groupBy(series, "step").agg(F.sum("total").alias("total"), F.sum("c").alias("c"))
    rows = row_index(region, [series], "step").withColumn("y", mean_of("total", "c"))
    lags = sized(seasonal_lags(rows, season, series, keep=("step", "total", "c")), [series], "idx")
    shut, product = F.col("idx") < F.col("n") - OPEN_HOURS, {(i, j): F.col(LAGGED[i]) * F.col(LAGGED[j]) for i, j in PAIRS}
    zero = F.lit(0.0)
    sums = lags.groupBy(series).agg(
        F.count("*").alias("rows"), F.max(F.when(shut, F.col("step"))).alias("frozen"),
        F.count(F.when(shut, F.col("w0"))).alias("closed"), F.count("w0").alias("all"),
        *[F.coalesce(F.sum(F.when(shut, product[p])), zero).alias(f"g_{p[0]}_{p[1]}") for p in PAIRS],
        *[F.coalesce(F.sum(product[p]), zero).alias(f"a_{p[0]}_{p[1]}") for p in PAIRS],
        F.sort_array(F.collect_list(F.when(F.col("idx") >= F.col("n") - kept, F.struct("step", "total", "c")))).alias("tail"))
    was = (sums.limit(0) if known is None else known).select(
        series, F.col("dropped" if known is not None else "rows").alias("was_dropped"), F.col("frozen").alias("was_frozen"),
        F.col("closed").alias("was_closed"), *[F.col(f"g_{i}_{j}").alias(f"was_{i}_{j}") for i, j in PAIRS])

    def plus(name: str, more: str) -> Column:
        return F.col(name) + F.coalesce(F.col(more), F.lit(0))

    return of(sums, was, series, "left").select(
        series, F.lit(batch_id).cast("bigint").alias("batch_id"),
        (F.coalesce("was_dropped", F.lit(0)) + F.greatest(F.col("rows") - kept, F.lit(0))).cast("bigint").alias("dropped"),
        F.coalesce("frozen", "was_frozen").alias("frozen"), plus("closed", "was_closed").alias("closed"),
        *[plus(f"g_{i}_{j}", f"was_{i}_{j}").alias(f"g_{i}_{j}") for i, j in PAIRS], plus("all", "was_closed").alias("all"),
        *[plus(f"a_{i}_{j}", f"was_{i}_{j}").alias(f"a_{i}_{j}") for i, j in PAIRS], "tail")


def forecasts(state: DataFrame, series: str, season=SEASON, share=FORECAST_SHARE) -> DataFrame:
    """(series, timestamp, forecast) of every series of a state, as `autoreg.seasonal_forecast` makes them."""
    sums = state.select(series, (F.col("dropped") + F.size("tail")).alias("n"), F.col("all").alias("equations"),
                        *[F.col(f"a_{i}_{j}").alias(f"g_{i}_{j}") for i, j in PAIRS])
    models = seasonal_rule(seasonal_solve(sums, series), season, share, series)
    ends = state.select(series, F.transform(F.slice("tail", -F.least(F.size("tail"), F.lit(2 * season + 1)), 2 * season + 1),
                                            lambda t: t["total"] / t["c"]).alias("tail"), F.element_at("tail", -1)["step"].alias("last"))
    ahead = extend(of(models, ends.select(series, "tail"), series, "inner"), series)
    return of(ahead, ends.select(series, "last"), series, "inner").withColumn("timestamp", step_start(F.col("last") + F.col("h"), HOUR))


def signal_batch(scored: DataFrame, batch_id: int, folder: str, series="series", per_batch=False, resolution=RESOLUTION) -> None:
    """Sink of the live flow: tables `messages` (where there are texts), `minute_sums`, `time_series`, `forecast`.

    `time_series` receives the minutes that this batch touched, with their mean over all batches so far and
    flagged against the whole history; `current_minutes` has one row per minute. `forecast` starts from all
    hours so far; `current_forecast` has the last one of each series. With `per_batch` both see this batch
    alone, and no state is kept. Batches are numbered from 0 without gaps; a replayed batch replaces what
    it wrote before.
    """
    spark = scored.sparkSession
    kept = scored.persist()
    try:
        if "text" in kept.columns:
            write_batch(kept.select(series, plain_timestamp(F.col("timestamp")).alias("timestamp"),
                                    clean_text(F.col("text")).alias("text"))
                        .withColumnsRenamed(MESSAGE_COLUMNS), f"{folder}/messages", batch_id)
        new = settle(bucket_sums(kept, "timestamp", "prediction", MINUTE, series)
                     .withColumn("hour", F.floor(F.col("step") * MINUTE / HOUR).cast("bigint")))
    finally:
        kept.unpersist()
    touched = folders_of(new.select("hour").distinct())
    block = F.concat(F.lit(f"{touched[0]}x"), F.floor(F.col("hour") / touched[0]).cast("string"))
    (new.withColumn("hours", block).withColumn("batch_id", F.lit(batch_id).cast("bigint")).drop("hour").hint("rebalance", "hours")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("hours", "batch_id").parquet(f"{folder}/minute_sums"))
    if per_batch:
        outputs = signals(new.drop("hour"), series)
        write_batch(outputs["time_series"], f"{folder}/time_series", batch_id)
        write_batch(outputs["forecast"], f"{folder}/forecast", batch_id)
        return
    minutes = settle(changed_minutes(new.drop("hour"), stored_minutes(spark, folder, batch_id, touched), series))
    bins = StateTable(spark, f"{folder}/state/bins", lambda parts: merged_bins(parts, series))
    changes = settle(bin_changes(minutes, series, resolution))
    before = bins.read(batch_id)
    own = changes if before is None else merged_bins(changes.unionByName(of(before, minutes.select(series).distinct(), series, "left_semi")), series)
    flags = loci_counts(own, series).select(series, "x", F.col("flagged").cast("int").alias("isAnomaly"))
    named = minutes.select(series, step_start(F.col("step"), MINUTE).alias("timestamp"), mean_of().alias("prediction"),
                           bin_of(mean_of(), resolution).alias("x"))
    write_batch(of(named, flags, series, "left", "x").select(series, *TIME_SERIES_COLUMNS).withColumnsRenamed(TIME_SERIES_COLUMNS),
                f"{folder}/time_series", batch_id)
    bins.write(changes, batch_id)

    hours = StateTable(spark, f"{folder}/state/hours", lambda parts: latest_state(parts, series))

    def history() -> DataFrame:
        every = stored_minutes(spark, folder, batch_id + 1, None)
        return coarser(every.select(series, "step", "total", "n"), HOUR // MINUTE, series)

    state = settle(hour_state(coarser(new.select(series, "step", "total", "n"), HOUR // MINUTE, series), hours.read(batch_id), history,
                              batch_id, series))
    write_batch(forecasts(state, series).select(series, *FORECAST_COLUMNS).withColumnsRenamed(FORECAST_COLUMNS),
                f"{folder}/forecast", batch_id)
    hours.write(state, batch_id)


def first_arrivals(rows: DataFrame, batch_id: int, folder: str, keys: list[str], ts="timestamp", seconds=DAY) -> DataFrame:
    """The rows of a batch whose keys no earlier batch has had, one of each.

    A message fetched again carries the time it was written, so digests are kept by that time in the table
    `arrivals`, and a batch looks only into the steps of `seconds` that it touches: history of any length
    costs disk and nothing else, and no state is held between batches. The digest is SHA-256 of the keys;
    NULL is a key like any other, rows without a time have a step of their own. A replayed batch finds the
    same rows again.
    """
    spark, path = rows.sparkSession, f"{folder}/arrivals"
    step = F.coalesce(F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / seconds), F.lit(-1)).cast("bigint")
    named = F.to_json(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)]), {"ignoreNullFields": "false"})
    marked = settle(rows.withColumn("_step", step).withColumn("_digest", F.unhex(F.sha2(named.cast("binary"), 256)))
                    .dropDuplicates(["_step", "_digest"]))
    there = {int(n.split("=")[1]) for n in folder_names(spark, path) if n.startswith("_step=")}
    paths = [f"{path}/_step={r[0]}" for r in marked.select("_step").distinct().collect() if r[0] in there]
    new = marked
    if paths:
        seen = spark.read.option("basePath", path).parquet(*paths).where(F.col("batch_id") < batch_id).select("_step", "_digest")
        new = marked.join(seen, ["_step", "_digest"], "left_anti")
    new.select("_digest", "_step", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("_step", "batch_id").parquet(path)
    return new.drop("_step", "_digest")


def set_late_aside(rows: DataFrame, batch_id: int, folder: str, delay: int, ts="timestamp") -> DataFrame:
    """The rows of a batch that are in time; the late ones go to the table `late` and are not lost.

    A row is late where its time lies more than `delay` seconds before the latest time of all earlier
    batches, which is when a watermark would drop it without a word. Rows without a time are in time.
    A replayed batch is judged as it was before and replaces its own rows.
    """
    spark = rows.sparkSession
    seen = StateTable(spark, f"{folder}/state/seen", lambda parts: parts.agg(F.max("latest").alias("latest")))
    before = seen.read(batch_id)
    latest = before.first().latest if before is not None else None
    seconds = F.unix_micros(F.col(ts).cast("timestamp"))
    late = F.lit(False) if latest is None else F.coalesce(seconds < F.lit(latest - delay * 1_000_000), F.lit(False))
    seen.write(rows.agg(F.max(seconds).alias("latest")).select(F.coalesce("latest", F.lit(latest).cast("bigint")).alias("latest")), batch_id)
    write_batch(rows.where(late), f"{folder}/late", batch_id)
    return rows.where(~late)


def current_minutes(spark: SparkSession, folder: str, series="series") -> DataFrame:
    """`time_series` with one row per minute: what the last batch that touched it says."""
    return latest_rows(read_table(spark, f"{folder}/time_series"), [series, "times"])


def current_forecast(spark: SparkSession, folder: str, series="series") -> DataFrame:
    """`forecast` with the rows of the last batch that touched the series."""
    rows = read_table(spark, f"{folder}/forecast")
    last = rows.groupBy(series).agg(F.max("batch_id").alias("batch_id"))
    return of(rows, last, series, "left_semi", "batch_id").drop("batch_id")
