"""Streaming: deduplication, windowed means, scoring and batch sinks."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.constants import BATCH_SECONDS
from heatline.functions.values import finite, plain_timestamp, step_start
from heatline.operators.anomaly import tag_anomalies
from heatline.operators.autoreg import seasonal_forecast
from heatline.operators.buckets import (
    HOUR, MINUTE, bucket_means, bucket_sums, coarser, dense_series, mean_of, series_ends)
from heatline.operators.learn import score
from heatline.schemas import FORECAST_COLUMNS, TIME_SERIES_COLUMNS
from heatline.sources.tables import write_batch

EVERY = f"{BATCH_SECONDS} seconds"


def event_time(stream: DataFrame, ts="timestamp", delay="10 minutes") -> DataFrame:
    """Declare the time column and how late a row may come."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def once_each(stream: DataFrame, keys: list[str]) -> DataFrame:
    """Drop messages fetched again within the watermark delay."""
    return stream.dropDuplicatesWithinWatermark(keys)


def window_sums(stream: DataFrame, length: str, ts="timestamp", value="prediction",
                series="series") -> DataFrame:
    """(series, timestamp, total, n) per tumbling window, as in `bucket_sums`.

    Without a declared event time (`event_time`) windows never close, and no row is too late.
    """
    return (stream.withColumn("_value", finite(F.col(value)))
            .where(F.col("_value").isNotNull() & F.col(ts).isNotNull())
            .groupBy(F.window(ts, length).alias("_w"), F.col(series))
            .agg(F.sum("_value").alias("total"), F.count("*").alias("n"))
            .select(series, plain_timestamp(F.col("_w.start")).alias("timestamp"), "total", "n"))


def latest_windows(written: DataFrame, series="series") -> DataFrame:
    """The last state written of each window: later batches replace earlier partial means."""
    return (written.groupBy(series, "timestamp")
            .agg(F.max_by("total", "batch_id").alias("total"), F.max_by("n", "batch_id").alias("n"))
            .withColumn("prediction", mean_of()))


def latest_rows(written: DataFrame, keys: list[str]) -> DataFrame:
    """The last row written of each key: what a table of partial results says now."""
    rest = [c for c in written.columns if c not in keys and c != "batch_id"]
    last = F.max_by(F.struct(*rest), "batch_id").alias("_last")
    return written.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def start_batches(stream: DataFrame, handle, checkpoint: str, mode="update", every=None):
    """Run `handle(df, batch_id)` per micro-batch: every so often, or once over what is there.

    The checkpoint remembers the offsets, so a restart resumes after the last finished batch.
    """
    writer = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
              .foreachBatch(handle))
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_available(stream: DataFrame, path: str, checkpoint: str, mode="update") -> None:
    """Write everything available to `path`, one partition per batch, and wait for it."""
    start_batches(stream, lambda df, batch_id: write_batch(df, path, batch_id),
                  checkpoint, mode).awaitTermination()


def score_stream(stream: DataFrame, model, text="text") -> DataFrame:
    """Add `prediction` with a model loaded once for the life of the stream."""
    return score(stream, model, text)


def signals(minute_sums: DataFrame, series="series") -> dict:
    """`time_series` (minute means with outlier flags) and `forecast` (hourly) from minute sums."""
    history = tag_anomalies(bucket_means(minute_sums, MINUTE, series), series=series)
    hours = dense_series(coarser(minute_sums, HOUR // MINUTE, series), "none", series)
    ends = series_ends(hours, series=series).select(F.col(series).alias("_series"), "last_step")
    ahead = (seasonal_forecast(hours, series=series)
             .join(ends, F.col(series).eqNullSafe(F.col("_series")))
             .withColumn("timestamp", step_start(F.col("last_step") + F.col("h"), HOUR)))
    return {
        "time_series": history.select(series, *TIME_SERIES_COLUMNS)
        .withColumnsRenamed(TIME_SERIES_COLUMNS),
        "forecast": ahead.select(series, *FORECAST_COLUMNS).withColumnsRenamed(FORECAST_COLUMNS),
    }
