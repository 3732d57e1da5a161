"""Filtered reads of stored tables, and output tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_series(df: DataFrame, key: str, keys, date: str, since, until,
                columns: list[str]) -> DataFrame:
    """Rows of the given keys with since <= date <= until, projected. All of it reaches the scan."""
    return (df.where(F.col(key).isin(*keys))
            .where(F.col(date).between(F.lit(since).cast("timestamp_ntz"),
                                       F.lit(until).cast("timestamp_ntz")))
            .select(*columns))


def append_table(df: DataFrame, name: str) -> None:
    """Append to a catalog table, creating it with the columns of the frame."""
    df.write.mode("append").format("parquet").saveAsTable(name)


def append_path(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch into its own partition; a replay replaces it instead of adding to it."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
