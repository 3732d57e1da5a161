"""Reading and writing delimited files."""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatline.constants import LEGACY_ENCODING
from heatline.functions.values import number
from heatline.operators.slices import row_index

# Files in a corpus folder that are not collected messages.
NOT_MESSAGES = ("timeseries.csv", "tweets_training.csv")


def read_csv(spark: SparkSession, path, schema: T.StructType, encoding="UTF-8") -> DataFrame:
    """Header CSV whose quotes are doubled inside quoted fields; malformed rows are dropped.

    Fields may span lines, so a file is read by one task: collect messages in many files. An empty
    field is NULL.
    """
    return (spark.read.schema(schema).option("header", True).option("mode", "DROPMALFORMED")
            .option("quote", '"').option("escape", '"').option("multiLine", True)
            .option("enforceSchema", False).option("encoding", encoding).csv(path))


def read_legacy_csv(spark: SparkSession, path, schema: T.StructType) -> DataFrame:
    return read_csv(spark, path, schema, LEGACY_ENCODING)


def read_corpus(spark: SparkSession, folder: str, schema: T.StructType,
                excluded=NOT_MESSAGES) -> DataFrame:
    """All CSV files (or folders of parts) of a folder as one table, without the listed names."""
    rows = read_csv(spark, f"{folder}/*.csv", schema)
    listed = "|".join(re.escape(name) for name in excluded)
    return (rows.select("*", F.col("_metadata.file_path").alias("_path"))
            .where(~F.rlike("_path", F.lit(f"/({listed})(/|$)"))).drop("_path"))


def write_csv(df: DataFrame, path: str, encoding="UTF-8") -> None:
    """Replace the folder by header CSV with doubled quotes. What the encoding cannot write becomes `?`."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"')
     .option("escape", '"').option("emptyValue", '""').option("encoding", encoding).csv(path))


def write_legacy_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, LEGACY_ENCODING)


def write_series(df: DataFrame, path: str, order="position", value="prediction", series=None) -> None:
    """Stored series: header CSV of an order column and the value, and the series' name where there are several."""
    names = [series] if series else []
    write_csv(df.select(*names, F.col(order).cast("bigint").alias(order), value), path)


def read_series(spark: SparkSession, path: str, order="position", value="prediction", series=None) -> DataFrame:
    """(series, idx, y) of stored series, without the name where there is one. The whole-number order column
    of the file says which value comes first, not the place of a line; rows without an order or a number are
    dropped."""
    names = [series] if series else []
    schema = T.StructType([*[T.StructField(n, T.StringType()) for n in names], T.StructField(order, T.LongType()),
                           T.StructField(value, T.StringType())])
    rows = read_csv(spark, path, schema).select(*names, F.col(order).alias("position"), number(F.col(value)).alias("y"))
    ordered = row_index(rows.where("position is not null and y is not null"), names, "position", levels=3)
    return ordered.select(*names, "idx", "y")
