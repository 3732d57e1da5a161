"""Schemas of inputs and outputs, and loading of stored tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from heatline.session import utc

MESSAGES = T.StructType([T.StructField("timestamp", T.StringType()),
                         T.StructField("text", T.StringType())])
SCORED_MESSAGES = T.StructType([T.StructField("timestamp", T.StringType()),
                                T.StructField("text", T.StringType()),
                                T.StructField("toxicity", T.StringType())])
LABELLED = T.StructType([T.StructField("text", T.StringType()),
                         T.StructField("label", T.StringType())])
SERIES = T.StructType([T.StructField("timestamp", T.StringType()),
                       T.StructField("prediction", T.DoubleType())])

TIME_SERIES_COLUMNS = {"timestamp": "times", "prediction": "prediction", "isAnomaly": "isAnomaly"}
MESSAGE_COLUMNS = {"timestamp": "times", "text": "message"}
FORECAST_COLUMNS = {"timestamp": "times", "forecast": "prediction"}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored Parquet table, read with the session zone pinned."""
    return utc(spark).read.parquet(f"{folder}/{name}.parquet")
