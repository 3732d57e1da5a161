"""Message streams: Kafka topics, or files standing in for them."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatline.functions.values import decode_message, encode_message, format_timestamp, parse_timestamp

VALUE = T.StructType([T.StructField("value", T.StringType())])


def kafka_options(servers: str, topic: str, starting="latest", **security) -> dict:
    """Options of the Kafka source; certificates and passwords come from the caller only."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting,
            **{f"kafka.{k}": v for k, v in security.items()}}


def read_kafka(spark: SparkSession, **options) -> DataFrame:
    """Stream with a binary `value`. Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(**options)).load()


def read_value_files(spark: SparkSession, folder: str, per_trigger=None) -> DataFrame:
    """Stream of text files, one JSON message per line."""
    reader = spark.readStream.schema(VALUE)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.text(folder)


def parse_messages(stream: DataFrame) -> DataFrame:
    """(value, timestamp, text): parsed messages; unreadable JSON or time gives NULLs."""
    body = F.col("value").cast("string")
    return (stream.select(body.alias("value"), decode_message(F.col("value")).alias("_m"))
            .select("value", parse_timestamp(F.col("_m.timestamp")).alias("timestamp"),
                    F.col("_m.text").alias("text")))


def readable(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("timestamp").isNotNull() & F.col("text").isNotNull()).drop("value")


def unreadable(parsed: DataFrame) -> DataFrame:
    """Values that carry no usable message, for a reject table."""
    return parsed.where(F.col("timestamp").isNull() | F.col("text").isNull()).select("value")


def to_values(messages: DataFrame) -> DataFrame:
    """One JSON `value` per message, as a Kafka sink expects."""
    return messages.select(encode_message(format_timestamp(F.col("timestamp")), F.col("text"))
                           .alias("value"))


def write_value_files(messages: DataFrame, folder: str, checkpoint: str, every=None):
    """Publish a stream of messages as text files; without `every`, once over what is there."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (to_values(messages).writeStream.format("text").option("path", folder)
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def write_kafka(messages: DataFrame, servers: str, topic: str, checkpoint: str, every="120 seconds",
                linger_ms=10, **security):
    """Publish a stream of messages. Needs the Kafka connector on the class path."""
    return (to_values(messages).writeStream.format("kafka")
            .options(**{"kafka.bootstrap.servers": servers, "topic": topic,
                        "kafka.linger.ms": str(linger_ms), "checkpointLocation": checkpoint},
                     **{f"kafka.{k}": v for k, v in security.items()})
            .trigger(processingTime=every).start())
