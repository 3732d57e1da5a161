"""Column functions over timestamps, numbers and JSON messages."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatline.constants import SCORE_JSON_PATH, TIMESTAMP_FORMAT

MESSAGE = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("text", T.StringType()),
])


def parse_timestamp(text: Column) -> Column:
    """Timestamp of a message; NULL where the text is no timestamp.

    The plain format first, then any ISO form with fractions or an offset.
    """
    return F.coalesce(F.try_to_timestamp(text, F.lit(TIMESTAMP_FORMAT)), text.try_cast("timestamp"))


def parse_timestamp_strict(text: Column) -> Column:
    """As `parse_timestamp`, but unreadable text raises."""
    return text.cast("timestamp")


def format_timestamp(ts: Column) -> Column:
    return F.date_format(ts, TIMESTAMP_FORMAT)


def plain_timestamp(ts: Column) -> Column:
    """Wall-clock timestamp without a zone, the form tables are stored in."""
    return ts.cast("timestamp_ntz")


def step_of(ts: Column, seconds: int) -> Column:
    """Number of whole `seconds`-long steps since the epoch: the integer time axis."""
    return F.floor(F.unix_seconds(ts.cast("timestamp")) / seconds).cast("bigint")


def step_start(step: Column, seconds: int) -> Column:
    """The timestamp at which a step begins."""
    return plain_timestamp(F.timestamp_seconds(step * seconds))


def number(text: Column) -> Column:
    """Number or NULL."""
    return text.try_cast("double")


def number_strict(text: Column) -> Column:
    """Number; anything else raises."""
    return text.cast("double")


def finite(value: Column) -> Column:
    """The value as a double; NULL for NULL, NaN and infinities."""
    number_ = value.cast("double")
    return F.when(F.abs(number_) < F.lit(float("inf")), number_)


def encode_message(ts: Column, text: Column) -> Column:
    """The JSON form of a message, with `timestamp` before `text`."""
    return F.to_json(F.struct(ts.alias("timestamp"), text.alias("text")))


def decode_message(value: Column) -> Column:
    """Struct (timestamp, text); both NULL where the value is no such JSON."""
    return F.from_json(value.cast("string"), MESSAGE)


def score_of(response: Column, path: str = SCORE_JSON_PATH) -> Column:
    """The score inside a scorer's JSON response."""
    return number(F.get_json_object(response, path))
