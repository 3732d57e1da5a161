import datetime as dt

import pytest
from pyspark.sql import functions as F

from heatline.functions import values as V


def one(spark, expression, text, kind="string"):
    return spark.createDataFrame([(text,)], f"c {kind}").select(expression).first()[0]


@pytest.mark.parametrize("text,expected", [
    ("2019-04-18 10:31:30", dt.datetime(2019, 4, 18, 10, 31, 30)),
    ("2019-04-18 10:31:30.123", dt.datetime(2019, 4, 18, 10, 31, 30, 123000)),
    ("2019-04-18 10:31:30+00:00", dt.datetime(2019, 4, 18, 10, 31, 30)),
    ("bad", None), ("", None), (None, None)])
def test_parse_timestamp(spark, text, expected):
    got = one(spark, V.plain_timestamp(V.parse_timestamp(F.col("c"))), text)
    assert got == expected


def test_strict_forms_raise(spark):
    for expression in (V.parse_timestamp_strict(F.col("c")), V.number_strict(F.col("c"))):
        with pytest.raises(Exception):
            one(spark, expression, "bad")


def test_numbers(spark):
    assert one(spark, V.number(F.col("c")), "n/a") is None
    assert one(spark, V.finite(F.col("c")), 6.55, "double") == 6.55
    for odd in (float("nan"), float("inf"), float("-inf"), None):
        assert one(spark, V.finite(F.col("c")), odd, "double") is None


def test_steps_round_down_before_the_epoch(spark):
    stamp = dt.datetime(1969, 12, 31, 23, 59, 30)
    assert one(spark, V.step_of(F.col("c"), 60), stamp, "timestamp_ntz") == -1


def test_messages(spark):
    value = V.encode_message(F.lit("2019-04-18 10:31:30"), F.col("c"))
    assert one(spark, value, 'say "hi"\n') == (
        '{"timestamp":"2019-04-18 10:31:30","text":"say \\"hi\\"\\n"}')
    assert one(spark, V.decode_message(F.col("c"))["text"], '{"timestamp":"x","text":"y"}') == "y"
    assert one(spark, V.decode_message(F.col("c"))["text"], "{broken") is None
    response = '{"attributeScores":{"TOXICITY":{"summaryScore":{"value":0.25}}}}'
    assert one(spark, V.score_of(F.col("c")), response) == 0.25
    assert one(spark, V.score_of(F.col("c")), "{}") is None
