"""Finding messages by topic."""

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatline.constants import FETCH_CAP
from heatline.operators.relational import newest_per_group

MAX_TOPICS = 10_000
#: Up to so many topics a text is searched for each of them, without leaving the JVM.
FEW_TOPICS = 64


def mentions(text: Column, topic: str) -> Column:
    return F.contains(F.lower(text), F.lit(topic.lower()))


def topic_search(messages: DataFrame, topic: str, key: str, lang="en", since=None, until=None,
                 cap=FETCH_CAP) -> DataFrame:
    """The newest `cap` messages of one topic, optionally in [since, until) of `timestamp`.

    The cap is what a search returns; None gives every match. The newest are found by key alone; only
    their texts are fetched afterwards. Keys are unique.
    """
    found = messages.where(F.col("lang") == lang).where(mentions(F.col("text"), topic))
    if since is not None:
        found = found.where(F.col("timestamp") >= F.lit(since).cast("timestamp_ntz"))
    if until is not None:
        found = found.where(F.col("timestamp") < F.lit(until).cast("timestamp_ntz"))
    found = found.withColumn("topic", F.lit(topic))
    if cap is None:
        return found
    newest = newest_per_group(found.select("topic", key), "topic", key, cap)
    return found.drop("topic").join(newest, key)


def topic_matches(messages: DataFrame, topics, lang=None) -> DataFrame:
    """One row per (message, topic it mentions), for all topics in one pass and without a join.

    A few topics are looked for one by one; many by an automaton that reads every text once, however many
    there are. The rows are the same.
    """
    topics = list(topics)
    if len(topics) > MAX_TOPICS:
        raise ValueError(f"{len(topics)} topics; a literal list is meant for {MAX_TOPICS} at most")
    if lang is not None:
        messages = messages.where(F.col("lang") == lang)
    if len(topics) > FEW_TOPICS:
        return automaton_matches(messages, topics)
    lowered = F.lower(F.col("text"))
    listed = F.array(*[F.lit(t) for t in topics])
    found = F.filter(listed, lambda t: F.contains(lowered, F.lower(t)))
    return messages.withColumn("topic", F.explode(found))


def lower_topics(messages: DataFrame, topics: list[str]) -> dict[str, list[str]]:
    """Topics by their lower-cased form, as Spark lowers texts; in the order given."""
    rows = (messages.sparkSession.createDataFrame(list(enumerate(topics)), "k int, topic string")
            .select("k", "topic", F.lower("topic").alias("low")).orderBy("k").collect())
    out: dict[str, list[str]] = {}
    for r in rows:
        out.setdefault(r.low, []).append(r.topic)
    return out


def automaton_matches(messages: DataFrame, topics: list[str]) -> DataFrame:
    """`topic_matches` by an Aho-Corasick automaton of all topics over Arrow batches of the texts.

    The automaton holds a node per letter of the topics at most; it is built once per task. Texts are
    lower-cased by Spark. The empty topic is in every text, a NULL text has none.
    """
    known = lower_topics(messages, topics)
    names = messages.columns
    fields = [*messages.schema.fields, T.StructField("_topics", T.ArrayType(T.StringType()))]

    def run(batches):
        patterns = ahocorasick.Automaton()
        for low in known:
            if low:
                patterns.add_word(low, low)
        patterns.make_automaton()
        always = known.get("", [])

        def mentioned(text):
            found = dict.fromkeys(low for _, low in patterns.iter(text)) if len(patterns) else ()
            return always + [t for low in found for t in known[low]]

        for batch in batches:
            lows = batch.column(len(names)).to_pylist()
            made = pa.array([None if t is None else mentioned(t) for t in lows], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(names)], made], names=[*names, "_topics"])

    searched = messages.withColumn("_low", F.lower(F.col("text"))).mapInArrow(run, T.StructType(fields))
    return searched.withColumn("topic", F.explode("_topics")).drop("_topics")


def topic_sweep(messages: DataFrame, topics, key: str, lang="en", cap=FETCH_CAP) -> DataFrame:
    """The newest `cap` messages of every topic."""
    found = topic_matches(messages, topics, lang)
    return found if cap is None else newest_per_group(found, "topic", key, cap)
