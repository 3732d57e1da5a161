"""From raw documents to token ids: language, near-duplicates, personal data, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes every stage's result as
Parquet below the shared folder and reads it back as the next one's documents; what a stage has read is
deleted once its result is written.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from heatline.llm import langid, mixing, pieces, pii, simhash
from heatline.llm.common import held_out, read
from heatline.session import drop_folder, fresh_folder, ship

LEAST_LANGUAGE_SCORE = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose language is less likely than not, go.

    The model learns from the documents given, but for the held-out third. NULL and empty texts have no
    letter and go; repeated rows are judged alike; where no row has a language to learn, all texts with a
    letter stay. Every column stays as it is. An empty table stays empty.
    """
    learned = docs.where(~held_out(F.col("doc_id"))).where("lang is not null and text rlike '\\\\p{L}'")
    if not learned.take(1):
        return docs.where("text rlike '\\\\p{L}'")
    # By number, so that a column of the documents cannot clash with one that is added.
    own = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    judged = langid.predict(docs.select(*[F.col(c).alias(n) for c, n in own.items()]), langid.fit(learned), own["text"])
    kept = judged.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE))
    return kept.select(*[F.col(n).alias(c) for c, n in own.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays.

    Rows that share id and fingerprint are one document, rows that share only the id are not. Rows with a
    NULL id stay. NULL and empty texts are near-duplicates of each other; an empty table stays empty.
    """
    return simhash.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind, and `n_chars`, where there is one, counted anew.

    NULL texts stay NULL, empty ones empty; no row goes or is added, repeated rows stay alike. An empty
    table stays empty.
    """
    clean = pii.redact(docs, pii.fit(docs))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of small sources repeat until every source has its target share; none goes.

    A NULL or empty text counts as one token, a NULL source as one source; repeated rows are used like
    others, up to the budget. An empty table stays empty.
    """
    return mixing.repeat(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids. A NULL or empty text has no ids; all rows stay, of an empty table none."""
    return pieces.encode(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing", mixture),
    ("SentencePiece encoding", encoding),
]

# Learned decisions and Viterbi paths are beyond SQL; tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(ship(spark), sf_dir, "documents")
    folder = fresh_folder(spark, "pipeline")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if k:
            drop_folder(spark, f"{folder}/{k - 1}")
    return docs
