"""Term statistics as tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heatline.functions.stemming import stems, stems_of
from heatline.operators.relational import SALTS, salt_of, salted, salted_join
from heatline.session import scanned_bytes

#: File bytes of texts whose terms are counted in a task, and the most such tasks; beyond, counts spill.
PART_BYTES, MOST_PARTS = 16 << 20, 20_000


def term_counts(docs: DataFrame, key: str, words: Column) -> DataFrame:
    """(key, term, tf). Texts move once, to the part of their key, and their terms are counted there.

    Parts are small enough for the counts of a part to stay in memory; rows without a key share one.
    """
    parts = -(-scanned_bytes(docs) // PART_BYTES)
    cores = docs.sparkSession.sparkContext.defaultParallelism
    gathered = docs.repartition(max(cores, min(parts, MOST_PARTS)), key) if parts else docs.repartition(key)
    return (gathered.select(key, F.explode(words).alias("term"))
            .groupBy(key, "term").agg(F.count("*").alias("tf")))


def tfidf_terms(docs: DataFrame, key: str, words: Column, salts=SALTS) -> DataFrame:
    """(key, term, tf, df, tfidf) with tfidf = tf * ln((m + 1) / (df + 1)), m the number of docs.

    Frequent terms sit in a large part of all documents, so the join back to the counts is salted: the rows
    of a term go to `salts` tasks. The counts are dealt out once for both of their uses: documents are counted
    per term and salt, only these sums meet by term, and they come back to the salts that hold the term.
    """
    tf = salted(term_counts(docs, key, words), "term", key, salts)
    # always true, but it needs the columns that the join needs, so Spark deals the counts out once
    held = (F.col("tf") > 0) & (salt_of(key, salts) == F.col("_place._salt"))
    df = (tf.groupBy("_place").agg(F.count_if(held).alias("_part"))
          .withColumn("df", F.sum("_part").over(W.partitionBy("_place.term"))).drop("_part"))
    total = docs.agg(F.count("*").alias("m")).scalar()
    weight = F.log((total + 1) / (F.col("df") + 1))
    return (salted_join(tf, df, "term", key, salts)
            .select(key, "term", "tf", "df", (F.col("tf") * weight).alias("tfidf")))


def vocabulary(docs: DataFrame, words: Column) -> DataFrame:
    """(token, occurrences)."""
    return (docs.select(F.explode(words).alias("token"))
            .groupBy("token").agg(F.count("*").alias("occurrences")))


def stemmed_vocabulary(docs: DataFrame, words: Column, longer_than=2) -> DataFrame:
    """(token, occurrences, stem) for stems longer than `longer_than` letters."""
    return (vocabulary(docs, words).withColumn("stem", stems(F.col("token")))
            .where(F.length("stem") > longer_than))


def stemmed_tokens(docs: DataFrame, key: str, words: Column, longer_than=2) -> DataFrame:
    """(key, stems): the stems of each document in order, without the short ones. No shuffle."""
    found = F.filter(stems_of(words), lambda s: F.length(s) > longer_than)
    return docs.select(key, found.alias("stems"))
