"""Projections, predicates, joins, set operations, ordering and sampling."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from heatline.constants import FETCH_CAP, SPLIT_SEED, TRAIN_SHARE

SALTS = 8


def drop_position(df: DataFrame, position: int) -> DataFrame:
    return df.drop(df.columns[position])


def rename(df: DataFrame, names: dict) -> DataFrame:
    """Rename by name; an unknown name is an error rather than ignored."""
    missing = set(names) - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return df.withColumnsRenamed(names)


def known(df: DataFrame, *columns: str) -> DataFrame:
    """Rows where no listed column is NULL, as a plain filter that is pushed to the scan."""
    for name in columns:
        df = df.where(F.col(name).isNotNull())
    return df


def between_open(column: Column, low, high) -> Column:
    """Inside the range, both ends excluded."""
    return (column > low) & (column < high)


def label_join(messages: DataFrame, labels: DataFrame, key: str, how="inner") -> DataFrame:
    """Attach stored scores: `inner`, `left` (unlabelled kept) or `left_anti` (still to be scored)."""
    return messages.join(labels, key, how)


def align(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Put two tables side by side on a real position key."""
    return left.join(right, keys, "inner")


def salt_of(spread: str, salts=SALTS) -> Column:
    """0..salts-1, never NULL."""
    return F.coalesce(F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"), F.lit(0))


def salted(rows: DataFrame, keys, spread: str, salts=SALTS) -> DataFrame:
    """The rows dealt out by key and a salt that is a hash of `spread`, both in `_place` instead of the keys.

    `_place` is never NULL, so a NULL key is a key like any other and no filter tells two uses apart.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    place = F.struct(*keys, salt_of(spread, salts).alias("_salt"))
    return rows.withColumn("_place", place).drop(*keys).repartition("_place")


def salted_join(rows: DataFrame, lookup: DataFrame, keys, spread: str, salts=SALTS) -> DataFrame:
    """Join a large table with a lookup of unique keys when some keys are very frequent.

    Rows of one key go to `salts` tasks by a hash of `spread`; the lookup is repeated per salt. Rows that
    `salted` dealt out stay where they are. A lookup made from these, with a row per `_place`, is not repeated:
    it has no key in a salt without rows, and each task looks its few rows up by hash instead of sorting.
    Otherwise a merge join: Spark's size estimate knows neither the copies nor words split out of texts,
    and would broadcast a vocabulary. A NULL key is a key like any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    order = [c for c in rows.columns if c != "_place"]
    if "_place" not in rows.columns:
        rows = salted(rows, keys, spread, salts)
    if "_place" in lookup.columns:
        copies = lookup.hint("shuffle_hash")
    else:
        copies = (lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
                  .withColumn("_place", F.struct(*keys, "_salt")).drop("_salt", *keys).hint("merge"))
    names = [*order, *[k for k in keys if k not in order], *[c for c in copies.columns if c != "_place"]]
    return rows.join(copies, "_place").select(*[F.col(f"_place.{c}") if c in keys else c for c in names])


def append_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; columns match by name and absent ones are NULL."""
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def earliest_copies(df: DataFrame, content: list[str], key: str) -> DataFrame:
    """One row per distinct content, the one with the smallest key.

    Only digests and keys are shuffled. What is joined to the messages are the keys of the copies,
    usually few, which Spark broadcasts where it measures them to be small. Rows without a key stay.
    """
    parts = [F.coalesce(F.concat(F.length(F.col(c)).cast("string"), F.lit(":"), F.col(c)),
                        F.lit("-")) for c in content]
    digest = F.sha2(F.concat(*parts), 256)
    narrow = df.select(digest.alias("_digest"), F.col(key).alias("_key"))
    first = narrow.groupBy("_digest").agg(F.min("_key").alias("_first"))
    copies = narrow.join(first, "_digest").where("_key > _first").select(F.col("_key").alias(key))
    return df.join(copies, key, "left_anti")


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    return df.orderBy(key).limit(n)


def newest_per_group(df: DataFrame, group: str, key: str, n=FETCH_CAP) -> DataFrame:
    """The n rows with the largest key of each group. Each task keeps n before the shuffle."""
    rank = F.row_number().over(W.partitionBy(group).orderBy(F.col(key).desc()))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def shuffled(df: DataFrame, key: str, seed=SPLIT_SEED) -> DataFrame:
    """A random order that depends on key and seed only."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key))


def hash_split(df: DataFrame, key: str, share=TRAIN_SHARE, seed=SPLIT_SEED):
    """(train, test) by a digest of the key: the same rows on any partitioning, retry or engine."""
    chosen = key_bucket(key, 10_000, seed) < int(share * 10_000)
    return df.where(chosen), df.where(~chosen)


def key_bucket(key: str, buckets: int, seed=SPLIT_SEED) -> Column:
    """Bucket 0..buckets-1 of a row, from the first 8 hex digits of the MD5 of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def random_split(df: DataFrame, share=TRAIN_SHARE, seed=SPLIT_SEED):
    """(train, test) by Spark's own sampler; depends on how the input is partitioned."""
    return tuple(df.randomSplit([share, 1 - share], seed=seed))


def surrogate_id(df: DataFrame, name="id") -> DataFrame:
    """Unique, increasing, not gapless, not stable between runs: never a join key."""
    return df.withColumn(name, F.monotonically_increasing_id())
