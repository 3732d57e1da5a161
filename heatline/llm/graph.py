"""Connected components of a large graph."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import settle, stored

MOST_ROUNDS = 60


def _to_larger(links: DataFrame) -> DataFrame:
    """Each larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
    return (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u > v").distinct())


def _to_smaller(links: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are linked to the smallest of them."""
    least = stored(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    `links` has integer columns (u, v) in any direction; NULLs, loops and repeats are ignored. Stars
    are built in alternating rounds (large star, small star), a number that grows with the logarithm
    of the graph's size. Every round is partially aggregated and ends in a durable checkpoint, so
    neither lineage nor one task grows with it; nothing but two numbers a round reaches the driver. The
    smallest neighbours are stored before they are joined, so that Spark can split the centre of a
    large star.
    """
    links = settle(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct())
    before = _state(links)
    for _ in range(MOST_ROUNDS):
        if not before[0]:
            break
        links = settle(_to_smaller(_to_larger(links)))
        after = _state(links)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct())
