"""Compare the rows that share a key, whatever the size of the groups."""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import stored

WIDTH = 2048


def meeting_places(rows: DataFrame, key: str, unit: str, width: int = WIDTH) -> DataFrame:
    """Rows of groups of two or more, each with the `place` (long) where it meets others.

    A group of at most `width` rows is one place. A larger one is cut into parts by a hash of
    `unit`, and every two parts (and each part with itself) are a place of their own, so that any
    two rows of a group meet while a place stays near 2 * `width` rows. `_a` and `_b` name the two
    parts of a place and `_part` the row's own. Rows whose key is unique meet nobody and go.

    The sizes are stored first, so that the join with them is a plain one, which Spark can split where
    a key is hot.
    """
    sizes = stored(rows.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
                   .select(key, F.ceil(F.col("_n") / F.lit(width)).cast("int").alias("_parts")), "sizes")
    cut = (rows.join(sizes, key)
           .withColumn("_part", F.pmod(F.xxhash64(F.lit("part"), unit), F.col("_parts")).cast("int"))
           .withColumn("_other", F.explode(F.expr("sequence(0, _parts - 1)"))))
    return (cut.withColumn("_a", F.least("_part", "_other")).withColumn("_b", F.greatest("_part", "_other"))
            .withColumn("place", F.xxhash64(key, "_a", "_b")).drop("_parts", "_other"))


def at_places(placed: DataFrame, function: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str,
              order: list[str] = ()) -> DataFrame:
    """Call `function` with tables of whole places, many small ones or one large one at a time."""
    def whole(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("place").to_numpy()
            edges = np.flatnonzero(np.diff(place)) + 1
            last = int(edges[-1]) if len(edges) else 0
            if last or (held and held[-1].column("place")[-1].as_py() != batch.column("place")[0].as_py()):
                done = held + ([batch.slice(0, last)] if last else [])
                if done:
                    yield from function(pa.Table.from_batches(done))
                held = [batch.slice(last)]
            else:
                held.append(batch)
        if held:
            yield from function(pa.Table.from_batches(held))

    return (placed.repartition("place").sortWithinPartitions("place", *order)
            .mapInArrow(whole, schema))
