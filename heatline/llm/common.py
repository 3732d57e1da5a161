"""Small helpers shared by the operators on text."""

import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatline.schemas import table
from heatline.session import fresh_folder, settle, ship

FOLDS = 3
HELD_OUT_FOLD = 1
BATCH_KEY, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(ship(spark), folder, name)


def fold(row_id: Column) -> Column:
    """crc32 of the id as text, modulo 3. NULL ids count as the empty text."""
    return (F.crc32(F.coalesce(row_id.cast("string"), F.lit("")).cast("binary")) % FOLDS).cast("int")


def held_out(row_id: Column) -> Column:
    return fold(row_id) == HELD_OUT_FOLD


def short_batches(df: DataFrame) -> DataFrame:
    """The frame, with its session's Arrow batches at most `BATCH_ROWS` long.

    Rows here hold whole texts or vectors. Ten thousand of them, the default, take tens of megabytes in
    each of the JVM's and the worker's buffers, several times over.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_KEY, "10000")) <= BATCH_ROWS:
        conf.set(BATCH_KEY, str(BATCH_ROWS))
    return df


def map_rows(df: DataFrame, function: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """Apply `function` to each Arrow batch; it returns the columns of `schema` by name."""
    fields = [(f.name, f.dataType) for f in T._parse_datatype_string(schema).fields] \
        if isinstance(schema, str) else [(f.name, f.dataType) for f in schema.fields]
    names = [name for name, _ in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = function(batch)
                yield pa.RecordBatch.from_arrays([made[n] for n in names], names=names)

    return short_batches(df).mapInArrow(run, schema)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame written as a table below the shared folder and read back.

    Durable like a checkpoint, and Spark knows its size: joins with it are broadcast where it is below
    Spark's own limit, and shuffled where it is not.
    """
    path = fresh_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, row_id: str, bound: int, seed: str) -> DataFrame:
    """Some `bound` rows, chosen by a hash of the id; all rows where there are fewer.

    Only for fitting a model. The expected size is 0.95 of the bound. Ids that repeat often can bring
    more, so whoever gathers the sample also limits it to the bound.
    """
    share = min(1.0, 0.95 * bound / max(df.count(), 1))
    point = F.pmod(F.xxhash64(F.lit(seed), F.col(row_id)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return df if share == 1.0 else df.where(point < share)


def fit_once(sample: DataFrame, order: str, bound: int, fit: Callable[[pa.Table], bytes]) -> bytes:
    """Fit a model on `bound` rows at most in one task, in an order that does not depend on the run.

    Returns the model's bytes; raises where the sample is empty.
    """
    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([fit(pa.Table.from_batches(held))], pa.binary())],
                                             names=["model"])

    one = (sample.limit(bound).withColumn("_at", F.xxhash64(F.lit("order"), order)).repartition(1)
           .sortWithinPartitions("_at", order).drop("_at"))
    rows = one.mapInArrow(run, "model binary").collect()
    if not rows:
        raise ValueError("no labelled row to learn from")
    return bytes(rows[0][0])


def pack(**arrays) -> bytes:
    """Arrays by name as bytes, without pickling."""
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob), allow_pickle=False) as got:
        return {k: got[k] for k in got.files}


__all__ = ["FOLDS", "HELD_OUT_FOLD", "bounded_sample", "fit_once", "fold", "held_out", "map_rows", "pack", "read",
           "settle", "short_batches", "stored", "unpack"]
