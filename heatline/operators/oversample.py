"""More rows for rare classes: new vectors between a row and one of its nearest neighbours.

Neighbours are sought among rows that meet in a bucket of quantised random projections. Buckets are split
until they are of bounded size; every task keeps the nearest few of a row, never the pairs.
"""

from math import ceil, log

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatline.operators.slices import row_index, sized
from heatline.session import settle

NEIGHBOURS = 5
#: Rows that are compared with each other at once; classes up to this size are searched exactly.
MEET = 1024
TABLES = 12
#: Width of a projection's cells in standard deviations of the projected rows.
CELL = 2.5
SEED = 7
#: Differences held at once while distances are measured.
CELLS = 1 << 21
DIGEST_BITS = 60


def digest(seed: int, purpose: str, *columns: str) -> Column:
    """A number below 2^60 from the parts as text; any engine with MD5 finds the same."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, DIGEST_BITS // 4), 16, 10).cast("long")


def shares(rows: DataFrame) -> DataFrame:
    """Add `copies`: how many new rows each row of (id, label, vec) gives so that all classes are as large as
    the largest. They are dealt evenly along the ids of a class."""
    counts = settle(rows.groupBy("label").agg(F.count("*").alias("n")))
    most = counts.agg(F.max("n")).first()[0] or 0
    placed = sized(row_index(rows.select("id", "label"), ["label"], "id", levels=3), ["label"], "idx")
    need = F.lit(most) - F.col("n")

    def before(k: Column) -> Column:
        return F.floor(k.cast("decimal(20,0)") * need / F.col("n")).cast("long")

    return placed.select("id", "label", "n", (before(F.col("idx") + 1) - before(F.col("idx"))).alias("copies")).where(need > 0)


def projections(size: int, hashes: int, spread: float) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([SEED, size, hashes])
    return rng.normal(size=(size, hashes * TABLES)) / (CELL * spread), rng.uniform(0, 1, hashes * TABLES)


def buckets(rows: DataFrame, most: int) -> DataFrame:
    """(id, label, vec, place): each row once per table, in a place of about MEET rows or fewer.

    A class of at most MEET rows is one place. A larger one is cut by so many projections that a cell of
    evenly spread rows holds MEET; a cell that holds more all the same is cut by a hash of the id.
    """
    if most <= MEET:
        return rows.withColumn("place", F.xxhash64("label"))
    hashes = max(1, ceil(log(most / MEET) / log(2)))
    moments = rows.select("label", F.posexplode("vec").alias("i", "v")).groupBy("label", "i").agg(F.var_pop("v").alias("s"))
    spreads = {r.label: max(r.s ** 0.5, 1e-300) for r in moments.groupBy("label").agg(F.sum("s").alias("s")).collect()}

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            labels, sizes = batch.column("label").to_pylist(), np.array([len(v) for v in batch.column("vec").to_pylist()])
            vecs = batch.column("vec").to_pylist()
            cells = np.zeros((batch.num_rows, TABLES), np.int64)
            for key in set(zip(labels, sizes.tolist())):
                own = np.array([k for k in range(batch.num_rows) if (labels[k], sizes[k]) == key])
                # The trace of the covariance over the dimensions is the mean variance of a projection.
                axes, shift = projections(key[1], hashes, spreads[key[0]])
                steps = np.floor(np.array([vecs[k] for k in own]) @ axes + shift).astype(np.int64).reshape(len(own), TABLES, hashes)
                mixed = np.zeros((len(own), TABLES), np.uint64)
                for h in range(hashes):
                    mixed = (mixed ^ steps[:, :, h].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                cells[own] = mixed.view(np.int64)
            ends = pa.array(np.arange(0, cells.size + 1, TABLES), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, pa.array(cells.ravel()))],
                                             names=[*batch.schema.names, "cells"])

    schema = T.StructType([*rows.schema.fields, T.StructField("cells", T.ArrayType(T.LongType()))])
    keyed = settle(rows.mapInArrow(run, schema).select("id", "label", "vec", F.posexplode("cells").alias("table", "cell"))
                   .select("id", "label", "vec", F.xxhash64("label", "table", "cell").alias("cell")))
    full = keyed.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(MEET)).cast("int").alias("parts")).where("parts > 1")
    return (keyed.join(full, "cell", "left")
            .withColumn("place", F.when(F.col("parts").isNull(), F.col("cell")).otherwise(
                F.xxhash64("cell", F.pmod(F.xxhash64("id", "cell"), F.col("parts"))))).drop("cell", "parts"))


def nearest(rows: DataFrame, k=NEIGHBOURS) -> DataFrame:
    """(id, near): ids of up to k nearest other rows of the class, nearest first, of equal ones the smaller id.

    `rows` has (id, label, vec), with ids unique and vectors of equal length within a class.
    """
    most = rows.groupBy("label").count().agg(F.max("count")).first()[0] or 0

    def run(frame):
        ids = frame["id"].to_numpy(np.int64)
        vecs = np.array(frame["vec"].tolist(), np.float64)
        order = np.argsort(ids, kind="stable")
        ids, vecs = ids[order], vecs[order]
        out, step = [], max(1, CELLS // max(1, vecs.size))
        for at in range(0, len(ids), step):
            part = vecs[at:at + step]
            far = ((part[:, None, :] - vecs[None, :, :]) ** 2).sum(axis=2)
            far[np.arange(len(part)), at + np.arange(len(part))] = np.inf
            kept = np.argsort(far, axis=1, kind="stable")[:, :min(k, len(ids) - 1)]
            row = np.repeat(np.arange(len(part)), kept.shape[1])
            out.append((ids[at:at + step][row], ids[kept.ravel()], far[row, kept.ravel()]))
        a, b, d = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"id": a, "other": b, "far": d})

    near = buckets(rows, most).groupBy("place").applyInPandas(run, "id long, other long, far double")
    best = F.slice(F.array_sort(F.collect_set(F.struct("far", "other"))), 1, k)
    return near.groupBy("id").agg(best.alias("best")).select("id", F.col("best.other").alias("near"))


def oversample(vectors: DataFrame, row_id: str, vector: str, label: str, k=NEIGHBOURS, seed=SEED) -> DataFrame:
    """(id, copy, label, neighbour, weight, vec): new rows until every class has as many as the largest.

    vec = own + weight * (neighbour - own), the neighbour one of the k nearest rows of the class; both are
    chosen by a digest of the seed, the id and the number of the copy. A class of up to MEET rows is searched
    exactly, a larger one among the rows that share a bucket in one of 12 tables.

    Rows with a NULL id, label or vector take no part, nor do vectors with a NULL or non-finite entry. A
    row without a neighbour is its own. Ids are unique, vectors of a class equally long.
    """
    usable = F.forall("vec", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = settle(vectors.select(F.col(row_id).cast("long").alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("vec"))
                  .where("id is not null and label is not null and vec is not null").where(usable))
    wanted = settle(shares(rows))
    # Only classes that need rows are searched.
    rare = rows.join(wanted.select("label").distinct(), "label", "left_semi")
    made = (wanted.where("copies > 0").join(nearest(rare.select("id", "label", "vec"), k), "id", "left")
            .withColumn("copy", F.explode(F.expr("sequence(1L, copies)")))
            .withColumn("pick", digest(seed, "pick", "id", "copy"))
            .withColumn("neighbour", F.when(F.size("near") > 0, F.get("near", F.pmod("pick", F.size("near")).cast("int"))).otherwise(F.col("id")))
            .withColumn("weight", digest(seed, "weight", "id", "copy") / F.lit(float(1 << DIGEST_BITS))))
    own = rows.select("id", F.col("vec").alias("own"))
    other = rows.select(F.col("id").alias("neighbour"), F.col("vec").alias("other"))
    return (made.select("id", "copy", "label", "neighbour", "weight").join(own, "id").join(other, "neighbour")
            .select("id", "copy", "label", "neighbour", "weight",
                    F.zip_with("own", "other", lambda a, b: a + F.col("weight") * (b - a)).alias("vec")))
