"""Near-duplicate vectors: Euclidean p-stable hashing, exact cosine checks, components."""

from math import ceil, erfc, exp, log, pi, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.blocks import at_places, meeting_places
from heatline.llm.common import settle, short_batches, stored
from heatline.llm.graph import components

COSINE = 0.93
RECALL = 0.97
WIDTH = 2.0
APART = 1.3
COMPANY = 256
LEAST_HASHES = 3
SEED = 1234
PART = 1024


def collision(distance: float, width: float = WIDTH) -> float:
    """Chance that two vectors at a distance share one quantised Gaussian projection."""
    r = width / distance
    return 1 - erfc(r / sqrt(2)) - 2 / (sqrt(2 * pi) * r) * (1 - exp(-r * r / 2))


def shape(rows: int, cosine=COSINE, recall=RECALL) -> tuple[int, int]:
    """Projections per table and tables, for the most rows that share a label.

    So many projections that about `COMPANY` unrelated rows (distance 1.3) share a bucket: comparing them is
    one product of matrices, while every table costs a copy of the vectors. And so many
    tables that a pair exactly at the threshold is found with probability `recall`; closer pairs are
    found more surely.
    """
    hashes = max(LEAST_HASHES, ceil(log(max(rows, 1) / COMPANY) / -log(collision(APART)))) if rows > COMPANY else LEAST_HASHES
    met = collision(sqrt(2 - 2 * cosine)) ** hashes
    return hashes, ceil(log(1 - recall) / log(1 - met))


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that no square overflows."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def signatures(distinct: DataFrame, hashes: int, tables: int) -> DataFrame:
    """Add `sigs`: one bucket (long) per table, of rows (rep, weight, label, vec)."""
    def run(batches):
        for batch in batches:
            vec = batch.column("vec")
            sizes = np.diff(vec.offsets.to_numpy())
            sigs = np.zeros((batch.num_rows, tables), np.int64)
            flat = vec.flatten().to_numpy(zero_copy_only=False)
            starts = np.concatenate(([0], np.cumsum(sizes)))
            for d in np.unique(sizes):
                own = np.flatnonzero(sizes == d)
                rows = unit(flat[starts[own][:, None] + np.arange(d)])
                rng = np.random.default_rng([SEED, int(d)])
                at = np.floor((rows @ rng.normal(size=(d, hashes * tables)) + rng.uniform(0, WIDTH, hashes * tables)) / WIDTH)
                mixed = np.zeros((len(own), tables), np.uint64)
                steps = at.astype(np.int64).astype(np.uint64).reshape(len(own), tables, hashes)
                for k in range(hashes):
                    mixed = (mixed ^ steps[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
                    mixed ^= mixed >> np.uint64(29)
                sigs[own] = mixed.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.ListArray.from_arrays(pa.array(np.arange(0, sigs.size + 1, tables), pa.int32()),
                                                          pa.array(sigs.ravel()))],
                names=[*batch.schema.names, "sigs"])

    kinds = dict(distinct.dtypes)
    return short_batches(distinct).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in distinct.columns) + ", sigs array<bigint>")


def forest(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of a graph given as a symmetric matrix of booleans."""
    u, v, rest = [], [], np.arange(len(near))
    while len(rest) > 1:
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            hit = near[at, rest]
            new = rest[hit]
            u += [at] * len(new)
            v += new.tolist()
            queue += new.tolist()
            rest = rest[~hit]
    return np.array(u, np.int64), np.array(v, np.int64)


def compare_place(got: dict, cosine: float):
    """Links of one place: per row the weight it links to, counting a pair only in the first of the
    tables in which it meets, and a spanning forest."""
    rows = got["vec"]
    near = rows @ rows.T >= cosine
    np.fill_diagonal(near, False)
    if got["a"] != got["b"]:
        first = got["part"] == got["a"]
        near &= first[:, None] != first[None, :]
    i, j = np.nonzero(np.triu(near))
    u, v = forest(near)
    if got["sigs"].shape[1] and len(i):
        again = np.zeros(len(i), bool)
        for earlier in range(got["sigs"].shape[1]):
            again |= got["sigs"][i, earlier] == got["sigs"][j, earlier]
        i, j = i[~again], j[~again]
    weight = got["weight"]
    linked = np.bincount(i, weight[j], len(rows)) + np.bincount(j, weight[i], len(rows))
    return u, v, linked


def links(distinct: DataFrame, cosine: float, hashes: int, tables: int) -> DataFrame:
    """(u, v, n): rows with v link two vectors, rows with n say to how many u links.

    `distinct` has (rep, weight, label, vec), each vector of a label once. A bucket of any size is
    compared in parts, and gives a spanning forest and a count per row, never its pairs.

    Where rows meet is worked out on their keys alone; a vector is sent once to each of its places, with
    its buckets in the tables before, by which a pair is counted only where it meets first.
    """
    signed = stored(signatures(distinct.withColumn("uid", F.monotonically_increasing_id()), hashes, tables), "signed")
    keyed = (signed.select("uid", "label", F.size("vec").alias("d"), F.posexplode("sigs").alias("t", "sig"))
             .select("uid", "t", F.xxhash64("label", "d", "t", "sig").alias("key")))
    places = meeting_places(keyed, "key", "uid", PART).drop("key")
    placed = (places.join(signed.drop("label"), "uid")
              .select("place", "rep", "weight", "vec", "t", "_a", "_b", "_part", F.slice("sigs", F.lit(1), F.col("t")).alias("sigs")))

    def compare(got: pa.Table):
        place = got.column("place").to_numpy()
        edges = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1, [len(place)]))
        rep, weight, part = (got.column(c).to_numpy() for c in ("rep", "weight", "_part"))
        table, a, b = (got.column(c).to_numpy() for c in ("t", "_a", "_b"))
        known = np.concatenate(([0], np.cumsum(table, dtype=np.int64)))
        vec = got.column("vec").combine_chunks()
        flat, ends = vec.flatten().to_numpy(zero_copy_only=False), np.concatenate(([0], np.cumsum(pa.compute.list_value_length(vec).to_numpy())))
        sigs = got.column("sigs").combine_chunks().flatten().to_numpy()
        out = []
        for lo, hi in zip(edges[:-1], edges[1:]):
            size = (ends[hi] - ends[lo]) // (hi - lo)
            if hi - lo < 2 or size * (hi - lo) != ends[hi] - ends[lo] or (table[lo:hi] != table[lo]).any():
                continue
            u, v, linked = compare_place({
                "vec": unit(flat[ends[lo]:ends[hi]].reshape(hi - lo, size)), "sigs": sigs[known[lo]:known[hi]].reshape(hi - lo, int(table[lo])),
                "a": a[lo], "b": b[lo], "part": part[lo:hi], "weight": weight[lo:hi]}, cosine)
            own = rep[lo:hi]
            on = np.flatnonzero(linked)
            out.append((np.concatenate([own[u], own[on]]), np.concatenate([own[v], np.full(len(on), -1)]),
                        np.concatenate([np.full(len(u), -1), linked[on].astype(np.int64)])))
        if out:
            u, v, n = (np.concatenate(x) for x in zip(*out))
            is_link = n < 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(u, pa.int64()), pa.array(v, pa.int64(), mask=~is_link), pa.array(n, pa.int64(), mask=is_link)],
                names=["u", "v", "n"])

    return at_places(placed, compare, "u long, v long, n long")


def near_duplicates(vectors: DataFrame, row_id="vec_id", vector="embedding", label="label", cosine=COSINE,
                    recall=RECALL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of `vectors`.

    Rows with equal labels link when their cosine is at least `cosine`; a pair at the threshold is
    found with probability `recall`, closer ones more surely, and no other pair links. Equal vectors
    of a label collapse to one before hashing and still count as links of each other.

    A NULL label, or a vector that is NULL, empty, zero or holds a NULL or non-finite component, links
    with nothing: 0 links, its own component. So does a NULL id, whose component is NULL. A repeated
    row is returned as often as it comes and counts once. Vectors of different lengths never link.
    Other columns are ignored; an empty table gives an empty result.
    """
    rows = settle(vectors.select(F.col(row_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                                 F.col(vector).alias("vec"))
                  .withColumn("usable", F.expr("""
        vec_id is not null and label is not null and vec is not null and size(vec) > 0
        and forall(vec, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(vec, x -> x <> 0)""")))
    usable = rows.where("usable")
    distinct = settle(usable.dropDuplicates(["vec_id", "label", "vec"]).groupBy("label", "vec")
                      .agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight")))
    most = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    hashes, tables = shape(most, cosine, recall)
    found = settle(links(distinct.select("rep", "weight", "label", "vec"), cosine, hashes, tables))
    joined = components(found.where("v is not null").select("u", "v"))
    counts = found.where("n is not null").groupBy("u").agg(F.sum("n").alias("others"))
    of_rep = stored(distinct.join(counts, F.col("rep") == F.col("u"), "left").join(joined, F.col("rep") == F.col("node"), "left")
              .select("label", "vec", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                      F.coalesce("component", "rep").alias("component_id")), "classes")
    linked = usable.join(of_rep, ["label", "vec"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
