"""SimHash near-duplicates: fingerprints, pigeonring candidates, components."""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heatline.llm.blocks import at_places, meeting_places
from heatline.llm.common import map_rows, settle, stored
from heatline.llm.graph import components

SHINGLE = 4
DISTANCE = 4
SEED = 42
BITS = 64
CHAIN = 3
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of a UTF-8 text, ASCII letters lowered; 0 for a text without a word."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(words) - shingle + 1)
    firsts, lasts = starts[:n].tolist(), (ends[min(shingle, len(words)) - 1:] - 1).tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        stop = min(n, at + CHUNK)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(firsts[at:stop], lasts[at:stop])),
                             np.uint64, stop - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, row_id="doc_id", text="text", shingle=SHINGLE) -> DataFrame:
    """(doc_id, fp) per row."""
    def made(batch):
        texts = batch.column(1).cast(pa.binary())
        return {"doc_id": batch.column(0), "fp": pa.array(
            [fingerprint(t.as_py() or b"", shingle) for t in texts], pa.int64())}
    return map_rows(docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")),
                    made, "doc_id long, fp long")


class Ring:
    """64 bits cut into segments that stand in a ring, and the pigeonring test on them.

    Two fingerprints within `distance` have a segment from which every chain of l consecutive
    segments differs in at most l * distance / m bits. With m = distance + 2 the first segment of
    such a chain is equal, and one of the next three is too: equal pairs of segments are the keys.
    """

    def __init__(self, distance: int = DISTANCE):
        self.distance, self.m = distance, distance + 2
        edges = [round(i * BITS / self.m) for i in range(self.m + 1)]
        self.spans = list(zip(edges, edges[1:]))
        self.masks = [((1 << (b - a)) - 1) << a for a, b in self.spans]
        reach = self._reach()
        self.tables = sorted({tuple(sorted((s, (s + o) % self.m))) for s in range(self.m) for o in range(1, reach + 1)})

    def _reach(self) -> int:
        """Least l so that a chain of l segments after the first must hold another equal one."""
        for l in range(1, self.m):
            if (l + 1) * self.distance // self.m < l:
                return l
        return self.m - 1

    def starts(self, t: int) -> list[int]:
        """Segments of table t from which the other one is within reach."""
        i, j = self.tables[t]
        reach = self._reach()
        return [s for s, other in ((i, j), (j, i)) if 1 <= (other - s) % self.m <= reach]

    def linked(self, x: np.ndarray, t: int) -> np.ndarray:
        """Which differences x (uint64, equal in table t's segments) pass the chains and the distance."""
        ring = np.zeros(x.shape, bool)
        for s in self.starts(t):
            chain, mask = np.ones(x.shape, bool), 0
            for l in range(1, CHAIN + 1):
                mask |= self.masks[(s + l - 1) % self.m]
                if l > 1:
                    chain &= np.bitwise_count(x & np.uint64(mask)) <= l * self.distance // self.m
            ring |= chain
        at = np.nonzero(ring)
        ring[at] = np.bitwise_count(x[at]) <= self.distance
        return ring


def _small_groups(ring, t, fp, rep, group):
    """Links inside many small groups at once: each row against the one `lag` further on."""
    made, lag, alive = [], 1, np.arange(len(fp))
    while True:
        alive = alive[alive + lag < len(fp)]
        alive = alive[group[alive] == group[alive + lag]]
        if not len(alive):
            return made
        hit = alive[ring.linked(fp[alive] ^ fp[alive + lag], t)]
        if len(hit):
            made.append((rep[hit], rep[hit + lag]))
        lag += 1


def _large_group(ring, t, fp, rep):
    """A spanning forest of the links of one group, breadth first."""
    made, rest = [], np.arange(len(fp))
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            u = queue.pop()
            hit = ring.linked(fp[rest] ^ fp[u], t)
            if hit.any():
                new = rest[hit]
                made.append((np.full(len(new), rep[u]), rep[new]))
                queue.extend(new.tolist())
                rest = rest[~hit]
    return made


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(u, v): links that connect all fingerprints within `distance`, a forest per large bucket.

    `distinct` has one row per fingerprint: (fp, rep). Every table of two equal segments is a
    bucketing; buckets of any size are compared in parts (`blocks`), and a bucket gives at most as
    many links as it has rows, never all of its pairs.
    """
    ring = Ring(distance)
    tables = ring.tables

    def segment(i):
        a, b = ring.spans[i]
        return F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << (b - a)) - 1))

    keys = F.array(*[F.struct(F.lit(t).alias("t"), F.xxhash64(F.lit(t), segment(i), segment(j)).alias("key"))
                     for t, (i, j) in enumerate(tables)])
    rows = distinct.select("fp", "rep", F.explode(keys).alias("k")).select("fp", "rep", "k.t", "k.key")
    placed = meeting_places(rows, "key", "fp").select("place", "t", "fp", "rep")

    def compare(got):
        fp = got.column("fp").to_numpy().view(np.uint64)
        t, rep, place = (got.column(c).to_numpy() for c in ("t", "rep", "place"))
        made = []
        edges = np.concatenate(([0], np.flatnonzero(np.diff(place)) + 1, [len(place)]))
        sizes = np.diff(edges)
        for k in np.flatnonzero(sizes > 64):
            own = slice(edges[k], edges[k + 1])
            made += _large_group(ring, int(t[own][0]), fp[own], rep[own])
        small = np.repeat(sizes <= 64, sizes)
        for k in np.unique(t[small]):
            own = small & (t == k)
            made += _small_groups(ring, int(k), fp[own], rep[own], place[own])
        if made:
            u, v = (np.concatenate(x) for x in zip(*made))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return at_places(placed, compare, "u long, v long")


def classes(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(fp, root, least, component_id) of every fingerprint that a row with an id has, stored.

    `least` is the smallest id with that fingerprint, `component_id` the smallest reachable. Components
    are made of fingerprints, so an id that stands on several texts does not join them.
    """
    distinct = settle(prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("least")))
    joined = components(links(distinct.select("fp", F.col("fp").alias("rep")), distance))
    rooted = stored(distinct.join(joined, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("root")), "roots")
    linked = rooted.join(stored(rooted.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("prints"))
                                .where("prints > 1").drop("prints"), "components"), "root", "left")
    return stored(linked.select("fp", "root", "least", F.coalesce("component_id", "least").alias("component_id")), "classes")


def near_duplicates(docs: DataFrame, row_id="doc_id", text="text", shingle=SHINGLE, distance=DISTANCE) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of `docs`.

    Texts are compared by SimHash over word shingles; two rows link when their fingerprints differ
    in at most `distance` bits, and `component_id` is the smallest id reachable. A NULL text counts
    as empty and has fingerprint zero, as has a text without a word; they link like any other.
    Repeated rows are returned as often as they come. Rows with a NULL id get component NULL and link
    nothing. Columns other than the two named are ignored. An empty table gives an empty result.

    Equal fingerprints collapse to one row before candidates are sought, so copies cost nothing. The
    classes are stored before they are joined to the rows, so that Spark can split a fingerprint that
    very many rows have.
    """
    prints = settle(fingerprints(docs, row_id, text, shingle))
    of_print = classes(prints, distance).select("fp", "component_id")
    return prints.join(of_print, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def with_fingerprint(docs: DataFrame, text: str, name: str, shingle=SHINGLE) -> DataFrame:
    """`docs` with one more column, the fingerprint of the text."""
    def made(batch):
        texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
        return {**{c: batch.column(k) for k, c in enumerate(batch.schema.names)},
                name: pa.array([fingerprint(t.as_py() or b"", shingle) for t in texts], pa.int64())}
    return map_rows(docs, made, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def keep_one(docs: DataFrame, row_id="doc_id", text="text", shingle=SHINGLE, distance=DISTANCE) -> DataFrame:
    """Of each group of near-duplicates one row: the one with the smallest id.

    Of rows that agree in id and fingerprint one stays; rows that share an id but not a group are decided
    each on its own. Rows with a NULL id stay. All columns stay as they are, of any type and name. NULL
    and empty texts are near-duplicates of each other. An empty table stays empty.

    Only ids are joined to the texts: those of which a row goes. Texts of ids that stand on several rows
    get their fingerprint a second time, to tell the rows apart.
    """
    prints = settle(fingerprints(docs, row_id, text, shingle))
    known = classes(prints, distance)
    # One (id, fingerprint) per group; of several fingerprints of one group under its smallest id the least.
    chosen = stored(known.where("least = component_id").groupBy("root").agg(F.min(F.struct("fp", "least")).alias("one"))
                    .select(F.col("one.fp").alias("fp"), F.col("one.least").alias("id")), "chosen")
    ids = prints.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).withColumnRenamed("doc_id", "id")
    marks = stored(ids.join(chosen.select("id").distinct().withColumn("chosen", F.lit(True)), "id", "left")
                   .where("n > 1 or chosen is null").select("id", F.expr("n > 1 and chosen is not null").alias("several")), "marks")
    # By number, so that a column of the documents cannot clash with one that is added.
    own = {c: f"c{k}" for k, c in enumerate(docs.columns)}
    named = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in own.items()]).withColumn("id", F.col(own[row_id]).cast("long"))
    marked = named.where("id is not null").join(marks, "id", "left")
    parts = [named.where("id is null"), marked.where("several is null")]
    if marks.where("several").take(1):
        several = with_fingerprint(marked.where("several").withColumn(own[text], F.col(own[text]).cast("string")), own[text], "fp", shingle)
        parts.append(several.join(chosen, ["id", "fp"], "left_semi").dropDuplicates(["id", "fp"]))
    names = list(own.values())
    whole = parts[0].select(*names)
    for part in parts[1:]:
        whole = whole.unionByName(part.select(*names))
    return whole.select(*[F.col(n).alias(c) for c, n in own.items()])
