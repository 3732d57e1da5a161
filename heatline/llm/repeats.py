"""Repeated passages: radix passes over suffixes that go no deeper than the threshold.

Suffixes are ordered only through their first 50 bytes, most significant digit first, and groups of
one are dropped after each digit; what is left after the last digit are groups of equal windows.

1. The first digit is the hash of 20 bytes. Not every suffix takes part in it: of the 31 such runs
   inside a window the least by hash is its anchor, and as equal windows have equal anchors, only
   anchors (one position in sixteen) are dealt out. Those found in two texts go on.
2. Neighbouring windows with the same anchor form a cell, which is a digit of its own: a cell that an
   earlier text holds too is gone as a whole. Long copies end here, at one number per cell.
3. The last digit is the whole window, of the cells that no earlier text holds.

Texts that are equal as a whole need no digit: all but the first go, if they have 50 bytes.
"""

import hashlib
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import settle, stored

SPAN, GRAM = 50, 20
REACH = SPAN - GRAM + 1
CHUNK = 1 << 15
PLACE = np.uint64((1 << 17) - 1)
BLOCK_BYTES = 2 << 20
BUCKET_ANCHORS = 1 << 20
SEED = 2024
BASE = 0x9E3779B97F4A7C15
POWER = {w: np.uint64(pow(BASE, w, 1 << 64)) for w in (1, 2, 4, 8, 16, 18)}
BYTES = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64)
DATA, STATE = 0, 1
PLAIN, COPY, ALONE = 0, 1, 2
ROW = "bucket int, block int, kind int, a binary, b binary, c binary"
NAMES = ["bucket", "block", "kind", "a", "b", "c"]


def mixed(x: np.ndarray, factor: int) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(factor)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def rolled(data: np.ndarray, widest: int) -> dict[int, np.ndarray]:
    """Polynomial hash of the run of 1, 2, 4 ... bytes from each position."""
    out = {1: BYTES[data]}
    w = 1
    while 2 * w <= widest:
        x = out[w]
        y = x[:-w] * POWER[w] if len(x) > w else x[:0].copy()
        y += x[w:] if len(x) > w else 0
        out[2 * w] = y
        w *= 2
    return out


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i : i + width] for every i."""
    span = 1
    while 2 * span <= width:
        x, span = np.minimum(x[:-span], x[span:]), 2 * span
    rest = width - span
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


class Texts:
    """Many texts end to end, and the cells of windows in them."""

    def __init__(self, texts: list[bytes]):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def whole(self, lo: int, size: int) -> np.ndarray:
        """Whether the window from each of `size` positions from lo on ends inside its text."""
        ok = np.ones(size, bool)
        first, last = np.searchsorted(self.starts, [lo + 1, lo + size + SPAN])
        for end in (self.starts[first:last] - lo).tolist():
            ok[max(0, end - SPAN + 1):max(0, end)] = False
        return ok

    def cells(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first window, last window, hash of the anchor) of every cell, in order.

        A window's anchor is the least of its 20-byte runs, the first of equal ones. Cells are cut at
        chunk edges too, which only makes them smaller.
        """
        found = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)]
        for lo in range(0, max(0, len(self.data) - SPAN + 1), CHUNK):
            h = rolled(self.data[lo:lo + CHUNK + SPAN - 1], 16)
            n = len(h[1]) - GRAM + 1
            gram = h[16][:n] * POWER[4]
            gram += h[4][16:16 + n]
            order = mixed(gram, 0xBF58476D1CE4E5B9)
            order &= ~PLACE
            order |= np.arange(n, dtype=np.uint64)
            place = (sliding_least(order, REACH) & PLACE).astype(np.int32)
            j = np.flatnonzero(self.whole(lo, len(place)))
            if not len(j):
                continue
            place = place[j]
            cut = np.flatnonzero((place[1:] != place[:-1]) | (j[1:] != j[:-1] + 1)) + 1
            heads, tails = np.append(0, cut), np.append(cut, len(j)) - 1
            found.append((j[heads] + lo, j[tails] + lo, mixed(gram[place[heads]], 0xD6E8FEB86659FD93)))
        return tuple(np.concatenate(x) for x in zip(*found))

    def codes(self, at: np.ndarray) -> np.ndarray:
        """Hash of the windows at the given positions, which are in order."""
        out = np.zeros(len(at), np.uint64)
        for lo in range(0, len(self.data), CHUNK):
            a, b = np.searchsorted(at, [lo, lo + CHUNK])
            if a < b:
                h, j = rolled(self.data[lo:lo + CHUNK + SPAN - 1], 32), at[a:b] - lo
                out[a:b] = h[32][j] * POWER[18] + h[16][j + 32] * POWER[2] + h[2][j + 48]
        return mixed(out, 0xBF58476D1CE4E5B9)


def split(codes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each 64-bit code; sorted codes have sorted buckets."""
    return (((codes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def short(codes: np.ndarray) -> np.ndarray:
    """The 31 bits of a code that are kept within its bucket in the first pass."""
    return (codes & np.uint64(0x7FFFFFFF)).astype(np.uint32)


def runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows of sorted keys, and the end."""
    n = len(keys[0])
    new = np.ones(n, bool)
    if n:
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), n)


def spread(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All whole numbers from each start to its end, the end included."""
    sizes = ends - starts + 1
    if not len(sizes):
        return np.zeros(0, np.int64)
    return np.repeat(starts - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())


def binaries(data: np.ndarray, edges: np.ndarray) -> list[bytes]:
    """Slices of an array as bytes."""
    raw, width = np.ascontiguousarray(data).tobytes(), data.dtype.itemsize
    return [raw[a * width:b * width] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def numbers(column: pa.ChunkedArray, kind) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), kind) for x in column]


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags(raw: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8))[:n].astype(bool)


def table(bucket, block, kind, a, b=None, c=None) -> pa.Table:
    n = len(a)
    own = lambda x, kind: pa.array(x if x is not None else [b""] * n, kind)
    number = lambda x: pa.array(np.broadcast_to(np.asarray(x, np.int32), n), pa.int32())
    return pa.table([number(bucket), number(block), number(kind), own(a, pa.binary()), own(b, pa.binary()), own(c, pa.binary())],
                    names=NAMES)


class Distinct:
    """Distinct codes of a block, each with the smallest id that holds it, dealt to buckets.

    By bucket, then by id, so that an id is sent once for all of its codes in a bucket.
    """

    def __init__(self, codes: np.ndarray, doc: np.ndarray, buckets: int):
        order = np.argsort(codes, kind="stable")
        edges = runs(codes[order])
        codes = codes[order[edges[:-1]]]
        first = np.minimum.reduceat(doc[order], edges[:-1]) if len(order) else doc
        names, rank = np.unique(first, return_inverse=True)
        bucket = split(codes, buckets)
        dealt = np.argsort(bucket * max(1, len(names)) + rank, kind="stable")
        self.codes, self.first, self.bucket, self.doc = codes[dealt], first[dealt], bucket[dealt], doc
        back = np.empty(len(dealt), np.int64)
        back[dealt] = np.arange(len(dealt))
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.repeat(back, np.diff(edges))

    def sent(self, block: int) -> pa.Table:
        """Codes, the ids in turn, and how many codes each has."""
        by_doc = runs(self.bucket, self.first)
        heads, sizes = by_doc[:-1], np.diff(by_doc).astype(np.int32)
        groups = runs(self.bucket[heads])
        return table(self.bucket[heads][groups[:-1]], block, DATA, binaries(self.codes, by_doc[groups]),
                     binaries(self.first[heads], groups), binaries(sizes, groups))

    def gone(self, answers: pa.Table) -> np.ndarray:
        """Per code given: does an earlier text hold it, of this block or another?"""
        earlier = np.zeros(len(self.codes), bool)
        edges = runs(self.bucket)
        of = {int(self.bucket[a]): (a, b) for a, b in zip(edges[:-1], edges[1:])}
        for bucket, raw in zip(answers.column("bucket").to_pylist(), answers.column("a").to_pylist()):
            a, b = of[bucket]
            earlier[a:b] = flags(raw, b - a)
        return earlier[self.place] | (self.doc > self.first[self.place])


class Block:
    """The texts of a block, in an order that does not depend on how they arrived."""

    def __init__(self, texts: pa.Table, buckets: int):
        rows = sorted(zip(texts.column("doc_id").to_pylist(),
                          [t.as_py() or b"" for t in texts.column("text").cast(pa.binary())]),
                      key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        self.ids, self.bodies, self.buckets = [r[0] for r in rows], [r[1] for r in rows], buckets
        self.block = texts.column("block")[0].as_py()

    def sort_out(self, copies: set) -> np.ndarray:
        """Per text: does it take part, is it a copy of an earlier text, or neither?"""
        some = {i for i, _ in copies}
        return np.array([ALONE if i is None or len(b) < SPAN else
                         COPY if i in some and (i, hashlib.sha256(b).hexdigest()) in copies else PLAIN
                         for i, b in zip(self.ids, self.bodies)], np.uint8)

    def enter(self, kinds: np.ndarray) -> None:
        self.kinds, self.taken = kinds, np.flatnonzero(kinds == PLAIN)
        self.texts = Texts([self.bodies[i] for i in self.taken])
        self.heads, self.tails, self.anchors = self.texts.cells()
        self.doc_of = np.array([self.ids[i] for i in self.taken], np.int64)
        self.cell_doc = self.doc_of[self.texts.row(self.heads)] if len(self.heads) else np.zeros(0, np.int64)

    def first_digit(self) -> pa.Table:
        bucket, value = split(self.anchors, self.buckets), short(self.anchors)
        order = np.lexsort((value, bucket))
        bucket, value, doc = bucket[order], value[order], self.cell_doc[order]
        edges = runs(bucket, value)
        lone = edges[:-1]
        many = (np.minimum.reduceat(doc, lone) != np.maximum.reduceat(doc, lone)) if len(lone) else np.zeros(0, bool)
        items = value[lone] * np.uint32(2) + many
        groups = runs(bucket[lone])
        return table(bucket[lone][groups[:-1]], self.block, DATA, binaries(items, groups))

    def know(self, answers: pa.Table) -> np.ndarray:
        """Which cells' anchors passed the first digit."""
        passed = [(np.int64(b) << 31) | v.astype(np.int64) for b, v in zip(
            answers.column("bucket").to_pylist(), numbers(answers.column("a"), np.uint32))]
        if not passed:
            return np.zeros(len(self.anchors), bool)
        passed = np.sort(np.concatenate(passed))
        own = (split(self.anchors, self.buckets) << 31) | short(self.anchors)
        return passed[np.minimum(np.searchsorted(passed, own), len(passed) - 1)] == own

    def cell_digit(self, known: np.ndarray) -> Distinct:
        """A cell's text is what its first and its last window cover, which overlap."""
        heads, tails = self.heads[known], self.tails[known]
        codes = mixed(self.texts.codes(heads) * np.uint64(0xD6E8FEB86659FD93) + self.texts.codes(tails)
                      + (tails - heads).astype(np.uint64), 0xBF58476D1CE4E5B9)
        return Distinct(codes, self.cell_doc[known], self.buckets)

    def window_digit(self, left: np.ndarray) -> tuple[np.ndarray, Distinct]:
        at = spread(self.heads[left], self.tails[left])
        doc = np.repeat(self.cell_doc[left], self.tails[left] - self.heads[left] + 1)
        return at, Distinct(self.texts.codes(at), doc, self.buckets)

    def spans(self, gone: np.ndarray) -> list[np.ndarray]:
        """Per text the runs, as rows (start, end), that the windows at the given positions cover."""
        out = [np.zeros((0, 2), np.int64)] * len(self.bodies)
        if len(gone):
            gone = np.sort(gone)
            row = self.texts.row(gone)
            starts = np.flatnonzero(np.append(True, (gone[1:] > gone[:-1] + SPAN) | (row[1:] != row[:-1])))
            ends = np.append(starts[1:], len(gone)) - 1
            pairs = np.stack([gone[starts], gone[ends] + SPAN], axis=1) - self.texts.starts[row[starts]][:, None]
            cuts = runs(row[starts])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                out[self.taken[row[starts[lo]]]] = pairs[lo:hi]
        for i in np.flatnonzero(self.kinds == COPY):
            out[i] = np.array([[0, len(self.bodies[i])]])
        return out


def parted(got: pa.Table) -> tuple[pa.Table, pa.Table]:
    is_state = pc.equal(got.column("kind"), STATE)
    return got.filter(pc.invert(is_state)), got.filter(is_state)


def shared(got: pa.Table) -> pa.Table:
    """Of one bucket: per block its anchors that occur in two texts or more."""
    data, state = parted(got)
    if not data.num_rows:
        return state
    parts = numbers(data.column("a"), np.uint32)
    items = np.concatenate(parts)
    block = np.repeat(data.column("block").to_numpy(), [len(p) for p in parts])
    order = np.argsort(items >> np.uint32(1), kind="stable")
    value, many, block = (items >> np.uint32(1))[order], (items & np.uint32(1))[order], block[order]
    edges = runs(value)
    keep = np.repeat((np.diff(edges) > 1) | (np.maximum.reduceat(many, edges[:-1]) > 0), np.diff(edges))
    value, block = value[keep], block[keep]
    order = np.argsort(block, kind="stable")
    value, block = value[order], block[order]
    edges = runs(block)
    return pa.concat_tables([state, table(got.column("bucket")[0].as_py(), block[edges[:-1]], DATA, binaries(value, edges))])


def earlier(got: pa.Table) -> pa.Table:
    """Of one bucket: per block and code a bit, does an earlier text of another block hold it?"""
    data, state = parted(got)
    if not data.num_rows:
        return state
    codes = numbers(data.column("a"), np.uint64)
    first = np.concatenate([np.repeat(ids, n) for ids, n in zip(
        numbers(data.column("b"), np.int64), numbers(data.column("c"), np.int32))])
    ends = np.cumsum([len(c) for c in codes])
    flat = np.concatenate(codes)
    order = np.argsort(flat, kind="stable")
    edges = runs(flat[order])
    least = np.empty(len(flat), np.int64)
    least[order] = np.repeat(np.minimum.reduceat(first[order], edges[:-1]), np.diff(edges))
    found = least < first
    return pa.concat_tables([state, table(data.column("bucket").to_numpy(), data.column("block").to_numpy(), DATA,
                                          [bits(found[e - len(c):e]) for c, e in zip(codes, ends)])])


def copies_of(rows: DataFrame) -> DataFrame:
    """(block, doc_id, digest): rows whose whole text a row with a smaller id has too."""
    narrow = rows.where("doc_id is not null").select("block", "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("digest"))
    least = stored(narrow.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
                   .where("n > 1").drop("n"), "copies")
    return narrow.join(least, "digest").where("doc_id > least").select("block", "doc_id", "digest")


def remove_repeats(docs: DataFrame, row_id="doc_id", text="text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) per row of `docs`.

    `spans` are the maximal runs (start, end) of bytes covered by a 50-byte string that also starts in
    a text with a smaller id, and `kept` the rest of the text's UTF-8 bytes, end to end. Strings are
    judged on the texts as given and never cross them. Windows are compared by 64-bit hashes within
    their bucket.

    A NULL text is empty. Rows with a NULL id neither remove nor lose anything; rows with equal ids
    remove nothing from each other. Other columns are ignored; an empty table gives an empty result.

    Texts meet in blocks of about two megabytes by a hash of their id. They are shuffled once; every
    pass reads that one shuffle again. What a block has found out goes along with what it deals out
    and comes back with the answers. A passage in every text is one number per block, not per text.
    """
    rows = docs.select(F.col(row_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = max(1, ceil(total / BLOCK_BYTES)), max(1, ceil(total * 2 / (REACH + 1) / BUCKET_ANCHORS))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(F.lit("block"), "doc_id"), F.lit(blocks)).cast("int"))
    nothing = table(0, 0, 0, [])

    def remembered(block, *parts):
        parts = [[p] for p in parts]
        return table(block.block % buckets, block.block, STATE, *parts)

    def opened(texts, answers):
        data, state = parted(answers)
        block = Block(texts, buckets)
        block.enter(np.frombuffer(state.column("a")[0].as_py(), np.uint8))
        known = flags(state.column("b")[0].as_py(), len(block.heads))
        return block, data, state, known

    def deal_anchors(texts: pa.Table, copies: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return nothing
        block = Block(texts, buckets)
        block.enter(block.sort_out(set(zip(copies.column("copy_id").to_pylist(), copies.column("digest").to_pylist()))))
        return pa.concat_tables([block.first_digit(), remembered(block, block.kinds.tobytes())])

    def deal_cells(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return nothing
        block, data, _, _ = opened(texts, answers)
        known = block.know(data)
        return pa.concat_tables([block.cell_digit(known).sent(block.block),
                                 remembered(block, block.kinds.tobytes(), bits(known))])

    def deal_windows(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return nothing
        block, data, _, known = opened(texts, answers)
        whole = block.cell_digit(known).gone(data)
        left = np.flatnonzero(known)[~whole]
        return pa.concat_tables([block.window_digit(left)[1].sent(block.block),
                                 remembered(block, block.kinds.tobytes(), bits(known), bits(whole))])

    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        block, data, state, known = opened(texts, answers)
        known = np.flatnonzero(known)
        whole = flags(state.column("c")[0].as_py(), len(known))
        at, windows = block.window_digit(known[~whole])
        found = block.spans(np.concatenate([at[windows.gone(data)],
                                            spread(block.heads[known[whole]], block.tails[known[whole]])]))
        kept = []
        for body, spans in zip(block.bodies, found):
            edges = [0, *spans.ravel().tolist(), len(body)]
            kept.append(b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2])))
        pairs = np.concatenate(found)
        ends = np.concatenate(([0], np.cumsum([len(x) for x in found])))
        spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
            [pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["start", "end"]))
        return pa.table({"doc_id": pa.array(block.ids, pa.int64()), "n_bytes": pa.array([len(b) for b in block.bodies], pa.int64()),
                         "spans": spans, "kept": pa.array(kept, pa.binary())})

    def asked(answers, function, schema=ROW):
        return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(function, schema)

    # Named anew: both sides of the first meeting come from the same columns.
    copies = settle(copies_of(dealt)).select(F.col("block").alias("block"), F.col("doc_id").alias("copy_id"),
                                               F.col("digest").alias("digest"))
    anchors = asked(copies, deal_anchors).groupBy("bucket").applyInArrow(shared, ROW)
    cells = asked(anchors, deal_cells).groupBy("bucket").applyInArrow(earlier, ROW)
    windows = asked(cells, deal_windows).groupBy("bucket").applyInArrow(earlier, ROW)
    return asked(windows, cut, "doc_id long, n_bytes long, spans array<struct<start:bigint,end:bigint>>, kept binary")
