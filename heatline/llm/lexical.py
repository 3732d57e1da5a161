"""Ranked search of a query set in all documents: one automaton of the query terms scans the texts."""

from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatline.llm.common import map_rows, short_batches, stored

BEST = 10
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bounds of what one scan holds: terms of the automaton (broadcast) and items of the table of scores.
BLOCK_TERMS, BLOCK_ITEMS = 200_000, 2_000
#: Postings times items worked on at once.
CELLS = 1 << 21
# Byte to byte: A-Z to a-z, the rest of ASCII but letters and digits to the guard.
GUARD = b"\x20"
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else GUARD[0] for b in range(256))


def item_terms(items: DataFrame, item_id="item_id", text="text") -> DataFrame:
    """(item_id, term), each once."""
    low = F.translate(F.col(text).cast("string"), LETTERS, LETTERS.lower())
    return (items.select(F.col(item_id).alias("item_id"), F.explode(F.regexp_extract_all(low, F.lit(TERM), F.lit(0))).alias("term"))
            .distinct())


def blocks(terms: DataFrame) -> list[DataFrame]:
    """The query set in parts that one scan can hold, by a hash of the item."""
    size = terms.agg(F.count("*").alias("terms"), F.count_distinct(F.coalesce(F.col("item_id").cast("string"), F.lit(""))).alias("items")).first()
    parts = max(1, -(-size.terms // BLOCK_TERMS), -(-size.items // BLOCK_ITEMS))
    own = F.pmod(F.xxhash64("item_id"), F.lit(parts))
    return [terms.where(own == k) for k in range(parts)]


def automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """Terms between guards, so that only whole terms match. Bytes stand as characters of one byte."""
    built = ahocorasick.Automaton()
    for k, term in enumerate(terms):
        built.add_word((GUARD + term + GUARD).decode("latin-1"), k)
    built.make_automaton()
    return built


def scan(docs: DataFrame, terms: list[bytes], row_id: str, text: str) -> DataFrame:
    """(doc_id, n, term array, tf array) of every document with a term; `term` numbers the query's terms."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    state: list[ahocorasick.Automaton] = []

    def run(batch: pa.RecordBatch) -> dict:
        if not state:
            state.append(automaton(shared.value))
        find = state[0].iter if len(state[0]) else lambda said: ()
        counts, ends, numbers, tfs = np.zeros(batch.num_rows, np.int64), [0], [], []
        for row, value in enumerate(batch.column("text")):
            said = GUARD + (value.as_py() or "").encode("utf-8").translate(FOLD) + GUARD
            inside = np.frombuffer(said, np.uint8) != GUARD[0]
            counts[row] = np.count_nonzero(inside[1:] & ~inside[:-1])
            found = Counter(k for _, k in find(said.decode("latin-1"))) if counts[row] else {}
            numbers.extend(found.keys())
            tfs.extend(found.values())
            ends.append(len(numbers))
        offsets = pa.array(ends, pa.int32())
        return {"doc_id": batch.column("doc_id"), "n": pa.array(counts),
                "term": pa.ListArray.from_arrays(offsets, pa.array(numbers, pa.int32())),
                "tf": pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))}

    rows = docs.select(F.col(row_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).where("text is not null")
    return map_rows(rows, run, "doc_id long, n long, term array<int>, tf array<bigint>").where("n > 0")


def leading(item: np.ndarray, score: np.ndarray, doc: np.ndarray, unnamed: np.ndarray, best: int) -> np.ndarray:
    """Places of the `best` rows of each item, highest score first, then smallest id, NULL ids last."""
    order = np.lexsort((doc, unnamed, -score, item))
    ordered = item[order]
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.concatenate((starts, [len(order)]))))
    return order[rank < best]


def best_of_tasks(scanned: DataFrame, weights: np.ndarray, starts: np.ndarray, members: np.ndarray, n_items: int,
                  n_docs: int, total: int, best: int) -> DataFrame:
    """(item, doc_id, score): the `best` documents of each item among the rows of each task.

    `members[starts[k]:starts[k + 1]]` are the items of term k. A task keeps `best` rows an item and sets
    each batch against them; it never holds the scores of more than one batch.
    """
    degree = np.diff(starts)

    def batch_scores(batch: pa.RecordBatch) -> np.ndarray:
        lengths = np.diff(batch.column("term").offsets.to_numpy())
        term = batch.column("term").flatten().to_numpy()
        tf = batch.column("tf").flatten().to_numpy()
        m = np.array([10 + 90 * n * n_docs // total for n in batch.column("n").to_pylist()], np.int64)
        row = np.repeat(np.arange(batch.num_rows), lengths)
        gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        scores = np.zeros(batch.num_rows * n_items, np.int64)
        reach = np.concatenate(([0], np.cumsum(degree[term])))
        lo = 0
        while lo < len(term):
            hi = max(lo + 1, int(np.searchsorted(reach, reach[lo] + CELLS, "right")) - 1)
            own = degree[term[lo:hi]]
            again = np.repeat(np.arange(lo, hi), own)
            place = np.arange(len(again)) - np.repeat(reach[lo:hi] - reach[lo], own) + starts[term[again]]
            np.add.at(scores, row[again] * n_items + members[place], gain[again])
            lo = hi
        return scores.reshape(batch.num_rows, n_items)

    def run(batches):
        held = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
        least = np.ones(n_items, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            scores = batch_scores(batch)
            row, item = np.nonzero(scores >= least)
            if not len(row):
                continue
            ids = batch.column("doc_id")
            doc, unnamed = ids.fill_null(0).to_numpy()[row], ids.is_null().to_numpy(zero_copy_only=False)[row]
            held = [np.concatenate(pair) for pair in zip(held, (item, scores[row, item], doc, unnamed))]
            kept = leading(*held, best)
            held = [part[kept] for part in held]
            full = np.bincount(held[0], minlength=n_items) >= best
            lowest = np.full(n_items, np.iinfo(np.int64).max)
            np.minimum.at(lowest, held[0], held[1])
            least = np.where(full, lowest, 1)
        if len(held[0]):
            yield pa.RecordBatch.from_arrays([pa.array(held[0], pa.int32()), pa.array(held[2], pa.int64(), mask=held[3]), pa.array(held[1])],
                                             names=["item", "doc_id", "score"])

    return short_batches(scanned).mapInArrow(run, "item int, doc_id long, score long")


def rank_block(docs: DataFrame, terms: DataFrame, row_id: str, text: str, best: int) -> DataFrame:
    """Ranking of the items of one block: scan, statistics of the terms, scores."""
    pairs = terms.collect()
    names = sorted({r.term.encode("utf-8") for r in pairs})
    number = {name: k for k, name in enumerate(names)}
    item_ids = list(dict.fromkeys(r.item_id for r in pairs))
    place = {item: k for k, item in enumerate(item_ids)}
    links = np.array(sorted((number[r.term.encode("utf-8")], place[r.item_id]) for r in pairs), np.int64).reshape(-1, 2)
    starts = np.searchsorted(links[:, 0], np.arange(len(names) + 1))
    found = stored(scan(docs, names, row_id, text), "postings")
    known = found.agg(F.count("*").alias("docs"), F.sum("n").alias("total")).first()
    n_docs, total = known.docs, known.total or 0
    df = np.zeros(len(names), np.int64)
    for r in found.select(F.explode("term").alias("term")).groupBy("term").count().collect():
        df[r.term] = r["count"]
    weights = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    own = best_of_tasks(found.where(F.size("term") > 0), weights, starts, links[:, 1], len(item_ids), n_docs, total, best)
    # Two levels, so that an item's rows from many tasks do not meet in one.
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    near = Window.partitionBy("item", F.floor(F.col("task") / 64)).orderBy(*order)
    far = Window.partitionBy("item").orderBy(*order)
    some = (own.withColumn("task", F.spark_partition_id()).withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= best)
            .withColumn("rank", F.row_number().over(far)).where(F.col("rank") <= best))
    kind = dict(terms.dtypes)["item_id"]
    ids = docs.sparkSession.createDataFrame(list(enumerate(item_ids)), f"item int, item_id {kind}")
    return some.join(ids, "item").select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, row_id="doc_id", text="text", item_id="item_id", item_text="text", best=BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` documents of every item, over all documents.

    The terms of the items, in blocks of bounded size, make an automaton that every task runs over its
    texts; no index of the documents is made. Document frequencies come from the same scan.

    A NULL text, or one without a term, is no document; an item without a term has no row. Items that
    share an id (NULL is an id too) are one. Every row of `docs` is a document of its own; rows with a NULL
    id count and are ranked, behind others of equal score. Other columns are ignored; empty tables give an
    empty result.
    """
    parts = [rank_block(docs, part, row_id, text, best) for part in blocks(stored(item_terms(items, item_id, item_text), "terms"))]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
