"""Quality rules: repetition and length counts, and divergence from the language's usual text."""

import re
import sys
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heatline.llm.common import map_rows, short_batches, stored
from heatline.llm.ngrams import code_points

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50
WINDOW = 3
COMMON = 40
LEAST_CHARS = 200
#: Languages that texts without one are compared with, a kilobyte or two each.
MOST_LANGUAGES = 10_000
LEAST_LETTER_WORDS = 40
# Allowed distance: a base, and the sampling noise of a text of n items, noise / sqrt(n).
CLASS_LIMIT = (0.13, 3.2)
WORD_LIMIT = (0.04, 4.2)
CLASSES = ("lower", "upper", "letter", "digit", "space", "mark", "symbol", "other")
MARKS = frozenset(".,;:!?'\"()-‘’“”«»¡¿–—…")
WORD = re.compile(r"[^\W\d_]+")


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Character class of every code point."""
    def of(i):
        c = chr(i)
        kind = unicodedata.category(c)
        if kind[0] == "L":
            return {"Ll": 0, "Lu": 1, "Lt": 1}.get(kind, 2)
        if kind[0] == "N":
            return 3
        if c.isspace():
            return 4
        if c in MARKS:
            return 5
        return 6 if kind[0] in "SP" else 7
    return np.fromiter((of(i) for i in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)


def class_counts(text: str) -> np.ndarray:
    return np.bincount(classes()[code_points(text)], minlength=len(CLASSES))


def letter_words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of `window` words that the text holds twice or more."""
    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    at = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    code = at[:len(at) - window + 1]
    for k in range(1, window):
        # Numbered anew after each word, so that codes stay below n * n.
        code = np.unique(code * len(ids) + at[k:len(at) - window + 1 + k], return_inverse=True)[1]
    twice = np.bincount(code)[code] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = text.split()
    flat = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (len(words), len(flat.decode("utf-8", "replace")), len(flat) - len(flat.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words))


def references(docs: DataFrame) -> DataFrame:
    """A stored table of one row per language: character classes, words, the most common ones and their counts.

    Counts cover every row of (lang, text) with a language, and words of every length.
    """
    def run(batches):
        found: Counter = Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for k, n in enumerate(class_counts(text).tolist()):
                    found[lang, "class", str(k)] += n
                words = letter_words(text)
                found[lang, "words", ""] += len(words)
                for word, n in Counter(words).items():
                    found[lang, "word", word] += n
            if len(found) > 200_000:
                yield rows(found)
                found = Counter()
        if found:
            yield rows(found)

    def rows(found):
        lang, kind, item = zip(*found)
        return pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(kind), pa.array(item), pa.array(list(found.values()), pa.int64())],
            names=["lang", "kind", "item", "n"])

    counts = (short_batches(docs.where("lang is not null and text is not null").select("lang", "text"))
              .mapInArrow(run, "lang string, kind string, item string, n long")
              .groupBy("lang", "kind", "item").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "item")
    top = counts.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= COMMON)
    own = F.collect_list(F.when(F.col("kind") == "word", F.struct("_r", "item", "n")))
    made = top.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.when(F.col("kind") == "class", F.struct(F.col("item").cast("int").alias("k"), "n")))).alias("c"),
        F.sort_array(own).alias("w"), F.sum(F.when(F.col("kind") == "words", F.col("n"))).alias("total"))
    return stored(made.select("lang", F.col("c.n").alias("classes"), F.col("w.item").alias("words"), F.col("w.n").alias("counts"),
                              "total"), "references")


def reference(classes: list[int], words: list[str], counts: list[int], total: int) -> dict:
    return {"classes": np.array(classes, float), "words": dict(zip(words, counts)), "total": total}


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, base 2, of two histograms: 0 equal, 1 disjoint."""
    p, q = p / max(p.sum(), 1e-300), q / max(q.sum(), 1e-300)
    m = (p + q) / 2

    def half(x):
        on = x > 0
        return (x[on] * np.log2(x[on] / m[on])).sum()

    return float(np.sqrt(max(0.0, (half(p) + half(q)) / 2)))


def word_histogram(counts: Counter, total: int, common: dict) -> np.ndarray:
    own = np.array([counts.get(w, 0) for w in common], float)
    return np.append(own, max(0.0, total - own.sum()))


def allowed(limit: tuple[float, float], n: int) -> float:
    return limit[0] + limit[1] / np.sqrt(n)


def divergence(text: str, near: list[dict], class_limit=CLASS_LIMIT,
               word_limit=WORD_LIMIT) -> tuple[float, float, bool]:
    """Distance of character classes and of common words to the nearest of some languages, and if both do.

    Texts below the guards' lengths, or without any reference, have distance 0: too little to judge by.
    """
    own = class_counts(text)
    words = letter_words(text)
    by_class = by_word = 0.0
    fits = True
    if near and own.sum() >= LEAST_CHARS:
        by_class = min(distance(own, r["classes"]) for r in near)
        fits = by_class <= allowed(class_limit, int(own.sum()))
    if near and len(words) >= LEAST_LETTER_WORDS:
        counts = Counter(words)
        by_word = min(distance(word_histogram(counts, len(words), r["words"]),
                               np.append(np.array(list(r["words"].values()), float),
                                         r["total"] - sum(r["words"].values()))) for r in near)
        fits = fits and by_word <= allowed(word_limit, len(words))
    return by_class, by_word, bool(fits)


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, class_distance double, word_distance double, kept boolean")


def judge(docs: DataFrame, row_id="doc_id", text="text", lang="lang", class_limit=CLASS_LIMIT,
          word_limit=WORD_LIMIT) -> DataFrame:
    """Counts, distances and the verdict per row of `docs`.

    `base_failed` is set below 50 words, or where over half of the words stand in repeated windows of
    three. Other texts are kept when neither histogram is further from its language than allowed: a
    limit plus the noise of a sample of the text's length, so that short texts are not held to what
    only long ones can meet. A text without a language is compared with all, and the nearest counts; with
    over 10,000 languages that is an error.
    A NULL text has no words and fails. Repeated rows are returned as often as they come, ids may be
    NULL, other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    refs = references(rows)
    whole = rows.where("lang is not null").join(refs, "lang", "left").select("doc_id", "text", "lang", *refs.columns[1:])
    if rows.where("lang is null").take(1):
        # Any language may be the nearest, so these texts meet them all: a broadcast of a proven size.
        if refs.count() > MOST_LANGUAGES:
            raise ValueError(f"texts without a language can be compared with {MOST_LANGUAGES} languages at most")
        every = docs.sparkSession.sparkContext.broadcast([tuple(r)[1:] for r in refs.orderBy("lang").collect()])
        held = rows.where("lang is null").select("doc_id", "text", "lang", *[
            F.lit(None).cast(kind).alias(name) for name, kind in refs.dtypes[1:]])
        whole = whole.unionByName(held)
    else:
        every = None
    nearest: list[dict] = []

    def made(batch):
        if every is not None and not nearest:
            nearest.extend(reference(*r) for r in every.value)
        known, out = {}, []
        for k, (raw, own) in enumerate(zip(batch.column(1), batch.column(2).to_pylist())):
            if own is None:
                near = nearest
            elif own in known:
                near = known[own]
            else:
                found = [batch.column(c)[k].as_py() for c in range(3, 7)]
                near = known[own] = [] if found[0] is None else [reference(*found)]
            body = raw.as_py() or ""
            found = base(body.encode("utf-8", "replace"))
            failed = found[0] < LEAST_WORDS or 100 * found[4] > MOST_REPEATED * found[0]
            far = divergence(body, near, class_limit, word_limit)
            out.append((*found, failed, *far[:2], not failed and far[2]))
        columns = list(zip(*out))
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return {"doc_id": batch.column(0)} | {n: pa.array(c) for n, c in zip(names, columns)}

    return map_rows(whole, made, f"doc_id {dict(rows.dtypes)['doc_id']}, {SCHEMA}")
