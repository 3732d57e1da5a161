"""Benchmark passages in documents: winnowed fingerprints of both sides meet, hits are extended to windows.

Column expressions and joins only; no Python runs on the executors.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatline.llm.common import stored

SPAN = 10
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
OUTSIDE = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bits of the filter of test fingerprints, a megabyte whatever the size of the benchmark.
BITS = 1 << 23


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; NULL has none."""
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), LETTERS, LETTERS.lower()), OUTSIDE), "")


def sizes(m: int) -> tuple[int, int]:
    """Words of a k-gram and k-grams of a winnowing window that together span m words."""
    k = (m + 1) // 2
    return k, m - k + 1


def each(count: Column, body: Callable[[Column], Column], kind: str) -> Column:
    """Array of `body(0)` to `body(count - 1)`."""
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), body)).otherwise(F.array().cast(f"array<{kind}>"))


def grams(hashes: Column, m: int) -> Column:
    """Hash of every k-gram of spans of m words, from the hashes of the words."""
    k, _ = sizes(m)
    return each(F.size(hashes) - (k - 1), lambda i: F.xxhash64(F.lit(m), *[F.get(hashes, i + j) for j in range(k)]), "bigint")


def hashed(found: Column) -> Column:
    return F.transform(found, lambda w: F.xxhash64(w))


def minima(codes: Column, m: int) -> Column:
    """Least k-gram hash of every winnowing window, so of every span of m words."""
    _, w = sizes(m)
    if w == 1:
        return codes
    return each(F.size(codes) - (w - 1), lambda i: F.least(*[F.get(codes, i + j) for j in range(w)]), "bigint")


def fingerprints(found: Column, lengths: list[int]) -> Column:
    """The winnowed fingerprints of an array of words, for spans of each of `lengths`."""
    def least(h: Column, m: int) -> Column:
        return let(grams(h, m), lambda g: minima(g, m))
    return let(hashed(found), lambda h: F.array_distinct(F.concat(*[least(h, m) for m in lengths])))


def anchors(found: Column, marks: Column, lengths: list[int]) -> Column:
    """Per k-gram whose hash is in `marks`: the hash, the length m of its spans, the first place where such
    a span can start, and the words from there to the last word that such a span can hold."""
    def at(h: Column, m: int) -> Column:
        _, w = sizes(m)
        places = let(grams(h, m), lambda g: F.transform(F.filter(
            each(F.size(g), lambda i: F.struct(F.get(g, i).alias("code"), i.cast("int").alias("place")), "struct<code:bigint,place:int>"),
            lambda s: F.array_contains(marks, s["code"])), lambda s: s))
        return F.transform(places, lambda s: F.struct(
            s["code"].alias("code"), F.lit(m).alias("m"), F.greatest(s["place"] - (w - 1), F.lit(0)).alias("since"),
            F.slice(found, F.greatest(s["place"] - (w - 1), F.lit(0)) + 1,
                    s["place"] + m - F.greatest(s["place"] - (w - 1), F.lit(0))).alias("around")))
    return let(hashed(found), lambda h: F.concat(*[at(h, m) for m in lengths]))


def test_side(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """Stored tables (code, window), (window, said) and (said, item), and the lengths of windows.

    Items of equal words are one `said`; a window that many items share is one window.
    """
    spoken = (items.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("found"))
              .where(F.size("found") > 0).withColumn("m", F.least(F.size("found"), F.lit(SPAN)))
              .withColumn("said", F.sha2(F.array_join("found", " "), 256)))
    ids = stored(spoken.where("item is not null").select("said", "item").distinct(), "items")
    distinct = stored(spoken.select("said", "m", "found").dropDuplicates(["said"]), "said")
    lengths = sorted(r.m for r in distinct.select("m").distinct().collect())
    parts = None
    for m in lengths:
        # Every window of m words has exactly one fingerprint, its least k-gram hash.
        own = (distinct.where(F.col("m") == m)
               .select("said", F.explode(each(F.size("found") - (m - 1), lambda i: F.slice("found", i + 1, F.lit(m)), "array<string>")).alias("span"))
               .select("said", F.array_join("span", " ").alias("window"),
                       F.get(fingerprints(F.col("span"), [m]), F.lit(0)).alias("code")))
        parts = own if parts is None else parts.unionByName(own)
    if parts is None:
        parts = distinct.select("said", F.lit("").alias("window"), F.lit(0).cast("long").alias("code"))
    whole = stored(parts.distinct(), "windows")
    return whole.select("code", "window").distinct(), whole.select("window", "said"), ids, lengths


def passes(codes: DataFrame) -> Callable[[Column], Column]:
    """Condition that holds for every one of `codes`, and for one in thousands of other hashes as long as
    the codes are few. The filter is a constant of the plan, 131,072 longs whatever the number of codes.
    """
    filled = dict(codes.select(F.shiftright(F.pmod("code", F.lit(BITS)), 6).alias("word"), F.pmod("code", F.lit(64)).cast("int").alias("place"))
                  .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, place))")).collect())
    bits = F.from_json(F.lit(f"[{','.join(str(filled.get(word, 0)) for word in range(BITS // 64))}]"), "array<bigint>")

    def passed(code: Column) -> Column:
        word = F.get(bits, F.shiftright(F.pmod(code, F.lit(BITS)), 6).cast("int"))
        return F.getbit(word, F.pmod(code, F.lit(64)).cast("int")) == 1

    return passed


def scanned(docs: DataFrame, codes: DataFrame, lengths: list[int], row_id: str, text: str) -> DataFrame:
    """(doc_id, n_words, marks, text, key) per row of `docs`, stored; the one pass over all texts.

    `marks` are the fingerprints of the text whose bit is set in the filter of test fingerprints. Text
    and key (its digest) are kept only where there is one. The filter passes every test fingerprint and
    few others; which they are is decided by the join that follows.
    """
    passed = passes(codes)
    own = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    marks = (lambda ws: F.filter(fingerprints(ws, lengths), passed)) if lengths else (lambda ws: F.array().cast("array<bigint>"))
    seen = own.withColumn("seen", let(words(F.col("text")), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), marks(ws).alias("marks"))))
    some = F.size("marks") > 0
    return stored(seen.select("doc_id", F.col("seen.n_words").alias("n_words"), F.col("seen.marks").alias("marks"), "text")
                  .select("doc_id", "n_words", F.when(some, F.col("marks")).alias("marks"), F.when(some, F.col("text")).alias("text"),
                          F.when(some, F.sha2("text", 256)).alias("key")), "scanned")


def occurrences(candidates: DataFrame, test: DataFrame, lengths: list[int]) -> DataFrame:
    """(key, start, stop, window) of every place where a window occurs in a candidate text.

    A fingerprint that both sides hold is extended to each span around it that the winnowing window
    allows, and the span is looked up among the windows by its words. Neither step depends on how many
    windows share a k-gram.
    """
    texts = (candidates.groupBy("key").agg(F.first("text").alias("text"), F.first("marks").alias("marks")))
    met = (texts.select("key", F.explode(let(words(F.col("text")), lambda ws: anchors(ws, F.col("marks"), lengths))).alias("a"))
           .select("key", "a.*").join(test.select("code").distinct(), "code", "left_semi"))
    offsets = each(F.size("around") - (F.col("m") - 1), lambda i: F.struct(
        (F.col("since") + i).cast("int").alias("start"), F.array_join(F.slice("around", i + 1, F.col("m")), " ").alias("window")),
        "struct<start:int,window:string>")
    spans = met.select("key", "m", F.explode(offsets).alias("s")).select(
        "key", F.col("s.start").alias("start"), (F.col("s.start") + F.col("m")).alias("stop"), F.col("s.window").alias("window"))
    return stored(spans.distinct().join(test.select("window").distinct(), "window", "left_semi"), "occurrences")


def contaminated(docs: DataFrame, items: DataFrame, row_id="doc_id", text="text", item_id="item_id", item_text="text") -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) per row of `docs`.

    A window is any 10 consecutive words of an item, or all of a shorter one. Texts keep, of every span as
    long as a window, the least of its k-gram hashes; equal spans keep equal hashes, so every occurrence of a
    window has a fingerprint that the windows have as well. Where no word is hit, the digest is that of
    the empty text.

    A NULL or empty text has no words and no hit; a NULL or empty item has no window. Items with a NULL id
    hit words but are not counted or listed; an id that comes more than once counts once. Repeated rows of
    `docs` are returned as often as they come, ids may be NULL, other columns are ignored. Without documents
    the result is empty, without items nothing is hit.
    """
    test, members, ids, lengths = test_side(items, item_id, item_text)
    rows = scanned(docs, test.select("code").distinct(), lengths, row_id, text)
    found = occurrences(rows.where("key is not null"), test, lengths) if lengths else None
    clean = [F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"), F.sha2(F.lit(""), 256).alias("items_sha256")]
    if found is None:
        joined = rows.select("doc_id", "n_words", *clean)
    else:
        before = Window.partitionBy("key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
        hit = (found.select("key", "start", "stop").distinct()
               .withColumn("since", F.greatest("start", F.coalesce(F.max("stop").over(before), F.lit(0))))
               .groupBy("key").agg(F.sum(F.greatest(F.col("stop") - F.col("since"), F.lit(0))).cast("long").alias("n_hit")))
        listed = (found.select("key", "window").distinct().join(members, "window").select("key", "said").distinct()
                  .join(ids, "said").select("key", "item").distinct()
                  .groupBy("key").agg(F.count("*").alias("n_items"), F.array_join(F.array_sort(F.collect_list("item")), ",").alias("list"))
                  .select("key", "n_items", F.sha2("list", 256).alias("items_sha256")))
        results = stored(hit.join(listed, "key", "left"), "hits")
        # Rows without a key do not enter the join: all would share one NULL.
        joined = rows.where("key is null").select("doc_id", "n_words", *clean).unionByName(
            rows.where("key is not null").join(results, "key", "left").select(
                "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256")))
    return joined.withColumn("contaminated", F.col("n_hit") > 0)
