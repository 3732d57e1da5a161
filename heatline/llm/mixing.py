"""Mixing sources to target weights: tempered shares, realised as budgeted block permutations.

DataFrame and SQL functions only.
"""

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heatline.llm.common import settle, stored

WORD = r"[^\x20\x09-\x0D]+"
ENTROPY = 0.9995
MOST_EPOCHS = 2.0
BLOCK_TOKENS = 1 << 16
BUCKET_ROWS = 2048
STEPS, ROUNDS = 64, 7
AXIS_BITS = 60
TIE, TIED_ROWS = "tie", 1000


def words(text: Column) -> Column:
    """Tokens of a text: its words, at least one."""
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0))).cast("long")


def order_key(epoch: Column, kind: str) -> Column:
    """A number below 2^60 that orders the documents of a source anew in every epoch."""
    text = F.concat_ws(":", F.lit(kind), epoch.cast("string"), F.col("doc_id").cast("string"), F.col("src"),
                       F.col("tokens").cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, AXIS_BITS // 4), 16, 10).cast("long")


def measured(docs: DataFrame, row_id="doc_id", source="source", text="text", ties: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, src, tokens, and a hash of the text under each name in `ties`) per row. NULL sources form one
    source with the empty name."""
    body = F.col(text).cast("string")
    return docs.select(F.col(row_id).alias("doc_id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("src"),
                       words(body).alias("tokens"), *[F.xxhash64(body).alias(name) for name in ties])


def exponent(totals: DataFrame, entropy=ENTROPY, most_epochs=MOST_EPOCHS) -> float:
    """Least exponent in [0, 1] whose weights are not too flat, by bisection.

    Weights are p ** a / sum(p ** a) for token shares p. They are too flat while their entropy is over
    `entropy` times its maximum, or while the smallest source would be repeated more than
    `most_epochs` times as often as the largest. Both only fall as the exponent grows; where even 1
    is too flat the shares stay as they are. One pass over the sources tests 63 exponents, which is
    six halvings; seven passes fix the exponent to 2^-42.
    """
    seen = totals.agg(F.sum("t"), F.max("t"), F.min("t"), F.count("*")).first()
    total, most, least, n = seen
    if not n:
        return 1.0
    target = entropy * log(n)

    def too_flat(points: list[float]) -> list[bool]:
        p = F.col("t") / F.lit(float(total))
        power = [F.pow(p, F.lit(a)) for a in points]
        got = totals.agg(*[F.struct(F.sum(x), F.sum(x * F.log(p))) for x in power]).first()
        return [log(z) - a * s / z > target or (most / least) ** (1 - a) > most_epochs
                for a, (z, s) in zip(points, got)]

    low, high = 0.0, 1.0
    if not too_flat([0.0])[0]:
        return 0.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * k / STEPS for k in range(1, STEPS)]
        flat = too_flat(points)
        edges = [low, *points, high]
        first = flat.index(False) if False in flat else len(points)
        low, high = edges[first], edges[first + 1]
    return high


def budgets(totals: DataFrame, alpha: float) -> DataFrame:
    """(src, t, n, budget, share, bits): tokens each source gives, its weight, and bits of its buckets.

    Budgets are proportional to the weights; the largest source is used exactly once.
    """
    most = totals.agg(F.max("t")).first()[0] or 1
    budget = F.floor(F.col("t") * F.pow(F.lit(float(most)) / F.col("t"), F.lit(1 - alpha)) + 0.5).cast("long")
    bits = F.ceil(F.log2(F.ceil(F.col("n") / F.lit(BUCKET_ROWS)).cast("double"))).cast("int")
    out = totals.withColumn("budget", F.greatest(budget, F.col("t"))).withColumn("bits", F.greatest(bits, F.lit(0)))
    whole = out.agg(F.sum("budget")).first()[0] or 1
    return out.withColumn("share", F.col("budget") / F.lit(float(whole))).withColumn("whole", F.lit(whole))


def offsets(rows: DataFrame, ties: tuple[str, ...] = ()) -> DataFrame:
    """Add `before`: tokens ahead of the row in the order of its source and epoch, then of `ties`.

    `rows` has (src, epoch, axis, bits, tokens). A source is cut into buckets of its axis, so that no
    window runs over a source; only one sum per bucket is added up per source.
    """
    cut = rows.withColumn("bucket", F.expr(f"shiftright(axis, {AXIS_BITS} - bits)"))
    sums = cut.groupBy("src", "epoch", "bucket").agg(F.sum("tokens").alias("own"))
    earlier = Window.partitionBy("src", "epoch").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("src", "epoch", "bucket", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("start"))
    inside = (Window.partitionBy("src", "epoch", "bucket").orderBy("axis", "tokens", *ties)
              .rowsBetween(Window.unboundedPreceding, -1))
    return (cut.join(starts, ["src", "epoch", "bucket"])
            .withColumn("before", F.col("start") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
            .drop("bucket", "start"))


def planned(docs: DataFrame, row_id, source, text, entropy, most_epochs, ties=()) -> tuple[DataFrame, DataFrame]:
    rows = settle(measured(docs, row_id, source, text, ties))
    totals = settle(rows.groupBy("src").agg(F.sum("tokens").alias("t"), F.count("*").alias("n")))
    return rows, stored(budgets(totals, exponent(totals, entropy, most_epochs)), "sources")


def mix(docs: DataFrame, row_id="doc_id", source="source", text="text", entropy=ENTROPY, most_epochs=MOST_EPOCHS,
        block_tokens=BLOCK_TOKENS) -> DataFrame:
    """The mixed order: one row per use of a document, (doc_id, source, epoch, block, place, tokens).

    Each epoch of a source is a new permutation of its documents; uses are taken until the source's
    budget of tokens is met, so that the shares of all sources in the whole, and nearly so in each
    block of about `block_tokens` tokens, are the target weights. Within a block the documents of all
    sources are permuted; `place` counts from 0.

    Every row of `docs` is used at least once. An empty or NULL text counts as one token. A NULL
    source is the source with the empty name. Repeated rows are used like others, NULL ids too, other
    columns are ignored; an empty table gives an empty result.
    """
    rows, plan = planned(docs, row_id, source, text, entropy, most_epochs)
    uses = (rows.join(plan, "src")
            .withColumn("epoch", F.explode(F.expr("sequence(0, int(ceil(budget / t)) - 1)")))
            .withColumn("axis", order_key(F.col("epoch"), "use")))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("whole") / F.lit(block_tokens))).cast("decimal(18,0)")
    at = (offsets(uses).withColumn("before", F.col("before") + F.col("epoch") * F.col("t"))
          .where("before < budget").withColumn("blocks", blocks)
          .withColumn("block", F.expr("cast(before as decimal(20,0)) * blocks div cast(budget as decimal(20,0))"))
          .withColumn("spot", order_key(F.col("epoch"), "place")))
    order = Window.partitionBy("block").orderBy("spot", "epoch", "doc_id")
    return at.select("doc_id", F.col("src").alias("source"), "epoch", "block",
                     (F.row_number().over(order) - 1).alias("place"), "tokens")


def repeat(docs: DataFrame, row_id="doc_id", source="source", text="text", entropy=ENTROPY,
           most_epochs=MOST_EPOCHS) -> DataFrame:
    """`docs` with every row as often as the mix uses it.

    The last, unfinished epoch of a source ends at one point of its order, a row. So each source needs only
    its number of whole epochs and that point: one row per source, joined to the texts without a
    shuffle while Spark measures that table to be small. Rows that agree in id, source and text share
    their point; where the epoch ends among them, one of them stands for all that are still used.

    NULL, empty, repeated rows and empty tables are treated as by `mix`; all columns stay.
    """
    rows, plan = planned(docs, row_id, source, text, entropy, most_epochs, (TIE,))
    plan = plan.withColumn("whole_epochs", F.expr("int(budget div t)"))
    last = (rows.join(plan.where("budget % t > 0"), "src").withColumn("epoch", F.col("whole_epochs"))
            .withColumn("axis", order_key(F.col("epoch"), "use")))
    taken = (offsets(last, (TIE,)).withColumn("taken", F.expr("int(before < budget % t)"))
             .groupBy("src", "axis", "tokens", TIE).agg(F.sum("taken").alias("taken"), F.count("*").alias("tied")).where("taken > 0"))
    ends = taken.groupBy("src").agg(F.max(F.struct("axis", "tokens", TIE, "taken", "tied")).alias("end"))
    by_source = stored(plan.join(ends, "src", "left").select("src", "whole_epochs", F.struct("end.axis", "end.tokens", f"end.{TIE}").alias("end"),
                                                             "end.taken", "end.tied"), "sources")
    own = {c: f"_mixed_{i}" for i, c in enumerate(docs.columns)}
    named = docs.select([F.col(f"`{c}`").alias(n) for c, n in own.items()])
    body = F.col(own[text]).cast("string")
    keyed = named.select("*", *[c.alias(n) for c, n in zip(
        [F.col(own[row_id]), F.coalesce(F.col(own[source]).cast("string"), F.lit("")), words(body), F.xxhash64(body)],
        ["doc_id", "src", "tokens", TIE])])
    joined = keyed.join(by_source, "src").withColumn("point", F.struct(order_key(F.col("whole_epochs"), "use").alias("axis"), "tokens", TIE))
    more = F.coalesce((F.col("point") < F.col("end")) | ((F.col("point") == F.col("end")) & (F.col("taken") == F.col("tied"))), F.lit(False))
    used = (joined.withColumn("uses", F.col("whole_epochs") + more.cast("int"))
            .withColumn("_use", F.explode(F.expr("sequence(1, uses)"))))
    names = list(own.values())
    whole = used.select(names)
    if by_source.where("taken < tied").take(1):
        parts = (joined.where((F.col("point") == F.col("end")) & (F.col("taken") < F.col("tied"))).dropDuplicates(["src"])
                 .withColumn("_part", F.explode(F.expr(f"sequence(0, int((taken - 1) div {TIED_ROWS}))")))
                 .repartition("src", "_part"))
        whole = whole.unionByName(parts.withColumn("_use", F.explode(F.expr(
            f"sequence(1, int(least({TIED_ROWS}, taken - _part * {TIED_ROWS})))"))).select(names))
    return whole.select([F.col(n).alias(c) for c, n in own.items()])
