"""Language of a text: multinomial logistic regression on TF-IDF character n-grams, by FTRL."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import bounded_sample, fit_once, held_out, map_rows, pack, short_batches, unpack
from heatline.llm.ngrams import chunks, code_points, grams, letters

BITS = 15
ORDERS = (1, 2, 3)
SAMPLE = 6000
PASSES = 2
ALPHA, BETA, LASSO, RIDGE = 0.5, 1.0, 1e-4, 1e-4
UNKNOWN = "und"
VALIDATION = 5


def counts(text: str) -> np.ndarray | None:
    """Occurrences of each hashed n-gram; None for a text without a letter.

    Letters are lowered, any other character counts as a space.
    """
    points = letters()[code_points(text.lower())]
    if not (points != 32).any():
        return None
    points = np.concatenate(([32], points, [32])).astype(np.uint32)
    total = np.zeros(1 << BITS, np.int64)
    for n in ORDERS:
        for part in chunks(points, n - 1):
            total += np.bincount(grams(part, n, BITS), minlength=1 << BITS)
    return total


def weighted(total: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = total * idf
    length = np.sqrt(x @ x)
    return x / length if length > 0 else x


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many texts there are, and in how many each n-gram occurs, over all rows of (text)."""
    def run(batches):
        seen, total = 0, np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                got = counts(text.as_py() or "")
                if got is not None:
                    total += got > 0
                    seen += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.append(total, seen).tolist()], pa.list_(pa.int64()))], names=["df"])

    rows = (short_batches(docs.select("text")).mapInArrow(run, "df array<bigint>").select(F.posexplode("df").alias("gram", "df"))
            .groupBy("gram").agg(F.sum("df").alias("df")).collect())
    found = np.zeros((1 << BITS) + 1, np.int64)
    for gram, df in rows:
        found[gram] = df
    return int(found[-1]), found[:-1]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow the regularised leader, per coordinate and class, with lasso and ridge."""

    def __init__(self, size: int, classes: int):
        self.z, self.n = np.zeros((size, classes)), np.zeros((size, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * LASSO - z
        return np.where(np.abs(z) <= LASSO, 0.0, shrunk / ((BETA + np.sqrt(n)) / ALPHA + RIDGE))

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p[None, :]
        n = self.n[at]
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] += g - step * w
        self.n[at] = n + g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section on its logarithm."""
    def loss(t):
        p = softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        if loss(a) <= loss(b):
            high = b
        else:
            low = a
    return float(np.exp((low + high) / 2))


def fit(docs: DataFrame, row_id="doc_id", text="text", lang="lang", sample=SAMPLE) -> bytes:
    """A model from the rows of `docs` that have a language and a letter.

    Document frequencies cover all of these rows; the weights are learned on at most `sample` rows,
    chosen by a hash of the id, a fifth of which only sets the temperature. Texts are counted where
    they are; the one task that learns gets no more than the buckets of each.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
    seen, df = document_frequencies(rows)
    idf = np.log((1 + seen) / (1 + df)) + 1

    def present(text):
        found = counts(text)
        on = np.flatnonzero(found) if found is not None else np.zeros(0, np.int64)
        return on.astype(np.int16), found[on].astype(np.int32) if len(on) else np.zeros(0, np.int32)

    def counted(batch):
        found = [present(t.as_py()) for t in batch.column(2)]
        return {"doc_id": batch.column(0), "lang": batch.column(1),
                "grams": pa.array([on for on, _ in found], pa.list_(pa.int16())),
                "n": pa.array([n for _, n in found], pa.list_(pa.int32()))}

    def learn(got: pa.Table) -> bytes:
        names = np.array(sorted(set(got.column("lang").to_pylist())))
        of = {name: k for k, name in enumerate(names.tolist())}
        rows = [k for k, at in enumerate(got.column("grams")) if len(at)]

        def row(k):
            """Weights of row k, made anew each time: what is held are the counts."""
            at = got.column("grams")[k].values.to_numpy().astype(np.int32)
            x = weighted(got.column("n")[k].values.to_numpy(), idf[at])
            return np.append(at, np.int32(1 << BITS)), np.append(x, 1.0), of[got.column("lang")[k].as_py()]

        model = Ftrl((1 << BITS) + 1, len(names))
        own = [k for i, k in enumerate(rows) if i % VALIDATION] or rows
        for _ in range(PASSES):
            for k in own:
                model.learn(*row(k))
        w = model.weights()
        tested = [(x @ w[at], label) for at, x, label in map(row, rows[::VALIDATION])]
        warm = temperature(np.array([z for z, _ in tested]), np.array([y for _, y in tested])) \
            if tested and len(names) > 1 else 1.0
        return pack(w=w[:-1].astype(np.float32), b=w[-1] / warm, idf=idf.astype(np.float32),
                    warm=np.float64(warm), names=names)

    chosen = bounded_sample(rows, "doc_id", sample, "language").select("doc_id", "lang", "text")
    kind = dict(rows.dtypes)["doc_id"]
    return fit_once(map_rows(chosen, counted, f"doc_id {kind}, lang string, grams array<short>, n array<int>"),
                    "doc_id", sample, learn)


def predict(docs: DataFrame, model: bytes, text="text") -> DataFrame:
    """`docs` with lang_pred and score added, one row for each row given; `text` is a string column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: dict = {}

    def made(batch):
        if not held:
            held.update(unpack(shared.value))
        names, known, scores = held["names"].tolist(), [], []
        for t in batch.column(batch.schema.get_field_index(text)):
            total = counts(t.as_py() or "")
            if total is None:
                known.append(UNKNOWN)
                scores.append(0.0)
                continue
            on = np.flatnonzero(total)
            x = total[on] * held["idf"][on].astype(np.float64)
            p = softmax((x @ held["w"][on]) / np.sqrt(x @ x) / held["warm"] + held["b"])
            known.append(names[int(p.argmax())])
            scores.append(float(p.max()))
        own = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        return own | {"lang_pred": pa.array(known, pa.string()), "score": pa.array(scores, pa.float64())}

    clean = docs.drop("lang_pred", "score")
    return map_rows(clean, made, ", ".join(f"`{n}` {t}" for n, t in [*clean.dtypes, ("lang_pred", "string"), ("score", "double")]))


def identify(docs: DataFrame, row_id="doc_id", text="text", lang="lang", sample=SAMPLE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of `docs`.

    Learns from the rows whose crc32(id as text) mod 3 is not 1 and predicts every row from its text
    alone. A NULL text, or one without a letter, gets `und` and score 0. Repeated rows are returned
    as often as they come; a NULL id hashes as the empty text. Other columns are ignored. Where no
    row can be learned from, every row gets `und`.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    learned = rows.where(~held_out(F.col("doc_id"))).where("text rlike '\\\\p{L}'")
    asked = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if not learned.where("lang is not null").take(1):
        return asked.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return predict(asked, fit(learned, sample=sample)).drop("text")
