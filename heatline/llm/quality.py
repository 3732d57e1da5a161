"""Quality of a text: averaged hashed word and subword vectors with a softmax, trained by SGD."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import bounded_sample, fit_once, held_out, map_rows, pack, unpack
from heatline.llm.ngrams import bucket, chunks, code_points, grams, word_codes

BITS = 16
ORDERS = (3, 4)
WIDTH = 8
SAMPLE = 6000
PASSES = 4
RATE = 0.4
SEED = 7
CLASSES = 2


def features(text: str) -> np.ndarray:
    """Bucket of every word, pair of neighbouring words and character n-gram, repeats included.

    Words and pairs share one half of the buckets. A pair's code is the exclusive or of its words, so
    all immediate repetitions share one bucket. N-grams of very long texts are hashed in parts.
    """
    points = np.concatenate(([32], code_points(text), [32])).astype(np.uint32)
    words = word_codes(points)
    found = [bucket(words, BITS - 1), bucket(words[1:] ^ words[:-1], BITS - 1)]
    for n in ORDERS:
        found += [grams(part, n, BITS - 1) + np.uint32(1 << (BITS - 1)) for part in chunks(points, n - 1)]
    return np.concatenate(found)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def learn(texts: list[tuple[np.ndarray, np.ndarray]], labels: list[int]) -> bytes:
    """Bucket vectors and output weights; what is kept is their product, one row per bucket.

    A text is given as its buckets and how often it has each.
    """
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH))
    out, bias = np.zeros((WIDTH, CLASSES)), np.zeros(CLASSES)
    data = []
    for (at, n), label in zip(texts, labels):
        if len(at):
            data.append((at, n / n.sum(), label))
    steps = max(1, PASSES * len(data))
    for step in range(steps):
        at, share, label = data[step % len(data)] if data else (None, None, None)
        if at is None:
            break
        rate = RATE * (1 - step / steps)
        rows = vectors[at]
        mean = share @ rows
        p = softmax(mean @ out + bias)
        p[label] -= 1
        back = out @ p
        out -= rate * np.outer(mean, p)
        bias -= rate * p * 0.1
        # The mean passes its gradient on in proportion to each bucket's share; as usual for averaged
        # vectors every occurrence gets it in full, scaled by the text's number of buckets.
        vectors[at] = rows - (rate * np.minimum(1.0, share * len(share)))[:, None] * back
    return pack(table=(vectors @ out).astype(np.float32), bias=bias)


def fit(docs: DataFrame, labels: DataFrame, row_id="doc_id", text="text", label="quality",
        sample=SAMPLE) -> bytes | None:
    """A model from at most `sample` labelled rows, chosen by a hash of the id; None without any.

    Texts are hashed where they are; the one task that learns gets no more than the buckets of each.
    What is broadcast are the chosen ids and labels, `sample` rows at most.
    """
    marked = labels.select(F.col(row_id).alias("doc_id"), F.col(label).cast("int").alias("label")).where(
        "label in (0, 1)")
    chosen = F.broadcast(bounded_sample(marked, "doc_id", sample, "quality").limit(sample))
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text")).where(
        "text is not null").join(chosen, "doc_id")
    if not rows.take(1):
        return None

    def counted(batch):
        found = [np.unique(features(t.as_py()), return_counts=True) for t in batch.column(1)]
        return {"doc_id": batch.column(0), "label": batch.column(2),
                "buckets": pa.array([at.astype(np.int32) for at, _ in found], pa.list_(pa.int32())),
                "n": pa.array([n.astype(np.int32) for _, n in found], pa.list_(pa.int32()))}

    def run(got: pa.Table) -> bytes:
        texts = [(at.values.to_numpy(), n.values.to_numpy()) for at, n in zip(got.column("buckets"), got.column("n"))]
        return learn(texts, got.column("label").to_pylist())

    kind = dict(rows.dtypes)["doc_id"]
    return fit_once(map_rows(rows.select("doc_id", "text", "label"), counted,
                             f"doc_id {kind}, label int, buckets array<int>, n array<int>"), "doc_id", sample, run)


def score(model: dict, text: str) -> float:
    at = features(text)
    mean = model["table"][at].mean(axis=0, dtype=np.float64) if len(at) else np.zeros(CLASSES)
    return float(softmax(mean + model["bias"])[1])


def classify(docs: DataFrame, labels: DataFrame, row_id="doc_id", text="text", label="quality",
             sample=SAMPLE) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of `docs`.

    Learns from labelled rows whose crc32(id as text) mod 3 is not 1 and scores every row from its
    text alone. A NULL text counts as empty; an empty text still gets a score, from its few n-grams
    and the learned bias. Ties at 0.5 predict 1. Labels other than 0 and 1 are ignored; an id that
    has several labels teaches each of them. Repeated rows are returned as often as they come, other
    columns are ignored. Without a label to learn from every score is 0.5.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    taught = labels.where(~held_out(F.col(row_id)))
    model = fit(rows, taught.select(F.col(row_id).alias("doc_id"), label), label=label, sample=sample)
    asked = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    if model is None:
        return asked.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    held: dict = {}

    def made(batch):
        if not held:
            held.update(unpack(shared.value))
        scores = np.array([score(held, t.as_py() or "") for t in batch.column(2)])
        return {"doc_id": batch.column(0), "held_out": batch.column(1), "score": pa.array(scores, pa.float64()),
                "predicted": pa.array((scores >= 0.5).astype(np.int32), pa.int32())}

    return map_rows(asked, made, f"doc_id {dict(asked.dtypes)['doc_id']}, held_out boolean, score double, predicted int")
