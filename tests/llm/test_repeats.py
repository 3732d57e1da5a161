import hashlib
import random

import numpy as np
import pytest

from heatline.llm import repeats
from heatline.llm.queries import QUERIES


def brute(rows, span=50):
    """rows: [(id, text)]; per row the covered runs, by the definition."""
    first = {}
    bodies = [(i, (t or "").encode()) for i, t in rows]
    for i, b in bodies:
        if i is not None:
            for j in range(len(b) - span + 1):
                w = b[j:j + span]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, b in bodies:
        covered = np.zeros(len(b) + 1, bool)
        if i is not None:
            for j in range(len(b) - span + 1):
                if first[b[j:j + span]] < i:
                    covered[j:j + span] = True
        edge = np.flatnonzero(np.diff(np.concatenate(([False], covered))))
        spans = list(zip(edge[::2].tolist(), edge[1::2].tolist()))
        kept = bytes(x for k, x in enumerate(b) if not covered[k])
        out.append((i, len(b), spans, kept))
    return out


def plain(rows):
    return sorted(((r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in rows), key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, kept string")
    assert plain(repeats.remove_repeats(docs).collect()) == sorted(brute(rows), key=str)


def test_documents(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = brute(rows)
    assert plain(repeats.remove_repeats(spark.read.parquet(f"{folder}/documents.parquet")).collect()) == sorted(want, key=str)
    got = {r.doc_id: r for r in QUERIES["op2_repeats"](spark, folder).collect()}
    for i, n, spans, kept in want:
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (n, sum(b - a for a, b in spans), len(spans))
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("seed", range(4))
def test_random_texts_in_many_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1500)
    monkeypatch.setattr(repeats, "BUCKET_ANCHORS", 40)
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefgé"
    passages = ["".join(rng.choice(letters) for _ in range(rng.randrange(30, 200))) for _ in range(12)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(passages)[rng.randrange(20):] if rng.random() < 0.4 else
                       "".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(rng.randrange(6)))
        rows.append((rng.randrange(200) - 50, text))
    check(spark, rows)


def test_small_chunks(spark, monkeypatch):
    rng = random.Random(9)
    part = "".join(rng.choice("abcdef ") for _ in range(3000))
    rows = [(1, part), (2, "x" * 700 + part[500:2500] + "y" * 300), (3, part[::-1] + part[100:149] + "z" + part[100:150])]
    want = brute(rows)
    monkeypatch.setattr(repeats, "CHUNK", 256)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert plain(repeats.remove_repeats(docs).collect()) == sorted(want, key=str)


def test_cells_hold_every_window_once():
    rng = np.random.default_rng(0)
    texts = repeats.Texts([rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (49, 50, 51, 400, 0, 90)])
    heads, tails, _ = texts.cells()
    want = [j for lo, hi in zip(texts.starts[:-1], texts.starts[1:]) for j in range(lo, hi - 49)]
    assert repeats.spread(heads, tails).tolist() == want
    assert (tails - heads < repeats.REACH).all()
    codes, windows = texts.codes(np.array(want)), [texts.data[j:j + 50].tobytes() for j in want]
    assert len(set(codes.tolist())) == len(set(windows))


def test_edge_cases(spark):
    same = "The same sentence of more than fifty bytes, again and again. " * 3
    check(spark, [(1, None), (2, ""), (3, same[:49]), (4, same[:50]), (5, same[:50]), (5, same[:50]), (None, same), (None, same),
                  (6, "ü" * 60), (7, "x" + "ü" * 60), (8, "a" * 3000), (9, "a" * 200 + "b"), (10, same), (-1, same[1:])])
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.remove_repeats(docs).count() == 0
    check(spark, [(1, "short"), (2, "short")])
