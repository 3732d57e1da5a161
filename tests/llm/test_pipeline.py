import re
from collections import Counter

import pytest
from test_mixing import brute_exponent
from test_pii import brute as brute_spans
from test_pieces import score, whole
from test_simhash import brute_components, brute_fingerprint

import __spark_entry__ as entry
import corpus_pipeline
from heatline.llm import langid, mixing, pieces


@pytest.fixture(scope="module")
def folder():
    return "/root/testdata/sf0.001"


def redacted(text):
    out, at = [], 0
    merged = []
    for kind, lo, hi in sorted(((k, int(a), int(b)) for k, a, b in (s.split(":") for s in brute_spans(text))),
                               key=lambda s: (s[1], -s[2])):
        if merged and lo < merged[-1][2]:
            merged[-1] = (merged[-1][0], merged[-1][1], max(hi, merged[-1][2]))
        else:
            merged.append((kind, lo, hi))
    for kind, lo, hi in merged:
        out += [text[at:lo], f"[{kind.upper()}]"]
        at = hi
    return "".join([*out, text[at:]])


def test_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = entry.queries()["pipeline"](spark, folder).collect()
    judged = {r.doc_id: r for r in langid.identify(docs).collect()}
    rows = {r.doc_id: r for r in docs.collect() if judged[r.doc_id].lang_pred != "und" and judged[r.doc_id].score >= 0.5}
    component = brute_components({i: brute_fingerprint(r.text) for i, r in rows.items()})
    rows = {i: r for i, r in rows.items() if component[i] == i}
    texts = {i: redacted(r.text) for i, r in rows.items()}
    assert {r.doc_id: r.text for r in got} == texts
    assert all(r.n_chars == len(r.text) and r.source == rows[r.doc_id].source for r in got)
    tokens = Counter()
    for i, t in texts.items():
        tokens[rows[i].source] += max(1, len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    alpha = brute_exponent(tokens, mixing.ENTROPY, mixing.MOST_EPOCHS)
    copies = Counter(r.doc_id for r in got)
    for i, n in copies.items():
        uses = (max(tokens.values()) / tokens[rows[i].source]) ** (1 - alpha)
        assert int(uses) <= n <= int(uses) + 1
    codec = pieces.Codec(pieces.load())
    for r in got:
        assert codec.decode(r.token_ids) == r.text and r.n_tokens == len(r.token_ids)
    for r in got[:20]:
        want = whole(codec, " " + r.text[:400])[1]
        assert abs(score(codec, codec.encode(r.text[:400])) - score(codec, want)) < 1e-6


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(60)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).columns[:len(docs.columns)] == docs.columns


def test_edge_cases(spark, folder):
    schema = "doc_id long, text string, lang string, source string, n_chars long, token_ids string, score double"
    body = "The quick brown fox jumps over the lazy dog near the river bank today. "
    rows = [(1, body, "en", "a", 1, "x", 0.0), (1, body, "en", "a", 1, "x", 0.0), (2, body, "en", "a", 1, "x", 0.0), (None, body, "en", None, 1, "x", 0.0),
            (3, None, "en", "a", 1, "x", 0.0), (4, "", None, "a", 1, "x", 0.0), (5, "12 34", "en", "b", 1, None, None),
            (6, "mail x@y.zz now " + "plain words here " * 20_000, None, "b", None, "x", 0.0)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert stage(spark, docs.where("false"), folder).count() == 0
    got = docs.collect()
    assert {r.doc_id for r in got} == {1, 6, None} and all(r.round_trip for r in got)
    assert {r.score for r in got} == {0.0}
    assert "[EMAIL]" in next(r.text for r in got if r.doc_id == 6)


def test_ids_on_several_texts_and_columns_of_any_type(spark, folder):
    """Rows that share an id lose nothing but their own copies; no stage needs n_chars or a type that can be hashed."""
    one, two = "The quick brown fox jumps over the lazy dog near the river bank today. ", "A slow green turtle walks under some old bridge by night. "
    rows = [(5, one * 3, "en", "a", {"k": 1}), (5, two * 3, "en", "a", {"k": 2}), (2, one * 3, "en", "a", {"k": 3}), (9, two * 3, "en", "a", {"k": 4})]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, extra map<string,int>")
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == [(2, one * 3), (5, two * 3)]
