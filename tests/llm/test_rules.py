import math
import re
from collections import Counter

import numpy as np
import pytest

from heatline.llm import rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines, seen, again = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)], set(), 0
    for line in lines:
        again += line in seen
        seen.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), again, len(covered))


TEXTS = ["", "a", "a b c", "a a a a", "a b c a b c d", "x\ny\nx\n \n \nx", "é é é é\x85b |<>", "a\x1cb c\x0bd # $"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_counts(text):
    assert rules.base(text.encode()) == brute(text)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = rules.judge(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = [r.kept for r in rows if labels.get(r.doc_id) == 1 and not r.base_failed]
    junk = [r.kept for r in rows if labels.get(r.doc_id) == 0 and not r.base_failed]
    assert np.mean(kept) > 0.99 and np.mean(junk) < 0.5


def test_distance():
    p = np.array([1.0, 0, 3])
    assert rules.distance(p, 7 * p) < 1e-7 and abs(rules.distance(np.array([1, 0]), np.array([0, 5])) - 1) < 1e-12


def test_edge_cases(spark):
    rows = [(1, None, "en", 1), (2, "", None, 1), (3, "word " * 400_000, "en", 1), (None, "one two", "xx", 1),
            (4, "\n".join(f"a{i} b{i} c" for i in range(40)), None, 1), (4, "\n".join(f"a{i} b{i} c" for i in range(40)), None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    got = rules.judge(docs).collect()
    assert len(got) == 6
    by = {r.doc_id: r for r in got}
    assert by[1].n_words == 0 and by[1].base_failed and by[3].n_repeat_words == 400_000
    assert not by[4].base_failed
    assert rules.judge(docs.where("false")).count() == 0


def test_every_language_has_its_own_reference(spark):
    rng = np.random.default_rng(3)

    def text(k, n):
        own = [chr(97 + k % 26) * 2 + chr(97 + k // 26) * 3 + c * 4 for c in "abcdefghij"]
        return " ".join(rng.choice(own, n).tolist())

    rows = [(k, text(k, 60 if k == 299 else 120), f"l{k}") for k in range(300)] + [(300, text(7, 120), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in rules.judge(docs).collect()}
    assert len(got) == 301 and rules.references(docs).count() == 300
    assert got[299].word_distance < 1e-6 and got[299].class_distance < 1e-6
    assert got[7].word_distance < 1e-6 and got[300].word_distance < 0.5
    assert set(rules.references(docs).where("lang = 'l299'").first().words) == set(rows[299][1].split())


def slow_distance(p, q):
    """Jensen-Shannon distance of two Counters, base 2."""
    a, b = sum(p.values()), sum(q.values())
    total = 0.0
    for k in {*p, *q}:
        x, y = p.get(k, 0) / a, q.get(k, 0) / b
        m = (x + y) / 2
        total += sum(v * math.log2(v / m) for v in (x, y) if v > 0) / 2
    return math.sqrt(max(0.0, total))


def test_distances_and_verdicts_equal_brute_force(spark, tables):
    """References, histograms and limits from plain Counters over the whole table."""
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = docs.collect()
    classes, words = {}, {}
    histogram = lambda text: Counter({k: n for k, n in enumerate(rules.class_counts(text).tolist()) if n})
    for r in rows:
        classes.setdefault(r.lang, Counter()).update(histogram(r.text))
        words.setdefault(r.lang, Counter()).update(rules.letter_words(r.text))

    def shortened(counts, common):
        out = Counter({w: counts[w] for w in common if counts[w]})
        out[None] = sum(counts.values()) - sum(out.values())
        return out

    common = {lang: [w for w, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:rules.COMMON]] for lang, c in words.items()}
    judged = {r.doc_id: r for r in rules.judge(docs).collect()}
    for r in rows:
        got, own, said = judged[r.doc_id], histogram(r.text), Counter(rules.letter_words(r.text))
        by_class = slow_distance(own, classes[r.lang]) if sum(own.values()) >= rules.LEAST_CHARS else 0.0
        n = sum(said.values())
        by_word = slow_distance(shortened(said, common[r.lang]), shortened(words[r.lang], common[r.lang])) if n >= rules.LEAST_LETTER_WORDS else 0.0
        assert abs(got.class_distance - by_class) < 1e-6 and abs(got.word_distance - by_word) < 1e-6
        fits = (not by_class or by_class <= rules.CLASS_LIMIT[0] + rules.CLASS_LIMIT[1] / math.sqrt(sum(own.values()))) and (
            not by_word or by_word <= rules.WORD_LIMIT[0] + rules.WORD_LIMIT[1] / math.sqrt(n))
        failed = got.n_words < 50 or 100 * got.n_repeat_words > 50 * got.n_words
        assert (got.base_failed, got.kept) == (failed, not failed and fits)


def test_too_many_languages_for_texts_without_one(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "a b", "y"), (3, "c d", None)], "doc_id long, text string, lang string")
    assert rules.judge(docs).count() == 3
    monkeypatch.setattr(rules, "MOST_LANGUAGES", 1)
    assert rules.judge(docs.where("lang is not null")).count() == 2
    with pytest.raises(ValueError):
        rules.judge(docs)
