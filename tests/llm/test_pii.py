import hashlib
import random
import re

import pytest

from heatline.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            hit = m.group(0)
            digits = re.sub("[^0-9]", "", hit)
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in hit.split("."))
                    or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)
                    or kind == "phone" and 8 <= len(digits) <= 15):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == digest(want), (r.doc_id, want, r.spans)
        assert set(want) <= set(r.spans.split(",")) | {""}
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in want) for k in pii.KINDS]


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def selector(documents):
    return pii.fit(documents)


def test_documents(documents, selector):
    check(pii.report(documents, selector=selector).collect(), {r.doc_id: r.text for r in documents.collect()})


def test_random_texts(spark, selector):
    rng = random.Random(5)
    pieces = ["a", "é", "@", ".", "..", "b.c", "-", " ", "  ", "1", "22", "4539148803436467", "4539-1488 0343-6467", "+1",
              "(", ")", "255", "1.2.3.4", "999", "%", "x@y.z", "@y", "+", "😀", "\n", "0001", "+1 (663) 555-6869"]
    texts = {i: "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 30))) for i in range(1500)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(pii.report(docs, selector=selector).collect(), texts)


def test_edge_cases(spark, selector):
    texts = {1: None, 2: "", 3: "1 " * 40_000, 4: "1" * 20_000, 5: "a@b" + ".c" * 50_000, 6: "a" * 20_000, 7: "1.2.3." * 6_000,
             8: "+" + "1 (" * 20_000, 9: "x@y.z " * 2000}
    docs = spark.createDataFrame([(k, v, 7) for k, v in texts.items()], "doc_id long, text string, spans int")
    check(pii.report(docs, selector=selector).collect(), texts)
    twice = spark.createDataFrame([(None, "x@y.z", 1), (None, "x@y.z", 1)], "doc_id long, text string, n_email int")
    assert [r.spans for r in pii.report(twice).collect()] == ["email:0:5"] * 2
    assert pii.report(docs.where("false")).count() == 0


def test_redaction(spark, selector):
    docs = spark.createDataFrame([(1, "é mail x@y.zz or +1 (663) 555-6869.", "k"), (2, None, "k"), (3, "plain 12", "k")],
                                 "doc_id long, text string, _base string")
    got = {r.doc_id: r for r in pii.redact(docs, selector).collect()}
    assert got[1].text == "é mail [EMAIL] or [PHONE]." and got[2].text is None and got[3].text == "plain 12"
    assert got[1]["_base"] == "k"


def test_wide_spans_are_added(spark, selector):
    docs = spark.createDataFrame([(1, "call me at (663) 555-6869 now"), (2, "in 1998 2003 there were 12,345,678,901 of them"),
                                  (3, "on 2024-05-17 at noon, number 5551234")], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.report(docs, selector=selector).collect()}
    assert got[2] == "" and got[3] == ""


def test_no_python_in_the_plan(documents, selector):
    plan = pii.report(documents, selector=selector)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_wide_forms_are_found_and_redacted(spark, selector):
    texts = ["call me at (663) 555-6869 now", "tel 5551234567 ok", "write jane [at] example [dot] com soon",
             "jane at example dot com", "jane (at) example.com", "card 4539.1488.0343.6467 paid", "host 1[.]2[.]3[.]4 up",
             "at 1700000000 it was 4539.1488.0343.6468, look at example.com", "a 1,2,3,4 list of 10.000.000"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id: r.spans for r in pii.report(docs, selector=selector).collect()} == {
        0: "phone:11:25", 1: "phone:4:14", 2: "email:6:33", 3: "email:0:23", 4: "email:0:21", 5: "card:5:24", 6: "ip:5:18",
        7: "", 8: ""}
    assert {r.doc_id: r.text for r in pii.redact(docs, selector).collect()} == {
        0: "call me at [PHONE] now", 1: "tel [PHONE] ok", 2: "write [EMAIL] soon", 3: "[EMAIL]", 4: "[EMAIL]",
        5: "card [CARD] paid", 6: "host [IP] up", 7: texts[7], 8: texts[8]}
