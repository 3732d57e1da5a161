import random

import numpy as np
import pytest

from heatline.llm import licences as L


def brute(text, notices=L.NOTICES):
    """Notices that some window of the grid contains, without any hashing."""
    words, found = L.WORD.findall(L.lowered(text)), set()
    runs = [tuple(words[i:i + L.SHINGLE]) for i in range(len(words) - L.SHINGLE + 1)]
    for name, notice in notices.items():
        own = L.shingles(L.WORD.findall(notice.lower()))
        stride = L.stride_for(len(own))
        for at in range(0, max(1, len(runs)), stride):
            if len(own & set(runs[at:at + 3 * stride])) >= L.CONTAINMENT * len(own):
                found.add(name)
    return found


@pytest.fixture(scope="module")
def scanner():
    return L.Scanner(L.NOTICES)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = L.scan(docs).join(docs, "doc_id").collect()
    assert len(rows) == 1000 and sum(r.n_matches > 0 for r in rows) > 20
    for r in rows:
        assert set(filter(None, r.licenses.split(","))) == brute(r.text)
        assert all(m.license in L.NOTICES and m.containment >= 0.8 for m in r.matches)


def test_every_notice_anywhere_and_edited(scanner):
    rng = random.Random(4)
    filler = ["alpha", "beta", "gamma", "delta", "license", "the", "software"]
    missed = total = 0
    for name, notice in L.NOTICES.items():
        for _ in range(40):
            words = notice.split()
            if len(words) > 40:
                words[rng.randrange(len(words))] = "changed"
            text = " ".join(rng.choice(filler) for _ in range(rng.randrange(300))) + " " + " ".join(words) + " " + \
                   " ".join(rng.choice(filler) for _ in range(rng.randrange(300)))
            got = {m[0] for m in scanner.scan(text)}
            want = brute(text)
            assert got <= want
            missed += len(want - got)
            total += len(want)
    assert total > 400 and missed <= 0.002 * total


def test_plain_notices_are_always_whole_in_a_window(scanner):
    for name, notice in L.NOTICES.items():
        for ahead in range(0, 40):
            text = " ".join(f"w{i}" for i in range(ahead)) + " " + notice.upper() + " and more words follow here " * 3
            assert name in brute(text)


def test_bands_reach_the_chance():
    part = L.CONTAINMENT / L.SLACK
    assert 1 - (1 - part / (3 + 1 / L.SLACK - part)) ** L.bands_for() >= L.SURE


def test_spans(scanner):
    text = "İé x. RELEASED under\nthe (MIT) License! y"
    (name, start, end, share), = scanner.scan(text)
    assert (name, share) == ("MIT", 1.0) and text[start:end] == "RELEASED under\nthe (MIT) License"


def test_edge_cases(spark):
    notice = L.NOTICES["MIT"]
    rows = [(1, None, 0), (2, "", 0), (3, "Released under the MIT", 0), (None, notice, 0), (4, "x " * 100_000 + notice, 0),
            (5, notice, 0), (5, notice, 0), (6, ("Ab " * 5000 + notice + ". ") * 3, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, matches int")
    got = L.scan(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].n_matches for k in (1, 2, 3, None, 4, 5, 6)] == [0, 0, 0, 1, 1, 1, 3]
    start, end = by[4].matches[0].start, by[4].matches[0].end
    assert (start, end) == (200_000, 200_000 + len(notice))
    assert L.scan(docs.where("false")).count() == 0
    with pytest.raises(ValueError):
        L.scan(docs, {"x": "short"})


def test_hashing_does_not_depend_on_chunks(scanner, monkeypatch):
    rng = np.random.default_rng(0)
    text = " ".join(f"w{i}" for i in rng.integers(0, 9, 3000)) + " " + L.NOTICES["GPL-header"] + " tail" * 50
    want = scanner.scan(text)
    monkeypatch.setattr(L, "CHUNK", 64)
    assert scanner.scan(text) == want and want


def test_usual_licenses_and_their_neighbours(spark):
    gnu = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {} as published " \
          "by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
    texts = {
        "Licensed under the MIT License": "MIT", "This project is licensed under the MIT license.": "MIT",
        "This work is licensed under the GNU General Public License, version 2": "GPL-2.0",
        "This work is licensed under the GNU General Public License, version 3": "GPL-3.0",
        "released under the GNU Lesser General Public License, version 2.1": "LGPL-2.1",
        gnu.format("Affero General Public License", 3): "AGPL-3.0", gnu.format("Lesser General Public License", 3): "LGPL-3.0",
        gnu.format("General Public License", 2): "GPL-2.0", gnu.format("General Public License", 3): "GPL-3.0,GPL-header",
        "made available under the terms of the Eclipse Public License 2.0": "EPL-2.0", "Licensed under CC0 1.0": "CC0-1.0",
        "This is free and unencumbered software released into the public domain.": "Unlicense",
        "Licensed under CC BY-SA 4.0": "CC-BY-SA-4.0", "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
        L.BSD_TWO + L.BSD_WARRANTY: "BSD-2-Clause", L.BSD_TWO + L.BSD_NAMES.format(3) + L.BSD_WARRANTY: "BSD-3-Clause",
        "an ordinary text about the terms of the general public": ""}
    docs = spark.createDataFrame([(k, f"some words ahead {t} and a few words after it") for k, t in enumerate(texts)],
                                 "doc_id long, text string")
    assert {r.doc_id: r.licenses for r in L.scan(docs).collect()} == dict(enumerate(texts.values()))


def test_bodies_are_found_as_themselves():
    scanner = L.Scanner(L.templates())
    for spdx, body in {**L.BODIES, "AGPL-3.0": L.AGPL_TERMS}.items():
        names = {m[0] for m in scanner.scan("ahead " * 50 + body + " after" * 50)}
        assert spdx in {L.family(n) for n in names}, (spdx, names)
    assert not any(m[0] == "GPL-3.0-text" for m in scanner.scan(L.AGPL_TERMS))


def test_short_notices_need_all_their_words():
    scanner = L.Scanner(L.templates())
    for text, want in {"SPDX-License-Identifier: MIT": {"MIT"}, "Licensed under GPL v2 or later": {"GPL-2.0"}, "# spdx license identifier isc": {"ISC"},
                       "Released under the BSD license": {"BSD"}, "code under MIT license": {"MIT"}, "Released under the MIT": set(),
                       "SPDX-License-Identifier:": set(), "under the GPL": set(), "": set(), "MIT": set()}.items():
        assert {m[0] for m in scanner.scan(text)} == want, text
    (name, start, end, share), = scanner.scan("x y. SPDX-License-Identifier: MIT. z")
    assert (start, end, share) == (5, 33, 1.0)


def test_windows_that_are_not_hashed_hold_too_few_shingles():
    """Against all windows of the grid, with every notice there is."""
    scanner, rng = L.Scanner(L.templates()), random.Random(8)
    texts = [t for _, t in L.templates()]
    words = [w for t in rng.sample(texts, 60) for w in t.split()]
    for _ in range(15):
        text = " ".join(" ".join(words[a:a + rng.randrange(3, 40)]) for a in (rng.randrange(len(words)) for _ in range(20)))
        codes = L.shingle_codes(L.lowered_codes(text))
        found = {(notice, at) for notice, at, _ in scanner.candidates(codes)}
        said = L.WORD.findall(L.lowered(text))
        runs = [tuple(said[i:i + L.SHINGLE]) for i in range(len(codes))]
        for stride, (notices, *_) in scanner.strides.items():
            for at in range(0, max(1, len(runs) - 2 * stride), stride):
                window = set(runs[at:at + 3 * stride])
                for notice in notices.tolist():
                    if len(window & scanner.sets[notice]) >= 0.95 * len(scanner.sets[notice]):
                        assert (notice, at) in found
