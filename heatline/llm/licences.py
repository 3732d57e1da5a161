"""License notices in texts: MinHash bands over overlapping windows, verified by shingle containment."""

import re
import sys
from collections import Counter
from functools import lru_cache
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heatline.llm.common import map_rows
from heatline.llm.licence_bodies import BODIES
from heatline.llm.ngrams import FACTORS, code_points, word_codes

SHINGLE = 5
LEAST_WORDS = 2
CONTAINMENT = 0.8
SURE = 0.999
SLACK = 1.1
CHUNK = 1 << 15
SEED = 99
WORD = re.compile(r"[^\W_]+")

# Public license notices, by identifier.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License."),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "GPL-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."),
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."),
}

GNU_HEADER = (
    "This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {name} as "
    "published by the Free Software Foundation; either version {version} of the License, or (at your option) any later version.")
AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
MIT_GRANT = NOTICES["MIT-text"].split(", subject to")[0]
MIT_NOTICE = ("The above copyright notice and this permission notice shall be included in all copies or substantial portions "
              "of the Software.")
ISC_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
    "OF THIS SOFTWARE.")
BSD_TWO = NOTICES["BSD-3-Clause"] + (
    " 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
BSD_ADVERTISING = (
    "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the organization. ")
BSD_NAMES = (
    "{}. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. ")
BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
# The Affero license is the GNU license under its name with another section 13.
AGPL_13 = (
    "13. Remote Network Interaction; Use with the GNU General Public License. Notwithstanding any other provision of this "
    "License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely "
    "through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding "
    "Source of your version by providing access to the Corresponding Source from a network server at no charge, through some "
    "standard or customary means of facilitating copying of software.\n14. ")
AGPL_TERMS = re.sub(r"\n13\. .*?\n14\. ", lambda _: "\n" + AGPL_13, BODIES["GPL-3.0"].split("TERMS AND CONDITIONS", 1)[1].split(
    "END OF TERMS AND CONDITIONS")[0], flags=re.S).replace("GNU General Public License", "GNU Affero General Public License")

# Headers and short bodies, by SPDX identifier.
HEADERS = {
    "GPL-1.0": [GNU_HEADER.format(what="program", name="General Public License", version="1")],
    "GPL-2.0": [GNU_HEADER.format(what="program", name="General Public License", version="2"),
                "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
                "Public License version 2 as published by the Free Software Foundation."],
    "GPL-3.0": [GNU_HEADER.format(what="program", name="General Public License", version="3")],
    "LGPL-2.0": [GNU_HEADER.format(what="library", name="Library General Public License", version="2")],
    "LGPL-2.1": [GNU_HEADER.format(what=w, name="Lesser General Public License", version="2.1") for w in ("library", "program")],
    "LGPL-3.0": [GNU_HEADER.format(what=w, name="Lesser General Public License", version="3") for w in ("library", "program")],
    "AGPL-3.0": [GNU_HEADER.format(what="program", name="Affero General Public License", version="3"), AGPL_TERMS],
    "MIT": [f"{MIT_GRANT}, subject to the following conditions: {MIT_NOTICE} {AS_IS}"],
    "MIT-0": [f"{MIT_GRANT}. {AS_IS}"],
    "ISC": [f"{NOTICES['ISC']} {ISC_WARRANTY}"],
    "0BSD": [f"{NOTICES['ISC'].split(', provided')[0]}. {ISC_WARRANTY}"],
    "BSD-2-Clause": [BSD_TWO + BSD_WARRANTY],
    "BSD-3-Clause": [BSD_TWO + BSD_NAMES.format(3) + BSD_WARRANTY],
    "BSD-4-Clause": [BSD_TWO + BSD_ADVERTISING + BSD_NAMES.format(4) + BSD_WARRANTY],
    "EPL-1.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"],
    "EPL-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License "
                "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
                "this work."],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors "
        "of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication "
        "for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to "
        "be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. "
        + AS_IS.replace(" OR COPYRIGHT HOLDERS", "").replace("COPYRIGHT HOLDERS ", "")],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being "
        "the original software. 3. This notice may not be removed or altered from any source distribution."],
    "BSL-1.0": [
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, '
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following:"],
}
CC_PARTS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
            "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
            "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
# How a license is named in one line, by SPDX identifier.
NAMED = {
    **{f"{short}-{spdx}": [f"the GNU {name}{v}{number}" for v in (", version ", " v", " ")] + [f"{short} {number}", f"the {short} v{number}", f"{short} v{number}", f"{short}v{number}"]
       for short, name, numbers in (("GPL", "General Public License", ("1.0", "2.0", "3.0")),
                                    ("LGPL", "Library General Public License", ("2.0",)),
                                    ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
                                    ("AGPL", "Affero General Public License", ("3.0",)),
                                    ("GFDL", "Free Documentation License", ("1.2", "1.3")))
       for spdx in numbers for number in [spdx.removesuffix(".0")]},
    **{f"CC-{part}-{v}": [f"CC {part} {v}", f"a Creative Commons {words} {v} {place} License", f"the Creative Commons {words} {v}",
                          f"Creative Commons {words} {v}"]
       for part, words in CC_PARTS.items() for v, place in (("4.0", "International"), ("3.0", "Unported"))},
    "Apache-2.0": ["the Apache License, Version 2.0", "the Apache License 2.0", "the Apache 2.0 License", "Apache License 2.0",
                   "the Apache License v2.0"],
    "MIT": ["the MIT License", "an MIT License", "the MIT/X11 License", "MIT License"], "ISC": ["the ISC License"], "Zlib": ["the zlib License"],
    "Unlicense": ["the Unlicense license"], "0BSD": ["the Zero-Clause BSD License", "the 0BSD License"],
    "BSD-2-Clause": ["the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"],
    "BSD-3-Clause": ["the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License"],
    "MPL-1.1": ["the Mozilla Public License, Version 1.1", "the Mozilla Public License 1.1"],
    "MPL-2.0": ["the Mozilla Public License, Version 2.0", "the Mozilla Public License 2.0", "the Mozilla Public License, v. 2.0"],
    **{f"EPL-{v}": [f"the Eclipse Public License{n}{v}" for n in (", version ", " v", " ")] for v in ("1.0", "2.0")},
    "CC0-1.0": ["CC0 1.0", "the CC0 1.0 Universal", "the Creative Commons Zero v1.0 Universal license"],
    "BSL-1.0": ["the Boost Software License, Version 1.0", "the Boost Software License 1.0"],
    "Artistic-2.0": ["the Artistic License 2.0", "the Artistic License, Version 2.0"],
    "EUPL-1.2": ["the European Union Public Licence v1.2", "the European Union Public Licence, version 1.2", "the EUPL 1.2"],
    "CDDL-1.0": ["the Common Development and Distribution License, Version 1.0", "the Common Development and Distribution License 1.0"],
    "OFL-1.1": ["the SIL Open Font License, Version 1.1", "the SIL Open Font License 1.1"],
    "ODbL-1.0": ["the Open Database License v1.0", "the Open Data Commons Open Database License"],
    "SSPL-1.0": ["the Server Side Public License, version 1"],
    "BSD": ["the BSD License", "a BSD License", "BSD License"],
}
VERBS = ("licensed", "released", "distributed", "available", "published", "provided")


def lines(name: str) -> list[str]:
    """Common one-line notices: as few words as name the license and make a shingle."""
    short = [f"under {name}", f"terms of {name}"]
    forms = [f for f in short if len(WORD.findall(f)) >= SHINGLE]
    forms += [f for f in (f"{verb} under {name}" for verb in VERBS) if len(forms) < 2 and len(WORD.findall(f)) >= SHINGLE]
    brief = [f for f in (short[0],) if 3 <= len(WORD.findall(f)) < SHINGLE]
    return [*forms, *brief, f"This work is licensed under {name}"]


def templates() -> list[tuple[str, str]]:
    """(identifier, text) of every notice that `scan` looks for: the first twelve, headers, bodies, lines."""
    out = list(NOTICES.items())
    out += [(spdx, text) for spdx, texts in HEADERS.items() for text in texts]
    out += [(f"{spdx}-text", body) for spdx, body in BODIES.items()]
    for spdx, names in NAMED.items():
        tags = [f"SPDX-License-Identifier: {spdx}"]
        out += [(spdx, line) for line in [*[x for n in names for x in lines(n)], *tags]]
    return list(dict.fromkeys(out))


def family(name: str) -> str:
    """The license of a notice: its identifier without the part that is held."""
    return "GPL-3.0" if name == "GPL-header" else re.sub("-(header|text)$", "", name)


@lru_cache(maxsize=1)
def word_points() -> np.ndarray:
    """Per code point: itself where it belongs to a word, else a space."""
    points = np.full(sys.maxunicode + 1, 32, np.uint32)
    own = np.fromiter((chr(i).isalnum() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    points[own] = np.flatnonzero(own)
    return points


def lowered(text: str) -> str:
    """Lower case, letter by letter, so that positions stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def lowered_codes(text: str) -> np.ndarray:
    """32-bit code of each word, letters lowered."""
    return word_codes(word_points()[code_points(lowered(text))])


def shingle_codes(codes: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """32-bit code of each run of `size` words, from the codes of the words."""
    n = len(codes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    total = np.zeros(n, np.uint32)
    for k in range(size):
        total = (total + codes[k:k + n]) * FACTORS[k]
        total ^= total >> np.uint32(15)
    return total


def stride_for(shingles: int) -> int:
    """Blocks of so many shingles; a window is three blocks and moves by one, so that a run of up to
    two blocks, with some words put in between, lies whole in a window."""
    stride = 1
    while 2 * stride < SLACK * shingles and shingles > 1:
        stride *= 2
    return stride


def bands_for(containment: float = CONTAINMENT, sure: float = SURE) -> int:
    """Bands of one hash each so that a window that holds a notice meets it with probability `sure`.

    The least likely case is a window of 3 * stride shingles, none of them repeated, that holds the
    demanded part of a notice just too long for the next smaller stride.
    """
    part = containment / SLACK
    similarity = part / (3 + (1 / SLACK - part))
    return ceil(log(1 - sure) / log(1 - similarity))


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    """Runs of five words; all words where there are fewer, so that containment of 0.8 means all of them."""
    size = min(SHINGLE, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


class Marks:
    """Whether a code is one of a fixed set: a bitmap first, then a binary search."""

    def __init__(self, codes: np.ndarray):
        self.codes = np.unique(codes)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[self.codes >> np.uint32(10)] = True

    def places(self, codes: np.ndarray) -> np.ndarray:
        near = np.flatnonzero(self.bits[codes >> np.uint32(10)])
        at = np.searchsorted(self.codes, codes[near])
        return near[self.codes[np.minimum(at, len(self.codes) - 1)] == codes[near]] if len(near) else near


class Scanner:
    """The notices' MinHash bands by stride, and their shingles."""

    def __init__(self, notices: dict[str, str] | list[tuple[str, str]], containment: float = CONTAINMENT, sure: float = SURE):
        self.containment = containment
        rng = np.random.default_rng(SEED)
        self.bands = bands_for(containment, sure)
        self.factor = rng.integers(1, 1 << 31, (self.bands, 1), dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.shift = rng.integers(0, 1 << 32, (self.bands, 1), dtype=np.uint32)
        self.names, self.sets = [], []
        by_stride: dict[int, list[int]] = {}
        by_size: dict[int, list[int]] = {}
        codes = []
        for name, text in sorted(notices.items() if isinstance(notices, dict) else notices):
            words = WORD.findall(lowered(text))
            own = shingles(words)
            if len(words) < LEAST_WORDS:
                raise ValueError(f"notice {name} has fewer than {LEAST_WORDS} words")
            if len(words) < SHINGLE:
                by_size.setdefault(len(words), []).append(len(self.names))
            else:
                by_stride.setdefault(stride_for(len(own)), []).append(len(self.names))
            self.names.append(name)
            self.sets.append(own)
            codes.append(shingle_codes(lowered_codes(text), min(SHINGLE, len(words))))
        self.strides = {}
        for stride, k in sorted(by_stride.items()):
            bands = np.array([self.hashed(codes[i]).min(axis=1) for i in k]).T
            # By band and half of its hash: whether a notice has it. Few windows are left to compare.
            known, each = np.zeros((2, self.bands, 1 << 16), bool), np.arange(self.bands)[:, None]
            known[0, each, bands >> np.uint32(16)] = True
            known[1, each, bands & np.uint32(0xFFFF)] = True
            fewest = min(ceil(containment * len(self.sets[i]) - 1e-9) for i in k)
            self.strides[stride] = np.array(k), bands, known, Marks(np.concatenate([codes[i] for i in k])), fewest
        self.marks = Marks(np.concatenate([codes[i] for k in by_stride.values() for i in k])) if by_stride else None
        # A notice of one shingle is its own and only window.
        self.short = {size: (Marks(np.concatenate([codes[i] for i in k])), k) for size, k in sorted(by_size.items())}

    def hashed(self, codes: np.ndarray) -> np.ndarray:
        """A row of permuted codes per band."""
        x = codes[None, :] * self.factor + self.shift
        return x ^ (x >> np.uint32(16))

    def minima(self, codes: np.ndarray, blocks: np.ndarray, stride: int) -> np.ndarray:
        """Least permuted codes per band of the given blocks of `stride` shingles; the last may be short."""
        out = np.empty((self.bands, len(blocks)), np.uint32)
        step = max(1, CHUNK // stride)
        for lo in range(0, len(blocks), step):
            at = np.minimum(blocks[lo:lo + step, None] * stride + np.arange(stride), len(codes) - 1)
            # Beyond the end the last shingle repeats, which is in that block already.
            out[:, lo:lo + step] = self.hashed(codes[at.ravel()]).reshape(self.bands, -1, stride).min(axis=2)
        return out

    def candidates(self, codes: np.ndarray):
        """(notice, first shingle, end) of windows that agree with a notice in a band.

        Only windows with as many shingles of the stride's notices as the smallest of them demands are
        hashed: no other can hold the demanded part of any.
        """
        if self.marks is None or not len(codes):
            return
        marked = self.marks.places(codes)
        if not len(marked):
            return
        for stride, (notices, bands, known, own, fewest) in self.strides.items():
            places = marked[own.places(codes[marked])]
            if len(places) < fewest:
                continue
            n = -(-len(codes) // stride)
            blocks, held = np.unique(places // stride, return_counts=True)
            windows = np.unique(np.clip(np.concatenate([blocks, blocks - 1, blocks - 2]), 0, max(0, n - 3)))
            total = np.concatenate(([0], np.cumsum(held)))
            inside = total[np.searchsorted(blocks, windows + 3)] - total[np.searchsorted(blocks, windows)]
            windows = windows[inside >= fewest]
            if not len(windows):
                continue
            parts = np.minimum(windows[:, None] + np.arange(3), n - 1)
            wanted, back = np.unique(parts, return_inverse=True)
            hashes = self.minima(codes, wanted, stride)[:, back.reshape(parts.shape)].min(axis=2)
            each = np.arange(self.bands)[:, None]
            both = known[0, each, hashes >> np.uint32(16)] & known[1, each, hashes & np.uint32(0xFFFF)]
            for w in np.flatnonzero(both.any(axis=0)).tolist():
                at = int(windows[w]) * stride
                for notice in notices[(bands == hashes[:, w:w + 1]).any(axis=0)].tolist():
                    yield notice, at, min(len(codes), at + 3 * stride)

    def short_candidates(self, codes: np.ndarray):
        """(notice, place, place + 1) of runs of words that have the code of a notice of fewer than five."""
        for size, (marks, notices) in self.short.items():
            for place in marks.places(shingle_codes(codes, size)).tolist():
                for notice in notices:
                    yield notice, place, place + 1

    def scan(self, text: str) -> list[tuple[str, int, int, float]]:
        """(notice, start, end, containment), in code points; matches of a notice that touch are one.

        A span reaches from the first to the last shingle of the window that the notice has too.
        """
        codes = lowered_codes(text)
        found = sorted({*self.candidates(shingle_codes(codes)), *self.short_candidates(codes)})
        if not found:
            return []
        matches = list(WORD.finditer(lowered(text)))
        words = [m.group(0) for m in matches]
        held: list[tuple] = []
        for notice, lo, hi in found:
            own = self.sets[notice]
            size = len(next(iter(own)))
            here = [i for i in range(lo, hi) if tuple(words[i:i + size]) in own]
            n = len({tuple(words[i:i + size]) for i in here})
            if n / len(own) >= self.containment:
                held.append((self.names[notice], here, n, n / len(own), size))
        out: list[list] = []
        for name, here, _, share, size in sorted(self.best(held), key=lambda h: (h[0], h[1][0])):
            start, end = matches[here[0]].start(), matches[here[-1] + size - 1].end()
            if out and out[-1][0] == name and start <= out[-1][2]:
                out[-1][2], out[-1][3] = max(out[-1][2], end), max(out[-1][3], share)
            else:
                out.append([name, start, end, share])
        return [tuple(x) for x in out]

    def best(self, held: list[tuple]) -> list[tuple]:
        """Matches (name, shingles' places, distinct shingles, share, words a shingle) without those that another license's
        notice explains better: one that has the demanded part of the same places, and more in all."""
        at: dict[int, list[int]] = {}
        if len({family(h[0]) for h in held}) > 1:
            for k, h in enumerate(held):
                for place in h[1]:
                    at.setdefault(place, []).append(k)
        out = []
        for h in held:
            shared = Counter(k for place in h[1] for k in at.get(place, ()))
            if not any(n >= self.containment * len(h[1]) and held[k][2:4] > h[2:4] and family(held[k][0]) != family(h[0])
                       for k, n in shared.items()):
                out.append(h)
        return out


def scan(docs: DataFrame, notices: dict[str, str] | None = None, row_id="doc_id", text="text", containment=CONTAINMENT,
         sure=SURE) -> DataFrame:
    """(doc_id, n_matches, licenses, matches) per row of `docs`.

    `matches` lists (license, start, end, containment), `licenses` the distinct names joined by commas.
    `notices` are a fixed list of texts of two words or more that goes to every task; those of
    `templates` unless given. One of fewer than five words is found where all its words stand in a row. Where notices of two licenses hold the same words, the one that has more of
    them is reported. A notice is
    found where a window holds at least `containment` of its five-word shingles; such a window is
    retrieved with probability `sure` or more, and whatever is retrieved is verified on the words.
    A NULL text, or one without a word, has no match. Repeated rows are returned as often as
    they come, ids may be NULL, other columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(row_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    known = notices or templates()
    Scanner(known, containment, sure)  # a bad list fails here, not in the tasks
    held: list[Scanner] = []
    item = pa.struct([("license", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("containment", pa.float64())])

    def made(batch):
        if not held:
            held.append(Scanner(known, containment, sure))
        found = [held[0].scan(t.as_py() or "") for t in batch.column(1)]
        return {"doc_id": batch.column(0), "n_matches": pa.array([len(f) for f in found], pa.int64()),
                "licenses": pa.array([",".join(sorted({m[0] for m in f})) for f in found], pa.string()),
                "matches": pa.array([[dict(zip(("license", "start", "end", "containment"), m)) for m in f] for f in found],
                                    pa.list_(item))}

    return map_rows(rows, made, f"doc_id {dict(rows.dtypes)['doc_id']}, n_matches long, licenses string, "
                                "matches array<struct<license:string,start:int,end:int,containment:double>>")
