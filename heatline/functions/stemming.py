"""Porter stems of a vocabulary.

The rules are those of the published algorithm (M. F. Porter, 1980) with the usual later extensions.
"""

import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words whose stem no rule gives.
IRREGULAR = {
    "skies": "sky", "sky": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
    "innings": "inning", "inning": "inning", "outings": "outing", "outing": "outing",
    "cannings": "canning", "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}

# Suffixes replaced where the rest has at least one vowel-consonant pair.
DERIVATIONAL = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"), ("logi", "log"),
)
ADJECTIVAL = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""),
    ("ness", ""),
)

# Suffixes deleted where the rest has at least two such pairs.
RESIDUAL = tuple((suffix, "") for suffix in (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
))
PAIR = re.compile(r"\*+#+")


def shape_of(word: str) -> str:
    """One mark per letter: `*` vowel, `#` consonant."""
    marks = ""
    for letter in word:
        vowel = letter in "aeiou" or (letter == "y" and marks.endswith("#"))
        marks += "*" if vowel else "#"
    return marks


def pairs(part: str) -> int:
    """Number of vowel-consonant pairs in a word's beginning."""
    return len(PAIR.findall(shape_of(part)))


def _short(word: str) -> bool:
    """Ends consonant-vowel-consonant (last not w, x, y), or is vowel-consonant altogether."""
    marks = shape_of(word)
    return marks == "*#" or (marks.endswith("#*#") and word[-1] not in "wxy")


def _rule(word: str, rules, least: int) -> str:
    """The first suffix that fits decides; the word changes if enough pairs stay before it."""
    for suffix, put in rules:
        if word.endswith(suffix):
            rest = word[:-len(suffix)]
            # `logi` may count its own l, `ion` goes after s and t only
            measured = pairs(rest + "l" if suffix == "logi" else rest) >= least
            fits = suffix != "ion" or rest.endswith(("s", "t"))
            return rest + put if measured and fits else word
    return word


def _plural(word: str) -> str:
    if word.endswith("ies"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("sses"):
        return word[:-2]
    return word[:-1] if word.endswith("s") and not word.endswith("ss") else word


def _participle(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if pairs(word[:-3]) > 0 else word
    cut = 2 if word.endswith("ed") else 3 if word.endswith("ing") else 0
    if not cut or "*" not in shape_of(word[:-cut]):
        return word
    word = word[:-cut]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if len(word) > 1 and word[-1] == word[-2] and shape_of(word).endswith("#"):
        return word if word[-1] in "lsz" else word[:-1]
    return word + "e" if pairs(word) == 1 and _short(word) else word


def _final_y(word: str) -> str:
    fits = word.endswith("y") and len(word) > 2 and shape_of(word[:-1]).endswith("#")
    return word[:-1] + "i" if fits else word


def _final_e_and_l(word: str) -> str:
    if word.endswith("e"):
        rest = word[:-1]
        if pairs(rest) > 1 or (pairs(rest) == 1 and not _short(rest)):
            word = rest
    return word[:-1] if word.endswith("ll") and pairs(word[:-1]) > 1 else word


@lru_cache(maxsize=100_000)
def stem(word: str) -> str:
    """The stem of one word. Frequent words are looked up, so text costs little more than its words."""
    word = word.lower()
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    word = _final_y(_participle(_plural(word)))
    if word.endswith("alli") and pairs(word[:-4]) > 0:
        word = word[:-2]    # `-al` may end a suffix of the next step
    word = _rule(_rule(word, DERIVATIONAL, 1), ADJECTIVAL, 1)
    return _final_e_and_l(_rule(word, RESIDUAL, 2))


def stems(words: Column) -> Column:
    """The stem of each word, in Arrow batches."""
    @F.pandas_udf("string")
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(stem, na_action="ignore")
    return run(words)


def stems_of(words: Column) -> Column:
    """The stems of each array of words, in Arrow batches: a batch holds each of its words once as a Python text."""
    @F.arrow_udf("array<string>")
    def run(batch: pa.Array) -> pa.Array:
        coded = batch.flatten().dictionary_encode()
        made = pa.array([stem(w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
        sizes = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
        return pa.ListArray.from_arrays(ends, made, mask=batch.is_null())
    return run(words)
