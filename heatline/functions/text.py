"""Column functions over message text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from heatline.constants import ENGLISH_STOP_WORDS


# The same characters as CLEAN_PATTERN, as one class: Java matches it many times faster.
UNWANTED = r"[\W_&&\S]+"
# A run of other characters, or nothing between two whitespace characters that text still follows,
# or the empty text.
TOKEN = r"(?<!\S)(?:\S+|(?=\s+\S)|^\z)"


def clean_text(text: Column, unicode_words=False) -> Column:
    """Delete everything that is neither word character nor whitespace, delete `_`, lower, trim.

    Word characters are ASCII unless `unicode_words` is set, so accented letters go by default.
    """
    pattern = ("(?U)" if unicode_words else "") + UNWANTED
    return F.trim(F.lower(F.regexp_replace(text, pattern, "")))


def normalise_text(text: Column) -> Column:
    """Lower, delete ASCII punctuation, collapse every run of whitespace to one space."""
    bare = F.regexp_replace(F.lower(text), r"\p{Punct}+", "")
    return F.trim(F.regexp_replace(bare, r"[\s\p{Z}]+", " "))


def tokens(text: Column) -> Column:
    """Lower and split on every single whitespace character, as Spark ML's Tokenizer does.

    Inner empty tokens stay, trailing ones go; the empty text has one empty token.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), 0)


def stop_words(bare_apostrophes=False) -> list[str]:
    """The English list; optionally also each contraction as cleaning leaves it (`dont`)."""
    words = list(ENGLISH_STOP_WORDS)
    if bare_apostrophes:
        words += [w.replace("'", "") for w in words if "'" in w]
    return words


def without_stop_words(words: Column, stops=None) -> Column:
    """Drop stop words, ignoring case, keeping order and repeats."""
    listed = list(stop_words() if stops is None else stops)
    return F.filter(words, lambda w: ~F.lower(w).isin(listed))
