"""Hashed character n-grams and words of a text, in whole arrays."""

import sys
from functools import lru_cache

import numpy as np

CHUNK = 1 << 20
# Fixed odd multipliers for the hashes of this package; models are only valid with these.
FACTORS = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393], np.uint32)
FINISH = np.uint32(2654435769)


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    """Per code point: itself where it is a letter, else a space."""
    points = np.full(sys.maxunicode + 1, 32, np.uint32)
    own = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    points[own] = np.flatnonzero(own)
    return points


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def grams(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Hash of every n-gram of code points, below 2 ** bits. Order n salts the hash."""
    size = len(points) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint32)
    total = np.full(size, n * 40503, np.uint32)
    for k in range(n):
        total += points[k:k + size] * FACTORS[k]
    total ^= total >> np.uint32(15)
    return (total * FINISH) >> np.uint32(32 - bits)


def word_codes(points: np.ndarray) -> np.ndarray:
    """32-bit code of every run of code points above the space."""
    inside = points > 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint32)
    lengths = ends - starts
    at = np.flatnonzero(inside)
    place = (at - np.repeat(starts, lengths)).astype(np.uint32)
    mixed = (points[at] + np.uint32(7)) * (place * np.uint32(2) + np.uint32(1)) * FACTORS[0]
    mixed ^= mixed >> np.uint32(13)
    mixed *= FACTORS[1] + place * np.uint32(4)
    total = np.add.reduceat(mixed, np.concatenate(([0], np.cumsum(lengths)[:-1]))).astype(np.uint32)
    return total ^ (total >> np.uint32(16))


def bucket(codes: np.ndarray, bits: int) -> np.ndarray:
    return (codes * FINISH) >> np.uint32(32 - bits)


def chunks(points: np.ndarray, overlap: int):
    """Parts of bounded length that share `overlap` points, so that no n-gram is lost or repeated."""
    for at in range(0, max(1, len(points) - overlap), CHUNK):
        yield points[at:at + CHUNK + overlap]
