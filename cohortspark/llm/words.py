"""Hashed words of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

from cohortspark.llm.common import SPACES, mixed

#: multiplier of the rolling hash; any odd number would do
BASE = np.uint64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BLANK = np.zeros(256, bool)
BLANK[list(SPACES)] = True
#: everything of ASCII but letters and digits
MARKS = np.zeros(256, bool)
MARKS[:128] = [not chr(i).isalnum() for i in range(128)]


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base², ... modulo 2^64."""
    out = np.ones(max(n, 1), np.uint64)
    size = 1
    while size < n:
        step = min(size, n - size)
        out[size : size + step] = out[:step] * (out[size - 1 : size] * base)
        size += step
    return out[:n]


_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def hashed_words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = BLANK, head: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z in lower case, and the n + 1 places where texts begin among them.

    ``data`` holds the bytes of the texts, ``offsets`` where each begins; ``between`` marks the bytes
    between words. A word's hash depends on its bytes alone: the sum of ``byte * base^place`` over
    the word, shifted back by the inverse power of its start. With ``head``, only so many first
    bytes of a word count.
    """
    n = len(data)
    inside = ~between[data]
    start = inside.copy()
    if n:
        start[1:] &= ~inside[:-1]
        borders = offsets[1:-1]
        borders = borders[borders < n]
        start[borders] = inside[borders]  # words never cross texts
    begin = np.flatnonzero(start)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    terms = (_LOWER[data].astype(np.uint64) + np.uint64(1)) * _powers(BASE, n)
    terms[~inside] = 0
    if head:
        # bytes before the first word are zero already
        place = np.arange(begin[0], n) - np.repeat(begin, np.diff(np.append(begin, n)))
        terms[begin[0] :][place >= head] = 0
    sums = np.add.reduceat(terms, begin)
    hashes = mixed(sums * _powers(_INVERSE, n)[begin])
    return hashes, np.searchsorted(begin, offsets)


def shingles(words: np.ndarray, places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of ``width`` words, sorted within each text, and where texts begin.

    A text with fewer words has one shingle of all of them; one without words has none.
    """
    counts = np.diff(places)
    n = len(words)
    # shingle at each word; the rows' last width - 1 places are cut off below
    value = np.zeros(n, np.uint64)
    factors = _powers(BASE, width + 1)[1:]
    for i in range(min(width, n)):
        value[: n - i] += mixed(words[i:] * factors[i])
    value = mixed(value)
    keep = np.maximum(counts - width + 1, 0)
    short = np.flatnonzero((counts > 0) & (counts < width))
    keep[short] = 1
    for r in short:
        own = words[places[r] : places[r + 1]]
        with np.errstate(over="ignore"):
            value[places[r]] = mixed(np.add.reduce(mixed(own * _powers(BASE, len(own) + 1)[1:]), keepdims=True) + np.uint64(len(own)))[0]
    rows = np.repeat(np.arange(len(counts)), keep)
    at = np.arange(len(rows)) - np.repeat(np.cumsum(keep) - keep, keep) + places[:-1][rows]
    value = value[at]
    order = np.argsort(value, kind="stable")
    order = order[np.argsort(rows[order].astype(np.uint16) if len(counts) < 65536 else rows[order], kind="stable")]
    value, rows = value[order], rows[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
    value, rows = value[new], rows[new]
    return value, np.searchsorted(rows, np.arange(len(counts) + 1))
