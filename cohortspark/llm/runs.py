"""Periodic runs of words in texts, by Kruskal's rule on common prefixes.

The suffixes of a text (from each of its words on) are united in the order of falling common prefix, as
Kruskal's algorithm unites nodes along the heaviest edges. Each class keeps its places in order. Where two
classes become one, places p < r that are now neighbours share exactly as many words as the edge says; if
these are at least r - p, the words from p on repeat with period r - p, and with no smaller one, since
then a place between p and r would be in the class as well. A run is told at its first word: the one place
whose stretch cannot be extended to the left.

A text never leaves its row, so texts are handled side by side in numpy, and only the uniting itself is a
loop over places. Places whose next ``(least + 1) // 2`` words occur once in the text start no run and
take no part in it.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cohortspark.llm.common import appended, mixed

PIECE = 1 << 22  # bytes of text that a task handles together, or one text
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _numbered(lists: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Equal words as equal numbers, behind each text one of its own; and where texts begin."""
    sizes = np.array([len(x) + 1 for x in lists], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    numbers = defaultdict(count().__next__)
    ids = np.empty(starts[-1], np.int64)
    inner = np.ones(len(ids), bool)
    inner[starts[1:] - 1] = False
    ids[inner] = np.fromiter(map(numbers.__getitem__, chain.from_iterable(lists)), np.int64, int(inner.sum()))
    ids[~inner] = len(numbers) + np.arange(len(lists))
    return ids, starts


def _again(ids: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """Texts in which the hash of some ``width`` words occurs twice."""
    n = len(ids) - width + 1
    if n < 2:
        return np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    words = mixed(ids.astype(np.uint64) + np.uint64(1))
    for i in range(width):
        value = value * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n]
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:n]
    value = mixed(value ^ mixed(text.astype(np.uint64)))
    order = np.argsort(value)
    twice = order[1:][value[order][1:] == value[order][:-1]]
    return np.unique(text[twice])


def _suffixes(ids: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of their suffixes, and the words each shares with the one before it.

    Texts follow each other in the order. Fewer than ``width`` shared words count as none. Prefixes
    double: places with equal labels at length n are ordered by the labels n words further on. The
    labels that a round replaces are kept, and taken back in turn to measure the shared words.
    """
    n = len(ids)
    padded = np.append(ids, np.full(width, -1))
    text = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort([*(padded[i : i + n] for i in reversed(range(width))), text])
    new = np.ones(n, bool)
    new[1:] = text[order][1:] != text[order][:-1]
    for i in range(width):
        word = padded[order + i]
        new[1:] |= word[1:] != word[:-1]
    label = np.empty(n + 1, np.int64)  # where in the order the places of equal prefix begin
    label[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    label[n] = -1
    first = label.copy()
    changes, size = [], width
    while True:
        begins = np.flatnonzero(new)
        groups = np.diff(np.append(begins, n))
        at = np.flatnonzero(np.repeat(groups > 1, groups))
        if not len(at):
            break
        place = order[at]
        one, two = label[place], label[np.minimum(place + size, n)]
        by = np.lexsort([two, one])
        place, one, two = place[by], one[by], two[by]
        order[at] = place
        fresh = np.ones(len(at), bool)
        fresh[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        changes.append((size, place, one))
        label[place] = at[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        new[at] = fresh
        size *= 2
    # pairs of neighbours in the order that share width words or more
    pair = np.flatnonzero(first[order][1:] == first[order][:-1]) + 1
    a, b = order[pair - 1], order[pair]
    shared = np.zeros(len(pair), np.int64)
    for size, place, one in reversed(changes):
        label[place] = one
        same = label[np.minimum(a + shared, n)] == label[np.minimum(b + shared, n)]
        shared[same] += size
    for _ in range(width - 1):
        shared += padded[a + shared] == padded[b + shared]
    out = np.zeros(n, np.int64)
    out[pair] = shared
    return order, out


def _neighbours(order: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places p < r that become neighbours when their classes are united, with the words they share.

    Only those that share r - p words or more.
    """
    edges = np.flatnonzero(shared)
    edges = edges[np.argsort(-shared[edges], kind="stable")]
    # nodes are the places with an edge, in the order of their suffixes
    nodes = np.unique(np.concatenate([edges, edges - 1]))
    right = np.searchsorted(nodes, edges).tolist()
    sets: list = [[p] for p in order[nodes].tolist()]
    parent = list(range(len(nodes)))
    lows, highs, commons = [], [], []
    for b, common in zip(right, shared[edges].tolist(), strict=True):
        a = b - 1
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        large, small = sets[a], sets[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b], sets[b] = a, None
        before, last = None, len(small) - 1
        for i, place in enumerate(small):
            k = bisect_left(large, place)
            if k and (low := large[k - 1]) != before and place - low <= common:
                lows.append(low)
                highs.append(place)
                commons.append(common)
            if k < len(large) and (high := large[k]) - place <= common and (i == last or high < small[i + 1]):
                lows.append(place)
                highs.append(high)
                commons.append(common)
            large.insert(k, place)
            before = place
    return np.array(lows, np.int64), np.array(highs, np.int64), np.array(commons, np.int64)


def runs_of(lists: list[list[bytes]], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of all runs, in the order of text, start and period."""
    width = max(1, (least + 1) // 2)
    ids, starts = _numbered(lists)
    some = _again(ids, starts, width)
    if not len(some):
        return (np.zeros(0, np.int64),) * 4
    ids, starts = _numbered([lists[i] for i in some.tolist()])
    low, high, common = _neighbours(*_suffixes(ids, starts, width))
    period = high - low
    text = np.searchsorted(starts, low, "right") - 1
    # the word before a text's first one is the end of another text, which no word equals
    leftmost = (low == 0) | (ids[low - 1] != ids[high - 1])
    keep = leftmost & (common + period >= least)
    text, low, period, common = text[keep], low[keep], period[keep], common[keep]
    order = np.lexsort([period, low])
    return some[text[order]], (low - starts[text])[order], (common + period)[order], period[order]


def _call(least: int):
    def call(texts: list[str | None]) -> tuple[pa.Array, pa.Array]:
        # bytes.split() parts at blank, tab, line feed, vertical tab, form feed and carriage return
        lists = [t.encode().split() if t else [] for t in texts]
        text, start, length, period = runs_of(lists, least)
        kept = [b" ".join(words) for words in lists]
        edges = np.searchsorted(text, np.arange(len(lists) + 1))
        for i in np.unique(text).tolist():
            own = slice(edges[i], edges[i + 1])
            step = np.zeros(len(lists[i]) + 1, np.int64)
            np.add.at(step, start[own] + period[own], 1)
            np.add.at(step, start[own] + length[own], -1)
            covered = np.cumsum(step)[:-1] > 0
            kept[i] = b" ".join([w for w, gone in zip(lists[i], covered.tolist(), strict=True) if not gone])
        values = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], ["start", "length", "period"])
        return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values), pa.array(kept, pa.binary()).cast(pa.string())

    return call


def periodic_runs(
    docs: DataFrame, text: str = "text", least: int = 12, fields: tuple[str, str] = ("runs", "collapsed")
) -> DataFrame:
    """``docs`` with the periodic runs of each whole text and the text without their repetitions.

    Words are what stands between ASCII white space, compared by their bytes. A run is a stretch of at
    least ``least`` words, and twice its period, in which words a period apart are equal, with no smaller
    period, and which no word beside it extends. ``runs`` lists start (word number from 0), length and
    period by start, then period. ``collapsed`` joins by one blank the words that no run holds after its
    first period. A null or empty text has no runs and collapses to the empty text. Rows are independent,
    so equal texts get equal results; other columns stay, but those named like the results. A task holds
    the words of about four megabytes of text, or of one text, and some hundred bytes for each.
    """
    return appended(docs, text, list(zip(fields, (RUNS, T.StringType()), strict=True)), lambda: _call(least), PIECE)
