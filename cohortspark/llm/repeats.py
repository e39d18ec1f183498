"""Passages of many bytes that repeat anywhere in a corpus, from merged Burrows-Wheeler transforms.

A window (``width`` bytes, 100) is repeated if the same bytes also start earlier. Repeats are found in
shards, and the shards' transforms are merged by refining their interleave: symbols are names of blocks of
20 bytes, and after k rounds the merged suffixes stand in the order of their first k blocks, with the
places known at which the common prefix ends. After the last round the intervals of equal windows are
left. No suffix is sorted again in a merge; a round only deals out the shards' own orders by symbol.

So that no task sees the whole corpus, windows are dealt out by content: by the least hash of the
32-byte grams in them, which equal windows share, and only windows are sent whose sampled grams all
occur twice somewhere. Neither drops a repeat.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortspark.llm.common import Scratch, mixed, parallelism, text_bytes, without

GRAM = 32  # bytes; a power of two
SAMPLED = np.uint64((1 << 64) // 16)  # grams with a smaller hash are counted
#: occurrences of a gram from which on its windows are dealt out by a second gram as well
HOT = 200
BLOCK = 20  # bytes of a symbol
SHARD_BYTES = 4 << 20
PART_BYTES = 4 << 20  # of the corpus to a part: grams and windows go to parts by hash
#: shards, or blocks of them, whose windows are merged together
FAN = 1000
BLOCK_BYTES = 1 << 18  # of a shard that are hashed at once, or one text
VERDICT = "__repeats_"  # begins the names of inner columns beside those of the caller
BASE = np.uint64(0xD1342543DE82EF95)
OTHER = np.uint64(0x9E3779B97F4A7C15)


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def rolled(data: np.ndarray, width: int, base: np.uint64 = BASE) -> np.ndarray:
    """Hash of the ``width`` bytes from each place on (fewer at the end count as if zeros followed)."""
    part = data.astype(np.uint64) + np.uint64(1)
    out, have = None, 0
    size = 1
    while True:
        if width & size:
            # the bytes from have to have + size go behind what there is
            if out is None:
                out = part if 2 * size > width else part.copy()
            else:
                out[: len(out) - have] += part[have:] * _power(base, have)
            have += size
        size *= 2
        if size > width:
            return _mix(out)
        half = size // 2
        part[:-half] += part[half:] * _power(base, half)


def _mix(x: np.ndarray) -> np.ndarray:
    """:func:`mixed` in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over the ``width`` values from each place on; shorter at the end."""
    out, size = values.copy(), 1
    while 2 * size <= width:
        pick(out[:-size], out[size:].copy(), out=out[:-size])
        size *= 2
    if width > size:
        pick(out[: size - width], out[width - size :].copy(), out=out[: size - width])
    return out


class Grams:
    """Gram hashes of some texts, and the least one of each window."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int):
        n = len(data)
        self.data = data
        self.grams = width - GRAM + 1  # in a window
        self.hash = rolled(data, GRAM)
        self.window = _inner(offsets, n, width)  # a whole window starts here
        self.least = _sliding(self.hash, self.grams, np.minimum) if n >= width else self.hash
        whole = _inner(offsets, n, GRAM)
        self.sampled = whole & (self.hash < SAMPLED)
        # the least gram of a window without a sampled one is counted as well
        lone = np.flatnonzero(self.window & (self.least >= SAMPLED))
        counted = self.sampled
        if len(lone):
            counted = counted.copy()
            # each such window, gram by gram, is few against the text
            for begin in range(0, len(lone), 4096):
                part = lone[begin : begin + 4096]
                near = self.hash[part[:, None] + np.arange(self.grams)]
                at, k = np.nonzero(near == self.least[part][:, None])
                counted[part[at] + k] = True
        self.counted = np.flatnonzero(counted)


def _inner(offsets: np.ndarray, n: int, width: int) -> np.ndarray:
    """Whether ``width`` bytes from a place on lie within its text."""
    out = np.ones(n, bool)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        out[max(a, b - width + 1) : b] = False
    return out


def _blocks(shard: "Shard", width: int):
    """The shard's texts some at a time: where they begin, and their grams. Bounds memory."""
    first = 0
    ends = shard.offsets[1:]
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, shard.offsets[first] + BLOCK_BYTES, "right")))
        begin, end = int(shard.offsets[first]), int(ends[last - 1])
        yield begin, Grams(shard.data[begin:end], shard.offsets[first : last + 1] - begin, width)
        first = last


def _by_part(values: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """An order by part (value modulo parts) and where each part begins in it."""
    part = (values % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


class Shard:
    """The distinct first texts of a shard, in the order of their ids."""

    def __init__(self, docs: pa.Table, firsts: set[tuple[int | None, bytes]]):
        rows, seen = [], set()
        for i, key in enumerate(zip(docs.column("doc_id").to_pylist(), docs.column("class").to_pylist(), strict=True)):
            if key in firsts and key not in seen:
                seen.add(key)
                rows.append((key[0] is None, key[0] or 0, key[1], i))
        rows.sort()
        self.classes = [r[2] for r in rows]
        self.order = np.array([(1 << 63) - 1 if r[0] else r[1] for r in rows], np.int64)
        texts = docs.column("text").combine_chunks()
        self.data, self.offsets = text_bytes(texts.take(pa.array([r[3] for r in rows], pa.int64())))


def _spans(doc: np.ndarray, start: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs covered by windows that come sorted by doc and start: doc, begin, end."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + width)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc))[: len(at)] - 1 if len(at) else at
    return doc[at], start[at], start[last] + width


def _radix(symbol: np.ndarray) -> np.ndarray:
    """A stable order by non-negative symbols below 2^32."""
    if symbol.dtype == np.uint16:
        return np.argsort(symbol, kind="stable")
    order = np.argsort((symbol & 0xFFFF).astype(np.uint16), kind="stable")
    if len(symbol) and symbol.max() > 0xFFFF:
        order = order[np.argsort((symbol[order] >> 16).astype(np.uint16), kind="stable")]
    return order


def transform(symbol: np.ndarray, before: np.ndarray, rounds: int) -> np.ndarray:
    """A shard's suffixes in the order of their first ``rounds`` symbols; ``before`` is the place a symbol earlier."""
    order = np.arange(len(symbol))
    for _ in range(rounds):
        order = before[order]
        order = order[_radix(symbol[order])]
    return order


def merge(transforms: list[np.ndarray], rounds: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Merges the transforms of shards: the symbols before their suffixes, in each shard's order.

    Returns the interleave (the shard of each merged place) and, for each shard, the number of the
    interval of equal first ``rounds`` symbols that each of its suffixes lies in.

    A round reads the transforms in the order of the interleave so far and deals them out, stably, by
    symbol: that is the interleave by one symbol more. Neighbours differ in their first k symbols if
    they differ in the symbol just read, or if what came after it differed in the round before.
    """
    sizes = [len(t) for t in transforms]
    kind = np.uint16 if len(sizes) < 65536 else np.int64
    interleave = np.repeat(np.arange(len(sizes), dtype=kind), sizes)
    symbols = np.concatenate(transforms)
    interval = np.zeros(len(symbols), np.int32)
    for _ in range(rounds):
        read = np.empty(len(symbols), symbols.dtype)  # symbol at each merged place
        read[_radix(interleave)] = symbols
        deal = _radix(read)
        read, interleave, interval = read[deal], interleave[deal], interval[deal]
        differs = np.zeros(len(read), np.int32)
        differs[1:] = (read[1:] != read[:-1]) | (interval[1:] != interval[:-1])
        interval = np.cumsum(differs, dtype=np.int32)
    own = interval[_radix(interleave)]
    return interleave, np.split(own, np.cumsum(sizes)[:-1])


def repeated_windows(shards: list[tuple[np.ndarray, np.ndarray, np.ndarray]], width: int) -> list[np.ndarray]:
    """For each shard, which of its windows also start earlier.

    A shard is (bytes, numbers of windows, ranks): segments one after the other, each with a run of
    windows and ``width - 1`` bytes more, and the rank of each segment's first window in the order of
    the corpus; ranks of the run follow.
    """
    rounds = width // BLOCK
    symbols, befores, windows, ranks, checks = [], [], [], [], []
    for data, runs, rank in shards:
        sizes = runs + width - 1
        starts = np.cumsum(sizes) - sizes
        # behind each segment one place for the end of each chain of blocks
        padded = sizes + BLOCK
        at = np.cumsum(padded) - padded
        place = np.arange(sizes.sum()) + np.repeat(at - starts, sizes)
        symbol = np.zeros(padded.sum(), np.uint16)
        symbol[place] = rolled(data, BLOCK) % np.uint64(0xFFFF) + np.uint64(1)
        ends = (np.arange(BLOCK) + (at + sizes)[:, None]).ravel()
        symbol[ends] = 0
        before = np.arange(len(symbol)) - BLOCK
        head = (np.arange(BLOCK) + at[:, None]).ravel()
        before[head] = ends
        local = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
        symbols.append(symbol)
        befores.append(before)
        windows.append(local + np.repeat(at, runs))
        ranks.append(local + np.repeat(rank, runs))
        checks.append(rolled(data, width, OTHER)[local + np.repeat(starts, runs)])
    orders = [transform(s, b, rounds) for s, b in zip(symbols, befores, strict=True)]
    _, intervals = merge([s[b[o]] for s, b, o in zip(symbols, befores, orders, strict=True)], rounds)
    found = []
    for order, interval, window in zip(orders, intervals, windows, strict=True):
        of = np.empty(len(order), interval.dtype)
        of[order] = interval
        found.append(of[window])
    interval, rank, check = np.concatenate(found), np.concatenate(ranks), np.concatenate(checks)
    order = np.lexsort((rank, check, interval))
    again = np.zeros(len(order), bool)
    # five equal symbols of 16 bits, and 64 bits of the whole window to guard against a clash of them
    again[order[1:]] = (interval[order][1:] == interval[order][:-1]) & (check[order][1:] == check[order][:-1])
    return np.split(again, np.cumsum([len(w) for w in windows])[:-1])


def _counted(docs: pa.Table, firsts: pa.Table, width: int, parts: int) -> pa.Table:
    """A shard's counted grams, each once with its number (255 at most), dealt out by hash."""
    shard = _shard(docs, firsts)
    out: list[tuple] = []
    if shard is not None and len(shard.data):
        values, times = np.unique(np.concatenate([g.hash[g.counted] for _, g in _blocks(shard, width)]), return_counts=True)
        order, edges = _by_part(values, parts)
        values, times = values[order], np.minimum(times, 255).astype(np.uint8)[order]
        name = docs.column("shard")[0].as_py()
        out = [(p, name, values[edges[p] : edges[p + 1]].tobytes(), times[edges[p] : edges[p + 1]].tobytes()) for p in np.flatnonzero(np.diff(edges)).tolist()]
    columns = list(zip(*out, strict=True)) or [[]] * 4
    return pa.table({n: pa.array(c, t) for n, c, t in zip(("part", "shard", "grams", "times"), columns, (pa.int32(), pa.int32(), pa.binary(), pa.binary()), strict=True)})


def _told(table: pa.Table) -> pa.Table:
    """For the grams of a part, to each shard: 0 occurs once, 1 again, 2 very often."""
    lists = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
    times = np.frombuffer(b"".join(table.column("times").to_pylist()), np.uint8).astype(np.int64)
    _, back = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.bincount(back, times)[back]
    flags = (total > 1).astype(np.uint8) + (total > HOT)
    ends = np.cumsum([len(x) for x in lists])
    raw = flags.astype(np.uint8).tobytes()
    return pa.table(
        {
            "shard": table.column("shard"),
            "part": table.column("part"),
            "flags": pa.array([raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)], pa.binary()),
        }
    )


def _shard(docs: pa.Table, firsts: pa.Table) -> Shard | None:
    if not docs.num_rows or not firsts.num_rows:
        return None
    keys = set(zip(firsts.column("doc_id").to_pylist(), firsts.column("class").to_pylist(), strict=True))
    return Shard(docs, keys)


SEGMENTS = "part int, shard int, orders binary, starts binary, runs binary, data binary, class binary, begins binary, ends binary"
_SEGMENT_KINDS = dict(zip([c.split()[0] for c in SEGMENTS.split(", ")], [pa.int32(), pa.int32(), *[pa.binary()] * 7], strict=True))


def _segment_table(rows: list[dict]) -> pa.Table:
    return pa.table({k: pa.array([r.get(k) for r in rows], t) for k, t in _SEGMENT_KINDS.items()})


def _segments(docs: pa.Table, side: pa.Table, width: int, parts: int) -> pa.Table:
    """Windows of a shard that may be repeated, in runs that share their least gram.

    Windows that occur earlier in the shard are told at once (rows with spans); the others go out, as
    the bytes of their runs with the classes they belong to.
    """
    shard = _shard(docs, side.filter(pa.compute.is_null(side.column("part"))))
    if shard is None or not len(shard.data):
        return _segment_table([])
    name = docs.column("shard")[0].as_py()
    told = side.filter(pa.compute.is_valid(side.column("part")))
    replies = dict(zip(told.column("part").to_pylist(), told.column("flags").to_pylist(), strict=True))
    blocks = list(_blocks(shard, width))
    values = np.unique(np.concatenate([g.hash[g.counted] for _, g in blocks]))
    order, edges = _by_part(values, parts)
    flags = np.zeros(len(values), np.uint8)
    flags[order] = np.frombuffer(b"".join(replies[p] for p in np.flatnonzero(np.diff(edges)).tolist()), np.uint8)
    found = [_candidates(g, begin, values, flags, width) for begin, g in blocks]
    del blocks
    window, key, whole = (np.concatenate(c) for c in zip(*found, strict=True))
    if not len(window):
        return _segment_table([])
    # the first of equal windows in the shard stays
    doc = np.searchsorted(shard.offsets, window, "right") - 1
    first = np.zeros(len(window), bool)
    first[np.unique(whole, return_index=True)[1]] = True
    rows: list[dict] = []
    rows += _span_rows(doc[~first], (window - shard.offsets[doc])[~first], shard.classes, width)
    window, key, doc = window[first], key[first], doc[first]
    new = np.ones(len(window), bool)
    new[1:] = (window[1:] != window[:-1] + 1) | (key[1:] != key[:-1])
    start = np.flatnonzero(new)
    runs = np.diff(np.append(start, len(window)))
    key, begin, doc = key[start], window[start], doc[start]
    order, edges = _by_part(key, parts)
    for p in np.flatnonzero(np.diff(edges)).tolist():
        own = np.sort(order[edges[p] : edges[p + 1]])
        sizes = runs[own] + width - 1
        at = np.arange(sizes.sum()) + np.repeat(begin[own] - (np.cumsum(sizes) - sizes), sizes)
        rows.append(
            {
                "part": p,
                "shard": name,
                "orders": np.column_stack([shard.order[doc[own]], (begin - shard.offsets[doc])[own], key[own].view(np.int64)]).tobytes(),
                "runs": runs[own].astype(np.int64).tobytes(),
                "data": shard.data[at].tobytes(),
                "class": b"".join(shard.classes[i] for i in doc[own].tolist()),
            }
        )
    return _segment_table(rows)


def _candidates(grams: Grams, begin: int, values: np.ndarray, flags: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """Windows whose counted grams all occur again: places, keys to deal them out by, and hashes."""
    none = np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    if not len(grams.counted):
        return none
    flag = flags[np.searchsorted(values, grams.hash[grams.counted])]
    once = np.zeros(len(grams.data) + 1, np.int32)
    alone = grams.counted[(flag == 0) & grams.sampled[grams.counted]]
    once[alone + 1] = 1
    np.cumsum(once, out=once)
    window = np.flatnonzero(grams.window)
    window = window[once[window] == once[np.minimum(window + grams.grams, len(grams.data))]]
    if not len(window):
        return none
    key = grams.least[window]
    # the least gram of a window is a counted one
    flag = flags[np.minimum(np.searchsorted(values, key), len(values) - 1)]
    window, key, flag = window[flag > 0], key[flag > 0], flag[flag > 0]
    hot = flag == 2
    if hot.any():
        most = _sliding(grams.hash, grams.grams, np.maximum)
        key = np.where(hot, mixed(key + most[window]), key)
    whole = mixed(rolled(grams.data, width)[window] + OTHER) if len(window) else none[2]
    return window + begin, key, whole


def _span_rows(doc: np.ndarray, start: np.ndarray, classes: list[bytes], width: int) -> list[dict]:
    doc, begin, end = _spans(doc, start, width)
    edges = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]])) if len(doc) else np.zeros(1, int)
    return [
        {"class": classes[doc[a]], "begins": begin[a:b].astype(np.int64).tobytes(), "ends": end[a:b].astype(np.int64).tobytes()}
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)
    ]


def _merged(table: pa.Table, width: int, last: bool = True, limit: int = 1 << 18) -> pa.Table:
    """Spans of the repeated windows of a part: merges its shards' transforms, some grams at a time.

    If this is not the ``last`` merge, the windows that are left, each once, go on with the spans, as
    those of one block.
    """
    shards = []
    for orders, runs, data, names in zip(*(table.column(c).to_pylist() for c in ("orders", "runs", "data", "class")), strict=True):
        orders = np.frombuffer(orders, np.int64).reshape(-1, 3)
        runs = np.frombuffer(runs, np.int64)
        names = np.frombuffer(names, "V16")
        shards.append((orders, runs, np.frombuffer(data, np.uint8), names))
    orders = np.concatenate([s[0] for s in shards])
    names = np.concatenate([s[3] for s in shards])
    # classes in the order of their bytes
    halves = names.view(">u8").astype(np.uint64).reshape(-1, 2)
    by = np.lexsort((halves[:, 1], halves[:, 0]))
    new = np.ones(len(by), bool)
    new[1:] = (halves[by][1:] != halves[by][:-1]).any(axis=1)
    classes = names[by[new]]
    which = np.empty(len(by), np.int64)
    which[by] = np.cumsum(new) - 1
    runs = np.concatenate([s[1] for s in shards])
    data = np.concatenate([s[2] for s in shards])
    of = np.repeat(np.arange(len(shards)), [len(s[1]) for s in shards])
    del shards
    sizes = runs + width - 1
    starts = np.cumsum(sizes) - sizes
    # rank of a segment's first window in the order of the corpus
    place = np.lexsort((orders[:, 1], which, orders[:, 0]))
    rank = np.empty(len(runs), np.int64)
    rank[place] = np.cumsum(runs[place]) - runs[place]
    # batches of whole grams, of about ``limit`` bytes
    by = np.argsort(orders[:, 2], kind="stable")
    key = orders[by, 2]
    new = np.concatenate([[True], key[1:] != key[:-1]]) if len(by) else np.zeros(0, bool)
    begins = np.flatnonzero(new)
    weight = np.add.reduceat(sizes[by], begins) if len(begins) else np.zeros(0, np.int64)
    alone = np.diff(np.append(begins, len(by))) == 1
    batch = np.repeat(np.cumsum(weight) // limit, np.diff(np.append(begins, len(by))))
    single = np.repeat(alone, np.diff(np.append(begins, len(by))))
    by, batch = by[~single], batch[~single]
    window = np.cumsum(runs) - runs  # number of a segment's first window
    repeated = np.zeros(runs.sum(), bool)
    for part in np.split(by, np.flatnonzero(np.diff(batch)) + 1) if len(by) else []:
        part = np.sort(part)
        groups, members = [], []
        for own in np.split(part, np.flatnonzero(np.diff(of[part])) + 1):
            at = np.arange(sizes[own].sum()) + np.repeat(starts[own] - (np.cumsum(sizes[own]) - sizes[own]), sizes[own])
            groups.append((data[at], runs[own], rank[own]))
            members.append(own)
        for own, again in zip(members, repeated_windows(groups, width), strict=True):
            repeated[np.arange(len(again)) + np.repeat(window[own] - (np.cumsum(runs[own]) - runs[own]), runs[own])] = again
    segment = np.repeat(np.arange(len(runs)), runs)
    local = np.arange(len(segment)) - window[segment]
    doc, start = which[segment[repeated]], (orders[segment, 1] + local)[repeated]
    order = np.lexsort((start, doc))
    rows = _span_rows(doc[order], start[order], [c.tobytes() for c in classes], width)
    if not last and not repeated.all():
        left = np.flatnonzero(~repeated)
        new = np.ones(len(left), bool)
        new[1:] = (left[1:] != left[:-1] + 1) | (segment[left][1:] != segment[left][:-1])
        at = np.flatnonzero(new)
        kept = np.diff(np.append(at, len(left)))
        own, skip = segment[left[at]], local[left[at]]
        sizes = kept + width - 1
        place = np.arange(sizes.sum()) + np.repeat(starts[own] + skip - (np.cumsum(sizes) - sizes), sizes)
        rows.append(
            {
                "part": table.column("part")[0].as_py(),
                "shard": table.column("shard")[0].as_py() // FAN,
                "orders": np.column_stack([orders[own, 0], orders[own, 1] + skip, orders[own, 2]]).tobytes(),
                "runs": kept.astype(np.int64).tobytes(),
                "data": data[place].tobytes(),
                "class": names[own].tobytes(),
            }
        )
    return _segment_table(rows)


def _merging(width: int, last: bool):
    return lambda table: _released(_merged(table, width, last))


def _released(out: pa.Table) -> pa.Table:
    """``out``, after Arrow has given back the memory that it holds for later use."""
    pa.default_memory_pool().release_unused()
    return out


def _joined(batches):
    """Maximal spans of each class from those of all tasks."""
    for batch in batches:
        out = []
        for parts in batch.column("parts").to_pylist():
            begin = np.concatenate([np.frombuffer(p["begins"], np.int64) for p in parts])
            end = np.concatenate([np.frombuffer(p["ends"], np.int64) for p in parts])
            order = np.argsort(begin, kind="stable")
            begin, end = begin[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], begin[1:] > end[:-1]])
            at = np.flatnonzero(new)
            last = np.append(at[1:], len(begin)) - 1
            out.append([{"start": int(a), "size": int(b - a)} for a, b in zip(begin[at], end[last], strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column("class"), pa.array(out, kind)], ["class", "spans"])


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 100) -> DataFrame:
    """``docs`` with ``n_bytes``, ``spans`` and ``copy``: what each text repeats of earlier ones.

    A byte is repeated if a window of ``width`` bytes (a multiple of 20) over it also starts earlier:
    in a smaller doc_id, or before in the same text. ``spans`` holds the maximal runs of such bytes
    (start and size, null: none). ``copy`` marks texts equal to one of a smaller doc_id; all of theirs
    is repeated if they hold a window at all. A null text is empty. Null ids come last; rows that
    share a doc_id but not the text are ordered by a hash of it; rows alike in both get equal results.
    Other columns stay, but for those of the three names.

    Texts are first named by hash, and only the first of equal ones goes on. Shards are hashed by
    doc_id, of about four megabytes, or one text of any length. Windows of more than a thousand shards
    are merged a thousand shards at a time, then a thousand blocks of them, and so on, so a passage that
    most shards hold is one window of a block when the next merge meets it.
    """
    spark = docs.sparkSession
    docs = without(docs, ["n_bytes", "spans", "copy"])
    work = Scratch(spark, "repeats")
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")))).alias("class"))
    # rows alike in id and text are one from here on, so that no later join meets them again and again
    rows = work.keep(named.select("doc_id", "class", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n")).distinct())
    firsts = work.keep(rows.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.max("n").alias("n")))
    total = firsts.agg(F.sum("n")).first()[0] or 0
    # shards and parts grow in number with the bytes, and not in size
    shards = max(1, math.ceil(total / SHARD_BYTES))
    parts = max(parallelism(spark), math.ceil(total / PART_BYTES))
    shard = F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int").alias("shard")
    wanted = firsts.where(F.col("n") >= width).select(shard, "doc_id", "class")
    texts = named.where(F.octet_length("text") >= width).select(shard, "doc_id", "text", "class")
    sent = texts.groupBy("shard").cogroup(wanted.groupBy("shard")).applyInArrow(
        lambda a, b: _released(_counted(a, b, width, parts)), "part int, shard int, grams binary, times binary"
    )
    told = work.keep(sent.groupBy("part").applyInArrow(lambda t: _released(_told(t)), "shard int, part int, flags binary"))
    work.release()
    side = told.select("shard", "part", "flags", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("class")).union(
        wanted.select("shard", F.lit(None).cast("int"), F.lit(None).cast("binary"), "doc_id", "class")
    )
    runs = work.keep(
        texts.groupBy("shard").cogroup(side.groupBy("shard")).applyInArrow(lambda a, b: _released(_segments(a, b, width, parts)), SEGMENTS)
    )
    work.drop(told)
    work.release()
    layers, blocks = [runs], shards
    while True:
        last = blocks <= FAN
        keys = ["part"] if last else ["part", F.floor(F.col("shard") / FAN).alias("block")]
        left = layers[-1].where("part is not null").groupBy(*keys)
        layers.append(work.keep(left.applyInArrow(_merging(width, last), SEGMENTS)))
        if last:
            break
        blocks = math.ceil(blocks / FAN)
    spans = reduce(DataFrame.union, (layer.where("part is null").select("class", "begins", "ends") for layer in layers))
    whole = spans.groupBy("class").agg(F.collect_list(F.struct("begins", "ends")).alias("parts"))
    whole = whole.mapInArrow(_joined, "class binary, spans array<struct<start:bigint,size:bigint>>")
    whole = work.keep(firsts.select("class", "doc_id").join(whole, "class").select("doc_id", "class", "spans"))
    work.drop(*layers)
    work.release()
    # written without an aggregate behind it, so that adaptive execution can split a large group of copies
    later = rows.join(firsts.select("class", F.col("doc_id").alias("first")), "class")
    later = later.where("n > 0 and first is not null and (doc_id is null or doc_id > first)").select("doc_id", "class", F.lit(True).alias("copy"))
    verdict = work.keep(
        whole.withColumn("copy", F.lit(False)).unionByName(later, allowMissingColumns=True).toDF(*(VERDICT + c for c in ("of", "name", "spans", "copy")))
    )
    work.drop(rows)
    ident = F.unhex(F.md5(F.coalesce(F.col(text), F.lit(""))))
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    same = F.col(doc_id).cast("long").eqNullSafe(F.col(VERDICT + "of")) & (ident == F.col(VERDICT + "name"))
    out = docs.join(verdict, same, "left")
    everything = F.when(size >= width, F.array(F.struct(F.lit(0).cast("long").alias("start"), size.alias("size"))))
    return out.select(
        *(docs[c] for c in docs.columns),
        size.alias("n_bytes"),
        F.when(F.col(VERDICT + "copy"), everything).otherwise(F.col(VERDICT + "spans")).alias("spans"),
        F.coalesce(VERDICT + "copy", F.lit(False)).alias("copy"),
    )


def _outside(raw: F.Column, spans: F.Column) -> F.Column:
    """The pieces of some bytes before, between and behind the spans, in hexadecimal."""

    def piece(i: F.Column) -> F.Column:
        before, span = F.get(spans, i - 1), F.get(spans, i)
        begin = F.when(i == 0, F.lit(0).cast("long")).otherwise(before["start"] + before["size"])
        end = F.when(i == F.size(spans), F.octet_length(raw).cast("long")).otherwise(span["start"])
        return F.hex(F.substring(raw, (begin + 1).cast("int"), (end - begin).cast("int")))

    return F.transform(F.sequence(F.lit(0), F.size(spans)), piece)


def _of_bytes(text: F.Column, make) -> F.Column:
    """``make`` of the bytes of a text, which are encoded once."""
    return F.transform(F.array(F.encode(F.coalesce(text, F.lit("")), "utf-8")), make)[0]


def kept_bytes(text: F.Column, spans: F.Column) -> F.Column:
    """The bytes of a text outside its spans, as binary; takes time in proportion to the text."""
    cut = _of_bytes(text, lambda raw: F.unhex(F.array_join(_outside(raw, spans), "")))
    return F.when(spans.isNull(), F.encode(F.coalesce(text, F.lit("")), "utf-8")).otherwise(cut)


def kept_text(text: F.Column, spans: F.Column) -> F.Column:
    """The text outside its spans; a character that a span cuts goes as a whole."""
    # continuation bytes at the beginning of a piece, and a character at its end that lacks some
    cut = r"^(?:[89AB].)+|(?:[CDEF].|[EF].[89AB].|F.(?:[89AB].){2})$"
    whole = _of_bytes(
        text, lambda raw: F.unhex(F.array_join(F.transform(_outside(raw, spans), lambda h: F.regexp_replace(h, cut, "")), "")).cast("string")
    )
    return F.when(spans.isNull(), text).otherwise(whole)
