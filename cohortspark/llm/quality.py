"""Quality of texts by a generalised additive model with pairwise interactions.

The log-odds of good quality are a sum of one lookup table for each feature of a text and of one for each of
a few pairs of features. Tables are learned by cyclic boosting: turn by turn, a shallow tree over the bins of
one feature is fitted to what all tables so far leave unexplained, and a small part of it is added to the
feature's table. The pairs whose tree of one cut in either feature explains most of what is left are boosted
in the same way afterwards. Scoring adds the entries of a text's bins.
"""

from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.llm.common import appended, hash_order, text_bytes
from cohortspark.llm.words import BLANK, hashed_words

PIECE = 1 << 22  # bytes of text that are measured together, or one text
BINS = 32  # of a feature
PAIR_BINS = 8  # of a feature in a pair
#: kinds of bytes
LOWER, UPPER, DIGIT, POINT, SYMBOL, SPACE, LINE, OTHER = range(8)
_KIND = np.full(256, SYMBOL, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = LOWER, UPPER, DIGIT, OTHER
_KIND[list(b".,;:!?'\"()-")] = POINT
_KIND[BLANK], _KIND[10] = SPACE, LINE
_LINES = np.zeros(256, bool)
_LINES[10] = True

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "longest_word", "upper", "digits", "points", "symbols", "beyond_ascii",
    "line_feeds", "same_as_before", "marked_words", "short_words", "capital_words", "new_words", "new_lines", "line_words",
)


class Model(NamedTuple):
    """Log-odds: bias, plus a table's entry for the bin of each feature, plus a grid's for each pair's bins."""

    bias: float
    edges: list[np.ndarray]  # lower ends of the bins from the second on
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    grids: list[np.ndarray]


def _distinct(hashes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Number of different hashes in each text."""
    n = len(places) - 1
    text = np.repeat(np.arange(n), np.diff(places))
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(text[order], kind="stable")]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (text[order][1:] != text[order][:-1])
    return np.bincount(text[order][new], minlength=n)


def features(texts: pa.Array) -> np.ndarray:
    """The features of each whole text, a row for each; null counts as empty, and that as all zeros."""
    data, offsets = text_bytes(texts)
    n, size = len(texts), np.diff(offsets)
    if not len(data):
        return np.zeros((n, len(FEATURES)))
    text = np.repeat(np.arange(n, dtype=np.int32), size)
    kind = _KIND[data]
    kinds = np.bincount(text.astype(np.int64) * 8 + kind, minlength=8 * n).reshape(n, 8)
    inside = ~BLANK[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[1:-1][offsets[1:-1] < len(data)]
    begins[edges] = inside[edges]
    begin = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    lasts = offsets[1:-1][offsets[1:-1] > 0] - 1
    ends[lasts] = inside[lasts]
    end = np.flatnonzero(ends)
    length, of = end - begin + 1, text[begin]
    words = np.bincount(of, minlength=n)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, of, length)

    def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return count / np.maximum(whole, 1)

    def words_with(mask: np.ndarray) -> np.ndarray:
        return share(np.bincount(of[mask], minlength=n), words)

    same = np.zeros(len(data), bool)
    same[1:] = (data[1:] == data[:-1]) & (text[1:] == text[:-1])
    last = kind[end]
    lines, at = hashed_words(data, offsets, _LINES)
    many = np.diff(at)
    hashes, places = hashed_words(data, offsets)
    return np.column_stack(
        [
            np.log2(1 + size), np.log2(1 + words), share(size - kinds[:, SPACE] - kinds[:, LINE], words), np.log2(1 + longest),
            share(kinds[:, UPPER], kinds[:, UPPER] + kinds[:, LOWER]), share(kinds[:, DIGIT], size), share(kinds[:, POINT], size),
            share(kinds[:, SYMBOL], size), share(kinds[:, OTHER], size), share(kinds[:, LINE], size),
            share(np.bincount(text[same], minlength=n), size), words_with((last == POINT) | (last == SYMBOL)), words_with(length < 2),
            words_with(kind[begin] == UPPER), share(_distinct(hashes, places), words), share(_distinct(lines, at), many), np.log2(1 + share(words, many)),
        ]
    )


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)]).astype(np.int64)


def _edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Borders between quantiles of the sample, without those that cut nothing off."""
    out = []
    for f in range(x.shape[1]):
        cuts = np.unique(np.quantile(x[:, f], np.arange(1, bins) / bins)) if len(x) else np.zeros(0)
        out.append(cuts[cuts > x[:, f].min()] if len(x) else cuts)
    return out


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int, ridge: float, least: float) -> np.ndarray:
    """Newton steps of a tree of ``depth`` over ordered bins, by the cuts that gain most."""
    total, weight = grad.sum(), hess.sum()
    leaf = np.full(len(grad), total / (weight + ridge))
    if not depth or len(grad) < 2:
        return leaf
    g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    gain = g**2 / (h + ridge) + (total - g) ** 2 / (weight - h + ridge) - total**2 / (weight + ridge)
    gain[(h < least) | (weight - h < least)] = 0
    cut = int(np.argmax(gain)) + 1
    if gain[cut - 1] <= 1e-9:
        return leaf
    return np.concatenate([_tree(part, own, depth - 1, ridge, least) for part, own in ((grad[:cut], hess[:cut]), (grad[cut:], hess[cut:]))])


def _cross(grad: np.ndarray, hess: np.ndarray, ridge: float, least: float) -> tuple[float, np.ndarray]:
    """Gain and Newton steps of the tree with one cut in either feature of a grid."""
    def corners(x: np.ndarray) -> np.ndarray:
        sums = np.zeros((x.shape[0] + 1, x.shape[1] + 1))
        sums[1:, 1:] = x.cumsum(0).cumsum(1)
        inner, right, below, whole = sums[1:-1, 1:-1], sums[1:-1, -1:], sums[-1:, 1:-1], sums[-1, -1]
        return np.stack([inner, right - inner, below - inner, whole - right - below + inner])

    flat = np.full(grad.shape, 0.0)
    if min(grad.shape) < 2:
        return 0.0, flat
    g, h = corners(grad), corners(hess)
    gain = (g**2 / (h + ridge)).sum(0)
    gain[(h < least).any(0)] = 0
    a, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
    if gain[a, b] <= 0:
        return 0.0, flat
    step = g[:, a, b] / (h[:, a, b] + ridge)
    flat[: a + 1, : b + 1], flat[: a + 1, b + 1 :], flat[a + 1 :, : b + 1], flat[a + 1 :, b + 1 :] = step
    return float(gain[a, b]), flat


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, weight: np.ndarray, interactions: int = 8, rounds: int = 120, pair_rounds: int = 40,
    rate: float = 0.1, depth: int = 2, ridge: float = 1.0, least: float = 1.0,
) -> Model:
    """The model of labels ``y`` (0 or 1) by features ``x``; rows count ``weight`` times.

    Without rows of both labels the tables are zero, and the bias says what share of the rows, with one
    more of either label, is 1.
    """
    edges, pair_edges = _edges(x, BINS), _edges(x, PAIR_BINS)
    yes, no = weight[y == 1].sum(), weight[y == 0].sum()
    tables = [np.zeros(len(e) + 1) for e in edges]
    model = Model(float(np.log((yes + 1) / (no + 1))), edges, tables, [], pair_edges, [])
    if not yes or not no:
        return model
    binned, coarse = _bins(x, edges), _bins(x, pair_edges)
    odds = np.full(len(y), model.bias)
    weight = weight / weight.mean()

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = _probability(odds)
        return weight * (y - p), weight * p * (1 - p)

    for _ in range(rounds):
        for f, own in enumerate(tables):
            grad, hess = (np.bincount(binned[:, f], r, len(own)) for r in residuals())
            step = rate * _tree(grad, hess, depth, ridge, least)
            own += step
            odds += step[binned[:, f]]

    def grid(pair: tuple[int, int], values: np.ndarray) -> np.ndarray:
        a, b = pair
        shape = len(pair_edges[a]) + 1, len(pair_edges[b]) + 1
        return np.bincount(coarse[:, a] * shape[1] + coarse[:, b], values, shape[0] * shape[1]).reshape(shape)

    left = residuals()
    gains = {p: _cross(*(grid(p, r) for r in left), ridge, least)[0] for p in combinations(range(x.shape[1]), 2)}
    pairs = [p for p in sorted(gains, key=lambda p: (-gains[p], p))[:interactions] if gains[p] > 0]
    grids = [np.zeros((len(pair_edges[a]) + 1, len(pair_edges[b]) + 1)) for a, b in pairs]
    for _ in range(pair_rounds):
        for pair, own in zip(pairs, grids, strict=True):
            step = rate * _cross(*(grid(pair, r) for r in residuals()), ridge, least)[1]
            own += step
            odds += step[coarse[:, pair[0]], coarse[:, pair[1]]]
    return model._replace(pairs=pairs, grids=grids)


def score(model: Model, x: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each row of features."""
    binned, coarse = _bins(x, model.edges), _bins(x, model.pair_edges)
    odds = np.full(len(x), model.bias)
    for f, own in enumerate(model.tables):
        odds += own[binned[:, f]]
    for (a, b), own in zip(model.pairs, model.grids, strict=True):
        odds += own[coarse[:, a], coarse[:, b]]
    return _probability(odds)


def _measured():
    def call(texts):
        return (pa.array([row.tobytes() for row in features(pa.array(texts, pa.string()))], pa.binary()),)

    return call


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", held_out: F.Column | None = None,
    doc_id: str = "doc_id", text: str = "text", each: int = 4000, **options,
) -> Model:
    """A model of ``label`` (0 or 1) in ``labels`` by the texts of ``docs`` with the same ``doc_id``.

    It is fitted on a bounded sample: ``each`` labelled ids at most of either label, chosen by a hash of
    the id, which weigh as much as all labelled ids of their label do. Rows with a null id or label, and
    those for which ``held_out`` (a condition on ``labels``) holds, teach nothing. An id that is labelled
    more than once counts as 1 if that is the label of at least half of its rows; of several texts
    of an id one is taken. The driver gets the features of the sample, never a text.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull())
    if held_out is not None:
        known = known.where(~F.coalesce(held_out, F.lit(False)))
    known = known.groupBy(F.col(doc_id).alias("id")).agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    by = hash_order("id", F.lit(label))
    sample = known.where("y = 0").orderBy(by, "id").limit(each).union(known.where("y = 1").orderBy(by, "id").limit(each))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id")  # bounded by ``each``
    found = appended(texts, "text", [("features", T.BinaryType())], _measured, PIECE)
    rows = found.groupBy("id").agg(F.min(F.struct("features", "y")).alias("own")).select("id", "own.*").collect()
    rows.sort(key=lambda r: r["id"])
    x = np.array([np.frombuffer(r["features"]) for r in rows]).reshape(-1, len(FEATURES))
    y = np.array([r["y"] for r in rows], np.int64)
    sampled = np.bincount(y, minlength=2)
    weight = np.array([counts.get(k, 0) / max(int(sampled[k]), 1) for k in (0, 1)])[y] if len(y) else np.zeros(0)
    return fit(x, y, weight, **options)


def predict(docs: DataFrame, model: Model, text: str = "text", field: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 from each whole text; all rows and columns stay.

    A null text counts as empty, and an empty text has all features zero. Equal texts get equal results.
    """

    def make():
        def call(texts):
            return (pa.array(score(model, features(pa.array(texts, pa.string())))),)

        return call

    return appended(docs, text, [(field, T.DoubleType())], make, PIECE)


def fold(doc_id: str = "doc_id") -> F.Column:
    """Whether a row is held out: crc32 of its id as text leaves 2 when divided by 4; not without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))
