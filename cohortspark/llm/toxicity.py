"""Toxicity by a chain of classifiers.

Categories are predicted one after the other. Each has a linear (logistic) model over the words of
the text and their beginnings, and over the probabilities of the categories before it. In training these probabilities
come out of fold: from models that have not seen the document, as is the case when predicting.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.llm.common import appended, hash_order, mixed, text_bytes
from cohortspark.llm.words import MARKS, hashed_words


#: a word counts in a model from this chi-square of its occurrence and the category on
CHI_SQUARE = 20.0
#: words that begin with the same so many bytes also share a feature
HEAD = 6


class Link(NamedTuple):
    """One classifier: log-odds = bias + sum of word weights + earlier probabilities' weights."""

    category: str
    bias: float
    words: np.ndarray
    earlier: np.ndarray


class Chain(NamedTuple):
    vocabulary: np.ndarray  # sorted word hashes
    links: list[Link]


class Rows(NamedTuple):
    """Documents as distinct words: word[i] of the vocabulary occurs in document doc[i]."""

    doc: np.ndarray
    word: np.ndarray
    size: int


def _rows(hashes: np.ndarray, places: np.ndarray, vocabulary: np.ndarray) -> Rows:
    n = len(places) - 1
    if not len(vocabulary):
        return Rows(np.zeros(0, np.int64), np.zeros(0, np.int64), n)
    at = np.searchsorted(vocabulary, hashes)
    at[at == len(vocabulary)] = 0
    known = vocabulary[at] == hashes
    doc = np.repeat(np.arange(n), np.diff(places))[known]
    pair = np.unique(doc * len(vocabulary) + at[known])
    return Rows(pair // len(vocabulary), pair % len(vocabulary), n)


def _odds(rows: Rows, link: Link, earlier: np.ndarray) -> np.ndarray:
    return link.bias + np.bincount(rows.doc, link.words[rows.word], rows.size) + earlier @ link.earlier


def _probability(odds: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _fit(category: str, rows: Rows, width: int, y: np.ndarray, earlier: np.ndarray, use: np.ndarray, ridge: float = 0.02, steps: int = 60) -> Link:
    """Ridge-penalised logistic regression by preconditioned gradient steps.

    Words enter scaled by the log ratio of their shares among positive and other documents, and only
    if their chi-square says that the shares differ: long texts would else add up chance words.
    """
    keep = use[rows.doc]
    doc, word = rows.doc[keep], rows.word[keep]
    y, n = y.astype(float), use.sum()
    yes = np.bincount(word, y[doc], width) + 0.5
    no = np.bincount(word, 1 - y[doc], width) + 0.5
    positives = y[use].sum()
    if not 0 < positives < n:
        return Link(category, -30.0 if not positives else 30.0, np.zeros(width), np.zeros(earlier.shape[1]))
    scale = np.log(yes / (positives + 1)) - np.log(no / (n - positives + 1))
    both = yes + no
    expected = both * positives / n
    scale[(yes - expected) ** 2 / (expected * (1 - positives / n)) / np.maximum(1 - both / n, 0.01) < CHI_SQUARE] = 0
    value = scale[word]
    bias, w, e = np.log(positives / (n - positives)), np.zeros(width), np.zeros(earlier.shape[1])
    curve = np.bincount(word, value**2, width) * 0.25 / n + ridge
    momentum = np.zeros(width), np.zeros(len(e)), 0.0
    for _ in range(steps):
        p = _probability(bias + np.bincount(doc, value * w[word], len(y)) + earlier @ e)
        gap = np.where(use, p - y, 0) / n
        grads = np.bincount(word, value * gap[doc], width) + ridge * w / n, earlier.T @ gap, gap.sum()
        momentum = tuple(0.8 * m + g for m, g in zip(momentum, grads, strict=True))
        w = w - 0.3 * momentum[0] / curve
        e = e - 1.0 * momentum[1]
        bias -= 0.5 * momentum[2]
    return Link(category, float(bias), w * scale, e)


def _sample(labels: DataFrame, doc_id: str, categories: dict[str, F.Column], each: int) -> DataFrame:
    """Labelled ids: ``each`` at most of every category, and twice as many of none, by hash."""
    marks = [F.coalesce(c.cast("boolean"), F.lit(False)).alias(f"y{i}") for i, c in enumerate(categories.values())]
    rows = labels.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), *marks).groupBy("id").agg(*(F.max(f"y{i}").alias(f"y{i}") for i in range(len(marks))))
    by = hash_order("id", F.lit("labels"))
    none = ~F.greatest(*(F.col(f"y{i}") for i in range(len(marks))), F.lit(False))
    parts = [rows.where(F.col(f"y{i}")).orderBy(by, "id").limit(each) for i in range(len(marks))]
    out = rows.where(none).orderBy(by, "id").limit(2 * each)
    for part in parts:
        out = out.union(part)
    return out.distinct()


def learn(
    docs: DataFrame, labels: DataFrame, categories: dict[str, F.Column], doc_id: str = "doc_id", text: str = "text",
    each: int = 2000, folds: int = 3, least: int = 2,
) -> Chain:
    """A chain over ``categories`` (name and condition on ``labels``), in their order.

    The models are fitted on a bounded sample: ``each`` labelled documents of every category at most,
    and twice as many of none, chosen by hash. The driver gets their distinct word hashes. Words of
    fewer than ``least`` sampled documents are left out. Of sampled texts that look like copies of each
    other (their four least word hashes agree in one of three orders, which a few texts that are none do
    as well) only the first is learned from; prediction covers every row. A document labelled more than once has a
    category if one of its rows says so. No labelled row: probabilities near 0.
    """
    wanted = F.broadcast(_sample(labels, doc_id, categories, each))  # bounded by ``each``
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).where("text is not null")
    hashes = appended(texts.join(wanted, "id"), "text", [("hashes", T.BinaryType())], _distinct_words, 1 << 22).drop("text")
    got = sorted(hashes.collect(), key=lambda r: (r["id"], r["hashes"]))
    got = _without_copies(got)
    sets = [np.frombuffer(r["hashes"], np.uint64) for r in got]
    joined = np.concatenate([np.zeros(0, np.uint64), *sets])
    vocabulary, times = np.unique(joined, return_counts=True)
    vocabulary = vocabulary[times >= least]
    rows = _rows(joined, np.cumsum([0, *map(len, sets)]), vocabulary)
    part = np.arange(rows.size) % folds
    every = np.ones(rows.size, bool)
    earlier, links = np.zeros((rows.size, 0)), []
    for i, name in enumerate(categories):
        y = np.array([r[f"y{i}"] for r in got], bool)
        out_of_fold = np.zeros(rows.size)
        for k in range(folds):
            model = _fit(name, rows, len(vocabulary), y, earlier, part != k)
            out_of_fold[part == k] = _probability(_odds(rows, model, earlier))[part == k]
        links.append(_fit(name, rows, len(vocabulary), y, earlier, every))
        earlier = np.column_stack([earlier, out_of_fold])
    return Chain(vocabulary, links)


def _without_copies(rows: list, keys: int = 3) -> list:
    """The sampled rows but for those that share the four least hashes of some order with one before.

    Copies of a text would make its chance words look like words of its category. Of the other rows
    a few go as well, which a sample can spare.
    """
    seen, out = set(), []
    for row in rows:
        words = np.frombuffer(row["hashes"], np.uint64)
        own = {(k, *np.sort(mixed(words ^ np.uint64(k * 0x9E3779B9)))[:4].tolist()) for k in range(keys)}
        if not own & seen:
            out.append(row)
        seen |= own
    return out


def _features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words and of their first bytes, text by text, and where texts begin."""
    import pyarrow as pa

    data, offsets = text_bytes(pa.array(texts, pa.string()))
    words, places = hashed_words(data, offsets, MARKS)
    heads, _ = hashed_words(data, offsets, MARKS, HEAD)
    return np.column_stack([words, ~heads]).ravel(), 2 * places


def _distinct_words():
    def call(texts):
        words, places = _features(texts)
        return ([np.unique(words[a:b]).tobytes() for a, b in zip(places[:-1], places[1:], strict=True)],)

    return call


def predict(docs: DataFrame, chain: Chain, text: str = "text", prefix: str = "p_") -> DataFrame:
    """``docs`` with the probability of each category, from the whole text; all rows and columns stay.

    A null text counts as one without words. Equal texts get equal results, with any doc_id or none. A
    task holds about four megabytes of text, or one text of any length.
    """

    def make():
        def call(texts):
            rows = _rows(*_features(texts), chain.vocabulary)
            earlier = np.zeros((rows.size, 0))
            for link in chain.links:
                earlier = np.column_stack([earlier, _probability(_odds(rows, link, earlier))])
            return list(earlier.T)

        return call

    return appended(docs, text, [(prefix + link.category, T.DoubleType()) for link in chain.links], make, 1 << 22)
