"""Language by cross-parsing: which language's sample lets a text be said in the fewest phrases.

For each language a suffix automaton of labelled text recognises all of its substrings. A text is
parsed from left to right into longest matches in the automaton; the number of phrases, times the
bits that name a place in the sample, estimates the cross entropy. The least one wins.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.llm.common import appended, hash_order

UNKNOWN, GAP = 0, 1  # symbols: a letter that no sample has; all that is no letter
ROOT = 1  # state 0 means: no such transition
#: symbols of a text that are parsed one after the other; blocks of a long text side by side
BLOCK = 512
#: characters of text that a call parses at once; a worker holds some twenty bytes for each
PIECE = 1 << 20


class Table(NamedTuple):
    """Transitions, packed: that of a state by a symbol is in slot base[state] + symbol, if it owns the slot."""

    base: np.ndarray
    owner: np.ndarray
    to: np.ndarray

    def next(self, state: np.ndarray | int, symbol: np.ndarray) -> np.ndarray:
        slot = self.base[state] + symbol
        return np.where(self.owner[slot] == state, self.to[slot], 0)


class Model(NamedTuple):
    languages: list[str]
    letters: str  # the letter with symbol 2, 3, ...: every letter of the samples
    tables: list[Table]  # of each language
    bits: list[float]  # to name a place in the sample


def _packed(moves: list[dict[int, int]], width: int) -> Table:
    """Rows laid over each other so that no two take a slot: long ones first, those of one move in what is free."""
    base = np.zeros(len(moves), np.int32)
    taken = bytearray(2 * width + 4 * sum(map(len, moves)))
    begin = width  # slots below stay free, so that no base is negative
    order = sorted((i for i, m in enumerate(moves) if len(m) > 1), key=lambda i: -len(moves[i]))
    for i in order:
        symbols = sorted(moves[i])
        low = symbols[0]
        at, tries = begin, 0
        while any(taken[at + s - low] for s in symbols):
            at, tries = at + 1, tries + 1
            if at + symbols[-1] - low >= len(taken):
                taken.extend(bytes(len(taken)))
        if tries > 64:
            begin += tries // 2
        for s in symbols:
            taken[at + s - low] = 1
        base[i] = at - low
    slot = width - 1
    for i, m in enumerate(moves):
        if len(m) == 1:
            slot = taken.find(0, slot + 1)
            if slot < 0:
                slot = len(taken)
                taken.extend(bytes(len(taken)))
            base[i] = slot - next(iter(m))
    size = int(base.max()) + width
    owner, to = np.zeros(size, np.int32), np.zeros(size, np.int32)
    for i, m in enumerate(moves):
        for s, j in m.items():
            owner[base[i] + s], to[base[i] + s] = i, j
    return Table(base, owner, to)


def _automaton(symbols: list[int], width: int) -> Table:
    """Transitions of the suffix automaton of a sample; the root is state 1."""
    moves: list[dict[int, int]] = [{}, {}]
    link, length, last = [0, 0], [-1, 0], ROOT
    for s in symbols:
        if s == UNKNOWN:  # the join of two pieces: no match runs over it
            last = ROOT
            continue
        if s in moves[last] and length[moves[last][s]] == length[last] + 1:
            last = moves[last][s]
            continue
        split_only = s in moves[last]
        state = last
        if not split_only:
            moves.append({})
            length.append(length[last] + 1)
            link.append(ROOT)
            new = len(moves) - 1
            while state and s not in moves[state]:
                moves[state][s] = new
                state = link[state]
        if state:
            to = moves[state][s]
            if length[to] != length[state] + 1:
                moves.append(dict(moves[to]))
                length.append(length[state] + 1)
                link.append(link[to])
                copy = len(moves) - 1
                link[to] = copy
                while state and moves[state].get(s) == to:
                    moves[state][s] = copy
                    state = link[state]
                to = copy
            if split_only:
                last = to
                continue
            link[new] = to
        last = new
    return _packed(moves, width)


class Parser:
    """Counts phrases of texts under a model, many texts at a time."""

    def __init__(self, model: Model):
        self.model = model
        points = np.arange(0x110000)
        letter = np.fromiter(map(str.isalpha, map(chr, points)), bool, len(points))
        self.symbol = np.where(letter, UNKNOWN, GAP).astype(np.int32)
        for i, c in enumerate(model.letters):
            self.symbol[ord(c)] = i + 2
        self.letter = letter

    def symbols(self, text: str) -> tuple[np.ndarray, bool]:
        """The text's symbols, runs of gaps as one, and whether it has a letter."""
        points = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        out = self.symbol[points]
        gap = out == GAP
        keep = ~gap
        keep[1:] |= ~gap[:-1]
        return out[keep], bool(self.letter[points].any())

    def phrases(self, texts: list[np.ndarray], block: int = BLOCK) -> np.ndarray:
        """phrases[language, text] of the one parse of each whole text, whatever ``block`` is.

        Each block of a text is parsed from its own first symbol, all blocks side by side; then each
        parse runs on over the blocks behind its own until it begins a phrase where the parse of such a
        block does, from where on both are the same. So the parse of a text is put together from those
        of its blocks, each from the place where the one before it met it.
        """
        sizes = np.array([len(t) for t in texts], np.int64)
        out = np.zeros((len(self.model.tables), len(texts)))
        if not sizes.sum():
            return out
        ends = np.cumsum(sizes)
        joined = np.concatenate([*texts, np.zeros(1, np.int32)])
        blocks = -(-sizes // block)
        text = np.repeat(np.arange(len(texts)), blocks)
        place = np.arange(len(text)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = (ends - sizes)[text] + place * block
        stop = np.minimum(begin + block, ends[text])
        order = np.argsort(begin - stop, kind="stable")
        active = np.searchsorted((begin - stop)[order], -np.arange(1, int((stop - begin).max()) + 1), "right")
        for k, table in enumerate(self.model.tables):
            first = table.next(ROOT, np.arange(len(self.model.letters) + 2, dtype=np.int32))

            def step(state: np.ndarray, symbol: np.ndarray, table: Table = table, first: np.ndarray = first):
                """The states behind a symbol, and whether a phrase begins with it."""
                to = table.next(state, symbol)
                ended = to == 0
                again = first[symbol[ended]]
                again[again == 0] = ROOT  # a symbol that the sample lacks is a phrase of its own
                to[ended] = again
                return to, ended | (state == ROOT)

            state = np.full(len(text), ROOT, np.int32)
            begins = np.zeros(len(joined), bool)  # phrases of each block's own parse
            for t, n in enumerate(active.tolist()):
                own = order[:n]
                at = begin[own] + t
                state[own], begins[at] = step(state[own], joined[at])
            # every parse runs on to where it meets another, or to the end of the text
            meets, more = ends[text].copy(), np.zeros(len(text), np.int64)
            going = np.flatnonzero(stop < ends[text])
            at = stop[going]
            while len(going):
                state[going], new = step(state[going], joined[at])
                met = new & begins[at]
                meets[going[met]] = at[met]
                more[going] += new & ~met
                keep = ~met & (at + 1 < ends[text[going]])
                going, at = going[keep], at[keep] + 1
            # from the first block of each text along the places where parses meet
            before = np.zeros(len(joined) + 1, np.int32 if len(joined) < 1 << 31 else np.int64)
            np.cumsum(begins, dtype=before.dtype, out=before[1:])
            now = np.flatnonzero(place == 0)
            since = begin[now]
            while len(now):
                out[k] += np.bincount(text[now], before[stop[now]] - before[since] + more[now], len(texts))
                on = meets[now] < ends[text[now]]
                now, since = now[on], meets[now[on]]
                now = now + (since - begin[now]) // block
        return out


def learn(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", held_out: F.Column | None = None,
    pieces: int = 96, piece_chars: int = 256,
) -> Model:
    """A model of the languages of ``lang``, from ``pieces`` pieces of ``piece_chars`` characters each.

    The pieces are a bounded sample: at hashed places of documents chosen by hash, among rows with a
    text and a language that ``held_out`` does not mark. The driver gets these pieces alone. No
    labelled row: a model without languages.
    """
    held = held_out if held_out is not None else F.lit(False)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"), held.alias("held"))
    rows = rows.where("text is not null and lang is not null and not coalesce(held, false)").drop("held")
    # texts stay where they are until the rows are chosen by id and language alone, and unchosen rows
    # as well: the shares are one number for each language, of which the driver holds a model
    named = rows.select("doc_id", "lang")
    share = F.broadcast(named.groupBy("lang").agg((F.lit(4.0 * pieces) / F.count("*")).alias("share")))
    chosen = hash_order("doc_id", F.lit("language"))
    first = Window.partitionBy("lang").orderBy("u", "doc_id")
    named = named.join(share, "lang").where(chosen < F.col("share")).select("lang", "doc_id", chosen.alias("u")).distinct()
    named = named.withColumn("n", F.row_number().over(first)).where(F.col("n") <= pieces)
    named = named.select(F.col("lang").alias("of"), F.col("doc_id").alias("id"), "n")
    at = F.floor(hash_order("doc_id", F.lit("place")) * F.greatest(F.length("text") - piece_chars, F.lit(0))) + 1
    piece = F.substring(F.col("text"), at.cast("int"), F.lit(piece_chars))
    same = (F.col("lang") == F.col("of")) & F.col("doc_id").eqNullSafe(F.col("id"))
    # at most ``pieces`` rows a language
    rows = rows.join(F.broadcast(named), same).groupBy("lang", "n").agg(F.min(piece).alias("piece"))
    sample: dict[str, list[str]] = {}
    for row in sorted(rows.collect(), key=lambda r: (r["lang"], r["n"])):
        sample.setdefault(row["lang"], []).append(row["piece"].lower())
    return model_of(sample)


def model_of(sample: dict[str, list[str]]) -> Model:
    """A model of the pieces of each language."""
    letters = sorted({c for pieces in sample.values() for p in pieces for c in p.lower() if c.isalpha()})
    model = Model(sorted(sample), "".join(letters), [], [])
    parser = Parser(model)
    for name in model.languages:
        symbols = [s for p in sample[name] for s in (*parser.symbols(p)[0].tolist(), UNKNOWN)]
        model.tables.append(_automaton(symbols, len(letters) + 2))
        model.bits.append(math.log2(len(symbols) + 2))
    return model


def predict(
    docs: DataFrame, model: Model, text: str = "text", fields: tuple[str, str] = ("lang_pred", "score"), lettered: str | None = None
) -> DataFrame:
    """``docs`` with the language of each whole text and a score; all rows and columns stay.

    Score: how much fewer bits the language needs than the next one, 0 to 1 (1 if there is no other).
    Ties go to the smaller name. A null text, one without a letter, and any text under a model
    without languages is ``und`` with score 0. Equal texts get equal results. ``lettered`` names one
    more column: whether the text has a letter, under any model.
    """

    def make():
        parser = Parser(model)
        bits = np.array(model.bits)[:, None]

        def call(texts):
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            read = [(i, *parser.symbols(t)) for i, t in enumerate(texts) if t]
            read = [(i, s) for i, s, has in read if has]
            has = [False] * len(texts)
            for i, _ in read:
                has[i] = True
            if read and model.languages:
                need = parser.phrases([s for _, s in read]) * bits
                best = np.argmin(need, axis=0)
                least = need[best, np.arange(len(read))]
                if len(need) > 1:
                    need[best, np.arange(len(read))] = np.inf
                    score = 1 - least / np.maximum(need.min(axis=0), 1e-9)
                else:
                    score = np.ones(len(read))
                for (i, _), b, s in zip(read, best.tolist(), score.tolist(), strict=True):
                    names[i], scores[i] = model.languages[b], s
            return (names, scores, has) if lettered else (names, scores)

        return call

    kinds = [(fields[0], T.StringType()), (fields[1], T.DoubleType())]
    if lettered:
        kinds.append((lettered, T.BooleanType()))
    return appended(docs, text, kinds, make, PIECE)


def fold(doc_id: str = "doc_id") -> F.Column:
    """Whether a document is held out: crc32 of its id as text is divisible by 5; not without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
