"""Near-duplicate texts by Jaccard similarity of word shingles, through prefixes of token combinations.

Two sets with overlap o share k of their first ``size - o + k`` tokens in any order of all tokens.
Here tokens stand in the order of their frequency, so prefixes hold a set's rarest tokens. A rare
token of the prefix is a key by itself. Frequent tokens are dealt by hash to m classes, and only pairs
within a class are keys; prefixes are m tokens longer for that, because sets that share m + 1 tokens
share a rare one or two of one class. Sets that share a key are compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortspark.llm.common import Scratch, appended, mixed, parallelism, pieces, text_bytes
from cohortspark.llm.graph import components
from cohortspark.llm.words import hashed_words, shingles

PIECE = 1 << 22  # bytes of text whose tokens a task deals out together
BLOCK = 1 << 19  # bytes of text that are hashed at once, or one text
PART = 1 << 22  # bytes of the corpus to a part: tokens go to parts by hash
#: from this many sets on a token is frequent
FREQUENT = 64


class Rule:
    """Jaccard similarity of at least ``percent`` / 100, in whole numbers.

    From 51 on, different sets that are similar share two tokens or more, as the keys need it.
    """

    def __init__(self, percent: int):
        if not 50 < percent <= 100:
            raise ValueError(f"percent must be from 51 to 100, not {percent}")
        self.percent = percent

    def overlap(self, n):
        """Least number of tokens that a set of ``n`` shares with any similar one."""
        return -(-n * self.percent // 100)

    def spare(self, n):
        return n - self.overlap(n)

    def sample(self, n):
        """Tokens of the first, hash-ordered prefix beyond the spare ones."""
        return -(-n // 10)

    def similar(self, a: int, b: int, shared: int) -> bool:
        return 100 * shared >= self.percent * (a + b - shared)


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of each text and where texts begin; hashes some texts at a time."""
    rows = pa.RecordBatch.from_arrays([texts], ["text"])
    tokens, places = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for part in pieces(rows, 0, BLOCK):
        words, at = hashed_words(*text_bytes(part.column(0)))
        own, at = shingles(words, at, width)
        tokens.append(own)
        places.append(at[1:] + places[-1][-1])
    return np.concatenate(tokens), np.concatenate(places)


def _name(tokens: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.md5(tokens.tobytes(), usedforsecurity=False).digest()


def _short(names: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(names), np.int64)[::2]


def _slices(sizes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Indices start .. start + size of all rows, one after the other."""
    at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return at + np.repeat(starts, sizes)


def _part_of(token: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """A stable order of tokens by part, and where each part begins in it."""
    part = (token % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part.astype(np.uint16) if parts < 65536 else part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _cut(token: np.ndarray) -> np.ndarray:
    """The bits of tokens that are compared within a part: a clash only makes a token look more common."""
    return (token >> np.uint64(24)).astype(np.uint32)


# What goes to a part: a row of the survey (n is set), or tokens of a piece. Of these, ``owners`` are the
# places in the piece of the sets that hold them, with ``counts`` tokens each; or, without owners,
# ``counts`` says how many sets of the piece hold each token.
SENT = "part int, piece bigint, place int, doc_id bigint, name binary, short bigint, n bigint, shared bigint, owners binary, counts binary, tokens binary"
_NAMES = [c.split()[0] for c in SENT.split(", ")]
_KINDS = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES)


def _piece_name(parts: list) -> int:
    """A number for a piece that depends on its rows alone, so that a task run again gives it again."""
    digest = hashlib.blake2b(repr(parts).encode(), digest_size=8).digest()
    return int.from_bytes(digest, "little", signed=True)


def _repeated(token: np.ndarray) -> np.ndarray:
    """Which tokens occur again in the list."""
    order = np.argsort(token, kind="stable")
    same = token[order][1:] == token[order][:-1]
    out = np.zeros(len(token), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _freeing(run):
    """``run`` (a table to a table), after which Arrow gives back the memory that it holds for later use."""

    def call(table: pa.Table) -> pa.Table:
        out = run(table)
        pa.default_memory_pool().release_unused()
        return out

    return call


def _survey(docs: DataFrame, width: int, rule: Rule, parts: int, work: Scratch) -> DataFrame:
    """Names and sizes of all sets, and how many tokens of a set's hash-ordered prefix others have too.

    Tokens go to parts by hash, piece by piece. One that several sets of a piece hold is counted
    there for all of them and sent once without an owner, so a token of very many texts stays small.
    A part answers each piece in one row. Equal sets of two pieces count as two here.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 1, PIECE):
                tokens, at = _sets(piece.column(1), width)
                sizes = np.diff(at)
                names = [_name(tokens[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)]
                ids = piece.column(0).to_pylist()
                whole = _piece_name([ids, names])
                out, local = [], np.zeros(len(sizes), np.int64)
                full = np.flatnonzero(sizes > 0)
                if len(full):
                    once = np.sort(full[np.unique(_short([names[i] for i in full]), return_index=True)[1]])
                    length = np.minimum(rule.spare(sizes[once]) + rule.sample(sizes[once]), sizes[once])
                    token = tokens[_slices(length, at[:-1][once])]
                    owner = np.repeat(once, length)
                    here = _repeated(token)  # held by another set of the piece
                    local = np.bincount(owner[here], minlength=len(sizes))
                    for alone in (True, False):
                        own = token[~here] if alone else np.unique(token[here])
                        order, edges = _part_of(own, parts)
                        own, who = own[order], owner[~here][order] if alone else None
                        for p in np.flatnonzero(np.diff(edges)).tolist():
                            a, b = edges[p], edges[p + 1]
                            owners = counts = None
                            if alone:
                                new = np.flatnonzero(np.concatenate([[True], who[a + 1 : b] != who[a : b - 1]]))
                                owners = who[a:b][new].astype(np.uint32).tobytes()
                                counts = np.diff(np.append(new, b - a)).astype(np.uint32).tobytes()
                            out.append((p, whole, None, None, None, None, None, None, owners, counts, _cut(own[a:b]).tobytes()))
                short = iter(_short([n for n in names if n]).tolist()) if len(full) else iter(())
                for place, (doc, name, n, c) in enumerate(zip(ids, names, sizes.tolist(), local.tolist(), strict=True)):
                    out.append((whole % parts, whole, place, doc, name, next(short) if name else None, n, c, None, None, None))
                yield _batch(out)

    def count(table: pa.Table) -> pa.Table:
        rows = table.filter(pa.compute.is_valid(table.column("n")))
        sent = table.filter(pa.compute.is_null(table.column("n")))
        token = np.frombuffer(b"".join(sent.column("tokens").to_pylist()), np.uint32)
        shared, out, at = _repeated(token), [], 0
        for whole, owners, counts, raw in zip(*(sent.column(c).to_pylist() for c in ("piece", "owners", "counts", "tokens")), strict=True):
            mine = shared[at : at + len(raw) // 4]
            at += len(mine)
            if owners is not None:
                who = np.repeat(np.frombuffer(owners, np.uint32), np.frombuffer(counts, np.uint32))[mine]
                places, hits = np.unique(who, return_counts=True)
                out.append((None, whole, None, None, None, None, None, None, places.astype(np.uint32).tobytes(), hits.astype(np.uint32).tobytes(), None))
        return pa.concat_tables([pa.Table.from_batches([_batch(out)]), rows.cast(pa.schema(list(zip(_NAMES, _KINDS, strict=True))))])

    def total(table: pa.Table) -> pa.Table:
        rows = table.filter(pa.compute.is_valid(table.column("n")))
        told = table.filter(pa.compute.is_null(table.column("n")))
        places = np.frombuffer(b"".join(told.column("owners").to_pylist()), np.uint32)
        hits = np.frombuffer(b"".join(told.column("counts").to_pylist()), np.uint32)
        place = rows.column("place").to_numpy()
        shared = np.bincount(places, hits, minlength=int(place.max()) + 1 if len(place) else 0)[place] if len(place) else np.zeros(0)
        shared = shared.astype(np.int64) + rows.column("shared").to_numpy()
        return rows.select(["doc_id", "name", "short", "n"]).append_column("shared", pa.array(shared, pa.int64()))

    answers = docs.mapInArrow(send, SENT).groupBy("part").applyInArrow(_freeing(count), SENT)
    return work.keep(answers.groupBy("piece").applyInArrow(_freeing(total), "doc_id bigint, name binary, short bigint, n bigint, shared bigint"))


def _packed_sets(piece: pa.RecordBatch, width: int, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows of a piece's sets (those named), and each of its tokens once with the number of sets that hold it."""
    tokens, at = _sets(piece.column("text"), width)
    keep, out = {}, []
    for name, a, b in zip(piece.column("name").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
        if name not in keep and _name(tokens[a:b]) == name:
            keep[name] = tokens[a:b]
    if not keep:
        return
    whole = _piece_name(list(keep))
    for name, own in keep.items():
        out.append((None, whole, None, None, name, None, len(own), None, None, None, own.tobytes()))
    token, times = np.unique(np.concatenate(list(keep.values())), return_counts=True)
    order, edges = _part_of(token, parts)
    token, times = _cut(token[order]), np.minimum(times, 255).astype(np.uint8)[order]
    for p in np.flatnonzero(np.diff(edges)).tolist():
        a, b = edges[p], edges[p + 1]
        out.append((p, whole, None, None, None, None, None, None, None, times[a:b].tobytes(), token[a:b].tobytes()))
    yield _batch(out)


def _frequencies(table: pa.Table) -> pa.Table:
    """For the tokens of a part, to each piece: in how many sets they are (255 at most)."""
    lists = table.column("tokens").to_pylist()
    token = np.frombuffer(b"".join(lists), np.uint32)
    times = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8)
    back = np.unique(token, return_inverse=True)[1]
    raw = np.minimum(np.bincount(back, times)[back], 255).astype(np.uint8).tobytes()
    ends = np.cumsum([len(x) // 4 for x in lists]).tolist()
    answer = [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    return pa.table({"piece": table.column("piece"), "part": table.column("part"), "counts": pa.array(answer, pa.binary())})


def keys_of(tokens: np.ndarray, times: np.ndarray, rule: Rule) -> np.ndarray:
    """Keys of a set of sorted tokens with their frequencies.

    Sizes fall in bands from a power of two to 200 / percent times it. Similar sizes always have a
    band in common, and a band has one number of classes. Tokens of one set alone are never shared.
    """
    n = len(tokens)
    band = n.bit_length() - 1
    order = np.lexsort((tokens, times))
    out = [np.zeros(0, np.uint64)]
    for j in (band, band - 1):
        if j < 0 or rule.percent * n >= 200 << j:
            continue
        classes = max(1, (1 << j) // 16)
        prefix = order[: rule.spare(n) + classes + 1]
        token, often = tokens[prefix], times[prefix]
        salt = np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (1 << 64) - 1)
        out.append(mixed(token[(often > 1) & (often < FREQUENT)] ^ salt))
        hot = np.sort(token[often >= FREQUENT])
        if len(hot) > 1:
            group = (mixed(hot) % np.uint64(classes)).astype(np.int64)
            by = np.argsort(group, kind="stable")
            hot, group = hot[by], group[by]
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                i, k = np.triu_indices(b - a, 1)
                own = hot[a:b]
                out.append(mixed(mixed(own[i] ^ salt) + own[k]))
    return np.unique(np.concatenate(out))


def _keys(sets: pa.Table, replies: pa.Table, parts: int, rule: Rule) -> pa.Table:
    """Keys of the sets of a piece, which has an answer for each part; ``held``: tokens other sets have too."""
    lists = [np.frombuffer(x, np.uint64) for x in sets.column("tokens").to_pylist()]
    names = sets.column("name").to_pylist()
    token = np.unique(np.concatenate([np.zeros(0, np.uint64), *lists]))
    order, _ = _part_of(token, parts)
    told = dict(zip(replies.column("part").to_pylist(), replies.column("counts").to_pylist(), strict=True))
    often = np.empty(len(token), np.uint8)
    often[order] = np.frombuffer(b"".join(told[p] for p in sorted(told)), np.uint8)
    times = [often[np.searchsorted(token, x)] for x in lists]
    keys = [keys_of(x, t, rule) for x, t in zip(lists, times, strict=True)]
    shared = np.array([int((t > 1).sum()) for t in times], np.int64)
    sizes = [len(k) for k in keys]
    who = np.repeat(np.arange(len(lists)), sizes)
    return pa.table(
        {
            "key": pa.array(np.concatenate([np.zeros(0, np.uint64), *keys]).astype(np.int64)),
            "name": pa.array(names, pa.binary()).take(pa.array(who)),
            "n": pa.array(np.array([len(x) for x in lists], np.int64)[who]),
            "held": pa.array(shared[who]),
        }
    )


#: bits of a set's sketch; each token flips one
SKETCH = 512
_WORDS = [f"s{i}" for i in range(SKETCH // 64)]


def sketch(tokens: np.ndarray) -> np.ndarray:
    """A set's tokens folded to few bits; sets differ in at least as many tokens as sketches in bits."""
    bits = np.bincount((tokens % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sketch(np.frombuffer(x, np.uint64)) for x in batch.column("tokens").to_pylist()]
        words = np.array(found, np.int64).reshape(-1, len(_WORDS)).T
        yield pa.RecordBatch.from_arrays([batch.column("name"), *map(pa.array, words)], ["name", *_WORDS])


def _verified(pairs: DataFrame, sets: DataFrame, rule: Rule, work: Scratch) -> DataFrame:
    """The pairs (a, b) whose sets are similar; many pairs may have the same b."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                keep.append(rule.similar(len(x), len(y), int((y[at] == x).sum())))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    # the many sets stay in their buckets; the few hubs are written, so that adaptive execution can split
    # the pairs of a hub
    one = pairs.join(sets.select(F.col("name").alias("a"), F.col("tokens").alias("x")), "a")
    hubs = work.keep(sets.join(pairs.select(F.col("b").alias("name")).distinct(), "name").select(F.col("name").alias("b"), F.col("tokens").alias("y")))
    return one.join(hubs, "b").select("a", "b", "x", "y").mapInArrow(test, "a binary, b binary")


def _may_link(rule: Rule) -> Column:
    """Whether any set of a component may be similar to any of another one (``to_``), by the bounds of both.

    Sets of sizes n and m need (100 + percent) * held >= percent * (n + m) of either. Their sketches differ
    at least in the bits that all of one component have and none of the other.
    """
    held = [f"{a}reach >= {rule.percent} * {b}n_least" for a, b in (("", "to_"), ("to_", ""))]
    bits = [f"bit_count((all_{w} & ~to_any_{w}) | (to_all_{w} & ~any_{w}))" for w in _WORDS]
    apart = f"{100 + rule.percent} * ({' + '.join(bits)}) <= {100 - rule.percent} * (n_most + to_n_most)"
    return F.expr(" and ".join([*held, apart]))


def _apart(lists: DataFrame, sets: DataFrame, rule: Rule, near: Column, work: Scratch) -> DataFrame:
    """Pairs (a, b) of sets in different components of which some sets share a key, but for those that a bound rules out.

    Sets that have a long passage in common share hundreds of keys. So keys only tell which components
    meet, each of a key's components once, and only those that bounds on all their sets leave to be
    similar; the sets of two that do then meet a single time.
    """
    still = lists.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r <> s").select("key")
    left = work.keep(lists.join(still, "key", "left_semi"))
    of = left.select("key", "root").distinct()
    # components that meet in many keys with the same company count in one of them
    company = F.struct(F.count(F.lit(1)), F.bit_xor(F.xxhash64("root")), F.bit_xor(F.xxhash64("root", F.lit(1)))).alias("company")
    once = work.keep(of.groupBy("key").agg(company).groupBy("company").agg(F.min("key").alias("key")).select("key"))
    folded = sets.mapInArrow(_sketches, "name binary, " + ", ".join(f"{w} bigint" for w in _WORDS))
    members = work.keep(left.select("name", "n", "held", "root").distinct().join(folded, "name"))
    # a component's bounds: the sizes and the reach of its sets, and the bits that all or any of their sketches have
    bounds = members.groupBy("root").agg(
        F.count(F.lit(1)).alias("size"), F.min("n").alias("n_least"), F.max("n").alias("n_most"),
        F.max((100 + rule.percent) * F.col("held") - rule.percent * F.col("n")).alias("reach"),
        *(F.bit_and(w).alias(f"all_{w}") for w in _WORDS), *(F.bit_or(w).alias(f"any_{w}") for w in _WORDS),
    )
    # the sets of the smaller component go to those of the larger one
    of = work.keep(of.join(once, "key", "left_semi").join(work.keep(bounds), "root"))
    larger = of.select("key", F.col("root").alias("to"), *(F.col(c).alias(f"to_{c}") for c in bounds.columns if c != "root"))
    meet = of.join(larger, "key").where("size < to_size or (size = to_size and root < to)").where(_may_link(rule))
    meet = work.keep(meet.select("root", "to").distinct())
    others = members.select(
        F.col("name").alias("hub"), F.col("n").alias("m"), F.col("held").alias("theirs"), F.col("root").alias("to"),
        *(F.col(w).alias("t" + w) for w in _WORDS),
    )
    apart = sum((F.bit_count(F.col(w).bitwiseXOR(F.col("t" + w))) for w in _WORDS), F.lit(0))
    near &= (100 + rule.percent) * apart <= (100 - rule.percent) * (F.col("n") + F.col("m"))
    pairs = meet.join(members, "root").join(others, "to").where(near)
    return pairs.select(F.least("name", "hub").alias("a"), F.greatest("name", "hub").alias("b"))


def named(docs: DataFrame, field: str, text: str = "text", width: int = 5) -> DataFrame:
    """``docs`` with the name of each text's set of shingles: null for an empty set."""

    def make():
        def call(texts):
            tokens, at = _sets(pa.array(texts, pa.string()), width)
            return ([_name(tokens[a:b]) if b > a else None for a, b in zip(at[:-1], at[1:], strict=True)],)

        return call

    return appended(docs, text, [(field, T.BinaryType())], make, PIECE)


def similar_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80, stars: int = 2,
    name: str | None = None,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id.

    A text's set: its distinct shingles of ``width`` words (A-Z in lower case, words between white
    space); with fewer words, all of them as one; a null text or one without words has an empty set
    and links with nothing. Texts link from ``percent`` (51 to 100) hundredths of Jaccard similarity on.
    component_id is the smallest doc_id in reach (nulls are passed over; a row that reaches none
    keeps its own). Rows that share a doc_id each have a row; equal sets are one and never compared.
    Tokens are 64-bit hashes of whole shingles. ``name`` adds a column of the sets' names, as ``named``
    gives them.

    1. Sets are named and surveyed: of its least spare + n/10 hashes, a set must share a known part
       with others to have a similar one at all. Sets that do not are done.
    2. The others' tokens get their exact frequencies among them; keys follow from prefixes.
    3. The sets of a key are first compared with one of them, in ``stars`` rounds with components in
       between; then, of different components of which some sets share a key, every two sets, once
       however many keys there are. So a group of many copies costs as many comparisons as it has
       members, and no pair goes untested unless a chain of links joins it already, or a bound on the
       overlap rules it out: the tokens that nobody else has, and the bits in which folded sets differ.
    """
    spark = docs.sparkSession
    work, rule = Scratch(spark, "jaccard"), Rule(percent)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # parts grow in number with the bytes, and not in size
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = max(parallelism(spark), -(-total // PART))
    survey = _survey(docs, width, rule, parts, work)
    work.release()
    rows = survey.select("doc_id", "name", "n")
    shared = survey.where("name is not null").groupBy("name").agg(F.max("shared").alias("shared"), F.max("n").alias("n"), F.min("doc_id").alias("of"))
    least = F.ceil(F.ceil(F.col("n") * percent / 100) / 10)
    # a set of n tokens is similar to no other one if not to one with a token more
    large = 100 * F.col("n") >= percent * (F.col("n") + 1)
    active = work.keep(shared.where(large & (F.col("shared") >= least)).select("of", "name"))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, 0, PIECE):
                yield from _packed_sets(piece, width, parts)

    # one plan at every size: the sets to read again grow with the corpus
    chosen = docs.join(active.hint("merge"), F.col("doc_id").eqNullSafe(F.col("of"))).select("text", "name")
    packed = work.keep(chosen.mapInArrow(again, SENT).select("part", "piece", "name", "n", "counts", "tokens"))
    work.drop(active)
    work.release()
    sets = packed.where("part is null").select("piece", "name", "n", "tokens")
    times = packed.where("part is not null").groupBy("part").applyInArrow(_freeing(_frequencies), "piece bigint, part int, counts binary")
    keys = sets.groupBy("piece").cogroup(times.groupBy("piece")).applyInArrow(
        lambda a, b: _keys(a, b, parts, rule), "key bigint, name binary, n bigint, held bigint"
    )
    keys = work.keep(keys.distinct())
    sets = work.keep_by(sets.select("name", "tokens"), "name")
    work.drop(packed)
    work.release()
    links, roots, tested = None, None, None
    # sets share at most what the one with less held by others has; that alone rules out most pairs
    # of copies of one text that have each been changed a lot
    near = F.expr(f"{100 + percent} * least(held, theirs) >= {percent} * (n + m)")
    lists = keys.withColumn("root", F.col("name"))
    for k in range(stars + 1):
        if k < stars:
            # first the set with the least of its own, like the original among its changed copies
            own = F.lit(0) if k else 1 - F.col("held") / F.col("n")
            order = F.struct(own.alias("own"), F.xxhash64("name", F.lit(k)).alias("o"), "name", "n", "held", "root")
            hubs = lists.groupBy("key").agg(F.min(order).alias("h"), (F.min("root") != F.max("root")).alias("open"))
            hubs = hubs.where("open").select("key", F.col("h.name").alias("hub"), F.col("h.n").alias("m"), F.col("h.held").alias("theirs"), F.col("h.root").alias("to"))
            pairs = lists.join(hubs, "key").where((F.col("root") != F.col("to")) & near).select(F.col("name").alias("a"), F.col("hub").alias("b"))
        else:
            pairs = _apart(lists, sets, rule, near, work)
        pairs = pairs.distinct()
        if tested is not None:
            known = tested.union(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
            pairs = pairs.join(known, ["a", "b"], "left_anti")
        pairs = work.keep(pairs)
        found = work.keep(_verified(pairs, sets, rule, work))
        work.release()
        links = found if links is None else links.union(found)
        tested = pairs if tested is None else tested.union(pairs)
        roots = components(links, work)
        lists = keys.join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    named = work.keep(rows.join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name")))
    work.drop(sets, keys)
    # written: adaptive execution splits a large group's rows only in a join without an aggregate
    first = work.keep(named.where("name is not null").groupBy("root").agg(F.min("doc_id").alias("first")))
    out = named.join(first, "root", "left")
    component = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.coalesce("first", "doc_id"))
    more = [F.col("name").alias(name)] if name else []
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), *more)
