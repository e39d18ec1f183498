"""Periodic runs against a search over all periods."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cohortspark.llm import runs
from cohortspark.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(words, least=12):
    """(start, length, period) of all runs, by trying every period."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, 2 * q) and not any(all(words[k] == words[k + r] for k in range(i, i + length - r)) for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, count):
    draw = random.Random(seed)
    for _ in range(count):
        letters = draw.choice(["a", "ab", "abc", "abcdefgh"])
        words = [draw.choice(letters) for _ in range(draw.randrange(0, 70))]
        if draw.random() < 0.6 and words:
            at, p = draw.randrange(len(words)), draw.randrange(1, 9)
            words = words[:at] + (words[at : at + p] * 20)[: draw.randrange(1, 60)] + words[at:]
        yield words


@pytest.mark.parametrize("least", [12, 2, 5, 7])
def test_against_all_periods(least):
    lists = list(texts(least, 400))
    fibonacci = ["a", "ab"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    lists += [list(fibonacci[-1]), ["x"] * 500, [], ["a"], list("ab") * 100 + list("ba") * 50]
    found = runs.runs_of([[w.encode() for w in x] for x in lists], least)
    rows = list(zip(*(c.tolist() for c in found), strict=True))
    assert rows == [(i, *r) for i, x in enumerate(lists) for r in plain(x, least)]


def test_frame(documents):
    rows = [(i, " ".join(w)) for i, w in enumerate(texts(1, 60))]
    rows += [(100, None), (101, ""), (102, " \t\x0b\x0c\r\n"), (102, "a\tb " * 9), (102, "a\tb " * 9), (None, "é é " * 30), (103, "A a " * 6 + "a a")]
    rows.append((104, "x y z " * 40_000))
    docs = documents(rows, extra=True).withColumn("runs", F.lit("old"))
    out = runs.periodic_runs(docs)
    assert out.columns == [c for c in docs.columns if c != "runs"] + ["runs", "collapsed"]
    got = sorted((repr((r.doc_id, r.text)), [tuple(x) for x in r.runs], r.collapsed) for r in out.collect())
    want = []
    for doc, text in rows:
        words = WORD.findall(text or "")
        found = plain(words) if doc != 104 else [(0, 120_000, 3)]
        want.append((repr((doc, text)), found, collapsed(words, found)))
    assert got == sorted(want)
    assert runs.periodic_runs(documents([])).collect() == []


def test_query(spark, tmp_path, documents):
    rows = [(i, " ".join(w) if i % 7 else None) for i, w in enumerate(texts(5, 200))] + [(None, "a b " * 9)]
    rows += [(1000 + i, " ".join(str(k * k % 83) for k in range(i))) for i in range(0, 200, 5)]
    documents(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect() if r.doc_id is not None)
    want, planted = [], 0
    for doc, text in rows[:200] + rows[201:]:
        words = WORD.findall(text or "")
        h, n = zlib.crc32(str(doc).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            planted += 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        found = plain(words)
        best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        lines = "".join(f"{s},{l},{q}\n" for s, l, q in found)
        one = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, found))]
        want.append((doc, len(found), *one, *sha))
    assert planted > 5
    assert got == sorted(want)
