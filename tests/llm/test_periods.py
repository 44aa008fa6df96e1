"""Runs against a search over all periods, and the query against plain Python."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entries
from statloom.llm import periods

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            # A multiple of a shorter period gives the same stretch again.
            if length >= max(6, 4 * q) and (start, length) not in out:
                out[start, length] = q
            i += 1
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


periodic = st.builds(
    lambda head, unit, times, tail: head + unit * times + tail,
    *(st.lists(st.integers(0, 3), max_size=6),) * 2, st.integers(0, 9),
    st.lists(st.integers(0, 3), max_size=6))


@settings(max_examples=400, deadline=None)
@given(st.lists(periodic, max_size=4).map(lambda parts: sum(parts, [])))
def test_runs_of_one_text(w):
    n = len(w)
    got = periods.runs_of(np.array(w, dtype=np.uint64), np.zeros(n, int), np.full(n, n))
    assert got == plain_runs(w)


def planted(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def expected(doc_id, text):
    w = planted(doc_id, text)
    runs = plain_runs(w)
    s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    hexed = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), s, n, q, n and 1000 * n // q,
            hexed("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            hexed(plain_collapsed(w, runs)))


def test_query(spark):
    got = entries.queries()["op13_descending_lcp_runs"](spark, entries.SMOKE_DIR).collect()
    rows = spark.read.parquet(f"{entries.SMOKE_DIR}/documents.parquet").collect()
    assert sorted(map(tuple, got)) == sorted(expected(r.doc_id, r.text) for r in rows)
    assert sum(r.n_runs > 0 for r in got) > 10


def test_odd_rows(documents):
    rows = [(None, None), (None, "x " * 9), (1, ""), (2, " \n\t "), (3, "a b " * 4 + "a"), (3, "a b " * 4 + "a"),
            (4, "é ü " * 40_000), (5, " ".join(f"w{i}" for i in range(1500)) + " z" * 6),
            (6, "one"), (20, "p q r " * 5)]
    got = periods.digest(periods.find(periods.planted(
        documents(rows, extra=("runs", "longest", "collapsed", "n_words", "start"))))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(*r)) for r in rows)
    assert periods.find(documents([])).count() == 0


def test_collapsed_text(documents):
    (row,) = periods.find(documents([(1, "so no no no no no no  yes\nyes")])).collect()
    assert row.collapsed == "so no yes yes"
    assert [tuple(r) for r in row.runs] == [(1, 6, 1)]


def test_very_long_text(documents):
    (row,) = periods.find(documents([(1, "é ü " * 100_000 + " ".join(f"w{i}" for i in range(100_000)))])).collect()
    assert [tuple(r) for r in row.runs] == [(0, 200_000, 2)] and row.n_words == 300_000
    assert row.collapsed.startswith("é ü w0 w1 ")
