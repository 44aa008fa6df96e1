"""Targets and copies against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest

from statloom.llm import mixing


def water_fill(sizes):
    """Targets by resharing what is above the limits until nothing is."""
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode())
    names += [None] if None in sizes else []
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, open_ = {}, set(names)
    left = 1.5 * sum(sizes.values())
    while open_:
        total = sum(weight[n] for n in open_)
        full = {n for n in open_ if left * weight[n] / total >= 2 * sizes[n]}
        if not full:
            return target | {n: left * weight[n] / total for n in open_}
        target |= {n: 2.0 * sizes[n] for n in full}
        left -= sum(target[n] for n in full)
        open_ -= full
    return target


def digest(text):
    return hashlib.md5(text.encode()).hexdigest()


def expected(rows):
    sized = [(d, s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for d, t, _, s in rows]
    sizes = defaultdict(int)
    for _, s, n in sized:
        sizes[s] += n
    target = water_fill(sizes)
    out = []
    for source in sizes:
        offset = int(digest("10:" + ("-" if source is None else "+" + source))[:12], 16) / 16**12
        step = target[source] / sizes[source] if sizes[source] else 0
        own = sorted((n, digest("" if d is None else str(d)), d is not None, d or 0)
                     for d, s, n in sized if s == source)
        for k, (n, _, has, d) in enumerate(own):
            copies = math.floor(offset + step * (k + 1)) - math.floor(offset + step * k)
            out.append((d if has else -1, n, sizes[source], round(target[source], 6), copies * n))
    return sorted(out)


def found(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r["size"], r.source_size,
                   round(r.target, 6), r.taken) for r in mixing.mix(df).collect())


def rows_of(seed):
    rng = random.Random(seed)
    names = ["b", "a", "é", "Z", None, "empty", "big"]
    return [(i, " ".join("w" * rng.randint(0, 30)) if s != "empty" else " \n", "en", s)
            for i in range(800) for s in [rng.choices(names, [3, 1, 1, 5, 2, 1, 30])[0]]]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_python(documents, seed):
    rows = rows_of(seed)
    assert found(documents(rows)) == expected(rows)


def test_equal_ratios(documents):
    """Sources that fill at the same level."""
    rows = [(i, "w " * n, "en", s) for i, (s, n) in enumerate([("a", 5), ("b", 2), ("c", 1)] * 3)]
    assert found(documents(rows)) == expected(rows)


def test_near_the_target(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    by_source = defaultdict(list)
    for r in mixing.mix(df).join(df.select("doc_id", "source"), "doc_id").collect():
        assert r.taken <= 2 * r["size"]
        by_source[r.source].append(r)
    total = 0
    for own in by_source.values():
        taken = sum(r.taken for r in own)
        assert abs(taken - own[0].target) <= 2 * max(r["size"] for r in own)
        total += own[0].target
    assert total == pytest.approx(1.5 * sum(own[0].source_size for own in by_source.values()))


def test_many_partitions_agree(spark, documents):
    df = documents(rows_of(3))
    one = found(df)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        assert found(df) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_odd_rows(documents):
    rows = [(None, "a b", "en", None), (None, "a b", "en", None), (1, None, "en", "s"),
            (1, "", "en", "s"), (2, "w " * 50_000, "en", "t"), (2, "w " * 50_000, "en", "t")]
    assert found(documents(rows, extra=("size", "part", "own", "of"))) == expected(rows)
    assert mixing.mix(documents([])).count() == 0
    assert {r.taken for r in mixing.mix(documents([(1, None), (2, "")])).collect()} == {0}
