"""Near-duplicates against all pairs compared in plain Python."""

from __future__ import annotations

import random
import re

import pytest

from statloom.llm import minmax
from statloom.llm.components import components


def sets_of(rows, size):
    out = []
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(
            c.lower() if "A" <= c <= "Z" else c for c in r[1] or ""))
        if len(words) < size:
            out.append({tuple(words)} if words else set())
        else:
            out.append({tuple(words[i:i + size]) for i in range(len(words) - size + 1)})
    return out


def expected(rows, size, percent):
    sets = sets_of(rows, size)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r[0])
    return sorted((r[0], len(sets[i]), min(groups[root(i)])) for i, r in enumerate(rows))


def found(df, size, percent):
    return sorted((r.doc_id, r.n_shingles, r.component_id)
                  for r in minmax.near_duplicates(df, size, percent).collect())


def family(rng, base, copies, share):
    for _ in range(copies):
        yield " ".join(f"w{rng.randint(0, 10**6)}" if rng.random() < share else w for w in base)


def corpus(seed):
    rng = random.Random(seed)
    texts = []
    for share in (0.005, 0.01, 0.02, 0.03):
        base = [f"w{rng.randint(0, 5000)}" for _ in range(150)]
        texts += [" ".join(base).upper(), *family(rng, base, 40, share)]
    texts += ["", None, "one", "One", "one two", "ONE  two", "a b c", "a b c d", "x " * 500,
              "x " * 700, *(["the very same text of a copy"] * 30)]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_all_pairs(documents, size, percent):
    rows = corpus(size)
    assert found(documents(rows), size, percent) == expected(rows, size, percent)


def test_families_cut_into_tiles(documents, monkeypatch):
    monkeypatch.setattr(minmax, "PART_DOCUMENTS", 7)
    monkeypatch.setattr(minmax, "PART_SHINGLES", 2000)
    rows = corpus(9)
    assert found(documents(rows), 3, 85) == expected(rows, 3, 85)


def test_sample_table(sample):
    df, rows = sample
    assert found(df, 3, 85) == expected([(r.doc_id, r.text) for r in rows], 3, 85)


def test_odd_rows(documents):
    long = "word " * 100_000
    rows = [(None, "a b c d"), (5, "a b c d"), (5, "a b c d"), (9, "A b C d"), (11, long),
            (12, long), (13, None), (14, " \n\t")]
    out = minmax.near_duplicates(documents(rows, extra=("part", "pivot", "n_shingles", "id")), 3, 85)
    got = {(r.doc_id, r.component_id, r.kept) for r in out.collect()}
    assert out.count() == len(rows)
    assert got == {(None, None, True), (5, 5, True), (9, 5, False), (11, 11, True),
                   (12, 11, False), (13, 13, True), (14, 14, True)}
    assert minmax.near_duplicates(documents([])).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(1000, i) for i in range(1001, 1200)]
    edges = spark.createDataFrame(chain + star + [(7, 7)], "u long, v long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {i: 1000 for i in range(1000, 1200)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_bands_keep_the_promised_miss_rate(percent):
    rows = minmax.band_rows(percent)
    assert (1 - (percent / 100) ** rows) ** (128 // rows) <= minmax.MISSED
