"""The machine's margin against the sum over all pairs, and held-out quality."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from statloom.llm import toxicity
from statloom.llm.words import blocks


def test_margin_is_the_sum_over_pairs():
    machine = toxicity.Machine.fresh(np.arange(3))
    rng = np.random.default_rng(5)
    machine.weights[:] = rng.normal(0, 0.3, machine.weights.shape)
    machine.bias = -0.7
    (block,) = blocks(pa.array(["You are a clown, clown", "", None, "ümlaut Überlänge words"]))
    slots, begins = toxicity.terms(block)
    got = machine.margin(slots, begins)
    for i in range(4):
        own = machine.weights[slots[begins[i]:begins[i + 1]]].astype(float)
        want = machine.bias + own[:, 0].sum()
        for a in range(len(own)):
            for b in range(a):
                want += own[a, 1:] @ own[b, 1:]
        assert got[i] == pytest.approx(want, rel=1e-4)
    assert begins[1] == 5 and begins[2] == begins[1] == begins[3]


def test_pairs_are_learned():
    """Two terms that are toxic only together, which a sum of weights cannot tell."""
    rng = np.random.default_rng(1)
    lists, labels = [], []
    for _ in range(3000):
        a, b = rng.random(2) < 0.5
        lists.append(np.array([s for s, on in ((11, a), (22, b)) if on]
                              + list(rng.integers(100, 200, 5)), np.int32))
        labels.append(a == b)
    machine = toxicity.fit(toxicity.Machine.fresh(np.arange(200)), lists, np.array(labels, np.float32), 40, 0)
    flat = np.concatenate(lists)
    begins = np.cumsum([0, *map(len, lists)])
    assert ((machine.margin(flat, begins) > 0) == labels).mean() > 0.9


def test_terms_toxic_only_together(spark):
    """Through the whole operator: one word is neutral by itself, the other nearly, both together are toxic."""
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(12_000):
        mild, target, insult = rng.random() < 0.03, rng.random() < 0.25, rng.random() < 0.01
        words = [f"w{rng.randint(0, 400)}" for _ in range(40)] + ["alphax"] * mild + ["betax"] * target + ["gammax"] * insult
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(mild and target or insult)))
    rows = toxicity.toxicity(spark.createDataFrame(docs, "doc_id long, text string").repartition(8),
                             spark.createDataFrame(labels, "doc_id long, toxic int")).where("held_out").collect()
    flags = {(a, b): [] for a in (False, True) for b in (False, True)}
    for r in rows:
        words = set(docs[r.doc_id][1].split())
        if "gammax" not in words:
            flags["alphax" in words, "betax" in words].append(r.predicted)
    share = {k: sum(v) / len(v) for k, v in flags.items()}
    assert share[True, True] >= 0.9
    assert max(share[True, False], share[False, True], share[False, False]) <= 0.05


def test_held_out(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    caught = [r.predicted for r in rows if r.toxic == 1]
    wrong = [r.predicted for r in rows if r.toxic == 0]
    assert sum(caught) / len(caught) > 0.9
    assert sum(wrong) / len(wrong) < 0.01


def test_odd_rows(spark, documents):
    rows = [(i, "you stupid clown " + "x" * i if i % 2 else f"a fine day {i}") for i in range(200)]
    rows += [(None, None), (None, "stupid"), (300, ""), (301, "word " * 100_000), (5, "again")]
    labels = spark.createDataFrame(
        [(i, 1, i % 2) for i in range(200)] + [(3, 1, 0), (None, 1, 1), (7, 0, None), (999, 0, 1)],
        "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(documents(rows, extra=("slots", "label", "of", "shard")), labels)
    assert got.count() == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.collect())
    assert {r.score for r in toxicity.toxicity(documents(rows), labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(documents([]), labels).count() == 0
