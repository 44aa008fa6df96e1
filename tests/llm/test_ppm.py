"""PPM code lengths against a coder that walks its trees byte by byte, and held-out accuracy."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from statloom.llm import ppm
from statloom.llm.words import blocks


def trees(texts, order, min_count):
    counts = defaultdict(Counter)
    for text in texts:
        raw = text.encode()
        for length in range(1, order + 2):
            for i in range(len(raw) - length + 1):
                counts[raw[i:i + length - 1]][raw[i + length - 1]] += 1
    return {c: Counter({s: n for s, n in after.items() if not c or n >= min_count})
            for c, after in counts.items()}


def coded(tree, raw, order):
    bits = 0.0
    for i, symbol in enumerate(raw):
        ruled_out = set()
        for k in range(min(order, i), -1, -1):
            after = tree.get(raw[i - k:i])
            open_ = {s: n for s, n in (after or {}).items() if s not in ruled_out}
            if not open_:
                continue
            total = sum(open_.values()) + len(open_)
            if symbol in open_:
                bits -= math.log2(open_[symbol] / total)
                break
            bits -= math.log2(len(open_) / total)
            ruled_out |= open_.keys()
        else:
            bits += math.log2(256 - len(ruled_out))
    return bits


def test_code_lengths(spark):
    rng = random.Random(1)
    corpora = {"aa": ["abcabd abca" * 3, "bca dab"], "bb": ["xyz zyx é" * 4, "abc"]}
    rows = [(lang, t) for lang, ts in corpora.items() for t in ts]
    grams = ppm.count_grams(spark.createDataFrame(rows, "lang string, text string"), 3).collect()
    model = ppm.build([tuple(r) for r in grams], 3, 2)
    texts = ["", "abc", "zyx é abd", *("".join(rng.choices("abcxyz é\n", k=rng.randint(1, 60)))
                                       for _ in range(30))]
    for piece in (7, 1 << 18):
        bits = np.concatenate([ppm.code_lengths(model, b.data, b.ends, piece)
                               for b in blocks(pa.array(texts), 100)])
        for i, lang in enumerate(model.langs):
            tree = trees(corpora[lang], 3, 2)
            for text, got in zip(texts, bits[:, i]):
                # Bytes that no language has are one symbol of the tables.
                assert got == pytest.approx(coded(tree, text.encode(), 3), rel=1e-5, abs=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = ppm.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    share = out.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert share.first()[0] > 0.98


def test_odd_rows(documents):
    rows = [(i, "the cat and the dog", "en", None) for i in range(6)]
    rows += [(i, "der Hund und die Katze", "de", None) for i in range(10, 16)]
    rows += [(20, None, "en", "s"), (21, "", None, "s"), (22, "123 456 !", "en", "s"),
             (None, "the dog", "en", "s"), (23, "die Katze " * 20_000, None, "s"),
             (23, "die Katze " * 20_000, None, "s"), (24, "Ω≠", None, None)]
    out = ppm.identify(documents(rows, extra=("worded", "score", "lang_pred"))).collect()
    assert len(out) == len(rows)
    found = defaultdict(set)
    for r in out:
        assert 0 <= r.score <= 1
        found[r.doc_id].add(r.lang_pred)
    assert found[20] == found[21] == found[22] == {"und"}
    assert found[23] == {"de"} and found[None] == {"en"} and found[24] <= {"en", "de"}


def test_a_language_of_long_texts_is_learned(spark):
    """Beyond the bound texts are taken by their hash until it is met, however few there are."""
    rng = random.Random(4)
    word = lambda letters: "".join(rng.choices(letters, k=5))
    rows = [("few", " ".join(word("abcde") for _ in range(6_000))) for _ in range(3)]
    rows += [("many", " ".join(word("vwxyz") for _ in range(30))) for _ in range(3_000)]
    rows += [("many", rows[-1][1])] * 3_000 + [("few", ""), ("many", None), (None, "abc")]
    docs = spark.createDataFrame(rows, "lang string, text string")
    sizes = {}
    for r in ppm.sample_of(docs, 20_000).collect():
        sizes.setdefault(r.lang, []).append(len(r.text))
    assert len(sizes["few"]) == 1
    assert 20_000 <= sum(sizes["many"]) <= 30_000 and len(sizes["many"]) < 200
    model = ppm.train(docs, train_bytes=20_000)
    assert model.langs == ["few", "many"]
    block, = blocks(pa.array(["abcde edcba", "vwxyz zyxwv"]))
    assert ppm.code_lengths(model, block.data, block.ends).argmin(axis=1).tolist() == [0, 1]


def test_trees_hold_what_was_seen(spark):
    docs = spark.createDataFrame([("a", "abab abab"), ("b", "xyzxyz")], "lang string, text string")
    model = ppm.train(docs)
    for lang, text, tree in zip(model.langs, ("abab abab", "xyzxyz"), model.trees):
        seen = trees([text], 3, 2)
        for k in range(4):
            assert len(tree.runs[k]) == sum(len(v) for c, v in seen.items() if len(c) == k)


def test_nothing_to_learn_from(documents):
    out = ppm.identify(documents([(1, "a b", None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)]
    assert ppm.identify(documents([])).count() == 0
