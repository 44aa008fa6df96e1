"""Every stage of the pipeline, on its own input, against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entries
import corpus_pipeline
from statloom.llm import sanitise
from test_minmax import expected as groups_of
from test_mixing import water_fill
from test_packing import check as check_pieces
from test_quality import kept
from test_sanitise import told

COLUMNS = corpus_pipeline.COLUMNS
PATH = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The rows each stage read and gave."""
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    copies = docs.where("doc_id % 5 = 0").selectExpr(
        "doc_id + 100000 AS doc_id", "text || ' addition' AS text", "lang", "source", "n_chars")
    docs = docs.unionByName(copies)
    out = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, PATH)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema).repartition(3)
        out.append(rows)
    return out


def test_names_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "pii", "mix", "pack"]
    assert entries.queries()["pipeline"] is corpus_pipeline.run


def test_quality(steps):
    verdicts = kept([(r.lang, r.source, r.text) for r in steps[0]])
    assert Counter(r for r, k in zip(steps[0], verdicts) if k) == Counter(steps[1])
    assert 0 < len(steps[1]) < len(steps[0])


def test_near_duplicates(steps):
    groups = groups_of([(r.doc_id, r.text) for r in steps[1]], 5, 80)
    assert {r.doc_id for r in steps[2]} == {d for d, _, c in groups if d == c}
    assert len(steps[2]) < len(steps[1])
    assert set(steps[2]) <= set(steps[1])


def test_pii(steps):
    spans = told([(r.doc_id, r.text) for r in steps[2]])
    before = {r.doc_id: r for r in steps[2]}
    assert len(before) == len(steps[3])
    for r in steps[3]:
        found = [x.split(":") for x in spans[r.doc_id].split(",") if x]
        want = sanitise.redacted(before[r.doc_id].text, [
            (int(s), sanitise.KINDS.index(k), int(e)) for k, s, e in found])
        assert (r.text, r.lang, r.source) == (want, before[r.doc_id].lang, before[r.doc_id].source)
        assert r.n_chars == len(want) or not found
    assert any(spans.values())


def test_mix(steps):
    size = lambda r: len((r.text or "").split())
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in steps[3]:
        sizes[r.source] += size(r)
    for r in steps[4]:
        taken[r.source] += size(r)
    target = water_fill(sizes)
    largest = max(size(r) for r in steps[3])
    assert all(abs(taken[s] - target[s]) <= 2 * largest for s in sizes)
    assert set(Counter(steps[4]).values()) <= {1, 2}
    assert set(steps[4]) <= set(steps[3])


def test_packed(steps):
    assert check_pieces([(r.doc_id, r.text) for r in steps[4]], steps[5]) < 0.02


def test_run_gives_pieces(spark):
    out = corpus_pipeline.run(spark, PATH)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                           "offset"]
    assert out.count() > 0


def test_odd_rows(spark, documents):
    rng = random.Random(3)
    text = lambda n=90: " ".join(f"w{rng.randint(0, 99999)}" for _ in range(n))
    same = text()
    rows = [(1, same), (1, same), (2, same), (None, same), (3, text(), None, None), (4, None),
            (5, ""), (6, text() + " a@b.cd", "en", "s"), (7, text(50_000), "en", "t")]
    docs = documents(rows, extra=("stays", "again", "of", "spans", "k", "copies", "total"))
    left = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, PATH)
        left.append(docs.count())
        if "text" in docs.columns:
            assert docs.columns == COLUMNS
    assert left[0] == 7 and left[1] == 5 and left[2] == 5
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, PATH)
        assert empty.count() == 0
