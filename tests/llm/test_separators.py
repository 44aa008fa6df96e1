"""Counts from flat files against the tokenizer, for blocks of any length."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statloom.llm import separators
from statloom.session import scratch_path

PLAIN = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def counts(rows):
    return Counter((d, len(PLAIN.encode(t or "", add_special_tokens=False).ids)) for d, t in rows)


def check_places(out):
    """Documents of a file follow each other without a gap."""
    files = {}
    for r in out:
        files.setdefault(r.file, []).append(r)
    for own in files.values():
        own.sort(key=lambda r: r.number)
        assert [r.number for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at + separators.HEADER
            at = r.start + r.n_tokens + 1


@pytest.mark.parametrize("block", [1 << 18, 4096, 7])
def test_sample_table(sample, block):
    df, rows = sample
    out = separators.token_counts(df, block_tokens=block).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in out) == counts([(r.doc_id, r.text) for r in rows])
    check_places(out)


@pytest.mark.parametrize("block", [5, 6, 11, 64])
def test_odd_rows(documents, block):
    rng = random.Random(block)
    rows = [(None, "abc"), (1, None), (2, ""), (2, ""), (-5, "minus"), ((1 << 63) - 1, "large"),
            (-(1 << 63), "small"), (65536, "x"), (0xC480, "Ā Ā"), (7, "word " * 5000)]
    rows += [(100 + i, "w " * rng.randint(0, 12)) for i in range(60)]
    df = documents(rows, extra=("file", "block", "number", "whole"))
    out = separators.token_counts(df, block_tokens=block).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in out) == counts(rows)
    check_places(out)


def test_empty(documents):
    assert separators.token_counts(documents([])).count() == 0


def test_files_are_flat(spark, documents):
    path = scratch_path(spark, "flat")
    separators.write_flat(documents([(3, "one two")]).coalesce(1), path)
    (row,) = spark.read.format("binaryFile").load(path).where("length > 0").collect()
    ids = PLAIN.encode("one two", add_special_tokens=False).ids
    assert np.frombuffer(bytes(row.content), ">u2").tolist() == [3, 0, 0, 0, 0, *ids, separators.END]


def test_files_are_bounded_by_bytes(spark, documents):
    path = scratch_path(spark, "flat")
    rows = [(i, "one two three " * (1 + i % 50)) for i in range(3_000)]
    separators.write_flat(documents(rows).coalesce(1), path, record_bytes=4_096)
    written = spark.read.format("binaryFile").load(path).where("length > 0")
    longest = 2 * (len(PLAIN.encode(rows[49][1]).ids) + separators.HEADER + 1)
    sizes = [r.length for r in written.select("length").collect()]
    assert len(sizes) > 5
    assert max(sizes) <= separators.FILE_RECORDS * (4_096 + longest)
    found = separators.stitched(separators.scan_blocks(spark, path, 1_000)).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in found) == counts(rows)


def test_a_remainder_is_no_document(spark):
    tokens = np.array([1, 0, 0, 0, 0, 9, separators.END, 2, 0, 0, 0, 0, 8], dtype=">u2")
    found = separators.scan_block(tokens, 0, 0)
    assert (found["n_ends"], found["opening"]) == (1, [2, 0, 0, 0, 0])
    assert found["whole"] == [{"doc_id": 1, "number": 0, "start": 5, "n_tokens": 1}]


def test_headers_come_back():
    for value in (None, 0, 1, -1, (1 << 63) - 1, -(1 << 63), 123456789012345):
        header = separators._header(value)
        assert separators._doc_id(header) == value
        assert max(header) < 1 << separators.HEADER_BITS


def test_headers_are_read_alike_in_sql(spark):
    values = [None, 0, 1, -1, (1 << 63) - 1, -(1 << 63), 123456789012345]
    df = spark.createDataFrame([(v, separators._header(v)) for v in values], "v long, h array<int>")
    assert all(r.v == r.got for r in df.select(
        "v", separators._id_of(F.col("h")).alias("got")).collect())
