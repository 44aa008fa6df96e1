"""Pieces against the tokenizer, and cuts against all ways to cut."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from statloom.llm import packing
from statloom.llm.packing import SEQUENCE, UNPADDED, WINDOW

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECES = ["a", " ", "  ", "\n", "\t", "it's", "don't ", "É", "x1", "1234", "...", "\x1c", "\xa0",
          "\x85", "😀", "word", "Word.", " the", "\r\n", "　", "'", "<|endoftext|>", "<|", "'s", "'ll", "''", "'t's", "s", "é'd",
          " 're", "²", "ⅷ", "ß "]


@pytest.fixture(scope="module")
def encoders():
    """With a table for all pieces, and with one that is emptied all the time."""
    return packing.encoder(VOCABULARY), packing.Encoder(VOCABULARY, 3)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=5))
def test_ids_are_the_tokenizers(encoders, texts):
    plain = Tokenizer.from_file(VOCABULARY)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for coder in encoders:
        got = coder.encode(pa.array([*texts, None], pa.string()))
        assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [*want, []]


def test_ids_of_any_latin_sign(encoders):
    plain = Tokenizer.from_file(VOCABULARY)
    signs = [chr(c) for c in [*range(1, 0x260), 0x370, 0x2028, 0x3000, 0x1F600]]
    texts = [x for s in signs for x in (s, f"a{s}b", f" {s}1", f"{s} {s}", f".{s}\n{s}'s")]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    got = [np.frombuffer(i, "<u4").tolist() for i in encoders[0].encode(pa.array(texts))]
    assert got == want


def test_ids_of_the_sample_table(encoders, sample):
    plain = Tokenizer.from_file(VOCABULARY)
    texts = [r.text for r in sample[1]]
    for coder in encoders:
        got = [np.frombuffer(i, "<u4").tolist() for i in coder.encode(pa.array(texts))]
        assert got == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def cost(cuts, costs, sequence):
    total, before = 0, 0
    for c in cuts:
        n = c - before
        total += (0 if n in UNPADDED else sequence - n) + costs[c] + WINDOW
        before = c
    return total


def best(bounds, costs, sequence):
    """The least cost by trying every window before every boundary."""
    least = {0: 0}
    for j in bounds:
        ways = [v + cost([j - i], {j - i: costs[j]}, sequence) for i, v in least.items()
                if 0 < j - i <= sequence]
        least[j] = min(ways)
    return least[bounds[-1]]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_best(seed):
    rng = random.Random(seed)
    sequence = rng.choice([64, 300, 2048])
    bounds = list(np.cumsum([rng.randint(1, max(1, sequence // rng.choice([1, 4, 20])))
                             for _ in range(rng.randint(1, 150))]))
    costs = {b: rng.choice([0, 4, 24]) for b in bounds}
    got = packing.cuts(bounds, [costs[b] for b in bounds], sequence)
    assert got[-1] == bounds[-1] and set(got) <= set(bounds)
    assert all(b - a <= sequence for a, b in zip([0, *got], got))
    assert cost(got, costs, sequence) == best(bounds, costs, sequence)


def check(rows, out, sequence=SEQUENCE):
    plain = Tokenizer.from_file(VOCABULARY)
    ids_of = defaultdict(list)
    for doc_id, text in rows:
        ids_of[doc_id].append(plain.encode(text or "", add_special_tokens=False).ids + [1])
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in out:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert pieces.keys() == ids_of.keys()
    for doc_id, own in pieces.items():
        assert sum(r.length for r in own) == sum(map(len, ids_of[doc_id]))
        if len(ids_of[doc_id]) == 1:
            ids, at = ids_of[doc_id][0], 0
            for r in sorted(own, key=lambda r: r.start):
                part = np.array(ids[r.start:r.start + r.length], "<u4").tobytes()
                assert r.start == at and r.ids_crc32 == zlib.crc32(part)
                assert r.doc_tokens == len(ids)
                at += r.length
            assert at == len(ids)
    used = padded = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= sequence
        used += at
        padded += at if at & (at - 1) == 0 else sequence
    # Order is kept: sequences by number hold documents by id.
    firsts = [sorted(own, key=lambda r: r.offset)[0].doc_id
              for _, own in sorted(sequences.items())]
    known = [d for d in firsts if d is not None]
    assert known == sorted(known)
    return (padded - used) / max(1, padded)


def test_sample_table(sample):
    df, rows = sample
    assert check([(r.doc_id, r.text) for r in rows], packing.pack(df).collect()) < 0.01


def test_small_blocks(sample):
    df, rows = sample
    out = packing.pack(df, block_tokens=5000).collect()
    assert check([(r.doc_id, r.text) for r in rows], out) < 0.01


def test_odd_rows(documents):
    rows = [(None, "abc"), (1, None), (2, ""), (3, "word " * 60_000), (3, "word " * 60_000),
            (4, "x" * 9000), (5, "😀" * 3000), (6, "two\n\nlines. here")]
    check(rows, packing.pack(documents(rows, extra=("tie", "start", "length"))).collect())
    assert packing.pack(documents([])).count() == 0
    check([(7, None)], packing.pack(documents([(7, None)])).collect())
