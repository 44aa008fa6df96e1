"""Words of many texts at once, as numpy arrays over the bytes of an Arrow text column.

A word is a run of bytes other than space and \\x09-\\x0D. Every helper takes whole texts; a null
text counts as empty. Memory follows the block, and a block is never less than one whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
IS_WORD = ~_SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_SHINGLE = [int(x) | 1 for x in _rng.integers(0, 1 << 63, 64, dtype=np.uint64)]


class Block:
    """Some whole texts: their bytes, and where each begins and ends."""

    def __init__(self, first: int, data: np.ndarray, ends: np.ndarray):
        self.first, self.data, self.ends = first, data, ends
        self.starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends

    def __len__(self) -> int:
        return len(self.ends)


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's texts in order, cut between texts into blocks of about `limit` bytes."""
    if not len(column):
        return
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset:][:len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(column):
        upto = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        upto = min(max(upto, at + 1), len(column))
        yield Block(at, data[offsets[at]:offsets[upto]], offsets[at + 1:upto + 1] - offsets[at])
        at = upto


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Powers:
    """Powers of the step and of its inverse, kept while blocks have about one size."""

    up = down = np.zeros(0, np.uint64)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > BLOCK_BYTES + 1:
            return _powers(_STEP, n), _powers(_BACK, n)
        if len(cls.up) < n:
            cls.up, cls.down = _powers(_STEP, n), _powers(_BACK, n)
        return cls.up[:n], cls.down[:n]


def _running(data: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _Powers.of(len(data) + 1)[0][:-1], out=total[1:])
    return total


def _between(total: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    sums = (total[end] - total[begin]) * _Powers.of(len(total))[1][begin]
    return mix(sums + (end - begin).astype(np.uint64))


def byte_ranges(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of ranges of bytes: equal bytes, equal hash."""
    return _between(_running(data), begin, end)


class Words:
    """The words of a block: byte ranges, the text each belongs to, and 64-bit hashes."""

    def __init__(self, block: Block, lower: bool = False, inside: np.ndarray = IS_WORD):
        data = LOWER[block.data] if lower else block.data
        inside = inside[data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        filled = block.starts < block.ends
        before[block.starts[filled]] = False
        self.data, self.inside = data, inside
        self._total = None
        self.begin = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[block.ends[filled] - 1] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        #: Word number range of text i: first[i]:first[i + 1].
        self.first = np.searchsorted(self.begin, np.append(block.starts, len(data)))
        self.counts = np.diff(self.first)

    def ranges(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the byte ranges: equal bytes, equal hash."""
        if self._total is None:
            self._total = _running(self.data)
        return _between(self._total, begin, end)

    def hashes(self) -> np.ndarray:
        return self.ranges(self.begin, self.end)


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of `size` words (repeats kept), and where each text's begin.

    A text with fewer words has one shingle, its whole sequence; one without words has none.
    """
    counts = np.diff(first)
    n = len(hashes)
    runs = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        runs[:n - k] += np.roll(hashes, -k)[:n - k] * np.uint64(_SHINGLE[k])
    owner = np.repeat(np.arange(len(counts)), counts)
    left = first[1:][owner] - np.arange(n)
    full = left >= size
    short = (np.arange(n) == first[:-1][owner]) & (counts[owner] < size)
    if short.any():
        for i in np.flatnonzero(short):
            own = hashes[i:first[owner[i] + 1]]
            with np.errstate(over="ignore"):
                runs[i] = np.uint64(_SHINGLE[size + len(own)]) + sum(
                    (h * np.uint64(_SHINGLE[k]) for k, h in enumerate(own)), np.uint64(0))
    keep = full | short
    begin = np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(counts)))])
    return mix(runs[keep]), begin.astype(np.int64)
