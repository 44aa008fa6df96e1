"""Packing documents into sequences by order-preserving dynamic programming.

Documents lie in order of doc_id, each as its tokens and one end token, and the stream is cut into
windows of at most SEQUENCE tokens. Cuts are free at the end of a document, cost a little at the
end of a sentence and more elsewhere. A window is padded to SEQUENCE, unless its length is one of a
few powers of two. The cuts that make padding plus penalties least are found from left to right:
the best way to end at a boundary extends the best way to end at one of the boundaries less than
SEQUENCE before it, and as padding is linear in where a window begins, the best of those is the head
of a monotone queue, so each boundary enters and leaves the queue once.

Documents are range partitioned by doc_id and streamed through their partition; windows are settled a
block of tokens at a time and what follows the last cut is carried into the next block. The remainder
at a partition's end is cut into powers of two if that costs less than padding it.

Defined results: a null text is the end token alone; ties and repeated rows follow each other
in order of a hash of the text, and each is a document; a null doc_id comes first; other
columns are not read; an empty table gives no pieces.
"""

from __future__ import annotations

import unicodedata
import zlib
from bisect import bisect_right
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from statloom.llm.tables import KEPT, lean
from statloom.llm.words import Block, blocks, byte_ranges

SEQUENCE = 2048
END_TOKEN = 1
#: Lengths that need no padding besides SEQUENCE: powers of two.
UNPADDED = (1024, 512, 256, 128)
#: In tokens of padding: a cut at a sentence's end, a cut elsewhere, and a further window.
SENTENCE_CUT, HARD_CUT, WINDOW = 4, 24, 32
#: Where no sentence ends for long, a cut is possible every so many tokens.
HARD_EVERY = 32
BLOCK_TOKENS = 1 << 20
#: Entries of the table from pieces to tokens, which is emptied when full; texts at a time.
KNOWN_PIECES = 1_000_000
PIECE_BYTES = 1 << 20

_PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


def _kinds() -> np.ndarray:
    """0 letter, 1 number, 2 other, 3 white space, for the code points of up to two bytes."""
    out = np.full(0x250, 2, dtype=np.uint8)
    for code in range(0x250):
        out[code] = {"L": 0, "N": 1}.get(unicodedata.category(chr(code))[0], 2)
    out[[0x20, *range(0x09, 0x0E), 0x85, 0xA0]] = 3
    return out


_KIND = _kinds()
#: Bytes that begin a code point from 0x250 on, or a second kind of white space, are left to the
#: tokenizer.
_LATIN_END = 0xC9
_SUFFIXES = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def pieces(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Where the pieces of all texts begin, and which texts are beyond the rule.

    Fixed rule of the vocabulary: 's 't 're 've 'm 'll 'd; letters, numbers or other signs with one
    space before; white space up to the last character before a sign; white space.
    """
    data, n = block.data, len(block.data)
    filled = block.starts < block.ends
    odd = np.zeros(len(block), dtype=bool)
    kind = _KIND[data]  # right for ASCII
    lead = np.flatnonzero(data >= 0xC0)
    high = data[lead] >= _LATIN_END
    if len(lead):
        code = ((data[lead] & 0x1F).astype(np.int32) << 6) | (
            data[np.minimum(lead + 1, n - 1)] & 0x3F)
        high |= (code == 0x85) | (code == 0xA0) | (code >= 0x250)
        odd[np.searchsorted(block.ends, lead[high], side="right")] = True
        lead, code = lead[~high], code[~high]
        kind[lead] = kind[lead + 1] = _KIND[code]
    space = kind == 3
    first = np.zeros(n, dtype=bool)
    first[block.starts[filled]] = True
    begins = first.copy()
    begins[1:] |= kind[1:] != kind[:-1]
    inner = ~first[1:]
    # A sign takes the space before it; the last white space before a sign is cut off its run.
    begins[1:] &= ~(inner & ~space[1:] & (data[:-1] == 0x20))
    begins[:-1] |= inner & space[:-1] & ~space[1:]
    for at in np.flatnonzero(data == 0x27).tolist():
        alone = begins[at] and at + 1 < n and not first[at + 1] and kind[at + 1] == 0
        if alone:
            tail = data[at + 1:at + 3].tobytes()
            for suffix in _SUFFIXES:
                stop = at + 1 + len(suffix)
                if tail.startswith(suffix) and not first[at + 1:stop].any():
                    begins[at + 1] = False
                    if stop < n:
                        begins[stop] = True
                    break
    return np.flatnonzero(begins), odd


class Encoder:
    """Token ids of texts as little-endian bytes; the tokenizer sees each distinct piece once.

    Byte-level tokenizers cut a text into pieces (words with the space before them, numbers, runs of
    other signs, white space) and encode each piece by itself. Pieces are found here for many texts
    at once, with the cut rule of the vocabulary, and looked up by a 64-bit hash in a bounded table; new
    ones go to the tokenizer. Texts beyond the Latin letters, or with a special token, go to it whole.
    """

    def __init__(self, path: str, known_pieces: int = KNOWN_PIECES):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode()
                        for t in self.tokenizer.get_added_tokens_decoder().values()]
        ends = np.zeros(self.tokenizer.get_vocab_size() + 1, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token[-1] in ".!?" or token.endswith("Ċ")  # Ċ stands for a newline
        self.ends_sentence = ends
        self.limit = known_pieces
        self._forget()

    def _forget(self, at_least: int = 0) -> None:
        # An open-addressing table that is at most half full; a single text may ask for more.
        size = 1 << (2 * max(self.limit, at_least) - 1).bit_length()
        self.keys = np.zeros(size, dtype=np.uint64)
        self.place = np.zeros(size, dtype=np.int32)
        self.count = 0
        self.begin = np.zeros(1 << 16, dtype=np.int64)  # of each piece in ids, and the end
        self.ids = np.zeros(1 << 18, dtype="<u4")

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """For each hash its slot, or the free one where it belongs."""
        mask = np.uint64(len(self.keys) - 1)
        slot = (hashes & mask).astype(np.int64)
        open_ = np.flatnonzero((self.keys[slot] != hashes) & (self.keys[slot] != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & int(mask)
            there = self.keys[slot[open_]]
            open_ = open_[(there != hashes[open_]) & (there != 0)]
        return slot

    def _learn(self, block: Block, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Put the pieces of these hashes into the table."""
        fresh, at = np.unique(hashes, return_index=True)
        raw = block.data.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(begin[at].tolist(), end[at].tolist())]
        ids, sizes = self._encode_pieces(texts)
        self._append(ids, sizes)
        left = np.arange(len(fresh))
        while len(left):  # pieces that want one slot get theirs in turn
            slot, first = np.unique(self._slots(fresh[left]), return_index=True)
            self.keys[slot], self.place[slot] = fresh[left[first]], self.count + left[first]
            left = np.delete(left, first)
        self.count += len(fresh)

    def _append(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        used = self.begin[self.count]
        while len(self.begin) <= self.count + len(sizes):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
        while len(self.ids) < used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.begin[self.count + 1:self.count + 1 + len(sizes)] = used + np.cumsum(sizes)
        self.ids[used:used + len(ids)] = ids

    def _encode_pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, and how many each has.

        Pieces that begin with a space before a sign are encoded as one text, in which the tokenizer
        finds the same pieces again; it numbers them.
        """
        joined = [t[0] == " " and len(t) > 1 and not t[1].isspace() for t in texts]
        parts: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        many = [i for i, j in enumerate(joined) if j]
        if many:
            found = self.tokenizer.encode("".join([texts[i] for i in many]),
                                          add_special_tokens=False)
            counts = np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(many))
            if len(counts) != len(many):
                raise ValueError("the vocabulary cuts texts by another rule")
            ids = np.array(found.ids, dtype="<u4")
            cut = np.concatenate([[0], np.cumsum(counts)]).tolist()
            for i, a, b in zip(many, cut[:-1], cut[1:]):
                parts[i] = ids[a:b]
        single = [i for i, j in enumerate(joined) if not j]
        for i, e in zip(single, self.tokenizer.encode_batch_fast(
                [texts[i] for i in single], add_special_tokens=False)):
            parts[i] = np.array(e.ids, dtype="<u4")
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        return np.concatenate(parts) if parts else np.zeros(0, "<u4"), sizes

    def encode(self, column: pa.Array) -> Iterator[bytes]:
        """The ids of each text, in order."""
        for block in blocks(column, PIECE_BYTES):
            yield from self._encode_block(block)

    def _encode_block(self, block: Block) -> list[bytes]:
        begin, odd = pieces(block)
        for special in self.special:
            raw = block.data.tobytes()
            at = raw.find(special)
            while at >= 0:
                odd[np.searchsorted(block.ends, at, side="right")] = True
                at = raw.find(special, at + 1)
        owner = np.searchsorted(block.ends, begin, side="right")
        end = np.append(begin[1:], len(block.data))
        if odd.any():
            usual = ~odd[owner]
            begin, end, owner = begin[usual], end[usual], owner[usual]
        hashes = byte_ranges(block.data, begin, end) | np.uint64(1)  # 0 marks a free slot
        slot = self._slots(hashes)
        new = self.keys[slot] == 0
        if new.any():
            if self.count + np.count_nonzero(new) > self.limit:
                self._forget(len(hashes))
                new[:] = True
            self._learn(block, hashes[new], begin[new], end[new])
            slot = self._slots(hashes)
        number = self.place[slot]
        first, sizes = self.begin[number], self.begin[number + 1] - self.begin[number]
        upto = np.cumsum(sizes)
        ids = self.ids[np.arange(sizes.sum()) + np.repeat(first - (upto - sizes), sizes)]
        cut = np.searchsorted(owner, np.arange(len(block) + 1))
        cut = np.concatenate([[0], upto])[cut].tolist()
        raw = ids.tobytes()
        out = [raw[4 * a:4 * b] for a, b in zip(cut[:-1], cut[1:])]
        whole = np.flatnonzero(odd)
        if len(whole):
            texts = [block.data[block.starts[i]:block.ends[i]].tobytes().decode() for i in whole]
            for i, e in zip(whole, self.tokenizer.encode_batch_fast(
                    texts, add_special_tokens=False)):
                out[i] = np.array(e.ids, dtype="<u4").tobytes()
        return out


_ENCODERS: dict[str, Encoder] = {}
KEPT.append(_ENCODERS)


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cuts(bounds: list[int], costs: list[int], sequence: int = SEQUENCE,
         more: bool = False) -> list[int]:
    """The best cuts up to the last of `bounds`, increasing positions after 0 with a cost each.

    No two neighbours (0 included) lie more than `sequence` apart. If `more` is to come, the last
    cut is the boundary of the last `sequence` tokens that is cheapest to reach for its place.
    """
    place = [0, *bounds]
    best = [0.0] * len(place)
    origin = [0] * len(place)
    at = {0: 0}
    find = at.get
    sizes = [size for size in UNPADDED if size < sequence]
    queue = deque([(0.0, 0)])  # (best + place, number), increasing in both
    for j in range(1, len(place)):
        here = place[j]
        while place[queue[0][1]] < here - sequence:
            queue.popleft()
        value, i = queue[0]
        value += sequence - here
        for size in sizes:
            k = find(here - size)
            if k is not None and best[k] < value:
                value, i = best[k], k
        value += costs[j - 1] + WINDOW
        best[j], origin[j] = value, i
        at[here] = j
        key = value + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    out, j = [], len(place) - 1
    if more:
        from_ = bisect_right(place, place[-1] - sequence)
        j = min(range(max(1, from_), len(place)),
                key=lambda k: best[k] - WINDOW * place[k] / sequence)
    while j:
        out.append(place[j])
        j = origin[j]
    return out[::-1]


def remainder(length: int, sequence: int = SEQUENCE) -> list[int]:
    """Lengths for a last window: as it is, or in powers of two if the cuts cost less."""
    if (sequence - length) <= (length.bit_count() - 1) * (HARD_CUT + WINDOW) or not length:
        return [length] if length else []
    return [1 << k for k in range(length.bit_length() - 1, -1, -1) if length >> k & 1]


class Stream:
    """Documents of one partition in order; gives pieces once their windows are settled."""

    def __init__(self, ends_sentence: np.ndarray, first_sequence: int, sequence: int = SEQUENCE):
        self.ends_sentence, self.sequence = ends_sentence, sequence
        self.next_sequence = first_sequence
        self.docs: list[tuple[int | None, bytes, int]] = []  # id, tokens, begin in the stream
        self.end = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, ids, self.end))
        self.end += len(ids) // 4

    def _boundaries(self) -> tuple[list[int], list[int]]:
        places, costs = [], []
        for _, ids, begin in self.docs:
            tokens = np.frombuffer(ids, dtype="<u4")
            stops = np.flatnonzero(self.ends_sentence[tokens]) + 1
            stops = stops[stops < len(tokens) - 1]
            marks = np.concatenate([[0], stops, [len(tokens)]])
            gaps = np.diff(marks) // HARD_EVERY
            extra = (np.repeat(marks[:-1], gaps) + HARD_EVERY * (
                np.arange(gaps.sum()) - np.repeat(np.cumsum(gaps) - gaps, gaps) + 1))
            place = np.concatenate([extra, marks[1:]])
            cost = np.full(len(place), SENTENCE_CUT)
            cost[:len(extra)] = HARD_CUT
            cost[-1] = 0
            place, first = np.unique(place[::-1], return_index=True)
            places.append(place + begin)
            costs.append(cost[::-1][first])
        place, cost = np.concatenate(places), np.concatenate(costs)
        ahead = place > 0
        return place[ahead].tolist(), cost[ahead].tolist()

    def settle(self, last: bool) -> list[tuple]:
        """Pieces of the windows found; without `last` what follows the final cut is kept."""
        if not self.end:
            return []
        found = cuts(*self._boundaries(), self.sequence, more=not last)
        if last:
            before = found[-2] if len(found) > 1 else 0
            found = [*found[:-1], *(before + np.cumsum(remainder(found[-1] - before))).tolist()]
        starts = np.array([0, *found[:-1]])
        stops = np.array(found)
        begin = np.array([b for _, _, b in self.docs])
        done = stops[-1]
        inside = begin[(begin > 0) & (begin < done)]
        piece = np.unique(np.concatenate([starts, inside]))
        piece_end = np.append(piece[1:], done)
        window = np.searchsorted(stops, piece, side="right")
        owner = np.searchsorted(begin, piece, side="right") - 1
        out = []
        for s, e, w, d in zip(piece.tolist(), piece_end.tolist(), window.tolist(), owner.tolist()):
            doc_id, ids, at = self.docs[d]
            out.append((doc_id, s - at, e - s,
                        zlib.crc32(memoryview(ids)[4 * (s - at):4 * (e - at)]), len(ids) // 4,
                        self.next_sequence + w, s - int(starts[w])))
        self.next_sequence += len(found)
        self.end -= int(done)
        self.docs = [(d, ids, at - int(done)) for d, ids, at in self.docs
                     if at + len(ids) // 4 > done]
        return out


def pack(docs: DataFrame, vocabulary: str | None = None, sequence: int = SEQUENCE,
         end_token: int = END_TOKEN, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece of a document that lies in one sequence.

    doc_id, start (tokens of its document before it), length, ids_crc32, doc_tokens, sequence_id and
    offset (tokens of its sequence before it). `vocabulary` is a tokenizers file that every worker
    can open.
    """
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    names = [c.split()[0] for c in _PIECE.split(", ")]
    end = np.array([end_token], dtype="<u4").tobytes()

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        stream = Stream(coder.ends_sentence, TaskContext.get().partitionId() << 32, sequence)
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1))):
                stream.add(doc_id, ids + end)
                if stream.end >= block_tokens and (rows := stream.settle(False)):
                    yield batch_of(rows)
        if rows := stream.settle(True):
            yield batch_of(rows)

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                    F.xxhash64("text").alias("tie"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    return ordered.mapInArrow(lean(run, keep=True), _PIECE)
