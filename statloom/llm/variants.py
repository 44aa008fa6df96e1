"""Spelling variants of the words of a corpus, grouped under their usual form.

Letters are hashed to SYMBOLS symbols, which maps words to reduced words: an edit of a word edits its reduced word at
most once. Each word's reduced word gets its full one-edit neighbourhood (itself, every deletion, replacement and insertion of
a symbol), the neighbourhood is joined with the reduced vocabulary, and the pairs found are verified on the words
themselves. Reduced words travel as 64-bit hashes.

Most neighbours are no reduced word. A bitmap of the reduced vocabulary drops nearly all of them before the join:
BITS_A_WORD bits a word, MOST_BITS (64 MB) at most, beyond which more of them reach the join and nothing else changes.
No pair is lost: the bitmap has no false negatives, and two words one edit apart always meet.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, at least MIN_CHARS code points
long and seen MIN_COUNT times or more. A word's form is its near word (one code point inserted, deleted or replaced) of
largest count, ties by code-point order, if that count is FACTOR times its own or more. Counts grow along forms, so they
end at a root.

Defined results: a null or empty text has no words; repeated rows count each; other columns are not read; an empty
table gives no rows. Work on a word follows its length and how many words share its neighbours' reduced words.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.tables import lean, settled, shipped
from statloom.llm.words import Block, Words, blocks, mix

MIN_CHARS, MIN_COUNT, FACTOR = 7, 2, 10
SYMBOLS = 8
BITS_A_WORD = 16
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
#: Bits a piece of the bitmap holds while it is gathered.
PIECE_BITS = 1 << 19
#: Words whose neighbours are made at once.
SLICE = 4096

_C3 = 0xC3
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _crc_table()


def _latin(block: Block) -> Block:
    """The block with a blank for every byte of a character beyond U+00FF or between A-Z and U+00C0."""
    data = block.data.copy()
    second = np.zeros(len(data), dtype=bool)
    second[1:] = data[:-1] == _C3
    data[(data >= 0x80) & (data != _C3) & ~second] = 0x20
    return Block(block.first, data, block.ends)


def _gathered(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow column of text."""
    ends = np.cumsum(end - begin)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - np.append(0, ends)[:-1], end - begin)
    return pa.LargeStringArray.from_buffers(
        len(begin), pa.py_buffer(np.append(0, ends).astype(np.int64)),
        pa.py_buffer(np.ascontiguousarray(data[at]))).cast(pa.string())


def _crc_of(state: np.ndarray, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 of the byte ranges, going on from the crc32 of what stands before each."""
    crc = ~state
    for k in range(int((end - begin).max(initial=0))):
        on = np.flatnonzero(begin + k < end)
        crc[on] = (crc[on] >> np.uint32(8)) ^ _CRC[(crc[on] ^ data[begin[on] + k]) & np.uint32(255)]
    return ~crc


def _without(raw: bytes, h: int) -> str:
    text = raw.decode()
    k = h % len(text)
    return text[:k] + text[k + 1:]


def counts(docs: DataFrame, garbled_in: int = 0) -> DataFrame:
    """word, n: the runs of letters of MIN_CHARS code points or more, and how often they occur.

    With garbled_in, where it divides h, the crc32 of `<doc_id>:<run>`, code point h % length of the run is left out
    (a null doc_id is empty text). Counted per batch and task before the shuffle.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                latin = _latin(block)
                words = Words(latin, lower=True, inside=_LETTER)
                wide = np.concatenate([[0], np.cumsum(words.data == _C3)])
                long = (words.end - words.begin) - (wide[words.end] - wide[words.begin]) >= MIN_CHARS
                owner = np.repeat(np.arange(len(block)), words.counts)[long]
                begin, end = words.begin[long], words.end[long]
                key = words.ranges(begin, end)
                _, first, n = np.unique(key + mix(owner.astype(np.uint64)), return_index=True,
                                        return_counts=True)
                begin, end, key, owner = begin[first], end[first], key[first], owner[first]
                other: dict[str, int] = {}
                if garbled_in:
                    state = np.array(
                        [zlib.crc32(f"{'' if i is None else i}:".encode())
                         for i in ids[block.first:block.first + len(block)]], dtype=np.uint32)
                    h = _crc_of(state[owner], words.data, begin, end)
                    hit = h % np.uint32(garbled_in) == 0
                    for i in np.flatnonzero(hit):
                        word = _without(words.data[begin[i]:end[i]].tobytes(), int(h[i]))
                        if len(word) >= MIN_CHARS:
                            other[word] = other.get(word, 0) + int(n[i])
                    begin, end, key, n = begin[~hit], end[~hit], key[~hit], n[~hit]
                _, first, of = np.unique(key, return_index=True, return_inverse=True)
                total = np.bincount(of, weights=n, minlength=len(first)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([_gathered(words.data, begin[first], end[first]),
                                       pa.array(list(other), pa.string())]),
                     pa.array(np.append(total, np.array(list(other.values()), dtype=np.int64)))],
                    names=["word", "n"])

    shipped(docs.sparkSession)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .mapInArrow(lean(run), "word string, n long")
        .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT))


def _symbols(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words' numbers and symbols (1 to SYMBOLS, a row a word), for each length and SLICE of words."""
    for block in blocks(column):
        after = np.zeros(len(block.data), dtype=np.uint64)
        after[1:] = np.where(block.data[:-1] == _C3, 64, 0)
        point = block.data != _C3
        symbol = ((block.data + after) % SYMBOLS + 1)[point].astype(np.uint64)
        ends = np.concatenate([[0], np.cumsum(point)])[block.ends]
        starts = np.concatenate([[0], ends[:-1]])
        lengths = ends - starts
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            for i in range(0, len(own), SLICE):
                some = own[i:i + SLICE]
                yield block.first + some, symbol[starts[some][:, None] + np.arange(length)]


def _place_values(n: int) -> np.ndarray:
    return np.array([pow(_BASE, k, 1 << 64) for k in range(n)], dtype=np.uint64)


def _reduced(symbols: np.ndarray) -> np.ndarray:
    return mix((symbols * _place_values(symbols.shape[1])).sum(axis=1, dtype=np.uint64))


def neighbourhood(symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of all reduced words one edit away from each row, each once, without the row's own."""
    n, length = symbols.shape
    value = _place_values(length + 1)
    total = np.zeros((n, length + 1), dtype=np.uint64)
    np.cumsum(symbols * value[:length], axis=1, out=total[:, 1:])
    whole = total[:, -1]
    for i in range(length + 1):
        before, behind = total[:, i], whole - total[:, i]
        own = symbols[:, i] if i < length else None
        if i < length:
            # Of a run of equal symbols only the last is deleted, and nothing is put before its equal.
            last = np.flatnonzero(own != symbols[:, i + 1]) if i + 1 < length else np.arange(n)
            rest = whole[last] - total[last, i + 1]
            yield last, mix(before[last] + rest * np.uint64(_BACK))
        for symbol in range(1, SYMBOLS + 1):
            c = np.uint64(symbol)
            other = np.flatnonzero(own != c) if i < length else np.arange(n)
            if i < length:
                yield other, mix(whole[other] + (c - own[other]) * value[i])
            yield other, mix(before[other] + value[i:i + 1] * c + behind[other] * np.uint64(_BASE))


def reduced(words: DataFrame) -> DataFrame:
    """word, n and key, the hash of the reduced word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = np.zeros(len(batch), dtype=np.uint64)
            for rows, symbols in _symbols(batch.column(0)):
                key[rows] = _reduced(symbols)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(key.view(np.int64))], names=["word", "n", "key"])

    return words.select("word", "n").mapInArrow(lean(run), "word string, n long, key long")


def bitmap(keys: DataFrame, bits: int) -> np.ndarray:
    """Bytes with the top bits of each key set; gathered in pieces, at most bits / 8 bytes in all."""
    shift = 64 - (bits.bit_length() - 1)
    size = min(bits, PIECE_BITS)

    def piece(group: tuple, table: pa.Table) -> pa.Table:
        own = np.zeros(size, dtype=bool)
        own[table.column("slot").to_numpy() % size] = True
        return pa.table({"piece": [group[0].as_py()], "bits": [np.packbits(own).tobytes()]})

    slot = F.shiftrightunsigned("key", shift)
    pieces = (
        keys.select(slot.alias("slot")).distinct()
        .withColumn("piece", F.floor(F.col("slot") / size))
        .groupBy("piece").applyInArrow(piece, "piece long, bits binary").collect())
    out = np.zeros(bits // 8, dtype=np.uint8)
    for row in pieces:
        out[row.piece * size // 8:][:size // 8] = np.frombuffer(row.bits, dtype=np.uint8)
    return out


def neighbours(words: DataFrame, held: np.ndarray) -> DataFrame:
    """word and key: each word's neighbourhood, as far as the bitmap may hold it."""
    shift = np.uint64(64 - (len(held) * 8).bit_length() + 1)
    shared = words.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for rows, symbols in _symbols(batch.column(0)):
                at, keys = [rows], [_reduced(symbols)]
                for some, key in neighbourhood(symbols):
                    slot = key >> shift
                    on = bits[slot >> np.uint64(3)] >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8) & 1
                    take = np.flatnonzero(on)
                    at.append(rows[some[take]])
                    keys.append(key[take])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.concatenate(at))),
                     pa.array(np.concatenate(keys).view(np.int64))], names=["word", "key"])

    return words.select("word").mapInArrow(lean(run), "word string, key long")


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and best (less: minus its count, other: the word): the near words of each that has some."""
    cells = reduced(words)
    total = words.count()
    # A word's neighbours are much work for few bytes, by which its tasks would be sized.
    width = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = words.repartition(width, "word")
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_WORD * total - 1).bit_length())) if total else LEAST_BITS
    found = neighbours(dealt, bitmap(cells, bits))
    others = cells.withColumnsRenamed({"word": "other", "n": "other_n"})
    return (
        found.hint("merge").join(others, "key")
        .where(F.levenshtein("word", "other", 1) == 1)
        .groupBy("word").agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")))


def with_roots(forms: DataFrame) -> DataFrame:
    """word, form, root of rows that have a form: every round doubles the steps that root has gone."""
    most = forms.agg(F.max("form_n").alias("n")).first()["n"] or 1
    steps = int(math.log(most, FACTOR)) + 1
    at = forms.select("word", "form", F.col("form").alias("root"))
    for _ in range(steps.bit_length()):
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = settled(at.hint("merge").join(ahead, "root", "left").select(
            "word", "form", F.coalesce("further", "root").alias("root")), "roots")
    return at


def groups(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of a vocabulary (word, n)."""
    judged = settled(
        words.hint("merge").join(near_words(words), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(-F.col("best.less") >= FACTOR * F.col("n"), F.col("best.other")).alias("form"),
            F.when(-F.col("best.less") >= FACTOR * F.col("n"), -F.col("best.less")).alias("form_n")),
        "judged")
    rooted = with_roots(judged.where("form IS NOT NULL")).select("word", "root")
    return judged.hint("merge").join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def variants(docs: DataFrame, garbled_in: int = 0) -> DataFrame:
    """The words of a table of documents with their forms and roots."""
    return groups(settled(counts(docs, garbled_in), "vocabulary"))
