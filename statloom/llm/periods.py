"""Periodic runs of words, found by uniting suffixes by decreasing common prefix.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends, at
least MIN_POWER * q and MIN_LENGTH words long. Per text, the suffixes are sorted by doubled prefixes, which also
gives the longest common prefix (LCP) of neighbours in that order. The neighbours are united in order of decreasing
LCP, as Kruskal's algorithm takes edges; each class holds its positions in order. Suffixes s and s + q of a run of
length L share L - q words, and none between them shares as many; so when their classes meet, at just
that LCP, the two become neighbours in the merged class. Every pair of positions that become neighbours at a distance
within the LCP is a seed, and a seed is a run if the words before the two differ.

Work: n log n for sorting, and merges of small classes into large ones; only suffixes that share LEAST_SHARED
words with another one take part in those. Memory: a few numbers a word for each doubling up to the longest repeat of a text.

Defined results: a null or blank text has no words, no runs and an empty collapsed text; a null doc_id is kept;
repeated rows give the same result each; other columns are not read; an empty table gives no rows.
Words are compared by 64-bit hashes of their bytes.
"""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.llm.tables import lean, shipped
from statloom.llm.words import Words, blocks, mix

MIN_LENGTH, MIN_POWER = 6, 4
#: The words that the first two copies of the shortest run share.
LEAST_SHARED = MIN_LENGTH - 1
#: A class this many times smaller is put into the larger one place by place.
MUCH_SMALLER = 8

_SCHEMA = ("doc_id long, n_words long, runs array<struct<start long, length long, period long>>, "
           "collapsed string")


def suffix_order(keys: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Positions in suffix order, and the ranks by the first 1, 2, 4, ... words.

    Position i's suffix ends before stop[i]; keys of different texts differ. A rank is the place of the first
    position with an equal prefix.
    """
    n = len(keys)
    order = np.argsort(keys, kind="stable")
    fresh = np.ones(n, dtype=bool)
    fresh[1:] = keys[order[1:]] != keys[order[:-1]]
    rank = np.empty(n, dtype=np.int32)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    ranks, size = [rank], 1
    while True:
        tied = np.flatnonzero(~fresh | ~np.append(fresh[1:], True))
        if not len(tied):
            return order, ranks
        at = order[tied]
        after = at + size
        own = rank[at]
        behind = np.where(after < stop[at], rank[np.minimum(after, n - 1)], -1)
        sort = np.lexsort((behind, own))
        own, behind = own[sort], behind[sort]
        order[tied] = at[sort]
        fresh[tied] = np.append(True, (own[1:] != own[:-1]) | (behind[1:] != behind[:-1]))
        rank = rank.copy()
        rank[order[tied]] = np.maximum.accumulate(np.where(fresh[tied], tied, 0))
        ranks.append(rank)
        size *= 2


def shared_prefixes(order: np.ndarray, ranks: list[np.ndarray], stop: np.ndarray,
                    least: int = LEAST_SHARED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with an LCP of `least` or more, and that LCP; longest first."""
    level = least.bit_length() - 1
    if len(ranks) <= level:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    near = ranks[level]
    close = np.flatnonzero(near[order[1:]] == near[order[:-1]])
    left, right = order[close], order[close + 1]
    lcp = np.zeros(len(left), dtype=np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        i, j = left + lcp, right + lcp
        inside = (i < stop[left]) & (j < stop[right])
        last = len(order) - 1
        lcp += (inside & (ranks[k][np.minimum(i, last)] == ranks[k][np.minimum(j, last)])) << k
    take = np.flatnonzero(lcp >= least)
    take = take[np.argsort(-lcp[take], kind="stable")]
    return left[take], right[take], lcp[take]


def _merged(large: list[int], small: list[int]) -> tuple[list[int], list[tuple[int, int]]]:
    """One ordered list of both, and the pairs that are neighbours only in it."""
    met = []
    places = [bisect(large, x) for x in small]
    for n, (x, k) in enumerate(zip(small, places)):
        if k and (n == 0 or small[n - 1] < large[k - 1]):
            met.append((large[k - 1], x))
        if k < len(large) and (n + 1 == len(small) or large[k] < small[n + 1]):
            met.append((x, large[k]))
    if MUCH_SMALLER * len(small) > len(large):
        return sorted(large + small), met
    for x, k in zip(reversed(small), reversed(places)):
        large.insert(k, x)
    return large, met


def seeds(left: list[int], right: list[int], lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(i, j, LCP) of positions that become neighbours in a class, classes uniting by decreasing LCP."""
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(x: int) -> int:
        if x not in parent:
            parent[x] = x
            members[x] = [x]
            return x
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j, shared in zip(left, right, lcp):
        a, b = root(i), root(j)
        large, small = members[a], members[b]
        if len(large) < len(small):
            a, b, large, small = b, a, small, large
        parent[b] = a
        del members[b]
        members[a], met = _merged(large, small)
        for x, y in met:
            yield x, y, shared


def runs_of(keys: np.ndarray, begin: np.ndarray, stop: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period; positions count over the whole block."""
    out = []
    if len(keys):
        order, ranks = suffix_order(keys, stop)
        edges = shared_prefixes(order, ranks, stop)
        for i, j, shared in seeds(*(e.tolist() for e in edges)):
            period = j - i
            if (shared >= (MIN_POWER - 1) * period and shared + period >= MIN_LENGTH
                    and (i == begin[i] or keys[i - 1] != keys[j - 1])):
                out.append((i, shared + period, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def _joined(words: Words, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of each text's kept words joined by one space, and where each text ends in them."""
    begin, end = words.begin[kept], words.end[kept]
    counts = np.diff(np.concatenate([[0], np.cumsum(kept)])[words.first])
    edge = np.zeros(len(words.data) + 1, dtype=np.int8)
    edge[begin] += 1
    edge[end] -= 1
    copied = np.cumsum(edge[:-1], dtype=np.int8) > 0
    final = np.zeros(len(begin), dtype=bool)
    final[np.cumsum(counts)[counts > 0] - 1] = True
    upto = np.cumsum(end - begin + ~final)
    out = np.full(upto[-1] if len(upto) else 0, 0x20, dtype=np.uint8)
    taken = np.ones(len(out), dtype=bool)
    taken[upto[~final] - 1] = False
    out[taken] = words.data[copied]
    return out, np.concatenate([[0], upto])[np.cumsum(counts)]


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), and collapsed: the words that no
    run contains after its first period, joined by one space."""
    shipped(docs.sparkSession)
    run_type = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def part(ids: pa.Array, words: Words) -> pa.RecordBatch:
        owner = np.repeat(np.arange(len(words.counts)), words.counts)
        begin, stop = words.first[:-1][owner], words.first[1:][owner]
        found = runs_of(words.hashes() + mix(owner.astype(np.uint64)), begin, stop)
        runs = np.array(found, dtype=np.int64).reshape(-1, 3)
        again = np.zeros(len(owner) + 1, dtype=np.int64)
        np.add.at(again, runs[:, 0] + runs[:, 2], 1)
        np.add.at(again, runs[:, 0] + runs[:, 1], -1)
        text, ends = _joined(words, np.cumsum(again[:-1]) == 0)
        of = owner[runs[:, 0]]
        ends_of_runs = np.searchsorted(of, np.arange(len(words.counts) + 1))
        return pa.RecordBatch.from_arrays([
            ids, pa.array(words.counts.astype(np.int64)),
            pa.ListArray.from_arrays(
                pa.array(ends_of_runs, pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(runs[:, 0] - words.first[of]), pa.array(runs[:, 1]),
                     pa.array(runs[:, 2])], fields=list(run_type))),
            pa.LargeStringArray.from_buffers(
                len(words.counts), pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64)),
                pa.py_buffer(text)).cast(pa.string())],
            names=["doc_id", "n_words", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                yield part(batch.column(0).slice(block.first, len(block)), Words(block))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        lean(run), _SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, a tenth of the texts with their words repeated periodically from some word on.

    With h = crc32(decimal doc_id), n words and g = floor(h / 10), where 10 divides h and n > 0: word i from a = g % n
    on becomes word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)). Those words are joined by
    one space; other texts stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    times = F.ceil((n - a) / p).cast("int")
    again = F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")
    hit = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.when(hit, changed).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """Per document: how many runs, the longest (ties: smallest start, then period), and digests."""
    def field(name: str) -> Column:
        return F.col("longest")[name]

    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                    r["period"].cast("string")), F.lit("\n"))))
    best = F.array_min(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    return found.withColumn("longest", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        field("start").alias("start"), (-field("less")).alias("length"),
        field("period").alias("period"),
        F.expr("-longest.less * 1000 div longest.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
