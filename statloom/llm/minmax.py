"""Near-duplicate documents by min-max hashing.

Every permutation of the shingles gives two signature values, its least and its greatest, so half
the hash evaluations give the same number of values. Values are banded; documents that share a
band meet. The smallest document of a band is its pivot; the documents that meet under one pivot
form a family, in which links are confirmed on the full sets of shingles. A family gives back only
a spanning forest of its links, and components are joined over all families.

Texts with equal sets are one class, found by a 128-bit digest, before any of this: a hot group of
copies is one document to what follows. A family that is too large for a task is cut into parts
and dealt as tiles of two parts; every pair of the family meets in some tile, so no link is lost,
and no cap drops anything. Bands are as long as a miss probability of MISSED for a pair at the
threshold allows: 5 of 128 values at 85 %, 4 at 80 %.

Defined results: a null or wordless text has no shingles, stands alone and is kept; a document
with a null id is not linked, has a null component and is kept; rows that repeat an id are
reported as often as they occur; other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.llm.components import components
from statloom.llm.tables import lean, settled
from statloom.llm.words import Words, blocks, mix, shingles

PERMUTATIONS = 64
#: A pair at the threshold may be missed with this probability at most.
MISSED = 1e-6
#: A part of a family holds at most about so many documents and shingles.
PART_DOCUMENTS, PART_SHINGLES = 2048, 1 << 20

_SETS = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"


def distinct_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each block: its first text's number, all distinct shingles, and where each text's begin."""
    for block in blocks(column):
        words = Words(block, lower=True)
        hashes, first = shingles(words.hashes(), words.first, size)
        sets = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:])]
        yield (block.first, np.concatenate(sets) if sets else hashes[:0],
               np.cumsum([0, *map(len, sets)]))


def signatures(hashes: np.ndarray, begins: np.ndarray, permutations: int) -> np.ndarray:
    """Least and greatest value of every permutation, for sets that aren't empty."""
    rng = np.random.Generator(np.random.PCG64(4))
    factors = rng.integers(0, 1 << 31, permutations, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    offsets = rng.integers(0, 1 << 32, permutations, dtype=np.uint32)
    top = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((2 * permutations, len(begins)), dtype=np.uint32)
    for k in range(permutations):
        values = top * factors[k] + offsets[k]
        out[k] = np.minimum.reduceat(values, begins)
        out[permutations + k] = np.maximum.reduceat(values, begins)
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band and set."""
    bands = len(signature) // rows
    keys = np.zeros((bands, signature.shape[1]), dtype=np.uint64)
    for r in range(rows):
        keys = mix(keys ^ signature[r * bands:(r + 1) * bands].astype(np.uint64))
    return mix(keys + np.arange(bands, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))


def band_rows(percent: int, permutations: int = PERMUTATIONS) -> int:
    """Values per band: as many as the miss probability allows."""
    alike = percent / 100
    return max([1, *(r for r in range(1, 17)
                     if (1 - alike ** r) ** (2 * permutations // r) <= MISSED)])


def describe(docs: DataFrame, size: int, rows: int,
             permutations: int = PERMUTATIONS) -> DataFrame:
    """doc_id, n_shingles, a digest of the set (d1, d2) and its band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, hashes, begins in distinct_sets(batch.column(1), size):
                counts = np.diff(begins)
                filled = np.flatnonzero(counts)
                digest = np.zeros((2, len(counts)), dtype=np.uint64)
                bands = 2 * permutations // rows
                keys = np.zeros((0, bands), dtype=np.uint64)
                if len(filled):
                    at = begins[:-1][filled]
                    for k in range(2):
                        digest[k, filled] = np.add.reduceat(
                            mix(hashes + np.uint64(0x5851F42D4C957F2D * (k + 1) % (1 << 64))), at)
                    keys = band_keys(signatures(hashes, at, permutations), rows).T
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *np.where(counts > 0, bands, 0)]), pa.int32()),
                    pa.array(np.ascontiguousarray(keys).reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(counts)), pa.array(counts, pa.int64()),
                     pa.array(digest[0].view(np.int64)), pa.array(digest[1].view(np.int64)), lists],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), _SETS)


def _families(classes: DataFrame) -> DataFrame:
    """A row for each document and each tile it is dealt to: pivot, lo, hi, part, id."""
    rows = classes.select("rep", "n_shingles", F.explode("bands").alias("key"))
    pivots = (rows.groupBy("key").agg(F.min("rep").alias("pivot"), F.count("*").alias("n"))
              .where("n > 1").select("key", "pivot"))
    members = rows.join(pivots, "key").groupBy("pivot", "rep").agg(
        F.max("n_shingles").alias("n_shingles"))
    members = settled(members, "members")
    parts = members.groupBy("pivot").agg(F.greatest(
        F.ceil(F.count("*") / PART_DOCUMENTS), F.ceil(F.sum("n_shingles") / PART_SHINGLES))
        .cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")
    return (
        members.join(parts, "pivot").withColumn("part", part)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("pivot", F.least("part", "other").alias("lo"),
                F.greatest("part", "other").alias("hi"), "part", F.col("rep").alias("id"))
    )


def confirm(table: pa.Table, size: int, percent: int) -> pa.Table:
    """A spanning forest of a tile's links: pairs of ids with enough of their sets in common."""
    ids = table["doc_id"].to_numpy()
    part, lo, hi = table["part"].to_numpy(), table["lo"][0].as_py(), table["hi"][0].as_py()
    n = len(ids)
    found = list(distinct_sets(table["text"].combine_chunks(), size))
    counts = np.concatenate([np.diff(b) for _, _, b in found])
    elements = np.concatenate([h for _, h, _ in found])
    owner = np.repeat(np.arange(n), counts)
    _, number, times = np.unique(elements, return_inverse=True, return_counts=True)
    shared = times[number] > 1
    number, owner = number[shared], owner[shared]
    order = np.argsort(number, kind="stable")
    posting = owner[order]
    ends = np.cumsum(np.bincount(number, minlength=len(times)))
    first = np.searchsorted(owner, np.arange(n + 1))

    parent = np.arange(n)

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    left = n - 1
    for i in range(n):
        own = number[first[i]:first[i + 1]]
        if not left or not len(own):
            continue
        length = times[own]
        at = np.arange(length.sum()) + np.repeat(ends[own] - np.cumsum(length), length)
        both = np.bincount(posting[at], minlength=n)
        linked = 100 * both >= percent * (counts[i] + counts - both)
        linked[:i + 1] = False
        if lo != hi:
            linked &= part != part[i]
        for j in np.flatnonzero(linked):
            a, b = root(i), root(int(j))
            if a != b:
                parent[max(a, b)] = min(a, b)
                left -= 1
    roots = np.array([root(i) for i in range(n)])
    moved = np.flatnonzero(roots != np.arange(n))
    return pa.table({"u": pa.array(ids[moved], pa.int64()),
                     "v": pa.array(ids[roots[moved]], pa.int64())})


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each row of doc_id and text.

    Documents are linked when `percent` % of the union of their sets of `size`-word shingles is
    common; component_id is the smallest doc_id that links reach.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = settled(describe(docs, size, band_rows(percent)), "sets")
    classes = settled(
        sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n_shingles")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")), "classes")
    # Tiles grow with the corpus, so they are never broadcast to the texts.
    tiles = _families(classes).join(docs.hint("merge"), F.col("id") == F.col("doc_id")).select(
        "pivot", "lo", "hi", "part", "doc_id", "text")
    links = tiles.groupBy("pivot", "lo", "hi").applyInArrow(
        lambda t: confirm(t, size, percent), "u long, v long")
    labels = (
        classes.select("d1", "d2", "n_shingles", "rep")
        .join(components(links), F.col("rep") == F.col("id"), "left")
        .select("d1", "d2", "n_shingles", F.coalesce("component", "rep").alias("component"))
    )
    return (
        sets.drop("bands").join(labels, ["d1", "d2", "n_shingles"], "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
                .alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )
