"""Document fingerprints: Merkle trees over paragraphs and sections.

Leaves are paragraphs (lines); a long one is cut at sentence ends, or between words where there is
none. A leaf's hash covers its text, a section's the leaves of a run of paragraphs, the root's the
sections. Sections end after a blank line, or after a paragraph whose hash says so, so that an
insertion moves no later border. A fingerprint is the tree as text:

    root|section:leaf,leaf,...|section:leaf,...

Equal texts have equal roots; two trees are compared from the top, and only where sections differ are
leaves looked at, which also tells where an edit lies.

Defined results: a null text is empty, and an empty text has a root and no sections; documents are
taken in descending doc_id, a null doc_id after all others, ties and repeated rows in order of a hash
of their text; a single document is its own next one; other columns are not read; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.llm.tables import lean

#: A paragraph longer than this is cut into leaves of about this many characters.
LEAF_CHARS = 160
#: A paragraph ends its section with a chance of one in so many.
SECTION_PARAGRAPHS = 8
_PART = re.compile(r".{%d,%d}?(?:[.!?](?=\s|$)|$)|.{1,%d}(?=\s|$)|.{1,%d}" % (
    LEAF_CHARS // 2, 2 * LEAF_CHARS, 2 * LEAF_CHARS, 2 * LEAF_CHARS), re.DOTALL)
_ROW = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double")
_FLUSH_CHARS = 4 << 20


def _digest(text: str, size: int) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=size).hexdigest()


def _leaves(paragraph: str) -> list[str]:
    if len(paragraph) <= LEAF_CHARS:
        return [_digest(paragraph, 5)]
    return [_digest(p, 5) for p in _PART.findall(paragraph)]


def fingerprint(text: str | None) -> str:
    """The tree of a text."""
    sections, leaves = [], []
    for paragraph in (text or "").split("\n"):
        if not paragraph or paragraph.isspace():
            if leaves:
                leaves.append(_digest(paragraph, 5))
                sections.append(leaves)
                leaves = []
            elif paragraph or sections:
                sections.append([_digest(paragraph, 5)])
            continue
        own = _leaves(paragraph)
        leaves += own
        if int(own[-1], 16) % SECTION_PARAGRAPHS == 0:
            sections.append(leaves)
            leaves = []
    if leaves:
        sections.append(leaves)
    written = []
    for own in sections:
        joined = ",".join(own)
        written.append(f"{_digest(joined, 8)}:{joined}")
    # The root also covers the text itself: leaves do not say where white space was cut.
    root = _digest("|".join(s[:16] for s in written) + "\n" + (text or ""), 16)
    return "|".join([root, *written])


def likeness(a: str, b: str) -> float:
    """Share of leaves that two trees have in common, 1 for equal roots; from the top down."""
    if a[:32] == b[:32]:
        return 1.0
    left, right = Counter(a.split("|")[1:]), Counter(b.split("|")[1:])
    same = left & right
    leaves = lambda s: s[17:].split(",")
    common = sum(n * len(leaves(s)) for s, n in same.items())
    rest_a = Counter(x for s, n in (left - same).items() for x in leaves(s) * n)
    rest_b = Counter(x for s, n in (right - same).items() for x in leaves(s) * n)
    total = 2 * common + rest_a.total() + rest_b.total()
    return 2 * (common + (rest_a & rest_b).total()) / total if total else 0.0


def differing(a: str, b: str) -> list[int]:
    """Numbers of the first tree's sections that the second lacks: where an edit lies."""
    there = set(b.split("|")[1:])
    return [i for i, s in enumerate(a.split("|")[1:]) if s not in there]


def edited(text: str, following: str) -> str:
    """The text whose last third is replaced by as much of the following one's beginning."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _place(splits: list[int], of: Column) -> Column:
    """How many of the sorted `splits` are at most the value, by binary search.

    The splits enter the plan as one text, which Catalyst folds into one array, so the plan stays
    small however many they are.
    """
    known = F.split(F.lit(",".join(map(str, splits))), ",").cast("array<long>")
    steps = F.array(*(F.lit(1 << k) for k in range(len(splits).bit_length() - 1, -1, -1)))
    return F.aggregate(steps, F.lit(0), lambda acc, step: F.when(
        (acc + step <= len(splits)) & (F.get(known, acc + step - 1) <= of),
        acc + step).otherwise(acc))


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id and text dealt to buckets of neighbouring ids, in descending order inside each.

    Columns bucket, trails, doc_id, text. The first document of the next lower bucket follows a
    bucket's own ones as its trailer, so that every document's next is in its bucket; after the
    lowest bucket comes the first document of all. Buckets are cut at quantiles of the ids, so the
    driver holds one number per bucket. The table of the buckets' first documents has one row per bucket
    too: it is ordered in one task and broadcast.
    """
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        order.alias("order"))
    wanted = [k / parts for k in range(1, parts)]
    splits = sorted({int(x) for x in
                     keyed.select("order").stat.approxQuantile("order", wanted, 0.2 / parts)})
    at = keyed.withColumn("own", _place(splits, F.col("order")) if splits else F.lit(0))
    # The bucket that a bucket's head trails: the next higher one, for the highest the lowest.
    upwards = Window.orderBy("own")
    whole = upwards.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = (
        at.groupBy("own").agg(F.max("order").alias("order"))
        .select("own", "order", F.coalesce(
            F.lead("own").over(upwards),
            F.first("own").over(whole)).alias("before"))
    )
    mine = F.struct(F.col("own").alias("bucket"), F.lit(False).alias("trails"))
    also = F.struct(F.col("before").alias("bucket"), F.lit(True).alias("trails"))
    return (
        at.join(F.broadcast(heads), ["own", "order"], "left")
        .withColumn("to", F.explode(F.when(F.col("before").isNotNull(), F.array(mine, also))
                                    .otherwise(F.array(mine))))
        .select("to.bucket", "to.trails", "doc_id", "text", "order", F.xxhash64("text").alias("tie"))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "trails", F.desc("order"), "tie")
        .select("bucket", "trails", "doc_id", "text")
    )


def compare_neighbours(docs: DataFrame) -> DataFrame:
    """For each row of doc_id and text its tree, its edited text's, and how alike they are.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    fields = [c.split() for c in _ROW.split(", ")]
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def row(doc: tuple, following: tuple) -> tuple:
        doc_id, text, own = doc
        other = edited(text, following[1])
        tree = own if other == text else fingerprint(other)
        return (doc_id, len(text), hashlib.sha256(other.encode()).hexdigest(), own, tree,
                likeness(own, tree), likeness(own, following[2]))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kinds[k]) for c, (_, k) in zip(zip(*rows), fields)],
            names=[n for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        bucket, waiting = None, None
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                for own, trails, doc_id, text in zip(*(c.to_pylist() for c in part.columns)):
                    if own != bucket:
                        bucket, waiting = own, None
                    elif waiting is None:
                        continue  # after the trailer: rows that repeat its id
                    doc = (doc_id, text or "", fingerprint(text))
                    if waiting is not None:
                        rows.append(row(waiting, doc))
                        size += len(waiting[1])
                    waiting = None if trails else doc
                if size > _FLUSH_CHARS:
                    yield batch_of(rows)
                    rows, size = [], 0
        if rows:
            yield batch_of(rows)

    return in_order(docs, parts).mapInArrow(lean(run), _ROW)
