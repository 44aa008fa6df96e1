"""Token counts from flat token files, by a scan for separators.

A flat file is nothing but 16-bit big-endian token ids: each document's ids, then the end identifier. It has
no index, and a block of it may begin and end inside a document. Blocks are searched for the identifier
with array comparisons. What a block can't know by itself, where the document it begins in started and
which one that is, comes from a prefix scan over one small row per block: the running maximum of the last
end, the running count of ends, and the last opening carried forward.

A document's ids are led by its doc_id as HEADER ids of 13 bits, so that counts can be given by
doc_id; they are not counted. END is beyond the vocabulary and can't occur in a text.

Files are written and read by Spark alone: END is, as bytes, the letter that the text writer puts
after each row. A row is a run of documents of about RECORD_BYTES, with END between them, and a file holds
FILE_RECORDS of those: files are bounded by bytes, about 32 MB and a document for each row at most, however long
or short documents are. A file is read as one row, scanned block by block, and files are dealt to tasks.

Defined results: a null or empty text has 0 tokens; a null doc_id is kept; repeated rows are counted
each; ids after a file's last end belong to no document; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from statloom.llm.packing import encoder
from statloom.llm.tables import lean, settled, shipped
from statloom.session import scratch_path
from statloom.sources import files

#: As bytes C4 80, which is the letter Ā in UTF-8.
END, END_LETTER = 0xC480, "Ā"
HEADER, HEADER_BITS = 5, 13
RECORD_BYTES = 4 << 20
FILE_RECORDS = 8
#: Flat files are scratch: documents are written, scanned and removed in so many slices, so that a
#: part of the corpus lies there at a time.
SLICES = 2
BLOCK_TOKENS = 1 << 18

_BLOCK = ("file string, block long, n_ends long, first_end long, last_end long, head array<int>, "
          "opening array<int>, "
          "whole array<struct<doc_id long, number long, start long, n_tokens long>>")


def _header(doc_id: int | None) -> list[int]:
    value = 1 << 64 if doc_id is None else doc_id & ((1 << 64) - 1)
    return [value >> (HEADER_BITS * k) & ((1 << HEADER_BITS) - 1) for k in range(HEADER)]


def _doc_id(header: list[int]) -> int | None:
    value = sum(h << (HEADER_BITS * k) for k, h in enumerate(header))
    return None if value >> 64 else value - (value >> 63 << 64)


def write_flat(docs: DataFrame, path: str, vocabulary: str | None = None,
               record_bytes: int = RECORD_BYTES) -> None:
    """Write each row of doc_id and text as its header, token ids and END."""
    vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    end = np.array([END], dtype=">u2").tobytes()

    def record(held: list[bytes]) -> pa.RecordBatch:
        # The writer adds the last END.
        return pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary())], names=["flat"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(vocabulary)
        if coder.tokenizer.get_vocab_size() > END:
            raise ValueError("the vocabulary does not leave the end identifier free")
        held, size = [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1))):
                held.append(np.array(_header(doc_id), dtype=">u2").tobytes()
                            + np.frombuffer(ids, dtype="<u4").astype(">u2").tobytes())
                size += len(held[-1])
                if size > record_bytes:
                    yield record(held)
                    held, size = [], 0
        if held:
            yield record(held)

    (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run, keep=True), "flat binary")
     .select(F.col("flat").cast("string").alias("value"))
     .write.option("lineSep", END_LETTER).option("maxRecordsPerFile", FILE_RECORDS).text(path))


def scan_block(tokens: np.ndarray, block: int, base: int) -> dict:
    """What one block of a file knows: its ends, its first ids, what opens after its last end, and the
    documents that lie in it whole."""
    ends = np.flatnonzero(tokens == END)
    starts = ends[:-1] + 1
    last = ends[1:]
    if block == 0 and len(ends):  # the file's first document starts here
        starts, last = np.concatenate([[0], starts]), ends
    first_number = len(ends) - len(last)
    opens = int(ends[-1]) + 1 if len(ends) else 0 if block == 0 else None
    return {
        "n_ends": len(ends),
        "first_end": base + int(ends[0]) if len(ends) else None,
        "last_end": base + int(ends[-1]) if len(ends) else None,
        "head": tokens[:HEADER].tolist(),
        "opening": None if opens is None else tokens[opens:opens + HEADER].tolist(),
        "whole": [{"doc_id": _doc_id(tokens[s:s + HEADER].tolist()), "number": first_number + i,
                   "start": base + s + HEADER, "n_tokens": e - s - HEADER}
                  for i, (s, e) in enumerate(zip(starts.tolist(), last.tolist()))],
    }


def scan_blocks(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """A row per block of the files below a path."""
    names = [c.strip().split()[0] for c in (
        "file", "block", "n_ends", "first_end", "last_end", "head", "opening", "whole")]
    whole = pa.list_(pa.struct([(c, pa.int64()) for c in ("doc_id", "number", "start", "n_tokens")]))
    kinds = [pa.string(), *[pa.int64()] * 4, *[pa.list_(pa.int32())] * 2, whole]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = np.frombuffer(content.as_buffer(), dtype=">u2")
                for block, at in enumerate(range(0, len(tokens), block_tokens)):
                    found = {"file": file, "block": block,
                             **scan_block(tokens[at:at + block_tokens], block, at)}
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([found[n]], k) for n, k in zip(names, kinds)], names=names)

    flat = spark.read.format("binaryFile").load(path).where("length > 0")
    return flat.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInArrow(
        lean(run), _BLOCK)


def _id_of(header: Column) -> Column:
    """doc_id of a header; the topmost id's bit 12 stands for null."""
    part = lambda k: F.get(header, k).cast("long")
    value = part(0)
    for k in range(1, HEADER):
        value = value.bitwiseOR(F.shiftleft(part(k), HEADER_BITS * k))
    return F.when(part(HEADER - 1) < 1 << (64 - HEADER_BITS * (HEADER - 1)), value)


def stitched(blocks: DataFrame) -> DataFrame:
    """file, number, doc_id, start and n_tokens of every document of the scanned files.

    A document that ends in a block but started before it gets its start from the blocks before.
    The scan over a file has one small row per block.
    """
    in_file = Window.partitionBy("file").orderBy("block")
    before = in_file.rowsBetween(Window.unboundedPreceding, -1)
    # An opening may go on in the next block.
    opening = F.when(F.col("opening").isNotNull(), F.slice(F.concat(
        "opening", F.coalesce(F.lead("head").over(in_file), F.array().cast("array<int>"))),
        1, HEADER))
    scanned = (
        blocks.select("file", "block", "n_ends", "first_end", "last_end", opening.alias("opening"))
        .select("file", "block", "n_ends", "first_end",
                F.coalesce(F.sum("n_ends").over(before), F.lit(0)).alias("number"),
                (F.coalesce(F.max("last_end").over(before), F.lit(-1)) + 1).alias("start"),
                F.last("opening", ignorenulls=True).over(before).alias("opening")))
    across = scanned.where("block > 0 AND n_ends > 0").select(
        "file", "number", _id_of(F.col("opening")).alias("doc_id"),
        (F.col("start") + HEADER).alias("start"),
        (F.col("first_end") - F.col("start") - HEADER).alias("n_tokens"))
    inside = (
        blocks.where(F.size("whole") > 0).select("file", "block", F.explode("whole").alias("d"))
        .join(scanned.select("file", "block", F.col("number").alias("ahead")), ["file", "block"])
        .select("file", (F.col("ahead") + F.col("d.number")).alias("number"), "d.doc_id",
                "d.start", "d.n_tokens"))
    return inside.unionByName(across)


def token_counts(docs: DataFrame, vocabulary: str | None = None,
                 block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Write the documents as flat files and scan them: file, number, doc_id, start, n_tokens."""
    spark = docs.sparkSession
    shipped(spark)
    slice_of = F.pmod(F.xxhash64("doc_id", "text"), F.lit(SLICES))
    found = []
    for i in range(SLICES):
        path = scratch_path(spark, "flat")
        write_flat(docs.where(slice_of == i), path, vocabulary)
        found.append(settled(scan_blocks(spark, path, block_tokens), "blocks"))
        files.delete(spark, path)
    return stitched(reduce(DataFrame.unionByName, found))
