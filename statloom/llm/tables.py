"""Reading the input tables, and small helpers the operators share."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import statloom
from statloom.session import scratch_path

#: A word in SQL regular expressions.
WORD = r"[^\x20\x09-\x0D]+"

BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20

_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: What workers keep from task to task, to be emptied before a task that does not use it.
KEPT: list[dict] = []
_SHIPPED: set[str] = set()


def shipped(spark: SparkSession) -> None:
    """Send this package to the executors once, unless their Python path has it already.

    Texts are long rows: if the session has Spark's own bounds for a batch that goes to Python, in rows and in
    bytes, less is sent at a time.
    """
    if spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if spark.conf.get(_BYTES) in ("64MB", "67108864b", "67108864"):
        spark.conf.set(_BYTES, str(BATCH_BYTES))
    context = spark.sparkContext
    root = Path(statloom.__file__).resolve().parent.parent
    known = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if str(root) in known or context.applicationId in _SHIPPED:
        return
    _SHIPPED.add(context.applicationId)
    folder = tempfile.mkdtemp(prefix="statloom-code-")
    context.addPyFile(shutil.make_archive(f"{folder}/statloom", "zip", root, "statloom"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    shipped(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the quarter of documents no model learns from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def settled(df: DataFrame, label: str = "step") -> DataFrame:
    """The frame written as Parquet to the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    shipped(spark)
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def lean(run: Task, keep: bool = False) -> Task:
    """The function of a task, giving back the memory it leaves.

    Workers serve many tasks, of one operator after the other: what Arrow's and the C library's pools hold when a task ends
    would stay with the executor. Unless the task asks to ``keep`` it, what an earlier operator kept goes first.
    """
    def bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keep:
            for kept in KEPT:
                kept.clear()
            trim()
        try:
            yield from run(batches)
        finally:
            trim()

    return bounded


def trim() -> None:
    """Return free memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    libc = ctypes.CDLL(None)
    if hasattr(libc, "malloc_trim"):
        libc.malloc_trim(0)
