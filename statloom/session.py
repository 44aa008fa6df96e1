"""Session settings and the shared folder for intermediate data."""

from __future__ import annotations

import atexit
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from statloom.sources import files

# A task reads and a reducer sorts about this much at most; what does not fit in memory spills.
TASK_BYTES = 1 << 30
SMALL_TASK_BYTES = 128 << 20
# Blocks of a shuffle are maps times reducers, and the driver keeps track of both.
MOST_PARTITIONS = 30_000
# Text is about this many times as large as its gzipped files; JSON records repeat their keys.
PACKED = 10
# Longer methods are interpreted by the JVM.
METHOD_BYTES = 8000
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def partition_bytes(input_bytes: int) -> int:
    """Input per task: 128 MB for small inputs, growing with the input up to 1 GB, and beyond only
    where MOST_PARTITIONS would be exceeded."""
    wanted = min(TASK_BYTES, max(SMALL_TASK_BYTES, input_bytes // 4096))
    return max(wanted, math.ceil(input_bytes / MOST_PARTITIONS))


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle width for an input size: two waves of the cores at least, MOST_PARTITIONS at most
    unless there are more cores."""
    return max(2 * cores, math.ceil(input_bytes / partition_bytes(input_bytes)))


def fit_to_input(spark: SparkSession, *paths: str) -> int:
    """Set split size and shuffle width for a job over these paths; returns their bytes.

    Sizes come from the listing, no data is read. Gzipped files count as the text they hold, since that is what tasks
    parse and shuffle; a split is set in bytes of files, so that few such files share a task.
    """
    sizes = [(files.total_bytes(spark, p), PACKED if _gzipped(spark, p) else 1) for p in paths]
    total = sum(size for size, _ in sizes)
    text = sum(size * times for size, times in sizes)
    split = partition_bytes(text) * total // text if total else partition_bytes(0)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(1, split)))
    spark.conf.set("spark.sql.shuffle.partitions",
                   str(shuffle_partitions(text, spark.sparkContext.defaultParallelism)))
    return total


def _gzipped(spark: SparkSession, path: str) -> bool:
    return any(name.endswith(".gz") for name in files.children(spark, path))


def small_methods(spark: SparkSession) -> None:
    """Have Spark split generated code that is too long for the JVM to compile, instead of fusing it.

    The JVM interprets methods above 8000 bytes of bytecode, and the projection of a feed is beyond that: its rows took
    two to four times as long.
    """
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > METHOD_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within, the shuffle files of an execution are removed when it ends, those of a stream with its micro-batch.

    Otherwise they stay until the driver collects its garbage, which follows its memory and not the disks of the executors: all
    steps of a job would lie there side by side.
    """
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def build_session(app_name: str = "statloom", master: str | None = None,
                  input_bytes: int | None = None, cores: int = 8,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with UTC dates, AQE, and a shuffle width that follows the input size."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if input_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions",
                                 str(shuffle_partitions(input_bytes, cores)))
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder; a cluster session must name one,
    because a folder on one machine is lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not _one_machine(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="statloom-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def _one_machine(spark: SparkSession) -> bool:
    """``local`` and ``local[n]``; ``local-cluster`` has executors of its own."""
    return spark.sparkContext.master.split("[")[0] == "local"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder, removed when this program ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_clear_scratch, spark)
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def _clear_scratch(spark: SparkSession) -> None:
    # Without its context the program can reach no storage, and the paths stay.
    if getattr(spark.sparkContext, "_jsc", None):
        for path in _SCRATCH:
            files.delete(spark, path)
