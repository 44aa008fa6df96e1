"""Partitioned and clustered Parquet tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.functions.dates import day
from statloom.operators import rows
from statloom.operators.columns import project
from statloom.schemas import STAMP, TableSpec
from statloom.session import scratch_path
from statloom.sources import files

APPEND = "append"
REPLACE_DATES = "replace_dates"
MERGE = "merge"
# The folder of rows without a date, as Spark names it.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
# What a file of a compacted date holds at most, about.
TARGET_BYTES = 256 << 20
# Folders are deleted side by side, as each takes a round trip to the storage.
DELETERS = 16
_MARK = "/part-[0-9]+-([0-9a-f-]{36})[^/]*$"


def date_layout(df: DataFrame, partition: str = "game_date") -> DataFrame:
    """Gather the rows of a date for writing, without a sampling pass.

    AQE cuts a date that is too large for one task and merges dates that are too small, so a hot
    date is written by many tasks and the number of files stays near the number of dates.
    """
    return df.hint("rebalance", F.col(partition))


def _storage_order(spec: TableSpec) -> list[str]:
    return list(dict.fromkeys([spec.partition, spec.cluster, *spec.keys]))


def cluster_ranges(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Give each task a range of the storage order: partition date, cluster column, key.

    The ranges are balanced by sampling. A small date shares a task with its neighbours and gives
    one file; a huge date is cut along the cluster column and the key, so no task holds a whole hot
    date or entity, and every file covers a narrow range of the cluster column.
    """
    # The width is the session's, which a job fits to its input: a file per date and task takes its
    # time to open however small it is, so small ranges are not merged into few tasks.
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(width, *_storage_order(spec))


def cluster_sort(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Sort each task's rows in storage order; the writer then needs no sort of its own."""
    return df.sortWithinPartitions(*_storage_order(spec))


def cluster_layout(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Ranges and order together, for a single write."""
    return df.transform(cluster_ranges, spec).transform(cluster_sort, spec)


def write_partitioned(df: DataFrame, path: str, partition: str = "game_date",
                      mode: str = APPEND) -> None:
    """Write one folder per date.

    ``append`` adds to what is there. ``replace_dates`` replaces the dates present in ``df`` and
    leaves the others, so a rerun changes nothing; the batch must hold all rows of its dates.
    """
    writer = df.write.partitionBy(partition)
    if mode == REPLACE_DATES:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    elif mode == APPEND:
        writer = writer.mode("append")
    else:
        raise ValueError(f"unknown mode: {mode}")
    writer.parquet(path)


def write_clustered(df: DataFrame, path: str, spec: TableSpec, mode: str = APPEND) -> None:
    """Write the storage layout of ``spec``: a folder per date, rows in cluster order."""
    write_partitioned(cluster_layout(df, spec), path, spec.partition, mode)


def read_table(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Read a table with its declared schema, columns in contract order."""
    return spark.read.schema(contract).parquet(path).transform(project, contract)


def create_table(spark: SparkSession, name: str, spec: TableSpec,
                 location: str | None = None) -> None:
    """Create a typed catalog table, partitioned by date, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.contract.fields)
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY (`{spec.partition}`){at}")


def write_marked(df: DataFrame, path: str, spec: TableSpec, mode: str = APPEND) -> DataFrame | None:
    """Write date partitions and return the rows of this write alone, read from its files.

    Spark names the files of one write alike; those that were there before are told apart by
    name, and a filter on the file name keeps the others from being opened. None if df was empty.
    """
    spark = df.sparkSession
    before = _marks(spark, path)
    write_partitioned(df, path, spec.partition, mode)
    marks = _marks(spark, path) - before
    if not marks:
        return None
    (mark,) = marks
    return read_table(spark, path, spec.contract).filter(
        F.col("_metadata.file_name").contains(mark))


def _marks(spark: SparkSession, path: str) -> set[str]:
    """What the names of each write's data files share: one entry per write. Lists, reads nothing."""
    if not files.children(spark, path):
        return set()
    names = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_extract("path", _MARK, 1).alias("mark")))
    return {r["mark"] for r in names.filter("mark <> ''").distinct().collect()}


def append_to_table(df: DataFrame, name: str, spec: TableSpec) -> None:
    """Append to a catalog table in the storage layout; columns go by name."""
    add_rows(cluster_layout(df, spec), name, spec)


def add_rows(df: DataFrame, name: str, spec: TableSpec, mode: str = APPEND) -> None:
    """Add rows that are laid out already to a catalog table, or replace their dates.

    Replacing writes to the table's folder: there Spark replaces single dates, and a frame that reads
    those very dates may do so, where an overwriting insert would empty all others.
    """
    if mode == REPLACE_DATES:
        spark = df.sparkSession
        folder = location(spark, name)
        write_partitioned(df.select(*spec.contract.names), folder, spec.partition, REPLACE_DATES)
        _know_dates(spark, name, folder, spec)
    elif mode == APPEND:
        values = [c for c in spec.contract.names if c != spec.partition]
        df.select(*values, spec.partition).write.insertInto(name)
    else:
        raise ValueError(f"unknown mode: {mode}")


def _know_dates(spark: SparkSession, name: str, folder: str, spec: TableSpec) -> None:
    """Enter the date folders that the catalog does not know yet."""
    known = {p[0].partition("=")[2] for p in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    held = {c.partition("=")[2] for c in files.children(spark, folder) if c.startswith(spec.partition + "=")}
    if fresh := sorted(held - known):
        parts = " ".join("PARTITION (`{}`={})".format(
            spec.partition, "null" if d == NO_DATE else f"'{d}'") for d in fresh)
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(name)


def staged(df: DataFrame, label: str = "staged") -> DataFrame:
    """The frame written once to the shared folder and read back, for several uses of its rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Remove the files of a ``staged`` frame that is not used any more."""
    for folder in {unquote(name.rpartition("/")[0]) for name in frame.inputFiles()}:
        files.delete(frame.sparkSession, folder)


# Merging by key


def dates_of(df: DataFrame, partition: str = "game_date") -> list[date | None]:
    """The dates of a batch: one value a day reaches the driver, whatever the rows."""
    return [r[0] for r in df.select(partition).distinct().collect()]


def on_dates(df: DataFrame, dates: list[date | None], partition: str = "game_date") -> DataFrame:
    """The rows of the given dates, null among them; a table lists and opens no other partition."""
    held = F.col(partition).isin([d for d in dates if d is not None])
    return df.filter(held | F.col(partition).isNull() if None in dates else held)


def merged(batch: DataFrame, stored: DataFrame, spec: TableSpec, corrects: bool = True) -> DataFrame:
    """One row for each key of a date: of the newest run that has it.

    Within one run the row of the ``batch`` replaces the stored one, as a correction, or, if it does not
    correct, the rule of ``rows.dedupe`` decides, so that the order in which batches come does not matter.
    """
    both = batch.withColumn("_stored", F.lit(0)).unionByName(stored.withColumn("_stored", F.lit(1)))
    first = [rows.newest_first(STAMP)]
    if corrects:
        first.append(F.col("_stored"))
    else:
        both = both.withColumn("_stored", F.lit(0))
    return both.transform(rows.dedupe, [spec.partition, *spec.keys], first, dealt=True).drop("_stored")


def merge_rows(batch: DataFrame, name: str, spec: TableSpec, corrects: bool = True) -> int:
    """Merge a batch into a catalog table by key, copying on write; returns how many dates it touched.

    Only the dates of the batch are read and written again: new keys come in, known ones are replaced by
    ``merged``, all others of those dates stay. A merge that runs again, in whole or in part, changes nothing.
    A key is known by its date as well: one that moves to another date is another row.
    """
    dates = dates_of(batch, spec.partition)
    if dates:
        stored = batch.sparkSession.table(name).select(*spec.contract.names).transform(
            on_dates, dates, spec.partition)
        add_rows(cluster_layout(merged(batch.select(*spec.contract.names), stored, spec, corrects), spec),
                 name, spec, REPLACE_DATES)
    return len(dates)


def merge_files(batch: DataFrame, path: str, spec: TableSpec, corrects: bool = True) -> int:
    """The same for a path that is in no catalog."""
    spark = batch.sparkSession
    dates = dates_of(batch, spec.partition)
    if dates:
        rows_of = batch.select(*spec.contract.names)
        if files.children(spark, path):
            stored = read_table(spark, path, spec.contract).transform(on_dates, dates, spec.partition)
            rows_of = merged(rows_of, stored, spec, corrects)
        else:
            rows_of = rows_of.transform(rows.latest, [spec.partition, *spec.keys], STAMP)
        # Written once: the ranges of the layout take these rows twice, and the shuffle that made them can go.
        once = staged(rows_of, "merged")
        try:
            write_clustered(once, path, spec, REPLACE_DATES)
        finally:
            discard(once)
    return len(dates)


# Files of a table


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """path, partition folder and length of every data file below a path. Lists, reads no file."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet").load(path)
        .select("path", F.regexp_extract("path", "/([^/=]+=[^/]*)/[^/]*$", 1).alias("folder"), "length"))


def crowded_dates(spark: SparkSession, path: str, most_files: int = 4,
                  target_bytes: int = TARGET_BYTES) -> list[tuple[date | None, int]]:
    """The dates whose files are more than ``most_files`` and than their bytes need, and the bytes of each."""
    if not files.children(spark, path):
        return []
    by_date = file_sizes(spark, path).groupBy("folder").agg(
        F.count("*").alias("n"), F.sum("length").alias("bytes"))
    value = F.regexp_extract("folder", "=(.*)$", 1)
    needed = F.greatest(F.ceil(F.col("bytes") / target_bytes), F.lit(1))
    return [(r["day"], r["bytes"]) for r in by_date.filter((F.col("n") > most_files) & (F.col("n") > needed))
            .select(value.try_cast("date").alias("day"), "bytes").collect()]


def compact(spark: SparkSession, name: str, spec: TableSpec, most_files: int = 4,
            target_bytes: int = TARGET_BYTES) -> int:
    """Write the dates of a catalog table that hold many small files anew, in files of about ``target_bytes``; returns
    how many dates that were.

    Appended runs leave a file or more in each of their dates. What is packed into one file is decided from the listing;
    only those dates are read, and each is swapped as a whole when its new files are complete. Rows are in
    storage order again.
    """
    crowded = crowded_dates(spark, location(spark, name), most_files, target_bytes)
    if crowded:
        own = spark.table(name).select(*spec.contract.names).transform(
            on_dates, [d for d, _ in crowded], spec.partition)
        bins = max(1, sum(size for _, size in crowded) // target_bytes + 1)
        ordered = own.repartitionByRange(bins, *_storage_order(spec)).transform(cluster_sort, spec)
        add_rows(ordered, name, spec, REPLACE_DATES)
    return len(crowded)


def location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(
        "col_name = 'Location'").first()["data_type"]


# Layouts for entities


def bucketed_table(df: DataFrame, name: str, column: str, buckets: int, *order: str) -> None:
    """Store a catalog table in buckets of one column, sorted within: the layout ``CLUSTERED BY ... INTO n BUCKETS``.

    Rows of an entity lie in one bucket, so aggregates and joins by that column need no shuffle, and a filter on it reads
    one bucket. The table has no date folders: it is a second copy for reading by entity. Rows are dealt to the buckets
    first, so that each task writes one file for each of its buckets.
    """
    (df.repartition(buckets, column).write.mode("overwrite").format("parquet")
     .bucketBy(buckets, column).sortBy(*(order or (column,))).saveAsTable(name))


def bloom_options(columns: list[str], distinct: int = 1 << 20) -> dict[str, str]:
    """Write options that give the columns a Bloom filter in each row group, so that a reader skips those without
    a wanted value even where it lies between their least and greatest."""
    out = {}
    for column in columns:
        out[f"parquet.bloom.filter.enabled#{column}"] = "true"
        out[f"parquet.bloom.filter.expected.ndv#{column}"] = str(distinct)
    return out


# Runs of a table


def runs_table(name: str) -> str:
    """The catalog table that holds, for each run and date of a table, how many rows were stored."""
    return name + "_runs"


def create_runs_table(spark: SparkSession, name: str, spec: TableSpec,
                      location: str | None = None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {runs_table(name)} (`{spec.partition}` date, "
              f"stored_rows bigint, last_run date) USING parquet{at}")


def note_run(spark: SparkSession, name: str, spec: TableSpec, added: DataFrame) -> None:
    """Note what a commit stored: one row a date. Counting rows by date opens footers only."""
    (added.groupBy(spec.partition).agg(F.count("*").alias("stored_rows"), F.max(STAMP).alias("last_run"))
     .coalesce(1).select(spec.partition, "stored_rows", "last_run").write.insertInto(runs_table(name)))


def last_runs(spark: SparkSession, name: str, spec: TableSpec) -> DataFrame:
    """Each date of a table and the last run that wrote to it: from the noted runs, where they are kept, or else from
    the run dates of its rows."""
    noted = runs_table(name)
    if spark.catalog.tableExists(noted):
        return spark.table(noted).groupBy(spec.partition).agg(F.max("last_run").alias("last"))
    return spark.table(name).groupBy(spec.partition).agg(F.max(STAMP).alias("last"))


def drop_expired(spark: SparkSession, name: str, spec: TableSpec, days: int = 30,
                 as_of: date | str | None = None) -> int:
    """Drop the dates of a catalog table whose rows all come from runs older than ``days``, the
    undated rows among them, and remove their files; returns how many dates went.

    One entry per date reaches the driver. Where runs are noted, no file of the table is opened; without notes only the run
    date is read. External tables keep the files of a dropped partition, so its folder is removed as well.
    """
    expired = [r[spec.partition] for r in last_runs(spark, name, spec).filter(
        F.col("last") < F.date_sub(day(as_of), days)).collect()]
    held = {p[0].partition("=")[2] for p in spark.sql(f"SHOW PARTITIONS {name}").collect()} if expired else set()
    expired = [d for d in expired if (NO_DATE if d is None else d.isoformat()) in held]
    if not expired:
        return 0
    folder = location(spark, name)
    parts = ", ".join(
        f"PARTITION (`{spec.partition}`={_sql_date(d)})" for d in expired)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {parts}")
    with ThreadPoolExecutor(DELETERS) as pool:
        list(pool.map(lambda d: files.delete(spark, f"{folder}/{spec.partition}={d or NO_DATE}"), expired))
    spark.catalog.refreshTable(name)
    return len(expired)


def _sql_date(value: date | None) -> str:
    return "null" if value is None else f"'{value.isoformat()}'"
