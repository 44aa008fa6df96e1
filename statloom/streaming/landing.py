"""Pick up new raw files as a stream: the same parsing, cleaning and sinks as the batch job."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from statloom.operators import columns, rows
from statloom.plans.clean import accepted, judge, refused
from statloom.plans.pipeline import prepare
from statloom.schemas import STAMP, TableSpec
from statloom.session import freed_shuffles
from statloom.sources import files, tables
from statloom.sources.jsonl import records
from statloom.sources.paths import Zones

_RUN_DATE = "/([0-9]{4}-[0-9]{2}-[0-9]{2})/[^/]+[.]json"
# Columns of the stream beside the line: when it arrived, and what tells it from others.
_ARRIVED, _DIGEST = "_arrived", "_digest"


def new_lines(spark: SparkSession, zones: Zones, feed: str, delay: str) -> DataFrame:
    """The lines of all raw files of a feed with their run date, repeated ones once.

    A line that comes again within ``delay`` of its first arrival, for the same run, is dropped before it is parsed. The state
    store keeps a digest of 16 bytes for each line that arrived within the delay, and no longer. The watermark follows the time
    of arrival and not the run date, so nothing ever is too late: a file of an old run is taken like any other.
    """
    run_date = F.regexp_extract("_metadata.file_path", _RUN_DATE, 1).try_cast("date")
    return (
        spark.readStream.text(zones.raw_runs(feed))
        .select("value", run_date.alias(STAMP), F.unhex(F.md5("value")).alias(_DIGEST),
                F.current_timestamp().alias(_ARRIVED))
        .withWatermark(_ARRIVED, delay).dropDuplicatesWithinWatermark([_DIGEST, STAMP])
    )


def merge_runs(batch: DataFrame, name: str, spec: TableSpec) -> int:
    """Merge rows of several runs into the table, whose key here is the run date as well.

    Of a key's rows in one run the most complete stays, whichever micro-batch brings it, as in a batch run. Only
    the game dates of the batch are read and written; their other rows are kept as they are.
    """
    dates = tables.dates_of(batch, spec.partition)
    if not dates:
        return 0
    stored = batch.sparkSession.table(name).select(*spec.contract.names).transform(
        tables.on_dates, dates, spec.partition)
    both = stored.unionByName(batch).transform(rows.dedupe, [spec.partition, *spec.keys, STAMP], dealt=True)
    # As in merge_files: the ranges of the layout take these rows twice.
    once = tables.staged(both, "merged")
    try:
        tables.add_rows(tables.cluster_layout(once, spec), name, spec, tables.REPLACE_DATES)
    finally:
        tables.discard(once)
    return len(dates)


def store_judged(judged: DataFrame, spec: TableSpec, feed: str, zones: Zones) -> None:
    """Bring rejects, processed zone and warehouse up to date for the runs of a micro-batch's judged records.

    Every step can run again after a failure: rejects are told apart by their text, rows are merged. The warehouse comes
    first and alone, as its merge holds as many rows on disk as those of all runs.
    """
    spark = judged.sparkSession
    rows_of = accepted(judged, spec).transform(columns.project, spec.contract)
    # A row for each run date reaches the driver.
    runs: list[date] = sorted(r[0] for r in judged.select(STAMP).distinct().collect())
    if not runs:
        return

    def one_run(run_date: date) -> None:
        own = F.col(STAMP) == F.lit(run_date)
        path = zones.rejects(run_date, feed)
        known = files.children(spark, path)
        bad = refused(judged.filter(own))
        if known:
            held = spark.read.schema(bad.schema).json(path).select("record")
            bad = bad.join(held.hint("merge"), "record", "left_anti")
        bad.write.mode("append").json(path)
        tables.merge_files(rows_of.filter(own), zones.processed(run_date, feed), spec, corrects=False)

    # Written once: its dates, the ranges of the layout and the merge all take these rows.
    best = tables.staged(rows_of.transform(rows.dedupe, [*spec.keys, STAMP], dealt=True), "deduped")
    try:
        merge_runs(best, zones.table(spec.name), spec)
    finally:
        tables.discard(best)
    with ThreadPoolExecutor(max(1, min(len(runs), RUNS_AT_ONCE))) as pool:
        for job in [pool.submit(one_run, d) for d in runs]:
            job.result()


# Run dates whose sinks are written side by side.
RUNS_AT_ONCE = 4


def stream_table(spark: SparkSession, spec: TableSpec, feed: str, zones: Zones, state: str,
                 delay: str = "1 day") -> StreamingQuery:
    """Clean every new raw file of a feed into both zones and the rejects; returns the stream, ended as none is left.

    A later file of a run adds what is new in it, and a micro-batch that runs again after a failure, or a stream that has
    lost its state, changes nothing. A micro-batch looks up the rows of its own game dates only.

    The stream itself parses and judges new lines into a folder of the ``state``, one for each micro-batch: all lines of
    a micro-batch lie on disk, shuffled, until it ends. Then its judged records go to the sinks and are
    removed. Those that a failure left there are stored by the next stream with this state.
    """
    prepare(spark, zones)
    held = f"{state.rstrip('/')}/judged"

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = judge(records(batch.select("value", STAMP), spec, STAMP), spec)
        judged.write.mode("overwrite").parquet(f"{held}/{batch_id:010d}")

    with freed_shuffles(spark):
        stream = (
            new_lines(spark, zones, feed, delay)
            .writeStream.foreachBatch(write)
            .option("checkpointLocation", state)
            .trigger(availableNow=True).start()
        )
        stream.awaitTermination()
        for batch_id in files.children(spark, held):
            store_judged(spark.read.parquet(f"{held}/{batch_id}"), spec, feed, zones)
            files.delete(spark, f"{held}/{batch_id}")
    return stream
