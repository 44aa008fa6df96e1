"""End to end: land, clean, store, report."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from statloom.operators.columns import project, stamp
from statloom.operators.rows import dedupe, union_entities
from statloom.plans.clean import accepted, audit, judge, refused
from statloom.plans.land import land_games, land_players
from statloom.plans.views import create_views
from statloom.schemas import GAMES, PLAYERS, TableSpec
from statloom.session import fit_to_input, shared_folder
from statloom.sources import files, tables
from statloom.sources.jsonl import presence, records, require_columns, write_json_lines
from statloom.sources.paths import Zones

FEEDS = ((GAMES, "games"), (PLAYERS, "player_stats"))


def prepare(spark: SparkSession, zones: Zones) -> None:
    """Create the database and its tables unless they exist, and know the dates stored before."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{zones.database}`")
    for spec, _ in FEEDS:
        name = zones.table(spec.name)
        for table in (spec.name, current(spec)):
            if not spark.catalog.tableExists(zones.table(table)):
                tables.create_table(spark, zones.table(table), spec, zones.warehouse(table))
                if files.children(spark, zones.warehouse(table)):
                    spark.catalog.recoverPartitions(zones.table(table))
        tables.create_runs_table(spark, name, spec, zones.warehouse(tables.runs_table(spec.name)))


def current(spec: TableSpec) -> str:
    """The name of the table that holds one row for each key of a date, from its newest run."""
    return f"{spec.name}_current"


def parse(spark: SparkSession, spec: TableSpec, feed: str, zones: Zones, run_date: date | str) -> DataFrame:
    """The judged records of one feed of a run date: its text is parsed here, once, and written typed.

    A contract column that no record has is an error.
    """
    lines = spark.read.text(zones.raw(run_date, feed))
    seen = Observation()
    judged = tables.staged(judge(records(lines, spec).observe(seen, *presence(spec)), spec), "judged")
    require_columns(seen.get, spec, lines)
    return judged


def keep_rejects(judged: DataFrame, spec: TableSpec, feed: str, zones: Zones, run_date: date | str) -> None:
    """Write the refused records and the audit of a run date beside the processed zone."""
    write_json_lines(refused(judged), zones.rejects(run_date, feed))
    write_json_lines(audit(judged, spec).coalesce(1), zones.audits(run_date, feed))


def store(spark: SparkSession, spec: TableSpec, feed: str, zones: Zones, run_date: date | str,
          mode: str = tables.APPEND, keep_current: bool = False) -> None:
    """Clean one feed of a run date and write it to the processed zone and the warehouse table.

    The feed is parsed once; rejects, audit and the cleaned batch come from what that pass wrote. The batch is written as
    Parquet in storage order; the warehouse is written from those files, so both hold the same rows and nothing
    else is kept. With ``keep_current`` the batch is merged into the table of newest rows as well.
    """
    judged = parse(spark, spec, feed, zones, run_date)
    keep_rejects(judged, spec, feed, zones, run_date)
    batch = (accepted(judged, spec).transform(dedupe, spec.keys, dealt=True)
             .transform(stamp, run_date).transform(project, spec.contract))
    name, processed = zones.table(spec.name), zones.processed(run_date, feed)
    if mode == tables.MERGE:
        tables.merge_files(batch, processed, spec)
        written = tables.read_table(spark, processed, spec.contract) if files.children(spark, processed) else None
        if written is not None:
            tables.merge_rows(written, name, spec)
    else:
        written = tables.write_marked(tables.cluster_layout(batch, spec), processed, spec, mode)
        if written is not None:
            tables.add_rows(written, name, spec, mode)
    if written is not None:
        tables.note_run(spark, name, spec, written)
        if keep_current:
            tables.merge_rows(written, zones.table(current(spec)), spec)


def transform(spark: SparkSession, zones: Zones, run_date: date | str,
              mode: str = tables.APPEND, keep_current: bool = False) -> None:
    """Clean and store both feeds of a run date, side by side: neither needs the other."""
    shared_folder(spark)
    fit_to_input(spark, *(zones.raw(run_date, feed) for _, feed in FEEDS))
    prepare(spark, zones)
    with ThreadPoolExecutor(len(FEEDS)) as pool:
        jobs = [pool.submit(store, spark, spec, feed, zones, run_date, mode, keep_current)
                for spec, feed in FEEDS]
    for job in jobs:
        job.result()


AUDIT = "records_read long, kept long, dropped long, duplicates long, unreadable long"


def audits(spark: SparkSession, zones: Zones, run_date: date | str) -> DataFrame:
    """Per feed of a run date: records read, kept, dropped, duplicate and unreadable, as counted when it was stored."""
    return union_entities([
        spark.read.schema(AUDIT).json(zones.audits(run_date, feed)).select(F.lit(feed).alias("feed"), "*")
        for _, feed in FEEDS])


def warehouse_tables(spark: SparkSession, zones: Zones, newest: bool = False) -> dict[str, DataFrame]:
    """The catalog tables by name; a date filter lists only the dates it wants. With ``newest`` those
    that hold one row for each key of a date."""
    prepare(spark, zones)
    names = {spec: zones.table(current(spec) if newest else spec.name) for spec, _ in FEEDS}
    for name in names.values():
        # A session remembers a table's files; another one, a stream's for instance, may have replaced some.
        spark.catalog.refreshTable(name)
    return {spec.name: spark.table(name).select(*spec.contract.names) for spec, name in names.items()}


def reconcile(spark: SparkSession, zones: Zones, run_date: date | str) -> DataFrame:
    """Per feed of a run date, whether what was read, kept and stored agrees, zone by zone.

    ``kept`` is the audit's count, ``processed`` the rows of the processed zone, ``noted`` and ``stored`` what the warehouse
    table should hold and holds, over the dates of all its runs. A lost file shows as a difference, ``missing_dates`` tells
    in how many dates. Rows are counted from file footers and from the small tables of runs; no data page is read.
    """
    prepare(spark, zones)
    out = []
    for spec, feed in FEEDS:
        processed, warehouse = zones.processed(run_date, feed), spark.table(zones.table(spec.name))
        in_zone = (tables.read_table(spark, processed, spec.contract) if files.children(spark, processed)
                   else warehouse.limit(0))
        noted = spark.table(tables.runs_table(zones.table(spec.name))).groupBy(
            F.col(spec.partition).alias("_day")).agg(F.sum("stored_rows").alias("noted"))
        held = warehouse.groupBy(spec.partition).agg(F.count("*").alias("stored"))
        by_date = noted.join(held, F.col("_day").eqNullSafe(F.col(spec.partition)), "full").select(
            F.coalesce("noted", F.lit(0)).alias("noted"), F.coalesce("stored", F.lit(0)).alias("stored"))
        totals = by_date.agg(
            F.coalesce(F.sum("noted"), F.lit(0)).alias("noted"), F.coalesce(F.sum("stored"), F.lit(0)).alias("stored"),
            F.count(F.when(F.col("noted") > F.col("stored"), 1)).alias("missing_dates"))
        counted = in_zone.agg(F.count("*").alias("processed"))
        read = spark.read.schema(AUDIT).json(zones.audits(run_date, feed)).agg(
            F.sum("records_read").alias("records_read"), F.sum("kept").alias("kept"))
        # Three frames of one row each, side by side.
        on = F.lit(feed).alias("feed")
        out.append(read.select(on, "*").join(counted.select(on, "*"), "feed").join(totals.select(on, "*"), "feed")
                   .select("*", ((F.col("kept") == F.col("processed")) & (F.col("missing_dates") == 0)).alias("agrees")))
    return union_entities(out)


def compact_tables(spark: SparkSession, zones: Zones, most_files: int = 4) -> int:
    """Gather the small files that appended runs left in the warehouse; returns how many dates were written anew."""
    prepare(spark, zones)
    return sum(tables.compact(spark, zones.table(table), spec, most_files)
               for spec, _ in FEEDS for table in (spec.name, current(spec)))


def register_views(spark: SparkSession, zones: Zones, since: date | str,
                   as_of: date | str | None = None, newest: bool = False) -> dict[str, DataFrame]:
    """Create the permanent views over the tables, for any session; returns them by name. With ``newest``, views of
    the newest rows (``current_`` and the name), in which runs that repeat a season count once."""
    prepare(spark, zones)
    return {name: spark.table(zones.table(name))
            for name in create_views(spark, zones.database, since, as_of, newest)}


def expire_runs(spark: SparkSession, zones: Zones, days: int = 30,
                as_of: date | str | None = None) -> list[str]:
    """Remove raw and processed run dates older than ``days``, and warehouse dates that no later run
    wrote; returns the run dates removed. Run dates are folders, and the runs of a warehouse date are noted, so no
    file of either is opened."""
    today = date.fromisoformat(as_of) if isinstance(as_of, str) else as_of or date.today()
    first = (today - timedelta(days=days)).isoformat()
    gone = set()
    for zone in zones.run_folders():
        for name in files.children(spark, zone):
            if _is_day(name) and name < first:
                files.delete(spark, f"{zone}/{name}")
                gone.add(name)
    prepare(spark, zones)
    for spec, _ in FEEDS:
        tables.drop_expired(spark, zones.table(spec.name), spec, days, today)
        tables.drop_expired(spark, zones.table(current(spec)), spec, days, today)
    return sorted(gone)


def _is_day(name: str) -> bool:
    try:
        return date.fromisoformat(name).isoformat() == name
    except ValueError:
        return False


def run(spark: SparkSession, raw_games: DataFrame, raw_players: DataFrame, dimension: DataFrame,
        entities, season: str, zones: Zones, run_date: date | str, since: date | str,
        as_of: date | str | None = None, mode: str = tables.APPEND,
        league: str | None = None) -> dict[str, DataFrame]:
    """The whole job for one run date; returns the reporting views."""
    land_games(raw_games, zones.raw(run_date, "games"), season, league)
    land_players(raw_players, zones.raw(run_date, "player_stats"), season, entities, dimension)
    transform(spark, zones, run_date, mode)
    return register_views(spark, zones, since, as_of)
