"""Registered queries: every operator over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.functions.dates import month_bucket, round_half_up
from statloom.operators import columns, joins, reports, rows
from statloom.plans import pipeline
from statloom.plans.clean import audit, clean, rejects, typed
from statloom.plans.land import land_games, land_players
from statloom.schemas import GAMES, PLAYERS, TableSpec
from statloom.session import scratch_path
from statloom.sources import jsonl, tables
from statloom.sources.paths import Zones
from statloom.streaming.landing import stream_table
from statloom.workload import standins
from statloom.workload.standins import table

RUN_DATE = "2025-04-13"
SINCE = "1998-01-01"
FIRST, LAST = "1997-10-01", "1998-04-13"
SEASON = "21998"
LEAGUE = "00"
EXPIRE_DAYS = 9500
EARLY_RUN = "1992-01-01"
EVENTS_AS_OF = "2024-01-30"
RETAIN_AS_OF = "2024-02-14"
STREAM_RUNS = {"2025-04-12": "O", "2025-04-13": "F"}
STREAM_DATES = tuple(STREAM_RUNS)
BUCKETS = 8
WANTED_GAMES = (1, 2, 3, 4, 5, 32, 33, 999)
ALL_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
              "pages benchmark labels conversations").split()

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def _stamped(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Contract rows for the sinks."""
    return (
        df.transform(typed, spec)
        .transform(columns.stamp, RUN_DATE)
        .transform(columns.project, spec.contract)
    )


def _event_days(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", F.col("ts").cast("date").alias(name))


# Sources and sinks


@query("json_roundtrip")
def json_roundtrip(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    path = scratch_path(spark, "json")
    jsonl.write_json_lines(df, path)
    return jsonl.read_json_lines(spark, path, df.schema)


@query("parquet_partitioned_roundtrip")
def parquet_partitioned_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "partitioned")
    df = standins.raw_games(spark, sf_dir).transform(_stamped, GAMES)
    tables.write_partitioned(tables.date_layout(df), path)
    return tables.read_table(spark, path, GAMES.contract)


@query("clustered_table_roundtrip")
def clustered_table_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "clustered")
    df = standins.raw_players(spark, sf_dir, named=True).transform(_stamped, PLAYERS)
    tables.write_clustered(df, path, PLAYERS)
    return tables.read_table(spark, path, PLAYERS.contract)


@query("table_contract")
def table_contract(spark, sf_dir):
    path = scratch_path(spark, "contract")
    name = "contract_" + path[-32:]
    tables.create_table(spark, name, GAMES, path)
    df = standins.raw_games(spark, sf_dir).transform(_stamped, GAMES)
    tables.append_to_table(df, name, GAMES)
    return spark.table(name).transform(columns.project, GAMES.contract)


@query("expired_partitions")
def expired_partitions(spark, sf_dir):
    path = scratch_path(spark, "expiring")
    name = "expiring_" + path[-32:]
    tables.create_table(spark, name, GAMES, path)
    df = standins.raw_games(spark, sf_dir).transform(_stamped, GAMES)
    # Every game is known from a run a month after it; undated ones from an early run.
    runs = F.coalesce(F.date_add("game_date", 30), F.lit(date.fromisoformat(EARLY_RUN)))
    tables.append_to_table(df.withColumn("ingestion_date", runs), name, GAMES)
    tables.drop_expired(spark, name, GAMES, EXPIRE_DAYS, RUN_DATE)
    # Read by path: the files are gone, not just their catalog entries.
    return tables.read_table(spark, path, GAMES.contract)


@query("append_batches")
def append_batches(spark, sf_dir):
    path = scratch_path(spark, "append")
    df = _event_days(spark, sf_dir, "game_date")
    batch = tables.date_layout(df)
    for _ in range(2):
        tables.write_partitioned(batch, path)
    return spark.read.schema(df.schema).parquet(path)


@query("replace_batches")
def replace_batches(spark, sf_dir):
    path = scratch_path(spark, "replace")
    df = _event_days(spark, sf_dir, "game_date")
    batch = tables.date_layout(df)
    for _ in range(2):
        tables.write_partitioned(batch, path, mode=tables.REPLACE_DATES)
    return spark.read.schema(df.schema).parquet(path)


def _two_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Contract rows of one season as two runs see it: the later one lacks some games and corrects the points of others."""
    season = standins.raw_games(spark, sf_dir).transform(
        rows.filter_season, SEASON, LEAGUE, "SEASON_ID", "LEAGUE_ID")
    first = season.transform(clean, GAMES, STREAM_DATES[0])
    second = season.filter("FG3M < 5").withColumn(
        "PTS", F.when(F.col("FTM") > 2, F.col("PTS") + 100).otherwise(F.col("PTS")))
    return [first, second.transform(clean, GAMES, STREAM_DATES[1])]


def _game_table(spark: SparkSession, label: str) -> str:
    path = scratch_path(spark, label)
    name = f"{label}_{path[-32:]}"
    tables.create_table(spark, name, GAMES, path)
    return name


@query("merge_runs")
def merge_runs(spark, sf_dir):
    """A table after both runs, the later one twice: one row for each key of a date, from its newest run."""
    name = _game_table(spark, "merged")
    first, second = (tables.staged(batch) for batch in _two_runs(spark, sf_dir))
    tables.append_to_table(first, name, GAMES)
    for _ in range(2):
        tables.merge_rows(second, name, GAMES)
    return spark.table(name).transform(columns.project, GAMES.contract)


@query("latest_rows")
def latest_rows(spark, sf_dir):
    """The same rows from an appended table that holds both runs, without storing them."""
    first, second = _two_runs(spark, sf_dir)
    return first.unionByName(second).transform(rows.latest, [GAMES.partition, *GAMES.keys])


@query("compacted_dates")
def compacted_dates(spark, sf_dir):
    """A table that five appends filled, compacted; and how many files a date has at most."""
    name = _game_table(spark, "compacted")
    own = tables.staged(_two_runs(spark, sf_dir)[0])
    for part in range(5):
        tables.append_to_table(
            own.filter(F.pmod(F.xxhash64("game_id"), F.lit(5)) == part), name, GAMES)
    tables.compact(spark, name, GAMES, most_files=1)
    most = tables.file_sizes(spark, tables.location(spark, name)).groupBy("folder").count().agg(
        F.max("count").alias("most_files"))
    return spark.table(name).groupBy("game_date").agg(
        F.count("*").alias("games"), F.sum("pts").alias("pts")).join(F.broadcast(most))


@query("bucketed_entities")
def bucketed_entities(spark, sf_dir):
    """Season averages of the selected players from the bucketed copy: neither the join nor the sums shuffle the table."""
    name = "by_player_" + scratch_path(spark, "buckets")[-32:]
    tables.bucketed_table(standins.players(spark, sf_dir), name, "player_id", BUCKETS, "player_id", "game_date")
    chosen = standins.rostered(spark, sf_dir).selectExpr("s_suppkey AS player_id")
    return spark.table(name).transform(rows.select_entities, "player_id", chosen).groupBy(
        "player_id").agg(*(F.avg(c).alias(f"avg_{c}") for c in ("pts", "reb", "ast")),
                         F.count("*").alias("games_played"))


@query("bloom_entities")
def bloom_entities(spark, sf_dir):
    """Games looked up by id in files whose row groups hold Bloom filters of it."""
    path = scratch_path(spark, "bloom")
    standins.players(spark, sf_dir).write.options(**tables.bloom_options(["game_id"])).parquet(path)
    wanted = [f"{k:010d}" for k in WANTED_GAMES]
    return spark.read.schema(standins.players(spark, sf_dir).schema).parquet(path).transform(
        rows.select_entities, "game_id", wanted)


@query("landed_counts")
def landed_counts(spark, sf_dir):
    return reports.landed_counts({n: table(spark, sf_dir, n) for n in ALL_TABLES})


# Column transforms


@query("cast_int")
def cast_int(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        ((25 - F.col("l_quantity")) / 2).alias("half"),
        F.when(F.col("l_tax") < 0.08, F.col("l_quantity")).otherwise(F.lit(float("nan")))
        .alias("gaps"),
        F.col("l_extendedprice").cast("string").alias("price_text"),
    )
    return df.transform(columns.cast_int, ["half", "gaps", "price_text"])


@query("cast_float")
def cast_float(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_discount", "l_tax",
        F.col("l_extendedprice").cast("string").alias("price_text"))
    return df.transform(columns.cast_float, ["l_discount", "l_tax", "price_text"])


@query("parse_date_iso")
def parse_date_iso(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderstatus = 'P' then 'bad' "
        "else cast(cast(o_orderdate as date) as string) end AS o_orderdate")
    return df.transform(columns.parse_date, "o_orderdate", GAMES.date_format)


@query("parse_date_monthname")
def parse_date_monthname(spark, sf_dir):
    df = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderstatus = 'P' then 'bad' "
        "else upper(date_format(o_orderdate, 'MMM dd, yyyy')) end AS o_orderdate")
    return df.transform(columns.parse_date, "o_orderdate", PLAYERS.date_format)


@query("stamp_ingestion_date")
def stamp_ingestion_date(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
        .transform(columns.stamp, RUN_DATE)
    )


@query("lowercase_columns")
def lowercase_columns(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    return df.toDF(*[c.upper() for c in df.columns]).transform(columns.lowercase_columns)


@query("project_contract")
def project_contract(spark, sf_dir):
    df = standins.raw_players(spark, sf_dir, named=True).withColumn("EXTRA", F.lit(1))
    return (
        df.transform(columns.lowercase_columns)
        .transform(columns.parse_date, "game_date", PLAYERS.date_format)
        .transform(columns.stamp, RUN_DATE)
        .transform(columns.conform, PLAYERS.contract)
    )


@query("fill_missing")
def fill_missing(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderstatus <> 'P' then o_custkey end AS o_custkey",
        "case when o_orderstatus = 'F' then cast('NaN' as double) "
        "when o_orderstatus = 'O' then o_totalprice end AS o_totalprice",
        "nullif(o_orderpriority, '5-LOW') AS o_orderpriority",
    ).transform(columns.fill_missing)


@query("case_insensitive_columns")
def case_insensitive_columns(spark, sf_dir):
    """A feed whose keys are all in another case than the contract's, read as records."""
    path = scratch_path(spark, "cases")
    raw = standins.raw_players(spark, sf_dir, named=True)
    jsonl.write_json_lines(raw.toDF(*[c.swapcase() for c in raw.columns]), path)
    return jsonl.read_records(spark, path, PLAYERS).transform(typed, PLAYERS)


@query("read_any_spelling")
def read_any_spelling(spark, sf_dir):
    """The players feed in three spellings of its keys, ids as decimal and as text, points as text."""
    raw = standins.raw_players(spark, sf_dir, named=True)
    part = F.pmod(F.xxhash64("Game_ID", "Player_ID"), F.lit(3))
    spellings = [
        (str.upper, {"Player_ID": F.col("Player_ID").cast("decimal(20,1)")}),
        (str.lower, {"Player_ID": F.col("Player_ID").cast("string")}),
        (str.title, {"PTS": F.when(~F.isnan("PTS"), F.col("PTS").cast("decimal(9,2)")
                                   .cast("string")).otherwise(
                         F.when(F.col("PTS").isNotNull(), "0"))}),
    ]
    paths = [scratch_path(spark, "spelled") for _ in spellings]
    for i, (path, (spell, other)) in enumerate(zip(paths, spellings)):
        own = raw.filter(part == i).withColumns(other)
        jsonl.write_json_lines(own.toDF(*map(spell, own.columns)), path)
    return jsonl.read_records(spark, paths, PLAYERS).transform(clean, PLAYERS, RUN_DATE)


@query("widen_types")
def widen_types(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")
        .transform(columns.cast_int, ["l_quantity"])
        .transform(columns.cast_float, ["l_discount"])
        .transform(columns.widen)
    )


@query("round_half_up")
def round_half_up_places(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        round_half_up(F.col("l_quantity") / F.lit(20)).alias("share"),
        round_half_up((F.col("l_quantity") - 25) / F.col("l_linenumber")).alias("signed_share"))


@query("month_bucket")
def month_buckets(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", month_bucket(F.col("o_orderdate").cast("date")).alias("month"))


# Filters


@query("drop_null_keys")
def drop_null_keys(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .selectExpr("l_orderkey", "l_partkey", "nullif(l_linenumber, 7) AS l_linenumber")
        .transform(rows.drop_null_keys, "l_linenumber")
    )


@query("filter_date_floor")
def filter_date_floor(spark, sf_dir):
    return standins.players(spark, sf_dir).transform(rows.since, SINCE)


@query("filter_lookback")
def filter_lookback(spark, sf_dir):
    return _event_days(spark, sf_dir, "ingestion_date").transform(
        rows.lookback, 7, EVENTS_AS_OF)


@query("filter_date_between")
def filter_date_between(spark, sf_dir):
    return standins.players(spark, sf_dir).transform(rows.between, FIRST, LAST)


@query("select_entities")
def select_entities(spark, sf_dir):
    chosen = standins.rostered(spark, sf_dir).selectExpr("s_suppkey AS player_id")
    return standins.players(spark, sf_dir).transform(rows.select_entities, "player_id", chosen)


@query("select_entities_listed")
def select_entities_listed(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "event_type", "value").transform(
        rows.select_entities, "event_type", ["click", "purchase", "error"])


@query("filter_season")
def filter_season(spark, sf_dir):
    return standins.raw_games(spark, sf_dir).select(
        "SEASON_ID", "LEAGUE_ID", "GAME_ID", "TEAM_ID", "FGA"
    ).transform(rows.filter_season, SEASON, LEAGUE, "SEASON_ID", "LEAGUE_ID")


@query("retain_recent")
def retain_recent(spark, sf_dir):
    return _event_days(spark, sf_dir, "ingestion_date").transform(
        rows.retain_recent, 30, RETAIN_AS_OF)


# Lookup, deduplication, union


@query("lookup_name_fallback")
def lookup_name_fallback(spark, sf_dir):
    names = table(spark, sf_dir, "customer").filter("c_acctbal > 1000").selectExpr(
        "c_custkey AS id", "c_name AS full_name")
    return (
        table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey AS player_id")
        .transform(joins.lookup_name, names)
    )


@query("dedupe_games")
def dedupe_games(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .withColumn("l_linenumber", F.expr("nullif(l_linenumber, 7)"))
        .transform(rows.dedupe, ["l_orderkey", "l_linenumber"])
    )


@query("dedupe_players")
def dedupe_players(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").transform(rows.dedupe, ["l_suppkey", "l_orderkey"])


@query("union_entities")
def union_entities(spark, sf_dir):
    return rows.union_entities([
        table(spark, sf_dir, "customer").selectExpr(
            "c_custkey AS id", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"),
        table(spark, sf_dir, "supplier").selectExpr(
            "s_acctbal AS balance", "s_suppkey AS id", "s_name AS name"),
        table(spark, sf_dir, "part").selectExpr("p_partkey AS id", "p_name AS name"),
    ])


# Reports


@query("top_k")
def top_k(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").transform(
        reports.top_k, [F.desc("o_totalprice"), "o_orderkey"], 100)


@query("top_scorers")
def top_scorers(spark, sf_dir):
    return standins.players(spark, sf_dir).transform(reports.top_scorers, SINCE)


@query("performance_over_time")
def performance_over_time(spark, sf_dir):
    return standins.players(spark, sf_dir).transform(reports.performance_over_time, SINCE)


@query("win_loss_by_team")
def win_loss_by_team(spark, sf_dir):
    return standins.games(spark, sf_dir).transform(reports.win_loss_by_team, SINCE)


@query("pipeline_health_check")
def pipeline_health_check(spark, sf_dir):
    return _event_days(spark, sf_dir, "ingestion_date").transform(
        reports.pipeline_health, EVENTS_AS_OF)


def _selected_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.rostered(spark, sf_dir).selectExpr("s_name AS player_name")


@query("tile_top_scorers")
def tile_top_scorers(spark, sf_dir):
    return top_scorers(spark, sf_dir).transform(reports.tile_top_scorers)


@query("tile_monthly_performance")
def tile_monthly_performance(spark, sf_dir):
    return performance_over_time(spark, sf_dir).transform(reports.tile_monthly, FIRST, LAST)


@query("tile_top_scorers_selected")
def tile_top_scorers_selected(spark, sf_dir):
    return (
        top_scorers(spark, sf_dir)
        .transform(rows.select_entities, "player_name", _selected_names(spark, sf_dir))
        .transform(reports.tile_top_scorers)
    )


@query("tile_monthly_selected")
def tile_monthly_selected(spark, sf_dir):
    return (
        performance_over_time(spark, sf_dir)
        .transform(rows.select_entities, "player_name", _selected_names(spark, sf_dir))
        .transform(reports.tile_monthly, FIRST, LAST)
    )


# Jobs


@query("clean_games")
def clean_games(spark, sf_dir):
    return standins.raw_games(spark, sf_dir).transform(clean, GAMES, RUN_DATE)


@query("clean_players")
def clean_players(spark, sf_dir):
    return standins.raw_players(spark, sf_dir, named=True).transform(clean, PLAYERS, RUN_DATE)


@query("rejected_records")
def rejected_records(spark, sf_dir):
    return (
        standins.raw_players(spark, sf_dir, named=True).transform(rejects, PLAYERS)
        .select("player_id", "game_id", "game_date", "dropped",
                F.concat_ws(",", "rejected").alias("rejected"))
    )


@query("land_games")
def land_games_season(spark, sf_dir):
    path = scratch_path(spark, "games")
    raw = standins.raw_games(spark, sf_dir)
    land_games(raw, path, SEASON, LEAGUE)
    return jsonl.read_json_lines(spark, path, raw.schema)


def _chosen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.rostered(spark, sf_dir).selectExpr("s_suppkey AS Player_ID")


@query("land_players")
def land_chosen_players(spark, sf_dir):
    path = scratch_path(spark, "players")
    land_players(standins.raw_players(spark, sf_dir), path, SEASON, _chosen(spark, sf_dir),
                 standins.dimension(spark, sf_dir))
    return jsonl.read_json_lines(spark, path, PLAYERS.raw)


@query("audit_players")
def audit_players(spark, sf_dir):
    """What became of every record; broken lines among them."""
    path = scratch_path(spark, "audited")
    jsonl.write_json_lines(standins.raw_players(spark, sf_dir, named=True), path)
    broken = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").selectExpr(
        "'{\"Player_ID\": ' || o_orderkey AS value")
    broken.write.mode("append").text(path)
    return jsonl.read_records(spark, path, PLAYERS).transform(audit, PLAYERS)


def _league(spark: SparkSession) -> Zones:
    """Zones and a catalog database that no other query uses."""
    return Zones(scratch_path(spark, "zones"), "league")


@query("stream_games")
def stream_games(spark, sf_dir):
    """Two run dates that arrive in two steps; what arrives later repeats what was there."""
    zones = _league(spark)
    raw, state = standins.raw_games(spark, sf_dir), scratch_path(spark, "state")
    for part in ("TEAM_ID <= 4", "true"):
        for run_date, outcome in STREAM_RUNS.items():
            own = raw.filter(F.col("MATCHUP").endswith(outcome)).filter(part)
            jsonl.write_json_lines(own, zones.raw(run_date, "games"), mode="append")
        stream_table(spark, GAMES, "games", zones, state).awaitTermination()
    return pipeline.warehouse_tables(spark, zones)[GAMES.name]


_STORED: dict[tuple, Zones] = {}


def _once(job: Callable[[SparkSession, str], Zones], spark: SparkSession, sf_dir: str) -> Zones:
    """The zones a job filled, shared by the queries that read different tables and views of it."""
    key = (spark.sparkContext.applicationId, job.__name__, sf_dir)
    if key not in _STORED:
        _STORED[key] = job(spark, sf_dir)
    return _STORED[key]


def _whole_job(spark: SparkSession, sf_dir: str) -> Zones:
    zones = _league(spark)
    pipeline.run(
        spark,
        raw_games=standins.raw_games(spark, sf_dir),
        raw_players=standins.raw_players(spark, sf_dir),
        dimension=standins.dimension(spark, sf_dir),
        entities=_chosen(spark, sf_dir),
        season=SEASON,
        league=LEAGUE,
        zones=zones,
        run_date=RUN_DATE,
        since=SINCE,
        as_of=RUN_DATE,
    )
    return zones


@query("end_to_end")
def end_to_end(spark, sf_dir):
    """Land, clean, store and report; the view is read by name in another session."""
    zones = _whole_job(spark, sf_dir)
    return spark.newSession().sql(f"SELECT * FROM {zones.table('top_scorers')}")


@query("stored_players")
def stored_players(spark, sf_dir):
    """All stored columns of the players, from both sinks: a row counts once for each."""
    zones = _once(_whole_job, spark, sf_dir)
    processed = tables.read_table(
        spark, zones.processed(RUN_DATE, "player_stats"), PLAYERS.contract)
    return processed.unionByName(pipeline.warehouse_tables(spark, zones)[PLAYERS.name])


@query("stored_games")
def stored_games(spark, sf_dir):
    """All stored columns of the games, from both sinks."""
    zones = _once(_whole_job, spark, sf_dir)
    processed = tables.read_table(spark, zones.processed(RUN_DATE, "games"), GAMES.contract)
    return processed.unionByName(pipeline.warehouse_tables(spark, zones)[GAMES.name])


@query("player_performance_view")
def player_performance_view(spark, sf_dir):
    """The time-ordered view of the stored players, read by name in another session."""
    zones = _once(_whole_job, spark, sf_dir)
    return spark.newSession().sql(f"SELECT * FROM {zones.table('player_performance_over_time')}")


@query("win_loss_view")
def win_loss_view(spark, sf_dir):
    zones = _once(_whole_job, spark, sf_dir)
    return spark.newSession().sql(f"SELECT * FROM {zones.table('win_loss_by_team')}")


@query("health_view")
def health_view(spark, sf_dir):
    zones = _once(_whole_job, spark, sf_dir)
    return spark.newSession().sql(f"SELECT * FROM {zones.table('pipeline_health_check')}")


def _season_twice(spark: SparkSession, sf_dir: str) -> Zones:
    """The whole job on two days for the same season, with the tables of newest rows."""
    zones = _league(spark)
    for run_date in STREAM_DATES:
        land_games(standins.raw_games(spark, sf_dir), zones.raw(run_date, "games"), SEASON, LEAGUE)
        land_players(standins.raw_players(spark, sf_dir), zones.raw(run_date, "player_stats"), SEASON,
                     _chosen(spark, sf_dir), standins.dimension(spark, sf_dir))
        pipeline.transform(spark, zones, run_date, keep_current=True)
    pipeline.register_views(spark, zones, SINCE, RUN_DATE, newest=True)
    return zones


@query("current_top_scorers")
def current_top_scorers(spark, sf_dir):
    """A season that two runs stored counts once."""
    zones = _once(_season_twice, spark, sf_dir)
    return spark.newSession().sql(f"SELECT * FROM {zones.table('current_top_scorers')}")


@query("reconciled_runs")
def reconciled_runs(spark, sf_dir):
    """Counts of every zone for the second of two runs of a season."""
    zones = _once(_season_twice, spark, sf_dir)
    return pipeline.reconcile(spark, zones, STREAM_DATES[1])


@query("health_check_today")
def health_check_today(spark, sf_dir):
    """The health check against the current date."""
    return table(spark, sf_dir, "events").select(
        F.date_sub(F.current_date(), F.pmod("event_id", F.lit(14)).cast("int"))
        .alias("ingestion_date")).transform(reports.pipeline_health)
