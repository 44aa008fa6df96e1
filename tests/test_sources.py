from __future__ import annotations

import os
from collections import Counter
from datetime import date

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from statloom.operators import columns, rows
from statloom.schemas import GAMES, PLAYERS
from statloom.plans.clean import audit, rejects, typed
from statloom.session import fit_to_input, partition_bytes, scratch_path, shuffle_partitions
from statloom.sources import jsonl, tables
from statloom.sources.paths import Zones


def bag(df):
    return Counter(repr(tuple(r)) for r in df.collect())


@pytest.fixture
def players(spark):
    """Contract rows; half of them fall on one date, a third belong to one player."""
    filled = {f.name: F.lit(None).cast(f.dataType) for f in PLAYERS.contract.fields}
    filled |= {
        "player_id": F.expr("if(id % 3 = 0, 1, id % 50)"),
        "player_name": F.expr("concat('P', id % 50)"),
        "game_id": F.lpad(F.col("id").cast("string"), 10, "0"),
        "game_date": F.expr("case when id % 2 = 0 then date'2024-10-01' when id % 101 = 0 then null "
                            "else date_add(date'2024-10-01', cast(id % 20 as int)) end"),
        "pts": F.col("id"),
        "ingestion_date": F.lit(date(2025, 4, 13)),
    }
    return spark.range(2000).select(*[c.alias(n) for n, c in filled.items()])


def test_paths():
    zones = Zones("s3://bucket", "league")
    assert zones.raw("2025-04-13", "games") == "s3://bucket/raw/league/2025-04-13/games.json"
    assert zones.processed(date(2025, 4, 13), "player_stats") == (
        "s3://bucket/processed/league/2025-04-13/player_stats")
    assert zones.warehouse("game_stats") == "s3://bucket/warehouse/league/game_stats"
    with pytest.raises(ValueError):
        zones.raw("13.04.2025", "games")


def test_json_lines_roundtrip(spark):
    df = spark.createDataFrame([("00022", 1.5, "W"), (None, float("nan"), None)],
                               "GAME_ID string, PTS double, WL string")
    path = scratch_path(spark, "json")
    jsonl.write_json_lines(df, path)
    lines = {r["value"] for r in spark.read.text(path).collect()}
    assert '{"GAME_ID":"00022","PTS":1.5,"WL":"W"}' in lines
    assert all('"WL"' in line for line in lines)
    assert bag(jsonl.read_json_lines(spark, path, df.schema)) == bag(df)
    jsonl.write_json_lines(df, path)
    assert jsonl.read_json_lines(spark, path, df.schema).count() == 2


def test_many_paths_are_one_scan(spark):
    paths = [scratch_path(spark, "json") for _ in range(3)]
    for i, path in enumerate(paths):
        jsonl.write_json_lines(spark.range(i, i + 2), path)
    df = jsonl.read_json_lines(spark, paths, spark.range(1).schema)
    assert sorted(r["id"] for r in df.collect()) == [0, 1, 1, 2, 2, 3]
    assert plan_of(df).count("Scan json") == 2  # the tree and its details


def test_broken_lines_are_kept_on_request(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id": 1}\n{"id": 2\n{"id": "x"}\n')
    schema = spark.range(1).schema
    assert jsonl.read_json_lines(spark, str(tmp_path), schema).count() == 3
    df = jsonl.read_json_lines(spark, str(tmp_path), schema, keep_corrupt=True)
    assert [r["_corrupt_record"] for r in df.collect()] == [None, '{"id": 2', '{"id": "x"}']


@pytest.mark.parametrize("layout", [
    lambda df: tables.date_layout(df), lambda df: tables.cluster_layout(df, PLAYERS)])
def test_partitioned_roundtrip_with_null_dates(spark, players, layout):
    path = scratch_path(spark, "table")
    tables.write_partitioned(layout(players), path)
    out = tables.read_table(spark, path, PLAYERS.contract)
    assert out.columns == PLAYERS.contract.names
    assert out.schema == PLAYERS.contract
    assert bag(out) == bag(players)
    assert out.filter("game_date is null").count() > 0
    assert rows.since(out, "2000-01-01").filter("game_date is null").count() == 0


def test_append_doubles_and_replace_does_not(spark, players):
    path = scratch_path(spark, "table")
    for _ in range(2):
        tables.write_partitioned(players, path)
    assert tables.read_table(spark, path, PLAYERS.contract).count() == 4000
    for _ in range(2):
        tables.write_partitioned(players, path, mode=tables.REPLACE_DATES)
    assert bag(tables.read_table(spark, path, PLAYERS.contract)) == bag(players)
    other = players.filter("game_date = date'2024-10-01'").limit(5)
    tables.write_partitioned(other, path, mode=tables.REPLACE_DATES)
    assert tables.read_table(spark, path, PLAYERS.contract).count() == 2000 - 1000 + 5 - (
        players.filter("game_date = date'2024-10-01'").count() - 1000)
    with pytest.raises(ValueError):
        tables.write_partitioned(players, path, mode="other")


def test_date_filter_prunes_partitions_and_columns(spark, players):
    path = scratch_path(spark, "table")
    tables.write_partitioned(players, path)
    plan = plan_of(rows.since(tables.read_table(spark, path, PLAYERS.contract), "2024-10-05")
                   .groupBy("player_id").agg(F.avg("pts")))
    assert "PartitionFilters: [isnotnull(game_date" in plan
    assert "ReadSchema: struct<player_id:bigint,pts:bigint>" in plan


def test_cluster_layout_splits_a_hot_date_along_the_cluster(spark, players):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        parts = (
            tables.cluster_layout(players.repartition(8), PLAYERS)
            .withColumn("p", F.spark_partition_id())
        )
        got = parts.groupBy("p").agg(
            F.count("*").alias("n"), F.countDistinct("player_id").alias("ids"),
            F.countDistinct("game_date").alias("dates")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["n"] for r in got) == 2000
    assert max(r["n"] for r in got) < 2000 / 4
    hot = [r for r in got if r["dates"] == 1]
    assert len(hot) >= 4 and max(r["ids"] for r in hot) < 50


def test_files_of_a_hot_date_hold_separate_cluster_ranges(spark, players):
    path = scratch_path(spark, "table")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        hot = players.filter("player_id <> 1").repartition(8)
        tables.write_partitioned(tables.cluster_layout(hot, PLAYERS), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    rows_of = (
        tables.read_table(spark, path, PLAYERS.contract)
        .filter("game_date = date'2024-10-01'")
        .select("player_id", F.col("_metadata.file_path").alias("file"))
    )
    ranges = sorted(
        (r["lo"], r["hi"]) for r in rows_of.groupBy("file").agg(
            F.min("player_id").alias("lo"), F.max("player_id").alias("hi")).collect())
    assert len(ranges) >= 4
    assert all(left[1] <= right[0] for left, right in zip(ranges, ranges[1:]))
    # Within a file the rows are in cluster order.
    for row in rows_of.select("file").distinct().collect():
        ids = [r["player_id"] for r in spark.read.parquet(row["file"]).collect()]
        assert ids == sorted(ids)


def test_catalog_table_is_created_once_and_appended_by_name(spark, players):
    name = "contract_players"
    for _ in range(2):
        tables.create_table(spark, name, PLAYERS)
    shuffled = players.select(*reversed(PLAYERS.contract.names))
    tables.append_to_table(shuffled, name, PLAYERS)
    out = spark.table(name).transform(columns.project, PLAYERS.contract)
    assert out.schema == PLAYERS.contract and bag(out) == bag(players)
    tables.append_to_table(players, name, PLAYERS)
    assert spark.table(name).count() == 4000
    spark.sql(f"DROP TABLE {name}")


def test_expired_partitions_are_dropped(spark, players):
    name = "expiring_players"
    tables.create_table(spark, name, PLAYERS)
    path = scratch_path(spark, "expiring")
    spark.sql(f"DROP TABLE {name}")
    tables.create_table(spark, name, PLAYERS, path)
    # The undated rows and the days up to the 10th come from an old run, the 4th from both.
    old = "game_date is null or game_date <= date'2024-10-10'"
    runs = players.withColumn("ingestion_date", F.expr(
        f"case when {old} and not (game_date <=> date'2024-10-04' and id % 3 = 0) "
        "then date'2024-10-11' else date'2024-11-01' end".replace("id % 3", "pts % 3")))
    tables.append_to_table(runs, name, PLAYERS)
    kept = players.filter(f"not ({old}) or game_date = date'2024-10-04'")
    dates = players.filter(old).select("game_date").distinct().count()
    assert tables.drop_expired(spark, name, PLAYERS, 30, "2024-11-12") == dates - 1
    assert spark.table(name).count() == kept.count()
    # The files are gone as well.
    assert tables.read_table(spark, path, PLAYERS.contract).count() == kept.count()
    assert tables.drop_expired(spark, name, PLAYERS, 30, "2024-11-12") == 0
    spark.sql(f"DROP TABLE {name}")


def test_game_table_columns(spark):
    tables.create_table(spark, "contract_games", GAMES)
    assert {f.name: f.dataType for f in spark.table("contract_games").schema} == {
        f.name: f.dataType for f in GAMES.contract}
    spark.sql("DROP TABLE contract_games")


def test_shuffle_width_follows_the_input():
    assert shuffle_partitions(0, 8) == 16
    assert shuffle_partitions(10 * 10**9, 8) == 75
    assert shuffle_partitions(10**12, 400) == 4096
    for size in (10**9, 10**12, 100 * 10**12, 10**15):
        maps, reducers = -(-size // partition_bytes(size)), shuffle_partitions(size, 4000)
        assert maps * reducers <= 1.01e9
    assert 3 * 10**9 < partition_bytes(100 * 10**12) < 4 * 10**9


def test_a_job_fits_the_session_to_its_input(spark, tmp_path):
    (tmp_path / "x.json").write_text("x" * 1000)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        assert fit_to_input(spark, str(tmp_path), str(tmp_path / "none")) == 1000
        assert [spark.conf.get(k) for k in keys] == [str(128 << 20), "16"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_gzipped_feeds_count_as_the_text_they_hold(spark, tmp_path):
    """Their tasks parse ten times the bytes of the files: fewer files share a task, and the shuffle is wider."""
    (tmp_path / "part-0.json.gz").write_bytes(b"x")
    os.truncate(tmp_path / "part-0.json.gz", 1 << 30)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        assert fit_to_input(spark, str(tmp_path)) == 1 << 30
        assert [int(spark.conf.get(k)) for k in keys] == [(128 << 20) // 10, 80]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_feeds_are_compressed_at_a_low_level(spark, tmp_path):
    df = spark.range(20_000).selectExpr(*(f"hash(id, {i}) % 50 AS column_{i}" for i in range(20))).coalesce(1)
    jsonl.write_json_lines(df, str(tmp_path / "low"))
    df.write.option("compression", "gzip").json(str(tmp_path / "usual"))
    low, usual = (sum(f.stat().st_size for f in (tmp_path / d).glob("*.gz")) for d in ("low", "usual"))
    assert usual < low < 2 * usual
    assert spark.read.json(str(tmp_path / "low")).exceptAll(df.selectExpr(*(f"cast({c} as bigint) {c}" for c in sorted(df.columns)))).isEmpty()


SPELLED = [
    '{"PLAYER_ID": 2544.0, "Pts": "30", "GAME_id": "g1", "fg_pct": "0.5", "MIN": 35.9}',
    '{"player_id": "77", "PTS": NaN, "Game_ID": 22, "TOV": 1e3, "REB": "1e3", "MIN": "x"}',
    '{"Player_ID": 5, "PTS": null, "AST": 3000000000, "STL": "3000000000", "other": {"a": 1}}',
    '{"PTS": 1}', '{"broken', '', '[1]',
]


def test_records_keep_every_spelling_and_type(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join(SPELLED))
    feed = jsonl.read_records(spark, str(tmp_path), PLAYERS)
    got = {r["player_id"]: r for r in feed.transform(typed, PLAYERS).collect()}
    assert set(got) == {2544, 77, 5}
    assert (got[2544]["pts"], got[2544]["min"], got[2544]["fg_pct"]) == (30, 35, 0.5)
    assert (got[2544]["game_id"], got[77]["game_id"]) == ("g1", "22")
    # Numbers and texts have rules of their own: 1e3 counts as a number only.
    assert (got[77]["pts"], got[77]["tov"], got[77]["reb"], got[77]["min"]) == (0, 1000, None, None)
    assert (got[5]["pts"], got[5]["ast"], got[5]["stl"]) == (None, 2147483647, None)


def test_rejects_do_not_depend_on_what_is_selected(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join(SPELLED))
    out = jsonl.read_records(spark, str(tmp_path), PLAYERS).transform(rejects, PLAYERS)
    got = sorted((r["rejected"], r["dropped"]) for r in out.collect())
    assert got == [([], True), (["_corrupt_record"], True), (["_corrupt_record"], True),
                   (["reb", "min"], False), (["stl"], False)]
    assert out.count() == len(out.select("rejected").collect()) == len(got)
    row = jsonl.read_records(spark, str(tmp_path), PLAYERS).transform(audit, PLAYERS).first()
    assert row.asDict() == {"records_read": 6, "kept": 3, "dropped": 3, "duplicates": 0,
                            "unreadable": 4}


def test_two_spellings_in_one_record_are_an_error(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"PTS": 1, "pts": 2}')
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        jsonl.read_records(spark, str(tmp_path), PLAYERS).collect()


def test_a_column_that_no_record_has_is_an_error(spark, tmp_path):
    (tmp_path / "p.json").write_text("\n".join(SPELLED))
    feed = jsonl.read_records(spark, str(tmp_path), PLAYERS)
    seen = feed.agg(*jsonl.presence(PLAYERS)).first().asDict()
    with pytest.raises(ValueError, match="matchup"):
        jsonl.require_columns(seen, PLAYERS)
    empty = feed.limit(0).agg(*jsonl.presence(PLAYERS)).first().asDict()
    jsonl.require_columns(empty, PLAYERS)


def test_a_write_gives_back_its_own_rows(spark, players):
    path = scratch_path(spark, "marked")
    for part in ("pts < 500", "pts >= 500"):
        own = players.filter(part)
        assert bag(tables.write_marked(own, path, PLAYERS)) == bag(own)
    assert tables.read_table(spark, path, PLAYERS.contract).count() == 2000
    assert tables.write_marked(players.limit(0), path, PLAYERS) is None


def test_merge_touches_the_dates_of_the_batch_only(spark, players):
    path = scratch_path(spark, "merge")
    name = "merge_" + path[-32:]
    tables.create_table(spark, name, PLAYERS, path)
    unique = players.transform(rows.dedupe, [PLAYERS.partition, *PLAYERS.keys])
    tables.append_to_table(unique, name, PLAYERS)
    before = {r["path"] for r in tables.file_sizes(spark, path).collect()}
    batch = unique.filter("game_date = date'2024-10-04' or game_date is null").withColumn("pts", F.col("pts") + 1000)
    assert tables.merge_rows(batch, name, PLAYERS) == 2
    kept = before & {r["path"] for r in tables.file_sizes(spark, path).collect()}
    assert all("2024-10-04" not in f and tables.NO_DATE not in f for f in kept) and kept
    out = spark.table(name).select(*PLAYERS.contract.names)
    touched = "game_date = date'2024-10-04' or game_date is null"
    assert bag(out.filter(touched)) == bag(batch)
    assert bag(out.filter(f"not coalesce({touched}, true)")) == bag(unique.filter(f"not coalesce({touched}, true)"))
    plan = plan_of(tables.on_dates(spark.table(name), tables.dates_of(batch)))
    assert "PartitionFilters: [(" in plan
    assert tables.merge_rows(batch.limit(0), name, PLAYERS) == 0
    spark.sql(f"DROP TABLE {name}")


def test_latest_prefers_the_newest_run_then_the_most_complete(spark):
    df = spark.createDataFrame(
        [("a", 1, "x", "2025-01-01"), ("a", 2, None, "2025-01-02"), ("a", 3, "y", "2025-01-02"),
         ("b", 4, "z", None), ("b", 5, "z", "2024-01-01"), (None, 6, None, None)],
        "k string, v int, w string, s string").withColumn("s", F.col("s").cast("date"))
    got = {r["k"]: r["v"] for r in rows.latest(df, ["k"], "s").collect()}
    assert got == {"a": 3, "b": 5, None: 6}
    tree = plan_of(rows.latest(df, ["k"], "s"))
    assert tree.split("\n\n\n")[0].count("Exchange") == 1


def test_compaction_bounds_the_files_of_a_date(spark, players):
    path = scratch_path(spark, "compact")
    name = "compact_" + path[-32:]
    tables.create_table(spark, name, PLAYERS, path)
    for n in range(6):
        tables.append_to_table(players.filter(f"pts % 6 = {n}"), name, PLAYERS)
    counts = lambda: {r[0]: r[1] for r in tables.file_sizes(spark, path).groupBy("folder").count().collect()}
    crowded = {d for d, n in counts().items() if n > 4}
    assert tables.compact(spark, name, PLAYERS) == len(crowded) > 0
    assert max(counts().values()) <= 4
    assert bag(spark.table(name).select(*PLAYERS.contract.names)) == bag(players)
    assert tables.compact(spark, name, PLAYERS) == 0
    # Small targets cut a date into as many files as its bytes need.
    assert tables.crowded_dates(spark, path, 0, 1) == []
    spark.sql(f"DROP TABLE {name}")


def scanned_rows(spark, df):
    """How many rows the scan of a frame gave."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        counted = df.groupBy().agg(F.count("*"), F.max(df.columns[0]))
        counted.collect()
        return counted._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply(
            "numOutputRows").value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_buckets_spare_the_shuffle(spark, players):
    name = "by_player_test"
    tables.bucketed_table(players, name, "player_id", 4, "player_id", "game_date")
    by_player = spark.table(name)
    chosen = spark.createDataFrame([(1,), (2,)], "player_id long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = by_player.groupBy("player_id", "player_name").agg(F.avg("pts"))
        assert "Exchange" not in plan_of(totals)
        picked = by_player.hint("merge").join(by_player.groupBy("player_id").count(), "player_id")
        assert "Exchange" not in plan_of(picked)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # A filter reads the rows of one bucket, not of all four.
    one = rows.select_entities(by_player, "player_id", [2])
    ids = {r[0] for r in by_player.selectExpr("player_id", "pmod(hash(player_id), 4) AS b").filter(
        "b = pmod(hash(2L), 4)").distinct().collect()}
    assert scanned_rows(spark, one) <= players.filter(F.col("player_id").isin(ids)).count() < players.count()
    assert bag(by_player.select(*players.columns)) == bag(players)
    assert bag(rows.select_entities(by_player, "player_id", chosen).select(*players.columns)) == bag(
        players.filter("player_id in (1, 2)"))
    spark.sql(f"DROP TABLE {name}")


def test_bloom_filters_skip_row_groups(spark):
    """An id within the least and greatest of a file, but in none of its rows, is read with no filter only."""
    df = spark.range(0, 200_000, 2).selectExpr("lpad(id, 10, '0') AS game_id", "id AS pts").coalesce(1)

    def scanned(options):
        path = scratch_path(spark, "bloom")
        df.write.options(**options).option("parquet.enable.dictionary", "false").parquet(path)
        out = spark.read.schema(df.schema).parquet(path).filter("game_id = '0000100001'")
        assert out.count() == 0
        return scanned_rows(spark, out)

    assert scanned({}) > 0
    assert scanned(tables.bloom_options(["game_id"], 100_000)) == 0


def test_numbers_of_odd_records_are_exact(spark, tmp_path):
    """Whether taken as declared or as variants; the text of the id makes each record odd."""
    lines = ['{"Player_ID": "1", "FGM": 9007199254740993, "PTS": 2147483648, "REB": -3000000000, "AST": 12.7, "STL": 1e3}',
             '{"Player_ID": "2", "FGM": "7", "PTS": "NaN", "REB": "+INF", "AST": "1e3", "STL": null}']
    (tmp_path / "p.json").write_text("\n".join(lines))
    feed = jsonl.read_records(spark, str(tmp_path), PLAYERS)
    assert [r["odd"] for r in feed.collect()] == [True, True]
    got = {r["player_id"]: (r["fgm"], r["pts"], r["reb"], r["ast"], r["stl"]) for r in feed.transform(typed, PLAYERS).collect()}
    assert got == {1: (9007199254740993, 2147483647, -2147483648, 12, 1000), 2: (7, 0, None, None, None)}


def test_json_lines_are_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jsonl, "FILE_LINES", 3)
    df = spark.range(10).selectExpr("id", "nullif(id, 4) AS other").coalesce(1)
    path = str(tmp_path / "out.json")
    jsonl.write_json_lines(df, path)
    jsonl.write_json_lines(df.filter("id < 2"), path, mode="append")
    names = [p.name for p in (tmp_path / "out.json").glob("part-*")]
    assert len(names) == 5 and all(n.endswith(".json.gz") for n in names)
    assert jsonl.read_json_lines(spark, path, df.schema).count() == 12


def test_odd_records_are_taken_as_declared_where_that_is_exact(spark, tmp_path):
    """The text of the id makes each record odd; only what declared types spell or round otherwise stays a variant."""
    usual = ('{"Player_ID": "1", "SEASON_ID": "22024", "Game_ID": "0022400001", "GAME_DATE": "JAN 15, 2025", "FG_PCT": 0.456, '
             '"PLUS_MINUS": -3.5, "PTS": 30, "player_name": "N. Infinity"}')
    other = ('{"Player_ID": "2", "SEASON_ID": 1e3, "Game_ID": 1.50, "GAME_DATE": -Infinity, "FG_PCT": -0.0, '
             '"PLUS_MINUS": 1.00000005960464477539062500000001, "PTS": "30", "player_name": {"b": 1, "a": 2.50}}')
    (tmp_path / "p.json").write_text(f"{usual}\n{other}")
    feed = jsonl.read_records(spark, str(tmp_path), PLAYERS)
    names = ["season_id", "game_id", "game_date", "fg_pct", "plus_minus", "pts", "player_name"]
    held = feed.select("odd", *(F.col("odd_" + n).isNotNull().alias(n) for n in names)).collect()
    assert [set(r) for r in held] == [{True, False}, {True}] and all(r["odd"] for r in held)
    assert not any(held[0][n] for n in names)
    got = {r["player_id"]: tuple(r[n] for n in names) for r in feed.transform(typed, PLAYERS).collect()}
    assert got[1] == ("22024", "0022400001", date(2025, 1, 15), 0.4560000002384186, -3.5, 30, "N. Infinity")
    assert got[2] == ("1000.0", "1.5", None, 0.0, 1.0000001192092896, 30, '{"a":2.5,"b":1}')
    assert str(got[2][3]) == "0.0"
