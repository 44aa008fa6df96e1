from __future__ import annotations

import random
from datetime import date

import pytest
from plans import plan_of
from pyspark.sql import functions as F

from statloom.operators import joins, rows


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_duplicates_leave_one_row(spark):
    df = spark.createDataFrame([(7, "g1", 4)] * 3 + [(7, "g2", 4)], ["k", "g", "v"])
    assert collected(rows.dedupe(df, ["k", "g"])) == [(7, "g1", 4), (7, "g2", 4)]


def test_null_keys_are_dropped(spark):
    df = spark.createDataFrame([(None, "a"), (3, None), (None, None)], "k long, v string")
    assert collected(rows.drop_null_keys(df, "k")) == [(3, None)]


def test_the_complete_record_is_kept(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 9, "b"), (1, 9, None), (1, None, None)],
                               "k long, v long, w string")
    assert collected(rows.dedupe(df, ["k"])) == [(1, 9, "b")]


def _smallest_by_key(data, width):
    def rank(row):
        return (sum(v is None for v in row[width:]),
                *((v is not None, 0 if v is None else v) for v in row[width:]))
    best = {}
    for row in data:
        key = row[:width]
        if key not in best or rank(row) < rank(best[key]):
            best[key] = row
    return sorted(best.values(), key=repr)


@pytest.mark.parametrize("parts", [1, 7])
def test_dedupe_is_the_smallest_row_however_split(spark, parts):
    rng = random.Random(5)
    data = [(rng.choice([1, 2, None]), rng.choice(["a", "b", None]),
             rng.choice([None, 1.5, 2.5]), rng.choice([None, "x", "y"])) for _ in range(300)]
    df = spark.createDataFrame(data, "k1 long, k2 string, v double, w string").repartition(parts)
    assert collected(rows.dedupe(df, ["k1", "k2"])) == _smallest_by_key(data, 2)


def test_dedupe_keeps_column_order_and_key_only_frames(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, "b", 2)], ["v", "k", "k2"])
    assert rows.dedupe(df, ["k", "k2"]).columns == ["v", "k", "k2"]
    assert rows.dedupe(df.select("k2"), ["k2"]).count() == 1


def test_dedupe_compares_keys_by_value(spark):
    df = spark.createDataFrame(
        [(0.0, 1), (-0.0, 2), (float("nan"), 1), (float("nan"), 2), (None, 1), (None, 2)],
        "k double, v int")
    assert rows.dedupe(df, ["k"]).count() == 3


def test_dedupe_aggregates_before_the_shuffle(spark):
    plan = plan_of(rows.dedupe(spark.range(10).selectExpr("id % 2 as k", "id as v"), ["k"]))
    assert "partial_min" in plan and plan.count("Exchange") >= 1


DAYS = [date(2024, 9, 30), date(2024, 10, 1), date(2025, 4, 13), date(2025, 4, 14), None]


@pytest.fixture
def dated(spark):
    return spark.createDataFrame([(d,) for d in DAYS], "game_date date")


def test_date_filters(dated):
    assert rows.since(dated, "2024-10-01").count() == 3
    assert rows.between(dated, "2024-10-01", "2025-04-13").count() == 2
    assert rows.lookback(dated, 1, "2025-04-14", "game_date").count() == 2
    assert rows.retain_recent(dated, 195, date(2025, 4, 14), "game_date").count() == 3


def test_lookback_defaults_to_today(spark):
    df = spark.range(1).select(F.explode(F.sequence(
        F.date_sub(F.current_date(), 9), F.current_date())).alias("ingestion_date"))
    assert rows.lookback(df).count() == 8


def test_season_and_league(spark):
    df = spark.createDataFrame([("22024", "00"), ("22024", "10"), ("22023", "00")],
                               ["season_id", "league_id"])
    assert rows.filter_season(df, "22024").count() == 2
    assert rows.filter_season(df, "22024", "00").count() == 1


def test_union_keeps_copies_and_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id long, name string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "name string, id long")
    c = spark.createDataFrame([(3, 0.5)], "id long, rate double")
    out = rows.union_entities([a, b, c])
    assert collected(out) == collected(spark.createDataFrame(
        [(1, "x", None), (2, "y", None), (2, "y", None), (3, None, 0.5)],
        "id long, name string, rate double"))


# Lookup and selection: the small and the large path must agree.

LIMITS = [joins.BROADCAST_BYTES, 0]


@pytest.fixture
def fact(spark):
    rng = random.Random(3)
    data = [(1 if rng.random() < 0.4 else rng.choice([2, 3, 4, None]), i) for i in range(400)]
    return spark.createDataFrame(data, "player_id long, pts long").repartition(5)


@pytest.mark.parametrize("limit", LIMITS)
def test_lookup_falls_back_to_the_id(spark, fact, limit):
    dimension = spark.createDataFrame(
        [(1, "One"), (1, "Uno"), (2, None), (3, "Three"), (None, "Nobody")],
        "id long, full_name string")
    out = joins.lookup_name(fact, dimension, broadcast_bytes=limit)
    names = {1: "One", 2: "2", 3: "Three", 4: "4", None: None}
    assert collected(out) == sorted(
        ((r["player_id"], r["pts"], names[r["player_id"]]) for r in fact.collect()), key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_lookup_replaces_an_existing_name(spark, fact, limit):
    dimension = spark.createDataFrame([(1, "One")], "id long, full_name string")
    out = joins.lookup_name(fact.withColumn("player_name", F.lit("old")), dimension,
                            broadcast_bytes=limit)
    assert out.filter("player_id = 1").select("player_name").distinct().collect() == [("One",)]


@pytest.mark.parametrize("limit", LIMITS)
def test_selection_by_frame(spark, fact, limit):
    wanted = spark.createDataFrame([(1,), (1,), (4,), (9,)], "player_id long")
    out = joins.semi_lookup(fact, wanted, "player_id", limit)
    assert collected(out) == collected(fact.filter("player_id in (1, 4)"))


def test_selection_by_list(fact):
    assert collected(rows.select_entities(fact, "player_id", [1, 4])) == collected(
        fact.filter("player_id in (1, 4)"))


def test_selection_by_an_empty_frame(spark, fact):
    assert rows.select_entities(fact, "player_id", spark.createDataFrame(
        [], "player_id long")).count() == 0


@pytest.mark.parametrize("hot_rows", [20, 10_000])
def test_hot_or_not_the_rows_are_the_same(spark, fact, hot_rows):
    dimension = spark.createDataFrame([(1, "One"), (3, "Three")], "id long, full_name string")
    assert collected(joins.lookup_name(fact, dimension, broadcast_bytes=0, hot_rows=hot_rows)) == \
        collected(joins.lookup_name(fact, dimension))
    wanted = dimension.selectExpr("id AS player_id")
    assert collected(joins.semi_lookup(fact, wanted, "player_id", 0, hot_rows)) == \
        collected(joins.semi_lookup(fact, wanted, "player_id"))


def test_selection_keeps_the_order_of_columns(spark, fact):
    turned = fact.select("pts", "player_id")
    wanted = spark.createDataFrame([(1,)], "player_id long")
    for limit in LIMITS:
        assert joins.semi_lookup(turned, wanted, "player_id", limit).columns == turned.columns


def test_small_lookup_is_broadcast_and_large_is_salted_where_hot(spark, fact):
    dimension = spark.createDataFrame([(1, "One")], "id long, full_name string")
    assert "BroadcastHashJoin" in plan_of(joins.lookup_name(fact, dimension))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(joins.lookup_name(fact, dimension, broadcast_bytes=0))
        hot = plan_of(joins.lookup_name(fact, dimension, broadcast_bytes=0, hot_rows=20))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan and "_salt" not in plan
    assert "_salt" in hot and "SortMergeJoin" in hot


def test_hot_key_is_spread_by_the_salt(spark):
    fact = spark.range(0, 64_000, 1, 64).selectExpr("1L as player_id", "id as pts")
    dimension = spark.createDataFrame([(1, "One")], "id long, full_name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        out = joins.lookup_name(fact, dimension, broadcast_bytes=0, hot_rows=2000)
        sizes = out.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in sizes) == 64_000
    assert max(r["count"] for r in sizes) < 64_000 / 3


def test_measured_size_counts_text(spark):
    df = spark.createDataFrame([(1, "é" * 10), (2, None)], "id long, full_name string")
    assert joins.measured_bytes(df) == 2 * (16 + 16) + 20
    assert joins.measured_bytes(df.limit(0)) == 0
