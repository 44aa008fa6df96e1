"""Filters, deduplication and union."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.dates import day
from statloom.operators.joins import semi_lookup


def drop_null_keys(df: DataFrame, column: str) -> DataFrame:
    """Drop rows whose key is null."""
    return df.filter(F.col(column).isNotNull())


def since(df: DataFrame, first: date | str, column: str = "game_date") -> DataFrame:
    """Keep rows on or after a day; null dates go."""
    return df.filter(F.col(column) >= day(first))


def lookback(df: DataFrame, days: int = 7, as_of: date | str | None = None,
             column: str = "ingestion_date") -> DataFrame:
    """Keep rows from ``days`` before ``as_of`` onward, without an upper bound."""
    return df.filter(F.col(column) >= F.date_sub(day(as_of), days))


def between(df: DataFrame, first: date | str, last: date | str,
            column: str = "game_date") -> DataFrame:
    """Keep rows in a date range, both ends included."""
    return df.filter(F.col(column).between(day(first), day(last)))


def retain_recent(df: DataFrame, days: int = 30, as_of: date | str | None = None,
                  column: str = "ingestion_date") -> DataFrame:
    """Keep rows no older than ``days``."""
    return lookback(df, days, as_of, column)


def select_entities(df: DataFrame, column: str, entities: Sequence | DataFrame) -> DataFrame:
    """Keep rows of the given entities: a list of values, or a frame holding them in ``column``."""
    if isinstance(entities, DataFrame):
        return semi_lookup(df, entities, column)
    return df.filter(F.col(column).isin(list(entities)))


def filter_season(df: DataFrame, season: str, league: str | None = None,
                  season_column: str = "season_id", league_column: str = "league_id") -> DataFrame:
    """Keep one season, and one league if given."""
    kept = df.filter(F.col(season_column) == season)
    return kept if league is None else kept.filter(F.col(league_column) == league)


def dedupe(df: DataFrame, keys: Sequence[str], first: Sequence[Column] = (), dealt: bool = False) -> DataFrame:
    """One row per key, nulls in a key being equal; of a key's rows the one with the fewest nulls
    stays, among those the smallest by the other columns. ``first`` are values to compare before that.

    A minimum over a struct is aggregated before the shuffle, so each task sends one row per key
    however many copies a key has, and the same row wins on every run. The hash leads the grouping
    because both sorts compare it first: game ids share their first characters, hashes do not.

    The aggregate sorts its rows, as a row has no fixed length. With ``dealt`` the rows are dealt by key first and sorted
    once, in tasks as large as the shuffle makes them, instead of once before in tasks as large as the files' splits, which
    spill. That is for feeds, whose keys have few copies each: all copies of one key are then sorted by one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    gaps = reduce(Column.__add__, (F.col(c).isNull().cast("int") for c in rest))
    before = [value.alias(f"_first{i}") for i, value in enumerate(first)]
    hashed = df.withColumn("_hash", F.xxhash64(*keys))
    return (
        (hashed.repartition("_hash") if dealt else hashed).groupBy("_hash", *keys)
        .agg(F.min(F.struct(*before, gaps.alias("_gaps"), *rest)).alias("_row"))
        .select(*keys, "_row.*").select(*df.columns)
    )


def latest(df: DataFrame, keys: Sequence[str], stamp: str = "ingestion_date") -> DataFrame:
    """One row per key: of its newest run, by the rule of ``dedupe`` within that run."""
    return dedupe(df, keys, [newest_first(stamp)])


def newest_first(stamp: str = "ingestion_date") -> Column:
    """Sorts later days first, null last."""
    return F.coalesce(-F.unix_date(stamp), F.lit(2**31 - 1))


def union_entities(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name, copies included; absent columns become null.

    Halving keeps the plan shallow for long lists. Files of one schema are better read in one scan
    (``read_json_lines`` takes many paths).
    """
    if len(frames) == 1:
        return frames[0]
    half = len(frames) // 2
    return union_entities(frames[:half]).unionByName(
        union_entities(frames[half:]), allowMissingColumns=True)
