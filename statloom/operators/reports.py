"""Reporting queries over the cleaned tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.dates import month_bucket, round_half_up
from statloom.operators import rows

METRICS = ("pts", "reb", "ast", "plus_minus")


def top_k(df: DataFrame, order: Sequence[Column | str], k: int) -> DataFrame:
    """The first ``k`` rows of an order; each task keeps ``k`` rows, nothing is fully sorted."""
    return df.orderBy(*order).limit(k)


def season_averages(df: DataFrame, first: date | str) -> DataFrame:
    """Per player: rounded average of each metric and the number of games."""
    return (
        df.transform(rows.since, first)
        .groupBy("player_id", "player_name")
        .agg(*[round_half_up(F.avg(m)).alias(f"avg_{m}") for m in METRICS],
             F.count("*").alias("games_played"))
    )


def top_scorers(df: DataFrame, first: date | str, k: int = 20) -> DataFrame:
    """The ``k`` players with the highest average; ties go to the smaller id and name."""
    return df.transform(season_averages, first).transform(
        top_k, [F.desc("avg_pts"), "player_id", "player_name"], k)


def performance_over_time(df: DataFrame, first: date | str) -> DataFrame:
    """One row per player and game, by date.

    The table's key follows the date in the sort, so that the rows of one busy day are split over
    many tasks instead of meeting in one.
    """
    return (
        df.transform(rows.since, first)
        .orderBy("game_date", "player_id", "game_id")
        .select("player_id", "player_name", "game_date", *METRICS)
    )


def win_loss_by_team(df: DataFrame, first: date | str) -> DataFrame:
    """Games per team and outcome; an unknown outcome counts as a group of its own."""
    return (
        df.transform(rows.since, first)
        .groupBy("team_abbreviation", "wl").agg(F.count("*").alias("game_count"))
        .orderBy("team_abbreviation", "wl")
    )


def pipeline_health(df: DataFrame, as_of: date | str | None = None, days: int = 7) -> DataFrame:
    """Rows per ingestion date in the last days, latest first."""
    return (
        df.transform(rows.lookback, days, as_of)
        .groupBy("ingestion_date").agg(F.count("*").alias("records_ingested"))
        .orderBy(F.desc("ingestion_date"))
    )


def tile_top_scorers(scorers: DataFrame) -> DataFrame:
    """Mean of the listed averages by name, highest first; rows of equal name are averaged again."""
    return (
        scorers.groupBy("player_name").agg(F.avg("avg_pts").alias("avg_pts"))
        .orderBy(F.desc("avg_pts"), "player_name")
    )


def tile_monthly(performance: DataFrame, first: date | str, last: date | str) -> DataFrame:
    """Average points by player name and month within a date range."""
    return (
        performance.transform(rows.between, first, last)
        .groupBy("player_name", month_bucket(F.col("game_date")).alias("month"))
        .agg(F.avg("pts").alias("avg_pts"))
        .orderBy("month", "player_name")
    )


def landed_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    return rows.union_entities([
        df.agg(F.count("*").alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ])
