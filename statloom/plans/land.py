"""Landing: selected raw records to JSON lines of one run date."""

from __future__ import annotations

from pyspark.sql import DataFrame

from statloom.operators import columns, joins, rows
from statloom.sources.jsonl import write_json_lines


def land_games(raw: DataFrame, path: str, season: str, league: str | None = None,
               season_column: str = "SEASON_ID", league_column: str = "LEAGUE_ID") -> None:
    """Write the games of one season (and league)."""
    write_json_lines(
        raw.transform(rows.filter_season, season, league, season_column, league_column), path)


def selected_players(raw: DataFrame, season: str, entities, dimension: DataFrame,
                     key: str = "Player_ID", season_column: str = "SEASON_ID") -> DataFrame:
    """The chosen players' records of one season, gaps filled with zero, with their names."""
    return (
        raw.transform(rows.filter_season, season, season_column=season_column)
        .transform(rows.select_entities, key, entities)
        .transform(columns.fill_missing)
        .transform(joins.lookup_name, dimension, key, "player_name")
    )


def land_players(raw: DataFrame, path: str, season: str, entities, dimension: DataFrame,
                 key: str = "Player_ID", season_column: str = "SEASON_ID") -> None:
    """Write the chosen players' records of one season in one job."""
    write_json_lines(
        selected_players(raw, season, entities, dimension, key, season_column), path)
