"""Raw schemas, table contracts and the specs that drive the cleaning jobs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
STAMP = "ingestion_date"
# Before a column's name: its variant, in records that the declared types can't read.
ODD = "odd_"

# Column names and their order are the data contract of the two tables.
GAME_COLUMNS = (
    "season_id team_id team_abbreviation team_name game_id game_date matchup wl min pts fgm fga "
    "fg_pct fg3m fg3a fg3_pct ftm fta ft_pct oreb dreb reb ast stl blk tov pf plus_minus "
    "ingestion_date"
).split()
PLAYER_COLUMNS = (
    "season_id player_id player_name game_id game_date matchup wl min pts fgm fga "
    "fg_pct fg3m fg3a fg3_pct ftm fta ft_pct oreb dreb reb ast stl blk tov pf plus_minus "
    "ingestion_date"
).split()

TEXT_COLUMNS = {"season_id", "team_abbreviation", "team_name", "player_name", "game_id",
                "matchup", "wl"}
DATE_COLUMNS = {"game_date", "ingestion_date"}
# Which columns the two feeds cast to floats and to integers.
RATE_COLUMNS = ("fg_pct", "fg3_pct", "ft_pct", "plus_minus")
COUNT_COLUMNS = ("pts", "reb", "ast", "stl", "blk", "tov")

# The players feed spells these in its own case; all other raw names are upper case.
PLAYER_SPELLING = {"player_id": "Player_ID", "game_id": "Game_ID", "player_name": "player_name"}


def _contract_type(name: str) -> T.DataType:
    if name in TEXT_COLUMNS:
        return T.StringType()
    if name in DATE_COLUMNS:
        return T.DateType()
    return T.DoubleType() if name in RATE_COLUMNS else T.LongType()


def _contract(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, _contract_type(n)) for n in names])


def _raw_type(name: str) -> T.DataType:
    # Dates arrive as text. Numbers are read as double so that 10, 10.5 and NaN all load.
    if name in TEXT_COLUMNS or name in DATE_COLUMNS:
        return T.StringType()
    return T.LongType() if name == "player_id" else T.DoubleType()


def _raw(names: list[str], spelling: dict[str, str]) -> T.StructType:
    return T.StructType([
        T.StructField(spelling.get(n, n.upper()), _raw_type(n))
        for n in names if n != "ingestion_date"
    ])


@dataclass(frozen=True)
class TableSpec:
    """Everything a cleaning job, a sink or a reader needs to know about one table."""

    name: str
    raw: T.StructType
    contract: T.StructType
    required: str
    keys: tuple[str, ...]
    int_columns: tuple[str, ...]
    float_columns: tuple[str, ...]
    date_column: str
    date_format: str
    partition: str
    cluster: str


GAMES = TableSpec(
    name="game_stats",
    raw=_raw(GAME_COLUMNS, {}),
    contract=_contract(GAME_COLUMNS),
    required="game_id",
    keys=("game_id", "team_id"),
    int_columns=(*COUNT_COLUMNS, "team_id"),
    float_columns=RATE_COLUMNS,
    date_column="game_date",
    date_format="yyyy-MM-dd",
    partition="game_date",
    cluster="team_abbreviation",
)

PLAYERS = TableSpec(
    name="player_stats",
    raw=_raw(PLAYER_COLUMNS, PLAYER_SPELLING),
    contract=_contract(PLAYER_COLUMNS),
    required="player_id",
    keys=("player_id", "game_id"),
    int_columns=(*COUNT_COLUMNS, "min"),
    float_columns=RATE_COLUMNS,
    date_column="game_date",
    date_format="MMM dd, yyyy",
    partition="game_date",
    cluster="player_id",
)

DIMENSION = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("full_name", T.StringType()),
])
