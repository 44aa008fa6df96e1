"""Box-score shaped inputs taken from the test tables.

The test data holds no games, so each column of the feeds is an expression over ``lineitem``:
suppliers play, orders are games, ship dates are game days. The expressions are SQL text that means
the same in both dialects; only dates are spelled per dialect. They shape the input alone, the
operators under test come after them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Dialect:
    long_date: str


SPARK = Dialect("upper(date_format({0}, 'MMM dd, yyyy'))")
DUCKDB = Dialect("upper(strftime({0}, '%b %d, %Y'))")

_DAY = "cast(l_shipdate as date)"
_SEASON = "'2' || cast(year(l_shipdate) as string)"
_OUTCOME = "case when l_linestatus = 'O' then 'W' when l_returnflag = 'A' then 'L' end"
_NAME = "'Supplier#' || lpad(cast(l_suppkey as string), 9, '0')"

_STATS = {
    "MIN": "l_quantity + l_discount",
    "FGM": "floor(l_quantity / 2)",
    "FGA": "l_quantity",
    "FG_PCT": "l_discount",
    "FG3M": "l_linenumber - 1",
    "FG3A": "l_linenumber",
    "FG3_PCT": "l_tax",
    "FTM": "l_linenumber",
    "FTA": "l_linenumber + 1",
    "FT_PCT": "l_discount + l_tax",
    "OREB": "l_linenumber",
    "DREB": "floor(l_quantity / 5)",
    "REB": "l_extendedprice / 1000",
    "AST": "floor(l_extendedprice / 9000)",
    "STL": "l_linenumber",
    "BLK": "l_linenumber - 1",
    "TOV": "(25 - l_quantity) / 2",
    "PF": "l_linenumber",
    "PLUS_MINUS": "l_quantity - 25.5",
}


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{expr} AS {name}" for name, expr in columns.items()]


def _some_bad(text: str) -> str:
    return f"case when l_linenumber = 3 and l_tax = 0.0 then 'bad' else {text} end"


def raw_game_columns() -> list[str]:
    """The games feed; some keys, dates, points and outcomes are missing or unreadable."""
    return _aliased({
        "SEASON_ID": _SEASON,
        "LEAGUE_ID": "case when l_returnflag = 'N' then '00' else '10' end",
        "TEAM_ID": "cast(nullif(l_linenumber, 7) as double)",
        "TEAM_ABBREVIATION": "l_returnflag",
        "TEAM_NAME": "'Team ' || l_returnflag",
        "GAME_ID": "lpad(cast(nullif(l_orderkey, l_partkey) as string), 10, '0')",
        "GAME_DATE": _some_bad(f"cast({_DAY} as string)"),
        "MATCHUP": "l_returnflag || ' vs. ' || l_linestatus",
        "WL": _OUTCOME,
        "PTS": "case when l_tax < 0.08 then l_quantity end",
        **{n: f"cast({e} as double)" for n, e in _STATS.items()},
    })


def raw_player_columns(dialect: Dialect) -> list[str]:
    """The players feed before names are added; points hold NaN, some keys are null."""
    return _aliased({
        "SEASON_ID": _SEASON,
        "Player_ID": "nullif(l_suppkey, 7)",
        "Game_ID": "lpad(cast(l_orderkey as string), 10, '0')",
        "GAME_DATE": _some_bad(dialect.long_date.format(_DAY)),
        "MATCHUP": "l_returnflag || ' vs. ' || l_linestatus",
        "WL": _OUTCOME,
        "PTS": "case when l_tax < 0.08 then l_quantity else cast('NaN' as double) end",
        **{n: f"cast({e} as double)" for n, e in _STATS.items()},
    })


PLAYER_NAME = f"{_NAME} AS player_name"

# Typed tables, as the reports read them from the warehouse.
PLAYER_TABLE = _aliased({
    "player_id": "l_suppkey",
    "player_name": _NAME,
    "game_id": "lpad(cast(l_orderkey as string), 10, '0')",
    "game_date": _DAY,
    "pts": "cast(l_quantity as bigint)",
    "reb": "cast(l_linenumber as bigint)",
    "ast": "cast(floor(l_extendedprice / 9000) as bigint)",
    "plus_minus": "l_quantity - 25.5",
})
GAME_TABLE = _aliased({
    "team_abbreviation": "l_returnflag",
    "wl": _OUTCOME,
    "game_date": _DAY,
})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str, columns: list[str]) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*columns)


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir, raw_game_columns())


def raw_players(spark: SparkSession, sf_dir: str, named: bool = False) -> DataFrame:
    columns = raw_player_columns(SPARK)
    return lineitem(spark, sf_dir, [*columns, PLAYER_NAME] if named else columns)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir, PLAYER_TABLE)


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir, GAME_TABLE)


def rostered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Players to select: suppliers with a positive balance."""
    return table(spark, sf_dir, "supplier").filter("s_acctbal > 0")


def dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of entities; suppliers with a small balance are missing from it."""
    return (
        table(spark, sf_dir, "supplier").filter("s_acctbal > 1000")
        .selectExpr("s_suppkey AS id", "s_name AS full_name")
    )
