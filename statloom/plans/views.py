"""The reporting queries as permanent views over the catalog tables."""

from __future__ import annotations

from datetime import date

from statloom.operators.reports import METRICS
from statloom.schemas import GAMES, PLAYERS


def _literal(value: date | str | None) -> str:
    """A DATE literal, or today when no day is given."""
    if value is None:
        return "current_date()"
    day = date.fromisoformat(value) if isinstance(value, str) else value
    return f"DATE '{day.isoformat()}'"


def view_sql(database: str, since: date | str, as_of: date | str | None = None,
             newest: bool = False) -> dict[str, str]:
    """Each view's query by name; the same results as the reports of ``operators.reports``."""
    table = "`{}`.{}_current" if newest else "`{}`.{}"
    players, games = (table.format(database, spec.name) for spec in (PLAYERS, GAMES))
    first = _literal(since)
    averages = ", ".join(f"round(avg({m}), 1) AS avg_{m}" for m in METRICS)
    return {
        "top_scorers": f"""
            SELECT player_id, player_name, {averages}, count(*) AS games_played
            FROM {players} WHERE game_date >= {first}
            GROUP BY player_id, player_name
            ORDER BY avg_pts DESC, player_id, player_name LIMIT 20""",
        "player_performance_over_time": f"""
            SELECT player_id, player_name, game_date, {", ".join(METRICS)}
            FROM {players} WHERE game_date >= {first}
            ORDER BY game_date, player_id, game_id""",
        "win_loss_by_team": f"""
            SELECT team_abbreviation, wl, count(*) AS game_count
            FROM {games} WHERE game_date >= {first}
            GROUP BY team_abbreviation, wl ORDER BY team_abbreviation, wl""",
        "pipeline_health_check": f"""
            SELECT ingestion_date, count(*) AS records_ingested
            FROM {games} WHERE ingestion_date >= date_sub({_literal(as_of)}, 7)
            GROUP BY ingestion_date ORDER BY ingestion_date DESC""",
    }


def create_views(spark, database: str, since: date | str, as_of: date | str | None = None,
                 newest: bool = False) -> list[str]:
    """Create or replace the views in the database of the tables; returns their names."""
    queries = {f"current_{name}" if newest else name: query
               for name, query in view_sql(database, since, as_of, newest).items()}
    for name, query in queries.items():
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.{name} AS {query}")
    return list(queries)
