"""Independent SQL for every registered query, in DuckDB's dialect."""

from __future__ import annotations

from pyspark.sql import types as T

from statloom.schemas import GAMES, PLAYERS, TableSpec
from statloom.workload.queries import (
    ALL_TABLES,
    EVENTS_AS_OF,
    EXPIRE_DAYS,
    FIRST,
    LAST,
    LEAGUE,
    RETAIN_AS_OF,
    RUN_DATE,
    SEASON,
    SINCE,
    STREAM_RUNS,
    WANTED_GAMES,
)
from statloom.workload.standins import (
    DUCKDB,
    GAME_TABLE,
    PLAYER_NAME,
    PLAYER_TABLE,
    raw_game_columns,
    raw_player_columns,
)

DATE_PATTERNS = {GAMES.name: "%Y-%m-%d", PLAYERS.name: "%b %d, %Y"}


def _select(columns: list[str], table: str = "lineitem") -> str:
    return f"SELECT {', '.join(columns)} FROM {table}"


def _whole(expr: str) -> str:
    return f"cast(trunc(case when isnan({expr}) then 0 else {expr} end) as bigint)"


def _typed(spec: TableSpec, source: str, casts: bool = True) -> str:
    """Contract columns (but the stamp) of a raw feed, read by lower-cased name."""
    out = []
    for field in spec.contract.fields:
        name = field.name
        if name == "ingestion_date":
            continue
        if name == spec.date_column:
            expr = f"cast(try_strptime({name}, '{DATE_PATTERNS[spec.name]}') as date)"
        elif isinstance(field.dataType, T.DoubleType):
            expr = f"cast(cast({name} as float) as double)" if casts else name
        elif isinstance(field.dataType, T.LongType) and name != "player_id":
            expr = _whole(f'"{name}"')
        else:
            expr = name
        out.append(f'{expr} AS "{name}"')
    where = f" WHERE {spec.required} IS NOT NULL" if casts else ""
    return f"SELECT {', '.join(out)} FROM ({source}){where}"


def _deduped(source: str, keys: tuple[str, ...] | list[str], columns: list[str]) -> str:
    others = [c for c in columns if c not in keys]
    gaps = " + ".join(f'("{c}" IS NULL)::INT' for c in others)
    rest = ", ".join([gaps, *(f'"{c}" ASC NULLS FIRST' for c in others)])
    return (f"SELECT * FROM ({source}) QUALIFY row_number() OVER "
            f"(PARTITION BY {', '.join(keys)} ORDER BY {rest}) = 1")


def _stamped(spec: TableSpec, source: str, run_date: str = RUN_DATE) -> str:
    columns = [f'"{n}"' for n in spec.contract.names if n != "ingestion_date"]
    return f"SELECT {', '.join(columns)}, DATE '{run_date}' AS ingestion_date FROM ({source})"


def _clean(spec: TableSpec, source: str, run_date: str = RUN_DATE) -> str:
    columns = [n for n in spec.contract.names if n != "ingestion_date"]
    return _stamped(spec, _deduped(_typed(spec, source), spec.keys, columns), run_date=run_date)


RAW_GAMES = _select(raw_game_columns())
NAMED_PLAYERS = _select([*raw_player_columns(DUCKDB), PLAYER_NAME])
PLAYER_ROWS = _select(PLAYER_TABLE)
GAME_ROWS = _select(GAME_TABLE)
EVENT_DAYS = "SELECT event_id, user_id, event_type, value, cast(ts as date) AS {} FROM events"


def _top_scorers(source: str) -> str:
    return f"""
        SELECT player_id, player_name, round(avg(pts), 1) AS avg_pts, round(avg(reb), 1) AS avg_reb,
               round(avg(ast), 1) AS avg_ast, round(avg(plus_minus), 1) AS avg_plus_minus,
               count(*) AS games_played
        FROM ({source}) WHERE game_date >= DATE '{SINCE}'
        GROUP BY player_id, player_name
        ORDER BY avg_pts DESC NULLS LAST, player_id NULLS FIRST, player_name NULLS FIRST LIMIT 20"""


TOP_SCORERS = _top_scorers(PLAYER_ROWS)
PERFORMANCE = f"""
    SELECT player_id, player_name, game_date, pts, reb, ast, plus_minus
    FROM ({PLAYER_ROWS}) WHERE game_date >= DATE '{SINCE}'"""
SELECTED = "player_name IN (SELECT s_name FROM supplier WHERE s_acctbal > 0)"


def _landed_players() -> str:
    filled = []
    for field in PLAYERS.raw.fields:
        name = f'"{field.name}"'
        if field.name in ("Player_ID", "player_name"):
            filled.append(name)
        elif isinstance(field.dataType, T.StringType):
            filled.append(f"coalesce({name}, '0') AS {name}")
        else:
            filled.append(f"CASE WHEN {name} IS NULL OR isnan({name}) THEN 0 ELSE {name} END AS {name}")
    raw = _select(raw_player_columns(DUCKDB))
    return f"""
        SELECT {', '.join(filled)} FROM (
            SELECT r.*, coalesce(s.s_name, cast(r.Player_ID as varchar)) AS player_name
            FROM ({raw}) r
            LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal > 1000) s ON s.s_suppkey = r.Player_ID
            WHERE r.SEASON_ID = '{SEASON}'
              AND r.Player_ID IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0))"""


LANDED_GAMES = f"""
    SELECT * FROM ({RAW_GAMES}) WHERE SEASON_ID = '{SEASON}' AND LEAGUE_ID = '{LEAGUE}'"""


def _twice(source: str) -> str:
    return f"SELECT * FROM ({source}) UNION ALL SELECT * FROM ({source})"


def _tile_top(source: str) -> str:
    return f"SELECT player_name, avg(avg_pts) AS avg_pts FROM ({source}) GROUP BY player_name"


def _tile_monthly(source: str) -> str:
    return f"""
        SELECT player_name, cast(date_trunc('month', game_date) as date) AS month,
               avg(pts) AS avg_pts
        FROM ({source}) WHERE game_date BETWEEN DATE '{FIRST}' AND DATE '{LAST}'
        GROUP BY ALL"""


LINE = "l_orderkey, l_linenumber, l_partkey"
LINE_COLUMNS = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount "
                "l_tax l_returnflag l_linestatus l_shipdate").split()

def _two_runs() -> str:
    corrected = LANDED_GAMES.replace(
        "SELECT * FROM", "SELECT * REPLACE (case when FTM > 2 then PTS + 100 else PTS end AS PTS) FROM", 1)
    first, second = STREAM_RUNS
    return f"""{_clean(GAMES, LANDED_GAMES, first)} UNION ALL
        {_clean(GAMES, f"SELECT * FROM ({corrected}) WHERE FG3M < 5", second)}"""


LATEST = f"""
    SELECT * FROM ({_two_runs()}) QUALIFY row_number() OVER (
        PARTITION BY game_date, game_id, team_id ORDER BY ingestion_date DESC) = 1"""


def _counts(feed: str, source: str, landed: str) -> str:
    return f"""
        SELECT '{feed}' AS feed, (SELECT count(*) FROM ({landed})) AS records_read, count(*) AS kept,
               count(*) AS processed, (2 * count(*))::BIGINT AS noted, (2 * count(*))::BIGINT AS stored,
               0::BIGINT AS missing_dates, true AS agrees FROM ({source})"""


ORACLE: dict[str, str] = {
    # Sources and sinks
    "json_roundtrip": """
        SELECT * REPLACE (cast(l_shipdate as date) AS l_shipdate) FROM lineitem""",
    "parquet_partitioned_roundtrip": _stamped(GAMES, _typed(GAMES, RAW_GAMES)),
    "clustered_table_roundtrip": _stamped(PLAYERS, _typed(PLAYERS, NAMED_PLAYERS)),
    "table_contract": _stamped(GAMES, _typed(GAMES, RAW_GAMES)),
    "expired_partitions": f"""
        SELECT * REPLACE (cast(game_date + INTERVAL 30 DAY as date) AS ingestion_date)
        FROM ({_stamped(GAMES, _typed(GAMES, RAW_GAMES))})
        WHERE game_date + INTERVAL 30 DAY >= DATE '{RUN_DATE}' - INTERVAL {EXPIRE_DAYS} DAY""",
    "append_batches": f"""
        {EVENT_DAYS.format('game_date')} UNION ALL {EVENT_DAYS.format('game_date')}""",
    "replace_batches": EVENT_DAYS.format("game_date"),
    "merge_runs": LATEST,
    "latest_rows": LATEST,
    "compacted_dates": f"""
        SELECT game_date, count(*) AS games, sum(pts)::BIGINT AS pts, 1::BIGINT AS most_files
        FROM ({_clean(GAMES, LANDED_GAMES)}) GROUP BY game_date""",
    "bucketed_entities": f"""
        SELECT player_id, avg(pts) AS avg_pts, avg(reb) AS avg_reb, avg(ast) AS avg_ast,
               count(*) AS games_played
        FROM ({PLAYER_ROWS}) WHERE player_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
        GROUP BY player_id""",
    "bloom_entities": f"""
        SELECT * FROM ({PLAYER_ROWS}) WHERE cast(game_id as bigint) IN ({', '.join(map(str, WANTED_GAMES))})""",
    "landed_counts": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ALL_TABLES),
    # Column transforms
    "cast_int": f"""
        SELECT {LINE}, cast(trunc((25 - l_quantity) / 2) as integer) AS half,
               cast(case when l_tax < 0.08 then trunc(l_quantity) else 0 end as integer) AS gaps,
               cast(trunc(l_extendedprice) as integer) AS price_text
        FROM lineitem""",
    "cast_float": f"""
        SELECT {LINE}, cast(l_discount as float) AS l_discount, cast(l_tax as float) AS l_tax,
               cast(l_extendedprice as float) AS price_text
        FROM lineitem""",
    "parse_date_iso": """
        SELECT o_orderkey,
               case when o_orderstatus <> 'P' then cast(o_orderdate as date) end AS o_orderdate
        FROM orders""",
    "parse_date_monthname": """
        SELECT o_orderkey, cast(try_strptime(
                   case when o_orderstatus = 'P' then 'bad'
                        else upper(strftime(o_orderdate, '%b %d, %Y')) end,
                   '%b %d, %Y') as date) AS o_orderdate
        FROM orders""",
    "stamp_ingestion_date": f"""
        SELECT o_orderkey, o_custkey, o_totalprice, DATE '{RUN_DATE}' AS ingestion_date
        FROM orders""",
    "lowercase_columns": "SELECT * FROM customer",
    "project_contract": _stamped(PLAYERS, _typed(PLAYERS, NAMED_PLAYERS, casts=False)),
    "fill_missing": """
        SELECT o_orderkey, case when o_orderstatus = 'P' then 0 else o_custkey end AS o_custkey,
               case when o_orderstatus = 'O' then o_totalprice else 0 end AS o_totalprice,
               case when o_orderpriority = '5-LOW' then '0' else o_orderpriority end
                   AS o_orderpriority
        FROM orders""",
    "case_insensitive_columns": _typed(PLAYERS, NAMED_PLAYERS),
    "read_any_spelling": _clean(PLAYERS, NAMED_PLAYERS),
    "widen_types": """
        SELECT l_orderkey, cast(l_linenumber as bigint) AS l_linenumber, l_partkey,
               cast(trunc(l_quantity) as bigint) AS l_quantity,
               cast(cast(l_discount as float) as double) AS l_discount
        FROM lineitem""",
    "round_half_up": f"""
        SELECT {LINE}, round(l_quantity / 20, 1) AS share,
               round((l_quantity - 25) / l_linenumber, 1) AS signed_share
        FROM lineitem""",
    "month_bucket": """
        SELECT o_orderkey, cast(date_trunc('month', o_orderdate) as date) AS month FROM orders""",
    # Filters
    "drop_null_keys": """
        SELECT l_orderkey, l_partkey, l_linenumber FROM lineitem WHERE l_linenumber <> 7""",
    "filter_date_floor": f"SELECT * FROM ({PLAYER_ROWS}) WHERE game_date >= DATE '{SINCE}'",
    "filter_lookback": f"""
        SELECT * FROM ({EVENT_DAYS.format('ingestion_date')})
        WHERE ingestion_date >= DATE '{EVENTS_AS_OF}' - INTERVAL 7 DAY""",
    "filter_date_between": f"""
        SELECT * FROM ({PLAYER_ROWS})
        WHERE game_date >= DATE '{FIRST}' AND game_date <= DATE '{LAST}'""",
    "select_entities": f"""
        SELECT * FROM ({PLAYER_ROWS})
        WHERE player_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
    "select_entities_listed": """
        SELECT event_id, event_type, value FROM events
        WHERE event_type IN ('click', 'purchase', 'error')""",
    "filter_season": f"""
        SELECT SEASON_ID, LEAGUE_ID, GAME_ID, TEAM_ID, FGA FROM ({RAW_GAMES})
        WHERE SEASON_ID = '{SEASON}' AND LEAGUE_ID = '{LEAGUE}'""",
    "retain_recent": f"""
        SELECT * FROM ({EVENT_DAYS.format('ingestion_date')})
        WHERE ingestion_date >= DATE '{RETAIN_AS_OF}' - INTERVAL 30 DAY""",
    # Lookup, deduplication, union
    "lookup_name_fallback": """
        SELECT o_orderkey, o_custkey AS player_id,
               coalesce(c_name, cast(o_custkey as varchar)) AS player_name
        FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 1000)
             ON c_custkey = o_custkey""",
    "dedupe_games": _deduped(
        "SELECT * REPLACE (nullif(l_linenumber, 7) AS l_linenumber) FROM lineitem",
        ["l_orderkey", "l_linenumber"], LINE_COLUMNS),
    "dedupe_players": _deduped("SELECT * FROM lineitem", ["l_suppkey", "l_orderkey"], LINE_COLUMNS),
    "union_entities": """
        SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
        FROM customer
        UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
        UNION ALL SELECT p_partkey, p_name, NULL, NULL FROM part""",
    # Reports
    "top_k": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 100""",
    "top_scorers": TOP_SCORERS,
    "performance_over_time": PERFORMANCE,
    "win_loss_by_team": f"""
        SELECT team_abbreviation, wl, count(*) AS game_count FROM ({GAME_ROWS})
        WHERE game_date >= DATE '{SINCE}' GROUP BY team_abbreviation, wl""",
    "pipeline_health_check": f"""
        SELECT ingestion_date, count(*) AS records_ingested
        FROM ({EVENT_DAYS.format('ingestion_date')})
        WHERE ingestion_date >= DATE '{EVENTS_AS_OF}' - INTERVAL 7 DAY GROUP BY ingestion_date""",
    "tile_top_scorers": _tile_top(TOP_SCORERS),
    "tile_monthly_performance": _tile_monthly(PERFORMANCE),
    "tile_top_scorers_selected": _tile_top(f"SELECT * FROM ({TOP_SCORERS}) WHERE {SELECTED}"),
    "tile_monthly_selected": _tile_monthly(f"SELECT * FROM ({PERFORMANCE}) WHERE {SELECTED}"),
    # Jobs
    "clean_games": _clean(GAMES, RAW_GAMES),
    "clean_players": _clean(PLAYERS, NAMED_PLAYERS),
    "rejected_records": f"""
        SELECT Player_ID AS player_id, Game_ID AS game_id, GAME_DATE AS game_date,
               Player_ID IS NULL AS dropped,
               CASE WHEN GAME_DATE = 'bad' THEN 'game_date' ELSE '' END AS rejected
        FROM ({NAMED_PLAYERS}) WHERE GAME_DATE = 'bad' OR Player_ID IS NULL""",
    "audit_players": f"""
        WITH broken AS (SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'P'),
        fed AS (SELECT count(*) AS n, count(*) FILTER (Player_ID IS NULL) AS keyless,
                       count(DISTINCT (Player_ID, Game_ID)) FILTER (Player_ID IS NOT NULL) AS kept,
                       count(*) FILTER (GAME_DATE = 'bad') AS bad
                FROM ({NAMED_PLAYERS}))
        SELECT fed.n + broken.n AS records_read, kept, keyless + broken.n AS dropped,
               fed.n - keyless - kept AS duplicates, bad + broken.n AS unreadable
        FROM fed, broken""",
    "land_games": LANDED_GAMES,
    "land_players": _landed_players(),
    "stream_games": " UNION ALL ".join(
        _clean(GAMES, f"SELECT * FROM ({RAW_GAMES}) WHERE MATCHUP LIKE '%{outcome}'", run_date)
        for run_date, outcome in STREAM_RUNS.items()),
    "end_to_end": _top_scorers(_clean(PLAYERS, _landed_players())),
    "stored_players": _twice(_clean(PLAYERS, _landed_players())),
    "stored_games": _twice(_clean(GAMES, LANDED_GAMES)),
    "player_performance_view": f"""
        SELECT player_id, player_name, game_date, pts, reb, ast, plus_minus
        FROM ({_clean(PLAYERS, _landed_players())}) WHERE game_date >= DATE '{SINCE}'""",
    "win_loss_view": f"""
        SELECT team_abbreviation, wl, count(*) AS game_count FROM ({_clean(GAMES, LANDED_GAMES)})
        WHERE game_date >= DATE '{SINCE}' GROUP BY team_abbreviation, wl""",
    "health_view": f"""
        SELECT ingestion_date, count(*) AS records_ingested FROM ({_clean(GAMES, LANDED_GAMES)})
        GROUP BY ingestion_date""",
    "current_top_scorers": _top_scorers(_clean(PLAYERS, _landed_players())),
    "reconciled_runs": " UNION ALL ".join([
        _counts("games", _clean(GAMES, LANDED_GAMES), LANDED_GAMES),
        _counts("player_stats", _clean(PLAYERS, _landed_players()), _landed_players())]),
    "health_check_today": """
        SELECT ingestion_date, count(*) AS records_ingested FROM (
            SELECT cast(cast(now() AT TIME ZONE 'UTC' as date) - (event_id % 14)::INT as date)
                AS ingestion_date FROM events)
        WHERE ingestion_date >= cast(now() AT TIME ZONE 'UTC' as date) - 7
        GROUP BY ingestion_date""",
}
