from __future__ import annotations

import json
import time
from datetime import date

import pytest
from plans import plan_of
from pyspark.sql import functions as F

import run
from statloom.operators import reports
from statloom.plans import pipeline
from statloom.plans.clean import accepted, clean, rejects, typed
from statloom.plans.land import land_games, land_players
from statloom.schemas import GAMES, PLAYERS
from statloom.session import scratch_path, shared_folder
from statloom.sources import files, tables
from statloom.sources.jsonl import read_json_lines, read_records
from statloom.sources.paths import Zones
from statloom.streaming import landing
from statloom.streaming.landing import new_lines, stream_table

RUN_DATE = "2025-04-13"
NUMBERS = {f.name: 1.0 for f in GAMES.raw.fields if f.dataType.simpleString() == "double"}


def game(**changes):
    return {"SEASON_ID": "22024", "TEAM_ABBREVIATION": "LAL", "TEAM_NAME": "Lakers",
            "GAME_ID": "0022400001", "GAME_DATE": "2025-01-15", "MATCHUP": "LAL vs. BOS",
            "WL": "W", **NUMBERS, **changes}


def player(**changes):
    numbers = {k: v for k, v in NUMBERS.items() if k != "TEAM_ID"}
    return {"SEASON_ID": "22024", "Player_ID": 2544, "player_name": "LeBron James",
            "Game_ID": "0022400001", "GAME_DATE": "JAN 15, 2025", "MATCHUP": "LAL vs. BOS",
            "WL": "W", **numbers, **changes}


def write(folder, records, extra=""):
    folder.mkdir(parents=True, exist_ok=True)
    # json.dumps writes NaN bare, as the feed does.
    (folder / "part.json").write_text("\n".join(map(json.dumps, records)) + "\n" + extra)
    return str(folder)


GAME_LINES = [
    game(), game(),                                         # an exact copy
    game(PTS=7.0), game(PTS=5.0),                           # same key, other values
    game(GAME_ID=None),                                     # no key
    game(GAME_ID="0022400002", TEAM_ID=None), game(GAME_ID="0022400002", TEAM_ID=None),
    game(GAME_ID="0022400003", PTS=float("nan"), FG_PCT=float("nan"), FGM=float("nan")),
    game(GAME_ID="0022400004", PTS=12.7, MIN=240.9, PLUS_MINUS=-3.5, FT_PCT=0.456),
    game(GAME_ID="0022400005", GAME_DATE="bad", WL=None),
    game(GAME_ID="0022400006", GAME_DATE=None, EXTRA="x", TEAM_ID=1610612747),
    game(GAME_ID="0022400007", GAME_DATE="2024-09-30"),
]


def test_clean_games(spark, tmp_path):
    raw = read_json_lines(spark, write(tmp_path / "g", GAME_LINES, '{"GAME_ID": "00224'), GAMES.raw)
    out = clean(raw, GAMES, RUN_DATE)
    assert out.schema.names == GAMES.contract.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in GAMES.contract]
    got = {r["game_id"]: r for r in out.collect()}
    assert len(got) == out.count() == 7
    assert got["0022400001"]["pts"] == 1                     # the smallest of 1, 1, 5, 7
    assert got["0022400002"]["team_id"] is None              # null keys are one key
    three = got["0022400003"]
    assert (three["pts"], three["fgm"]) == (0, 0) and three["fg_pct"] != three["fg_pct"]
    four = got["0022400004"]
    assert (four["pts"], four["min"], four["plus_minus"]) == (12, 240, -3.5)
    assert four["ft_pct"] == 0.4560000002384186
    assert got["0022400005"]["game_date"] is None and got["0022400005"]["wl"] is None
    assert got["0022400006"]["team_id"] == 1610612747
    assert got["0022400007"]["game_date"] == date(2024, 9, 30)
    assert {r["ingestion_date"] for r in got.values()} == {date(2025, 4, 13)}


PLAYER_LINES = [
    player(), player(), player(PTS=0.0), player(Player_ID=None),
    player(Game_ID=None), player(Game_ID=None),
    player(Game_ID="0022400002", GAME_DATE="Jan 15, 2025", MIN=35.9, WL=0),
    player(Game_ID="0022400003", GAME_DATE="JAN 5, 2025"),
    player(Player_ID=99, player_name="99", GAME_DATE="OCT 01, 2024"),
]


def test_clean_players(spark, tmp_path):
    raw = read_json_lines(spark, write(tmp_path / "p", PLAYER_LINES), PLAYERS.raw)
    out = clean(raw, PLAYERS, RUN_DATE)
    assert [f.dataType for f in out.schema] == [f.dataType for f in PLAYERS.contract]
    got = {(r["player_id"], r["game_id"]): r for r in out.collect()}
    assert len(got) == out.count() == 5
    assert got[2544, "0022400001"]["pts"] == 0
    assert (2544, None) in got
    two = got[2544, "0022400002"]
    assert (two["game_date"], two["min"], two["wl"]) == (date(2025, 1, 15), 35, "0")
    assert got[2544, "0022400003"]["game_date"] is None
    assert got[99, "0022400001"]["game_date"] == date(2024, 10, 1)


def test_typed_has_no_shuffle_and_clean_has_one(spark, tmp_path):
    raw = read_json_lines(spark, write(tmp_path / "g", [game()]), GAMES.raw)
    tree = plan_of(typed(raw, GAMES))
    assert "Exchange" not in tree
    tree = plan_of(clean(raw, GAMES, RUN_DATE)).split("\n\n\n")[0]
    assert tree.count("Exchange") == 1


def test_rejects_name_their_columns(spark, tmp_path):
    path = write(tmp_path / "g", [game(), game(GAME_DATE="bad"), game(GAME_DATE=None)],
                 '{"GAME_ID": "00224\n')
    raw = read_json_lines(spark, path, GAMES.raw, keep_corrupt=True)
    assert sorted(r["rejected"] for r in rejects(raw, GAMES).collect()) == [
        ["_corrupt_record"], ["game_date"]]
    texts = spark.createDataFrame([("12", "2025-01-15"), ("x", "2025-01-15")], "PTS string, D string")
    full = raw.limit(1).drop("PTS", "_corrupt_record").crossJoin(texts.select("PTS"))
    assert [r["rejected"] for r in rejects(full, GAMES).collect()] == [["pts"]]


def test_land_games_keeps_one_season(spark, tmp_path):
    raw = spark.createDataFrame([("22024", "00", "a"), ("22023", "00", "b"), ("22024", "10", "c")],
                                "SEASON_ID string, LEAGUE_ID string, GAME_ID string")
    path = str(tmp_path / "games.json")
    land_games(raw, path, "22024", "00")
    assert [r["GAME_ID"] for r in read_json_lines(spark, path, raw.schema).collect()] == ["a"]


@pytest.mark.parametrize("as_frame", [True, False])
def test_land_players_selects_fills_and_names(spark, tmp_path, as_frame):
    raw = spark.createDataFrame(
        [("22024", 1, "a", None, None), ("22024", 2, "b", float("nan"), "W"),
         ("22024", 3, "c", 4.0, "L"), ("22023", 1, "d", 9.0, "W"), (None, 1, "e", 9.0, "W")],
        "SEASON_ID string, Player_ID long, Game_ID string, PTS double, WL string")
    names = spark.createDataFrame([(1, "One"), (3, "Three")], "id long, full_name string")
    chosen = spark.createDataFrame([(1,), (2,)], "Player_ID long") if as_frame else [1, 2]
    path = str(tmp_path / "player_stats.json")
    land_players(raw, path, "22024", chosen, names)
    out = spark.read.schema(raw.schema.add("player_name", "string")).json(path).drop("SEASON_ID")
    assert sorted(map(tuple, out.collect())) == [
        (1, "a", 0.0, "0", "One"), (2, "b", 0.0, "W", "2")]


@pytest.fixture
def zones(tmp_path):
    zones = Zones(str(tmp_path), "league")
    base = tmp_path / "raw" / "league"
    for run_date in ("2025-04-12", RUN_DATE):
        write(base / run_date / "games.json", GAME_LINES)
        write(base / run_date / "player_stats.json", PLAYER_LINES)
    return zones


def test_both_sinks_hold_the_same_rows(spark, zones):
    pipeline.transform(spark, zones, RUN_DATE)
    for spec, feed in pipeline.FEEDS:
        one = tables.read_table(spark, zones.processed(RUN_DATE, feed), spec.contract)
        two = tables.read_table(spark, zones.warehouse(spec.name), spec.contract)
        assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
        assert one.count() == {"games": 7, "player_stats": 5}[feed]


def test_reruns_append_or_replace(spark, zones):
    games = lambda: pipeline.warehouse_tables(spark, zones)[GAMES.name].count()
    for _ in range(2):
        pipeline.transform(spark, zones, RUN_DATE)
    assert games() == 14
    pipeline.transform(spark, zones, RUN_DATE, tables.REPLACE_DATES)
    assert games() == 7


def test_rejects_are_written_and_records_add_up(spark, zones):
    pipeline.transform(spark, zones, RUN_DATE)
    for spec, feed in pipeline.FEEDS:
        raw = read_records(spark, zones.raw(RUN_DATE, feed), spec)
        written = spark.read.json(zones.rejects(RUN_DATE, feed))
        assert written.count() == rejects(raw, spec).count() > 0
    for r in pipeline.audits(spark, zones, RUN_DATE).collect():
        assert r["records_read"] == r["kept"] + r["dropped"] + r["duplicates"]
        assert r["kept"] == {"games": 7, "player_stats": 5}[r["feed"]]


def test_a_feed_without_a_column_is_refused(spark, zones, tmp_path):
    lines = [{k: v for k, v in line.items() if k != "MATCHUP"} for line in GAME_LINES]
    write(tmp_path / "raw" / "league" / "2025-04-14" / "games.json", lines)
    write(tmp_path / "raw" / "league" / "2025-04-14" / "player_stats.json", PLAYER_LINES)
    with pytest.raises(ValueError, match="matchup"):
        pipeline.transform(spark, zones, "2025-04-14")
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 0


def test_views_answer_in_another_session(spark, zones):
    pipeline.transform(spark, zones, RUN_DATE)
    views = pipeline.register_views(spark, zones, "2024-10-01", RUN_DATE)
    assert set(views) == {"top_scorers", "player_performance_over_time", "win_loss_by_team",
                          "pipeline_health_check"}
    other = spark.newSession()
    sql = lambda what, name: other.sql(f"SELECT {what} FROM {zones.table(name)}").collect()
    assert sql("player_id, games_played", "top_scorers") == [(99, 1), (2544, 3)]
    assert sql("count(*)", "game_stats") == [(7,)]
    assert sql("count(*)", "player_stats") == [(5,)]
    assert sql("*", "pipeline_health_check") == [(date(2025, 4, 13), 7)]
    assert sql("game_count", "win_loss_by_team") == [(4,)]
    assert sql("count(*)", "player_performance_over_time") == [(4,)]


def test_views_equal_the_reports(spark, zones):
    pipeline.transform(spark, zones, RUN_DATE)
    views = pipeline.register_views(spark, zones, "2024-10-01", RUN_DATE)
    stored = pipeline.warehouse_tables(spark, zones)
    games, players = stored[GAMES.name], stored[PLAYERS.name]
    for name, report in {
        "top_scorers": reports.top_scorers(players, "2024-10-01"),
        "player_performance_over_time": reports.performance_over_time(players, "2024-10-01"),
        "win_loss_by_team": reports.win_loss_by_team(games, "2024-10-01"),
        "pipeline_health_check": reports.pipeline_health(games, RUN_DATE),
    }.items():
        assert views[name].columns == report.columns
        assert list(map(repr, views[name].collect())) == list(map(repr, report.collect()))


def test_a_lost_catalog_is_rebuilt_from_the_files(spark, zones):
    pipeline.transform(spark, zones, RUN_DATE)
    spark.sql(f"DROP DATABASE `{zones.database}` CASCADE")
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 7


def test_old_runs_are_removed(spark, zones):
    for run_date in ("2025-04-12", RUN_DATE):
        pipeline.transform(spark, zones, run_date)
    assert pipeline.expire_runs(spark, zones, 30, "2025-05-12") == []
    # The warehouse dates were written by the later run too, so they stay.
    assert pipeline.expire_runs(spark, zones, 30, "2025-05-13") == ["2025-04-12"]
    stored = pipeline.warehouse_tables(spark, zones)[GAMES.name]
    assert stored.count() == 14
    assert files.children(spark, f"{zones.root}/raw/league") == [RUN_DATE]
    assert files.children(spark, f"{zones.root}/processed/league") == [RUN_DATE]
    pipeline.expire_runs(spark, zones, 30, "2025-05-14")
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 0
    assert tables.read_table(spark, zones.warehouse(GAMES.name), GAMES.contract).count() == 0


def test_command_line_stores_and_counts(spark, zones, capsys):
    run.main([RUN_DATE, "--root", zones.root, "--dataset", "league"])
    shown = capsys.readouterr().out
    assert "|game_stats  |7        |" in shown and "|player_stats|5        |" in shown


def test_stream_matches_batch_per_run_date(spark, zones):
    state = scratch_path(spark, "state")
    stored = lambda: pipeline.warehouse_tables(spark, zones)[GAMES.name]
    stream_table(spark, GAMES, "games", zones, state).awaitTermination(120)
    got = stored()
    expected = None
    for run_date in ("2025-04-12", RUN_DATE):
        raw = read_records(spark, zones.raw(run_date, "games"), GAMES)
        part = clean(raw, GAMES, run_date)
        expected = part if expected is None else expected.union(part)
    assert got.count() == 14
    assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    # Nothing new: a second run adds nothing, nor does a stream that has lost its state.
    stream_table(spark, GAMES, "games", zones, state).awaitTermination(120)
    stream_table(spark, GAMES, "games", zones, scratch_path(spark, "state")).awaitTermination(120)
    assert stored().count() == 14


def test_a_late_file_of_a_run_adds_only_new_keys(spark, zones, tmp_path):
    state = scratch_path(spark, "state")
    stream_table(spark, PLAYERS, "player_stats", zones, state).awaitTermination(120)
    folder = tmp_path / "raw" / "league"
    write(folder / "2025-04-14" / "player_stats.json", PLAYER_LINES[:1])
    late = [*PLAYER_LINES, player(Game_ID="0022400099", PTS=3.0)]
    (folder / RUN_DATE / "player_stats.json" / "late.json").write_text(
        "\n".join(map(json.dumps, late)))
    stream_table(spark, PLAYERS, "player_stats", zones, state).awaitTermination(120)
    out = pipeline.warehouse_tables(spark, zones)[PLAYERS.name]
    assert {tuple(r) for r in out.groupBy("ingestion_date").agg(F.count("*")).collect()} == {
        (date(2025, 4, 12), 5), (date(2025, 4, 13), 6), (date(2025, 4, 14), 1)}
    # The batch job appends to the same table, by the same layout.
    pipeline.transform(spark, zones, RUN_DATE)
    assert pipeline.warehouse_tables(spark, zones)[PLAYERS.name].count() == 12 + 6
    assert tables.read_table(spark, zones.warehouse(PLAYERS.name), PLAYERS.contract).count() == 18


def test_stream_fills_both_zones_and_the_rejects(spark, zones):
    for _ in range(2):  # the second time with no state: everything comes again
        stream_table(spark, GAMES, "games", zones, scratch_path(spark, "state")).awaitTermination(120)
        for run_date in ("2025-04-12", RUN_DATE):
            expected = clean(read_records(spark, zones.raw(run_date, "games"), GAMES), GAMES, run_date)
            got = tables.read_table(spark, zones.processed(run_date, "games"), GAMES.contract)
            assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
            refused = spark.read.json(zones.rejects(run_date, "games"))
            assert sorted(r["dropped"] for r in refused.collect()) == [False, True]


def test_stream_keeps_the_most_complete_record(spark, zones, tmp_path):
    """Whichever file of a run comes first."""
    state, folder = scratch_path(spark, "state"), tmp_path / "raw" / "league" / "2025-04-15"
    stored = lambda: {r["game_id"]: (r["wl"], r["pts"]) for r in
                      pipeline.warehouse_tables(spark, zones)[GAMES.name]
                      .filter("ingestion_date = date'2025-04-15'").collect()}
    for n, lines in enumerate([[game(WL=None, PTS=3.0), game(GAME_ID="b")], [game(PTS=9.0), game(GAME_ID="b", WL=None)]]):
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "games.json").mkdir(exist_ok=True)
        (folder / "games.json" / f"{n}.json").write_text("\n".join(map(json.dumps, lines)))
        stream_table(spark, GAMES, "games", zones, state).awaitTermination(120)
    assert stored() == {"0022400001": ("W", 9), "b": ("W", 1)}


def test_stream_plan_has_bounded_state(spark, zones):
    lines = new_lines(spark, zones, "games", "1 day")
    plan = lines._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark [_digest" in plan and "EventTimeWatermark" in plan


def test_rerunning_a_season_counts_once_in_the_current_tables(spark, zones):
    for run_date in ("2025-04-12", RUN_DATE):
        pipeline.transform(spark, zones, run_date, keep_current=True)
    newest = pipeline.warehouse_tables(spark, zones, newest=True)
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 14
    assert newest[GAMES.name].count() == 7 and newest[PLAYERS.name].count() == 5
    assert {r[0] for r in newest[GAMES.name].select("ingestion_date").collect()} == {date(2025, 4, 13)}
    # A run that is repeated late does not replace newer rows.
    pipeline.transform(spark, zones, "2025-04-12", keep_current=True)
    assert {r[0] for r in pipeline.warehouse_tables(spark, zones, newest=True)[GAMES.name]
            .select("ingestion_date").collect()} == {date(2025, 4, 13)}
    views = pipeline.register_views(spark, zones, "2024-10-01", RUN_DATE, newest=True)
    assert set(views) >= {"current_top_scorers", "current_win_loss_by_team"}
    assert {r["player_id"]: r["games_played"] for r in views["current_top_scorers"].collect()} == {99: 1, 2544: 3}


def test_a_partial_rerun_changes_nothing_and_a_correction_replaces(spark, zones, tmp_path):
    pipeline.transform(spark, zones, RUN_DATE, tables.MERGE)
    stored = lambda: sorted(map(str, pipeline.warehouse_tables(spark, zones)[PLAYERS.name].collect()))
    before = stored()
    assert len(before) == 5
    raw = tmp_path / "raw" / "league" / RUN_DATE / "player_stats.json"
    write(raw, PLAYER_LINES[2:3] + PLAYER_LINES[6:7])
    pipeline.transform(spark, zones, RUN_DATE, tables.MERGE)
    assert stored() == before
    write(raw, [player(PTS=44.0), player(Game_ID="new")])
    pipeline.transform(spark, zones, RUN_DATE, tables.MERGE)
    after = pipeline.warehouse_tables(spark, zones)[PLAYERS.name]
    assert after.count() == 6
    assert after.filter("player_id = 2544 and game_id = '0022400001'").first()["pts"] == 44
    processed = tables.read_table(spark, zones.processed(RUN_DATE, "player_stats"), PLAYERS.contract)
    assert processed.exceptAll(after).count() == 0 and processed.count() == 6


def test_a_conforming_feed_is_parsed_once(spark, zones, monkeypatch):
    """Parsing and judging happen in one pass over the text; all sinks read what it wrote."""
    texts = []
    read_text = type(spark.read).text
    monkeypatch.setattr(type(spark.read), "text", lambda self, *a, **k: texts.append(a) or read_text(self, *a, **k))
    judged = pipeline.parse(spark, GAMES, "games", zones, RUN_DATE)
    pipeline.keep_rejects(judged, GAMES, "games", zones, RUN_DATE)
    assert len(texts) == 1 and "Scan text" not in plan_of(judged) and "Scan parquet" in plan_of(judged)


def test_a_lost_file_is_reported(spark, zones):
    pipeline.transform(spark, zones, RUN_DATE)
    rows_of = lambda: {r["feed"]: r for r in pipeline.reconcile(spark, zones, RUN_DATE).collect()}
    assert all(r["agrees"] and r["noted"] == r["stored"] == r["processed"] == r["kept"] for r in rows_of().values())
    day = f"{zones.warehouse(GAMES.name)}/game_date=2025-01-15"
    (name,) = [c for c in files.children(spark, day) if c.endswith(".parquet")][:1]
    files.delete(spark, f"{day}/{name}")
    spark.catalog.refreshTable(zones.table(GAMES.name))
    got = rows_of()
    assert not got["games"]["agrees"] and got["games"]["missing_dates"] == 1 and got["player_stats"]["agrees"]
    plan = plan_of(spark.table(zones.table(GAMES.name)).groupBy("game_date").count())
    assert "ReadSchema: struct<>" in plan


def test_a_column_that_is_always_null_is_no_missing_column(spark, zones, tmp_path):
    lines = [game(MATCHUP=None)]
    write(tmp_path / "raw" / "league" / "2025-04-16" / "games.json", lines)
    assert pipeline.parse(spark, GAMES, "games", zones, "2025-04-16").count() == 1


def test_a_feed_of_another_spelling_is_stored_alike(spark, zones, tmp_path):
    lines = [{k.lower(): str(v) if k in ("PTS", "GAME_ID") and v is not None else v for k, v in line.items()}
             for line in GAME_LINES if line["PTS"] == line["PTS"]]
    write(tmp_path / "raw" / "league" / "2025-04-17" / "games.json", lines + GAME_LINES[:1])
    raw = read_records(spark, zones.raw("2025-04-17", "games"), GAMES)
    expected = clean(raw, GAMES, "2025-04-17").drop("ingestion_date")
    got = accepted(pipeline.parse(spark, GAMES, "games", zones, "2025-04-17"), GAMES)
    assert expected.count() == 6 and expected.exceptAll(got).count() == 0


def test_expiry_reads_the_noted_runs_only(spark, zones):
    pipeline.transform(spark, zones, RUN_DATE)
    plan = plan_of(tables.last_runs(spark, zones.table(GAMES.name), GAMES))
    assert "game_stats_runs" in plan and "/game_stats]" not in plan


def test_replacing_dates_leaves_the_others(spark, zones, tmp_path):
    pipeline.transform(spark, zones, RUN_DATE)
    write(tmp_path / "raw" / "league" / "2025-04-18" / "games.json", [game(GAME_ID="x", GAME_DATE="2025-03-01")])
    write(tmp_path / "raw" / "league" / "2025-04-18" / "player_stats.json", PLAYER_LINES)
    pipeline.transform(spark, zones, "2025-04-18", tables.REPLACE_DATES)
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 8


def test_cleaning_sorts_after_its_shuffle_only(spark, tmp_path):
    raw = read_json_lines(spark, write(tmp_path / "g", [game()]), GAMES.raw)
    tree = plan_of(clean(raw, GAMES, RUN_DATE)).split("\n\n\n")[0]
    assert tree.rindex("SortAggregate") < tree.index("Exchange")


def test_cleaning_bounds_generated_methods(spark, tmp_path):
    own = spark.newSession()
    own.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    raw = read_json_lines(own, write(tmp_path / "g", GAME_LINES), GAMES.raw)
    assert clean(raw, GAMES, RUN_DATE).count() == 7
    assert own.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_micro_batch_dedupes_once(spark, zones, monkeypatch):
    labels = []
    staged = tables.staged
    monkeypatch.setattr(tables, "staged", lambda df, label="staged": labels.append(label) or staged(df, label))
    stream_table(spark, GAMES, "games", zones, scratch_path(spark, "state")).awaitTermination(120)
    assert labels.count("deduped") == 1
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 14


def shuffle_files(spark):
    held = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {held.apply(i).getName() for i in range(held.size()) if held.apply(i).getName().startswith("shuffle_")}


def test_a_stream_leaves_no_shuffle_and_no_staged_rows(spark, zones):
    pipeline.prepare(spark, zones)
    state, before, staged = scratch_path(spark, "state"), shuffle_files(spark), set(files.children(spark, shared_folder(spark)))
    freed = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    stream_table(spark, GAMES, "games", zones, state).awaitTermination(120)
    left = set(files.children(spark, shared_folder(spark))) - staged
    assert {name.partition("-")[0] for name in left} <= {"state"} and files.children(spark, f"{state}/judged") == []
    deadline = time.time() + 20
    while shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == freed
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 14


def test_the_state_keeps_short_digests(spark, zones):
    assert dict(new_lines(spark, zones, "games", "1 day").dtypes)["_digest"] == "binary"


def test_what_a_failure_left_is_stored_by_the_next_stream(spark, zones, monkeypatch):
    state, merge = scratch_path(spark, "state"), landing.merge_runs

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(landing, "merge_runs", fail)
    with pytest.raises(RuntimeError, match="lost"):
        stream_table(spark, GAMES, "games", zones, state)
    monkeypatch.setattr(landing, "merge_runs", merge)
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 0
    stream_table(spark, GAMES, "games", zones, state).awaitTermination(120)
    assert pipeline.warehouse_tables(spark, zones)[GAMES.name].count() == 14
