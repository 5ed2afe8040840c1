"""Seasons, possessions, play-by-play, ingest, streaming, validation, features, priors, tuning and the command line."""

import datetime
import json
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from courtside import cli
from courtside.functions import seasons as S
from courtside.functions.columns import garbage_time
from courtside.operators import features, ingest, priors, tune, validate
from courtside.operators.events import final_scores, game_statistics, possession_statistics, possession_totals, read_events, statistics_or_error
from courtside.operators.possessions import score_warnings, stints_and_failures, stints_strict
from courtside.operators.rapm import fit_rapm
from courtside.schema import STAT_ROWS
from courtside.smoke import check_games
from courtside.sources import names, results, schedule, stints as store, web
from courtside.sources.throttle import Throttled
from courtside.streaming.ingest import SCOPED, ingest_stream
from courtside.synthetic import make_league, simulate_stints, write_scope

OFF, DEF = make_league()
A, B, B2 = "1-2-3-4-5", "6-7-8-9-10", "6-7-8-9-11"


def test_seasons(monkeypatch):
    assert S.season_name(1997) == "1996-97" and S.season_name(2000) == "1999-00" and S.end_year("1999-00") == 2000
    assert S.current_end_year(datetime.date(2024, 9, 30)) == 2024 and S.current_end_year(datetime.date(2024, 10, 1)) == 2025
    monkeypatch.setattr(S, "current_end_year", lambda today=None: 2025)
    assert S.parse_seasons("all")[0] == "1996-97" and S.parse_seasons("all")[-1] == "2024-25"
    assert S.parse_seasons("recent-2, 2010-11:2011-12,2024-25") == ["2023-24", "2024-25", "2010-11", "2011-12"]
    assert S.parse_season_types("Regular-Season, PLAY IN,playoffs,regular") == ["Regular Season", "Play In", "Playoffs"]
    with pytest.raises(ValueError):
        S.parse_season_types("preseason")
    assert S.stints_path(Path("d"), "2023-24", "Regular Season").as_posix() == "d/stints/2023_24_regularseason.parquet"


def stats(spark, facts):
    """Rows of (possession, period, clock, margin, team, opponent, lineup, opponent lineup, key, value)."""
    rows = [("G", i, period, clock, margin, int(p), team, opp, line, other, key, value) for i, period, clock, margin, team, opp, line, other, key, value in facts for p in line.split("-")]
    return spark.createDataFrame(rows, STAT_ROWS)


def matchups(df):
    return {(r.off_lineup, r.def_lineup, r.garbage): (r.poss, r.points) for r in df.collect()}


def test_possessions_to_stints(spark):
    off = lambda i, x, y, **k: (i, k.get("period", 1), k.get("clock", "10:00"), k.get("margin", 0), 100 if x == A else 200, 200 if x == A else 100, x, y, "OffPoss", 1)
    pts = lambda i, x, y, v, **k: (i, k.get("period", 1), k.get("clock", "10:00"), k.get("margin", 0), 100 if x == A else 200, 200 if x == A else 100, x, y, "OpponentPoints", v)
    facts = [off(1, A, B), pts(1, B, A, 2), off(2, B, A), off(3, A, B), pts(3, B, A, 3), off(4, B2, A), pts(4, A, B2, 2), (4, 1, "10:00", 0, 100, 200, A, B2, "Other", 9)]
    assert matchups(stints_and_failures(stats(spark, facts))[0]) == {(A, B, False): (2, 5), (B, A, False): (1, 0), (B2, A, False): (1, 2)}
    orphan = [off(1, A, B), pts(1, A, B, 1)]
    assert matchups(stints_strict(stats(spark, orphan))) == {(A, B, False): (1, 0), (B, A, False): (0, 1)}
    late = {"period": 4, "clock": "2:00", "margin": 20}
    assert matchups(stints_strict(stats(spark, [off(1, A, B), off(2, A, B, **late), pts(2, B, A, 2, **late)]))) == {(A, B, False): (1, 0), (A, B, True): (1, 2)}
    for bad in ([(1, 1, "10:00", 0, 100, 200, "1-2-3-4", B, "OffPoss", 1)], [(1, 1, "10:00", 0, 100, 200, "1-2-3-4-5-6", B, "OffPoss", 5)]):
        good, failed = stints_and_failures(stats(spark, [*bad, off(2, A, B)]))
        assert good.count() == 0 and failed.first().error.startswith("ValueError")
        with pytest.raises(Exception, match="ValueError"):
            stints_strict(stats(spark, bad)).collect()


def test_garbage_tiers(spark):
    cases = [(4, "10:00", 30, True), (4, "10:00", -30, True), (4, "10:00", 20, False), (4, "5:00", 20, True), (4, "2:00", -13, True), (2, "1:00", 40, False), (5, "3:00", 12, True), (4, "12:01", 60, False), (5, "5:00.5", 18, True), (5, "5:00", 17, False)]
    df = spark.createDataFrame(cases, "p int, c string, m int, want boolean")
    assert df.where(garbage_time(F.col("p"), F.col("c"), F.col("m")) != F.col("want")).count() == 0


def test_score_warnings(spark):
    s = spark.createDataFrame([("G", 2), ("G", 3)], "game_id string, points long")
    for score, n in (({"100": 2, "200": 3}, 0), ({"100": 2, "200": 5}, 1)):
        finals = spark.createDataFrame([("G", 1, {"100": 0, "200": 0}), ("G", 9, score)], "game_id string, event_order int, score map<string,int>")
        assert len(score_warnings(s, finals).first().warnings) == n


HOME, AWAY = 1610612737, 1610612738
HEADERS = ["GAME_ID", "EVENTNUM", "EVENTMSGTYPE", "EVENTMSGACTIONTYPE", "PERIOD", "WCTIMESTRING", "PCTIMESTRING", "HOMEDESCRIPTION", "NEUTRALDESCRIPTION", "VISITORDESCRIPTION", "SCORE", "SCOREMARGIN"]
for _n in (1, 2, 3):
    HEADERS += [f"PERSON{_n}TYPE", f"PLAYER{_n}_ID", f"PLAYER{_n}_NAME", f"PLAYER{_n}_TEAM_ID", f"PLAYER{_n}_TEAM_CITY", f"PLAYER{_n}_TEAM_NICKNAME", f"PLAYER{_n}_TEAM_ABBREVIATION"]
HEADERS.append("VIDEO_AVAILABLE_FLAG")


def play_by_play(game_id="0022300999", odd=None):
    """Away and home score by turns, away first; 106 comes in for 105 before the last home shot of the third period."""
    rows = []

    def event(kind, period, clock, p1=(0, None), p2=(0, None), p3=(0, None)):
        r = dict.fromkeys(HEADERS) | {"GAME_ID": game_id, "EVENTNUM": len(rows) + 1, "EVENTMSGTYPE": kind, "PERIOD": period, "PCTIMESTRING": clock, "HOMEDESCRIPTION": "x"}
        for n, (player, team) in enumerate((p1, p2, p3), 1):
            r |= {f"PLAYER{n}_ID": player, f"PLAYER{n}_TEAM_ID": team}
        rows.append([r[h] for h in HEADERS])

    for period in (1, 2, 3, 4):
        event(12, period, "12:00")
        if period == 1:
            event(10, 1, "11:58", (105, HOME), (205, AWAY), (201, AWAY))
        for i in range(5):
            event(1, period, f"{11 - 2 * i}:30", (201 + i, AWAY))
            if (period, i) == (3, 4):
                event(8, 3, "3:15", (105, HOME), (106, HOME))
            event(1, period, f"{11 - 2 * i}:00", (106 if i == 4 and period >= 3 else 101 + i, HOME))
        event(odd if odd and period == 4 else 13, period, "0:00")
    return {"resultSets": [{"name": "PlayByPlay", "headers": HEADERS, "rowSet": rows}]}


def write_game(data_dir, game_id, payload):
    path = S.play_by_play_path(data_dir, game_id)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload))


def test_play_by_play(spark, tmp_path):
    write_game(tmp_path, "0022300999", play_by_play())
    events = read_events(spark, str(S.play_by_play_path(tmp_path, "0022300999")))
    got = matchups(stints_and_failures(possession_statistics(events))[0])
    away, h5, h6 = "201-202-203-204-205", "101-102-103-104-105", "101-102-103-104-106"
    assert sum(p for p, _ in got.values()) == 44 and sum(x for _, x in got.values()) == 80
    assert {k[:2]: v for k, v in got.items()} == {(away, h5): (17, 30), (away, h6): (7, 10), (h5, away): (14, 28), (h6, away): (6, 12)}
    assert len(game_statistics(events.toPandas())) == 44 * 5 + 40 * 5


def every_kind(game_id="k1", score="3 - 8"):
    """One period with misses, rebounds, free throws, fouls, turnovers, a technical, a flagrant foul and a lost jump ball."""
    rows = []

    def event(kind, clock, *people, text="x", action=None, **more):
        r = dict.fromkeys(HEADERS) | {"GAME_ID": game_id, "EVENTNUM": len(rows) + 1, "EVENTMSGTYPE": kind, "EVENTMSGACTIONTYPE": action, "PERIOD": 1, "PCTIMESTRING": clock, "HOMEDESCRIPTION": text}
        for n, player in enumerate(people, 1):
            team = player >= 1_600_000_000
            r |= {f"PLAYER{n}_ID": player, f"PLAYER{n}_TEAM_ID": None if team else HOME if player < 200 else AWAY, f"PERSON{n}TYPE": 2 if team else 4}
        rows.append([(r | more)[h] for h in HEADERS])

    event(12, "12:00")
    event(10, "11:58", 105, 205, 201)
    event(2, "11:40", 202, text="MISS 2PT")
    event(4, "11:39", 203)
    event(2, "11:35", 203, text="MISS 3PT")
    event(4, "11:33", 101)  # away 1: none
    event(1, "11:20", 102, text="3PT shot")
    event(6, "11:20", 204, 102, action=2)
    event(3, "11:20", 102, text="Free Throw 1 of 1")  # home 1: four points
    event(5, "11:05", 205, 103, action=1)  # away 2: none
    event(6, "10:50", 201, 104, action=2)
    event(8, "10:50", 105, 106)
    event(3, "10:50", 104, text="MISS Free Throw 1 of 2")
    event(4, "10:50", HOME)
    event(3, "10:50", 104, text="Free Throw 2 of 2")  # home 2, with the five at the foul: one point
    event(6, "10:40", 101, action=11)
    event(3, "10:40", 202, text="Free Throw Technical")  # one point for away
    event(2, "10:30", 201, text="MISS")
    event(4, "10:28", AWAY)
    event(5, "10:20", AWAY, action=11)  # away 3
    event(6, "10:00", 203, 103, action=14)
    event(3, "10:00", 103, text="Free Throw Flagrant 1 of 2")
    event(3, "10:00", 103, text="MISS Free Throw Flagrant 2 of 2")
    event(4, "10:00", HOME)
    event(1, "9:50", 103, text="shot")  # home 3: three points
    event(1, "9:30", 204, text="shot", SCORE=score)  # away 4: two points
    event(9, "9:20", HOME)
    event(7, "9:20", HOME)
    event(10, "9:10", 104, 204, 203)  # home 4: none
    event(18, "9:00")
    event(2, "0:05", 205, text="MISS")
    event(13, "0:00")  # away 5
    return {"resultSets": [{"name": "PlayByPlay", "headers": HEADERS, "rowSet": rows}]}


def test_every_kind_of_event(spark, tmp_path):
    write_game(tmp_path, "k1", every_kind())
    broken = every_kind("k2")
    broken["resultSets"][0]["rowSet"] = broken["resultSets"][0]["rowSet"][:1]
    write_game(tmp_path, "k2", broken)
    events = read_events(spark, [str(S.play_by_play_path(tmp_path, g)) for g in ("k1", "k2")])
    good, bad = stints_and_failures(possession_statistics(events))
    away, h5, h6 = "201-202-203-204-205", "101-102-103-104-105", "101-102-103-104-106"
    assert {k[:2]: v for k, v in matchups(good).items()} == {(away, h5): (2, 0), (away, h6): (3, 3), (h5, away): (2, 5), (h6, away): (2, 3)}
    assert bad.count() == 0
    got = {r.game_id: r.score for r in final_scores(events).collect()}
    assert got["k1"] == {"away": 3, "home": 8} and sum(got["k2"].values()) == 0
    torn = events.where("GAME_ID = 'k1'").toPandas().assign(PLAYER1_TEAM_ID=AWAY, PLAYER2_TEAM_ID=AWAY, PLAYER3_TEAM_ID=AWAY)
    assert statistics_or_error(torn)["lineup_id"].iat[0].startswith("unreadable")


def test_games_are_read_once_and_by_rows(spark, tmp_path):
    """Games that cross Arrow batches, unknown kinds and unreadable games: totals are the sums of all players' rows."""
    for k in range(30):
        write_game(tmp_path, f"k{k:02}", every_kind(f"k{k:02}"))
    write_game(tmp_path, "odd", play_by_play("odd", odd=99))
    events = read_events(spark, [str(S.play_by_play_path(tmp_path, g)) for g in (*(f"k{k:02}" for k in range(30)), "odd")])
    torn = events.where("GAME_ID = 'k00'").withColumns({"GAME_ID": F.lit("torn"), **{f"PLAYER{n}_TEAM_ID": F.lit(AWAY).cast("long") for n in (1, 2, 3)}})
    events = events.unionByName(torn).cache()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        keys = [c for c in STAT_ROWS.fieldNames() if c not in ("player_id", "stat_value")]
        rows = possession_statistics(events).toPandas()
        totals = possession_totals(events).toPandas()
        made = stints_and_failures(possession_totals(events))
        good, bad = made[0].toPandas(), [r.game_id for r in made[1].collect()]
        plan = made[0]._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert plan.count("MapInArrow") == 1 and "MapInPandas" not in plan and "FlatMapGroups" not in plan
    assert set(rows["game_id"]) == {*(f"k{k:02}" for k in range(30)), "torn"}
    pd.testing.assert_series_equal(rows.groupby(keys)["stat_value"].sum().astype("int64"), totals.groupby(keys)["stat_value"].sum().astype("int64"))
    assert bad == ["torn"] and len(good) == 30 * 4 and good["poss"].sum() == 30 * 9 and good["points"].sum() == 30 * 11
    own = events.where("GAME_ID = 'k07'").toPandas()
    want = game_statistics(own).sort_values([*keys, "player_id"], ignore_index=True)
    pd.testing.assert_frame_equal(rows[rows["game_id"] == "k07"].sort_values([*keys, "player_id"], ignore_index=True), want, check_dtype=False)


def test_build_keeps_warnings_and_batches(spark, tmp_path):
    scope = ("2023-24", "Regular Season")
    games = {"k1": every_kind("k1"), "k2": every_kind("k2", score="3 - 9"), "k3": every_kind("k3")}
    asked = []
    fetch = lambda g: asked.append(g) or games[g]
    out = ingest.build_season(spark, tmp_path, *scope, game_ids=lambda *a: [*games, "k9"], fetch=fetch, flush_every=2)
    assert asked == ["k1", "k2", "k3", "k9"] and (out["games_processed"], out["games_failed"]) == (3, 1) and out["failed"]["k9"].startswith("KeyError")
    done = store.read_manifest(S.manifest_path(tmp_path, *scope))["processed"]
    assert done["k1"] == {"rows": 4, "poss": 9, "points": 11, "warnings": []} and len(done["k2"]["warnings"]) == 1
    assert validate.validate_season(spark, tmp_path, *scope)["build_warnings"] == 1
    assert store.stored_stints(spark, tmp_path, *scope).count() == 12


def test_fetchers_ask_the_api():
    asked = []

    def call(url, params):
        asked.append((url.rsplit("/", 1)[1], params))
        return web.Response(200, b'{"resultSets": []}')

    league = web.League(call, sleep=lambda s: None)
    assert league.schedule("2023-24", "Playoffs") == league.play_by_play("001") == league.names("2023-24") == {"resultSets": []}
    pick = league.features("2023-24", "Playoffs")
    pick("dash_base_2023_24_playoffs"), pick("pt_speeddistance_2023_24_playoffs")
    assert [a for a, _ in asked] == ["leaguegamelog", "playbyplayv2", "commonallplayers", "leaguedashplayerstats", "leaguedashptstats"]
    assert asked[3][1]["PerMode"] == "Per100Possessions" and asked[4][1]["PtMeasureType"] == "SpeedDistance"
    with pytest.raises(OSError):
        web.League(lambda url, params: web.Response(404, b"")).names(None)


def test_build_resume_and_retry(spark, tmp_path):
    scope = ("2023-24", "Regular Season")
    ids = lambda *a: ["g1", "g2", "g3", "g4"]
    write_game(tmp_path, "g1", play_by_play("g1"))
    write_game(tmp_path, "g2", {})
    write_game(tmp_path, "g3", play_by_play("g3", odd=99))
    out = ingest.build_season(spark, tmp_path, *scope, game_ids=ids, game_limit=3)
    assert out["games_processed"] == 1 and out["games_failed"] == 2
    manifest = store.read_manifest(S.manifest_path(tmp_path, *scope))
    assert manifest["processed"]["g1"]["poss"] == 44 and "unsupported" in manifest["failed"]["g3"]
    assert ingest.build_season(spark, tmp_path, *scope, game_ids=ids, game_limit=3)["games_new"] == 0
    write_game(tmp_path, "g2", play_by_play("g2"))
    out = ingest.build_season(spark, tmp_path, *scope, game_ids=ids, retry_failed=True)
    assert out["games_processed"] == 2 and out["games_failed"] == 2 and out["games_new"] == 3
    table = store.stored_stints(spark, tmp_path, *scope)
    assert table.agg(F.sum("points")).first()[0] == 160
    # rows that the manifest doesn't confirm (a run that ended in between) are left out and built again
    manifest = store.read_manifest(S.manifest_path(tmp_path, *scope))
    del manifest["processed"]["g2"]
    store.write_manifest(S.manifest_path(tmp_path, *scope), manifest)
    ingest.build_season(spark, tmp_path, *scope, game_ids=ids)
    assert spark.read.parquet(str(S.stints_path(tmp_path, *scope))).agg(F.sum("points")).first()[0] == 160
    table = store.stored_stints(spark, tmp_path, *scope)
    assert check_games(table) and not check_games(table.limit(0))


def test_streaming_ingest(spark, tmp_path):
    off = [("G1", 0, 1, "10:00", 0, p, 100, 200, A, B, "OffPoss", 1, "2023-24", "Playoffs") for p in range(1, 6)]
    spark.createDataFrame(off, SCOPED).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/stints")).agg(F.sum("poss")).first()[0] == 1
    spark.createDataFrame([("G2", *r[1:]) for r in off], SCOPED).write.mode("append").parquet(str(tmp_path / "in"))
    ingest_stream(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out/stints")).agg(F.sum("poss")).first()[0] == 2


def write_schedule(data_dir, season, kind, rows):
    path = S.schedule_path(data_dir, season, kind)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps({"resultSets": [{"headers": ["GAME_ID", "TEAM_ID", "PTS", "MATCHUP"], "rowSet": rows}]}))


def test_stream_stores_sums_and_deals_out_plays(spark, monkeypatch):
    """No batch stores its rows, plays are joined once and dealt out before they become ten rows each, games stay in one file."""
    from courtside.plans import driver, queries

    d, frame, stored = "/root/testdata/sf0.001", type(spark.range(1)), []
    own = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a, **b: (stored.append(self.columns), own(self, *a, **b))[1])
    folders = []
    shared = queries.shared_folder
    monkeypatch.setattr(queries, "shared_folder", lambda spark: (folders.append(shared(spark)), folders[-1])[1])
    got = queries.stream_ingest(spark, d)
    assert stored and not any("stat_value" in c for c in stored)
    files = spark.read.parquet(f"{folders[0]}/in").select("game_id", F.input_file_name().alias("f")).distinct().toPandas()
    assert len(files) == files["game_id"].nunique() and spark.read.parquet(f"{folders[0]}/in").count() == 10 * driver.plays(spark, d).count()
    want, key = driver.stints(spark, d), driver.SCOPE_KEY
    sums = lambda df: df.groupBy(*key, "off_team_id", "def_team_id").agg(F.sum("poss").alias("poss"), F.sum("points").alias("points")).toPandas().sort_values(key, ignore_index=True)
    pd.testing.assert_frame_equal(sums(got), sums(want))
    plan = driver.statistics(spark, d, by_game=True)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and plan.index("Generate") < plan.index("RepartitionByExpression")


def test_validate_and_schedule(spark, tmp_path):
    scope = ("2023-24", "Playoffs")
    assert validate.validate_season(spark, tmp_path, *scope)["problems"]
    pdf = pd.DataFrame([("g1", 1, 2, A, B, False, 20, 40), ("g1", 2, 1, B, A, False, 20, 42)], columns=["game_id", "off_team_id", "def_team_id", "off_lineup", "def_lineup", "garbage", "poss", "points"])
    write_scope(pdf, tmp_path, *scope)
    write_schedule(tmp_path, *scope, [["g1", 1, 40, "x"], ["g1", 2, 42, "x"]])
    report = validate.validate_season(spark, tmp_path, *scope)
    assert report["problems"] == [] and report["score_checked"] == 1 and report["pts_per_100"] == 205.0
    write_schedule(tmp_path, *scope, [["g1", 1, 41, "x"], ["g1", 2, 42, "x"], ["g7", 1, 3, "x"], ["g7", 3, 3, "x"]])
    report = validate.validate_season(spark, tmp_path, *scope)
    assert report["games_missing"] == ["g7"] and report["score_mismatches"] == [{"game_id": "g1", "team_id": 1, "stints": 40, "official": 41}] and len(report["problems"]) == 2
    assert schedule.season_game_ids(spark, tmp_path, *scope) == ["g1", "g7"]
    fetched = []
    schedule.season_game_ids(spark, tmp_path, *scope, refresh=True, fetch=lambda s, t: fetched.append(s) or {"resultSets": [{"headers": ["GAME_ID", "TEAM_ID", "PTS"], "rowSet": [["g9", 1, 2]]}]})
    assert fetched and schedule.season_game_ids(spark, tmp_path, *scope) == ["g9"]
    with pytest.raises(FileNotFoundError):
        schedule.season_game_ids(spark, tmp_path, "2001-02", "Playoffs")


def payload(headers, rows):
    return {"resultSets": [{"headers": headers, "rowSet": rows}]}


def test_features(spark, tmp_path):
    box = payload(["PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_ABBREVIATION", "AGE", "GP", "W", "L", "W_PCT", "MIN", "PTS", "AST", "STL", "PTS_RANK", "CFID", "CFPARAMS"], [[i, "x", 1, "T", 25.0, 70, 40, 30, 0.5, 34.0, 20.0 + i, 5.0, 1.0, 3, 7, "q"] for i in (1, 2)])
    track = payload(["PLAYER_ID", "PLAYER_NAME", "TEAM_ID", "TEAM_ABBREVIATION", "GP", "W", "L", "MIN", "DRIVES", "DRIVE_PTS", "DRIVE_FG_PCT"], [[1, "x", 1, "T", 70, 40, 30, 2380.0, 700, 400, 0.5], [3, "x", 1, "T", 1, 1, 0, 0.5, 2, 1, 0.25]])
    asked = []
    fetch = lambda name: asked.append(name) or (box if name.startswith("dash") else track)
    features.build_season_features(spark, tmp_path, "2023-24", "Regular Season", fetch=fetch)
    features.build_season_features(spark, tmp_path, "2005-06", "Regular Season", fetch=fetch)
    wide = spark.read.parquet(str(S.features_path(tmp_path, "2023-24", "Regular Season"))).toPandas().set_index("player_id")
    assert abs(wide.pt_drives_DRIVES[1] - 700 / 2380 * 36) < 1e-9 and wide.pt_drives_DRIVE_FG_PCT[1] == 0.5 and wide.minutes[1] == 34 * 70
    assert abs(wide.pt_drives_DRIVES[3] - 2 * 36) < 1e-9 and np.isnan(wide.box_PTS[3]) and {"box_PTS", "adv_PTS"} <= set(wide.columns)
    assert not [c for c in wide.columns if "RANK" in c or "CFID" in c or c.endswith("_GP")]
    both = features.load_features(spark, tmp_path, ["2005-06", "2023-24"], ["Regular Season"])
    assert both.where("season = '2005-06' and pt_drives_DRIVES is null").count() == 2 and len(asked) == 2 + 6 + 2
    with pytest.raises(FileNotFoundError):
        features.load_features(spark, tmp_path, ["1999-00"], ["Regular Season"])


def spm_rows(n=60, seed=3):
    rng = np.random.default_rng(seed)
    off, deff = rng.normal(0, 2, n), rng.normal(0, 1.5, n)
    f = pd.DataFrame({"player_id": np.arange(1, n + 1), "minutes": rng.uniform(300, 3000, n), "box_PTS": off * 2 + rng.normal(0, 0.3, n), "box_AST": off + rng.normal(0, 0.3, n), "box_STL": deff + rng.normal(0, 0.3, n), "pt_defense_CONTESTED_SHOTS": deff * 3 + rng.normal(0, 0.3, n), "box_NOISE": rng.normal(0, 1, n)})
    return f, pd.DataFrame({"player_id": np.arange(1, n + 1), "orapm": off, "drapm": deff})


def test_statistical_plus_minus(spark):
    f, t = spm_rows()
    model = priors.fit_spm(spark.createDataFrame(f), spark.createDataFrame(t))
    again = priors.SpmModel.from_json(model.to_json())
    assert again == model and model.alpha_o in priors.ALPHAS
    got = priors.collect_prior(priors.predict_spm(model, spark.createDataFrame(f)))
    o, d = np.array([got[i] for i in t.player_id]).T
    assert np.corrcoef(o, t.orapm)[0, 1] > 0.9 and np.corrcoef(d, t.drapm)[0, 1] > 0.9
    less = priors.collect_prior(priors.predict_spm(model, spark.createDataFrame(f.drop(columns="box_AST"))))
    assert all(np.isfinite(v).all() for v in less.values())
    with pytest.raises(ValueError):
        priors.fit_spm(spark.createDataFrame(f.head(20)), spark.createDataFrame(t))
    nan = f.copy()
    nan.loc[3, "box_STL"] = np.nan
    assert abs(priors.fit_spm(spark.createDataFrame(nan), spark.createDataFrame(t)).mean[2] - np.nanmean(nan.box_STL)) < 1e-9


@pytest.fixture(scope="module")
def league(tmp_path_factory):
    d = tmp_path_factory.mktemp("league")
    for season, kind, games, seed in (("2023-24", "Regular Season", 40, 1), ("2023-24", "Playoffs", 10, 2), ("2024-25", "Regular Season", 40, 3), ("2024-25", "Playoffs", 10, 4)):
        write_scope(simulate_stints(OFF, DEF, games, seed=seed, prefix=f"S{seed}_", garbage=0.08), d, season, kind)
    return d


def test_stint_store(spark, league):
    s = store.load_stints(spark, league, ["2023-24"], ["Regular Season", "Playoffs"])
    assert s.select("game_id").distinct().count() == 50 and {"season", "season_type"} <= set(s.columns)
    with pytest.raises(FileNotFoundError, match="2020-21 Playoffs.*2021-22 Playoffs"):
        store.load_stints(spark, league, ["2020-21", "2021-22", "2023-24"], ["Playoffs"])
    store.write_partitioned(s, str(league / "all"))
    plan = store.load_partitioned(spark, str(league / "all"), ["2023-24"], ["Playoffs"])
    assert plan.count() == 250 and "PartitionFilters: [" in plan._jdf.queryExecution().toString()
    assert store.stored_stints(spark, league, "1999-00", "Playoffs").count() == 0


def test_last_season_and_two_phase(spark, league):
    got = priors.last_season_prior(spark, league, ["2024-25"], ["Regular Season"], lam=500.0, scale=0.7)
    fit = fit_rapm(store.load_stints(spark, league, ["2023-24"], ["Regular Season"]), lam=500.0)
    want = {int(r.player_id): (0.7 * r.orapm, 0.7 * r.drapm) for r in fit.players.itertuples()}
    assert got == want
    s = store.load_stints(spark, league, ["2024-25"], ["Regular Season"])
    wide = fit_rapm(s, lam=500.0, prior=priors.two_phase_prior(s, lam=500.0)).players
    assert wide.rapm.std() > fit_rapm(s, lam=500.0).players.rapm.std()


def test_command_line(spark, league, capsys):
    common = ["--data-dir", str(league), "--seasons", "2023-24:2024-25"]
    assert cli.main(["rapm", *common, "--lambda", "500", "--no-names"]) == 0
    files = sorted((league / "results").glob("rapm_*.csv"))
    assert len(files) == 4
    table = pd.read_csv(files[0])
    assert table.columns.tolist() == ["player_id", "player_name", "orapm", "drapm", "rapm", "off_poss", "def_poss"] and table.player_name.isna().all()
    assert cli.main(["rapm", *common, "--pool", "--combine-types", "--lambda", "500", "--decay", "0.9", "--min-poss", "1", "--prior", "two-phase"]) == 0
    meta = json.loads((league / "results/rapm_2023_24_to_2024_25_regularseason_playoffs_twophase.meta.json").read_text())
    assert meta["n_games"] == 100 and meta["decay"] == 0.9 and meta["playoff_weight"] == 1.5 and meta["prior"] == "two-phase"
    assert pd.read_csv(league / "results/rapm_2023_24_to_2024_25_regularseason_playoffs_twophase.csv").player_name.str.startswith("Player ").all()
    assert cli.main(["evaluate", *common, "--lambda", "500", "--spm"]) == 1
    assert cli.main(["evaluate", *common, "--lambda", "500", "--garbage-weights", "1,0.5", "--holdout-no-garbage"]) == 0
    assert "two-phase-1" in capsys.readouterr().out
    assert cli.main(["validate", *common]) == 1  # no schedules
    with pytest.raises(ValueError, match="prior"):
        from courtside.operators.scopes import run_rapm

        run_rapm(spark, league, ["2023-24"], ["Playoffs"], prior_kind="odd")


def test_tune(spark, league):
    out = tune.tune(spark, league, ["2023-24", "2024-25"], ["Regular Season"], n_seeds=1, lam=500.0)
    notes = {h["note"] for h in out["history"]}
    assert {"baseline", "garbage_weight", "decay", "prior", "interactions"} == notes and out["holdout_mse"] <= out["history"][0]["mse"]
    assert results.read_tuned(league)["lambda"] == 500.0 and set(results.read_tuned(league)) == set(results.TUNED_KEYS)
    assert cli.main(["rapm", "--data-dir", str(league), "--seasons", "2024-25", "--season-types", "regular", "--tuned", "--no-names"]) == 0


def test_names(tmp_path):
    asked = []
    fetch = lambda season: asked.append(season) or {"resultSets": [{"headers": ["PERSON_ID", "DISPLAY_FIRST_LAST"], "rowSet": [[1, "One"]]}]}
    assert names.player_names(tmp_path, [1, 2], "2023-24", fetch) == {1: "One", 2: "Player 2"}
    assert names.player_names(tmp_path, [1, 2], "2023-24", fetch)[2] == "Player 2" and len(asked) == 1


def test_throttle():
    class Reply:
        def __init__(self, code):
            self.status_code = code

    replies, slept = [OSError(), Reply(503), Reply(200)], []

    def call(url):
        r = replies.pop(0)
        if isinstance(r, Exception):
            raise r
        return r

    t = Throttled(call, sleep=slept.append, clock=lambda: 0.0)
    assert t.get("u").status_code == 200 and 1 <= slept[0] <= 2 and any(6 <= s <= 8 for s in slept)
    replies[:] = [Reply(500)] * 5
    assert t.get("u").status_code == 500 and not replies
