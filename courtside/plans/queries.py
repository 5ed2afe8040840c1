"""Queries over the driver's tables, each with its DuckDB statement where SQL can express it."""

from __future__ import annotations

import tempfile
from contextlib import closing, contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtside.functions.columns import clock_seconds, dashes, garbage_time, per_100, player_ids
from courtside.functions.seasons import end_year, end_year_col, season_name, season_name_col
from courtside.operators import evaluate, events, features, ingest, interactions, possessions, priors, rapm, validate
from courtside.operators.cube import Cube, column_sums, matchups, pair_sums
from courtside.operators.ridge import LAMBDA_GRID, solve
from courtside.operators.tune import Search, descend
from courtside.operators.weights import Knobs, with_multiplier
from courtside.plans import solve_sql
from courtside.plans.driver import FEATURES_SQL, STINTS_SQL, statistics, stints, table
from courtside.plans.driver import features as feature_frames
from courtside.sources import schedule, stints as store
from courtside.sources.names import with_names
from courtside.sources.payloads import result_lines
from courtside.sources.results import TUNED_KEYS
from courtside.sources.scratch import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in cols})


WITH = f"WITH {STINTS_SQL}"


# --- possessions to stints -----------------------------------------------------------------------------------------


@query(f"{WITH} SELECT * FROM stints")
def stint_build(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d)


@query(f"{WITH} SELECT game_id, off_team_id, def_team_id, off_lineup, def_lineup, garbage, CAST(sum(poss) AS BIGINT) AS poss, CAST(sum(points) AS BIGINT) AS points FROM stints GROUP BY ALL")
def stat_rows_to_stints(spark: SparkSession, d: str) -> DataFrame:
    return possessions.stints_and_failures(statistics(spark, d))[0]


@query(f"{WITH} SELECT game_id, off_lineup, def_lineup, garbage, CAST(5 * sum(poss) AS BIGINT) AS poss5, CAST(5 * sum(points) AS BIGINT) AS points5 FROM stints GROUP BY ALL")
def stat_rows_agg(spark: SparkSession, d: str) -> DataFrame:
    return possessions.matchup_sums(statistics(spark, d)).select("game_id", "off_lineup", "def_lineup", "garbage", "poss5", "points5")


@query("SELECT event_id, CAST(lpad(CAST(event_id % 13 AS VARCHAR), 2, '0') AS DOUBLE) * 60 + event_id % 60 AS seconds FROM events")
def clock_seconds_of_events(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    clock = F.concat(F.lpad((F.col("event_id") % 13).cast("string"), 2, "0"), F.lit(":"), F.lpad((F.col("event_id") % 60).cast("string"), 2, "0"))
    return e.select("event_id", clock_seconds(clock).alias("seconds"))


@query(
    """SELECT event_id, event_id % 6 >= 4 AND abs(event_id % 67 - 33) >= CASE WHEN event_id % 13 * 60 + event_id % 60 <= 180 THEN 12
       WHEN event_id % 13 * 60 + event_id % 60 <= 360 THEN 18 WHEN event_id % 13 * 60 + event_id % 60 <= 720 THEN 25 ELSE 1000 END AS garbage FROM events"""
)
def garbage_flag(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    clock = F.concat((F.col("event_id") % 13).cast("string"), F.lit(":"), (F.col("event_id") % 60).cast("string"))
    return e.select("event_id", garbage_time(F.col("event_id") % 6, clock, F.col("event_id") % 67 - 33).alias("garbage"))


@query(f"{WITH} SELECT season, season_type, CAST(count(*) AS BIGINT) AS rows, CAST(sum(points) AS BIGINT) AS points FROM stints WHERE poss = 0 GROUP BY ALL")
def orphan_points(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d).where("poss = 0").groupBy("season", "season_type").agg(F.count("*").alias("rows"), F.sum("points").alias("points"))


@query(f"{WITH} SELECT game_id, off_lineup, def_lineup, garbage, round(100.0 * points / poss, 6) AS y FROM stints WHERE poss > 0")
def target_rate(spark: SparkSession, d: str) -> DataFrame:
    s = stints(spark, d).where("poss > 0")
    return s.select("game_id", "off_lineup", "def_lineup", "garbage", F.round(per_100(F.col("points"), F.col("poss")), 6).alias("y"))


@query(f"{WITH} SELECT game_id, off_lineup, def_lineup, garbage FROM stints WHERE length(off_lineup) - length(replace(off_lineup, '-', '')) <> 4 OR poss NOT BETWEEN 0 AND 40")
def lineup_check(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d).where((dashes(F.col("off_lineup")) != 4) | ~F.col("poss").between(0, 40)).select("game_id", "off_lineup", "def_lineup", "garbage")


# --- weights -------------------------------------------------------------------------------------------------------

_MULT = "season, season_type, garbage, CAST(count(*) AS BIGINT) AS rows, CAST(round(max({m}), 6) AS DOUBLE) AS weight_mult FROM stints WHERE {m} > 0 GROUP BY ALL"
_DECAY = "power(0.9, (SELECT max(CAST(left(season, 4) AS INTEGER)) FROM stints) - CAST(left(season, 4) AS INTEGER))"
_PLAYOFF = "(CASE WHEN season_type <> 'Regular Season' THEN 1.5 ELSE 1.0 END)"


def _weights(spark, d, **knobs) -> DataFrame:
    w = with_multiplier(stints(spark, d), Knobs(**knobs))
    return w.groupBy("season", "season_type", "garbage").agg(F.count("*").alias("rows"), F.round(F.max("weight_mult"), 6).alias("weight_mult"))


@query(f"{WITH} SELECT {_MULT.format(m=_DECAY)}")
def weight_decay(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d, decay=0.9)


@query(f"{WITH} SELECT {_MULT.format(m=_PLAYOFF)}")
def weight_playoff(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d, playoff_weight=1.5)


@query(f"{WITH} SELECT {_MULT.format(m='(CASE WHEN garbage THEN 0.0 ELSE 1.0 END)')}")
def weight_garbage(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d, garbage_weight=0.0)


@query(f"{WITH} SELECT {_MULT.format(m=f'({_DECAY} * {_PLAYOFF} * CASE WHEN garbage THEN 0.5 ELSE 1.0 END)')}")
def weight_combined(spark: SparkSession, d: str) -> DataFrame:
    return _weights(spark, d, decay=0.9, playoff_weight=1.5, garbage_weight=0.5)


# --- aggregations --------------------------------------------------------------------------------------------------


@query(f"{WITH} SELECT game_id, off_team_id, CAST(sum(points) AS BIGINT) AS points FROM stints GROUP BY ALL")
def team_game_points(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d).groupBy("game_id", "off_team_id").agg(F.sum("points").alias("points"))


@query(f"{WITH} SELECT game_id, CAST(count(*) AS BIGINT) AS rows, CAST(sum(poss) AS BIGINT) AS poss, CAST(sum(points) AS BIGINT) AS points FROM stints GROUP BY ALL")
def game_totals(spark: SparkSession, d: str) -> DataFrame:
    return possessions.game_totals(stints(spark, d))


_SIDES = """players AS (
  SELECT CAST(unnest(string_split(off_lineup, '-')) AS BIGINT) AS player_id, 0 AS side, poss, points FROM stints WHERE poss > 0
  UNION ALL SELECT CAST(unnest(string_split(def_lineup, '-')) AS BIGINT), 1, poss, points FROM stints WHERE poss > 0)"""


@query(f"{WITH}, {_SIDES} SELECT player_id, CAST(coalesce(sum(poss) FILTER (side = 0), 0) AS BIGINT) AS off_poss, CAST(coalesce(sum(poss) FILTER (side = 1), 0) AS BIGINT) AS def_poss FROM players GROUP BY ALL")
def player_possessions(spark: SparkSession, d: str) -> DataFrame:
    sums = column_sums(matchups(stints(spark, d), []), [])
    side = lambda k: F.coalesce(F.sum(F.when(F.col("i") % 2 == k, F.col("w"))), F.lit(0))
    return sums.groupBy(F.expr("i div 2").alias("player_id")).agg(side(0).alias("off_poss"), side(1).alias("def_poss"))


@query(f"{WITH}, {_SIDES} SELECT DISTINCT player_id FROM players")
def player_universe(spark: SparkSession, d: str) -> DataFrame:
    s = stints(spark, d).where("poss > 0")
    return s.select(F.explode(F.array_union(player_ids(F.col("off_lineup")), player_ids(F.col("def_lineup")))).alias("player_id")).distinct()


@query(f"{WITH} SELECT CAST(sum(poss) AS BIGINT) AS poss, CAST(sum(points) AS BIGINT) AS points, round(100.0 * sum(points) / sum(poss), 2) AS per_100 FROM stints")
def league_per100(spark: SparkSession, d: str) -> DataFrame:
    return validate.league_per_100(stints(spark, d))


@query(f"{WITH}, y AS (SELECT season, poss AS w, 100.0 * points / poss AS y FROM stints WHERE poss > 0), m AS (SELECT season, sum(y * w) / sum(w) AS m FROM y GROUP BY season) SELECT season, round(max(m), 6) AS mean, round(CASE WHEN sqrt(sum(w * (y - m) * (y - m)) / sum(w)) = 0 THEN 1 ELSE sqrt(sum(w * (y - m) * (y - m)) / sum(w)) END, 6) AS std FROM y JOIN m USING (season) GROUP BY season")
def weighted_mean_std(spark: SparkSession, d: str) -> DataFrame:
    s = stints(spark, d).where("poss > 0").select("season", F.col("poss").alias("w"), per_100(F.col("points"), F.col("poss")).alias("y"))
    m = s.groupBy("season").agg((F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("m"))
    std = F.sqrt(F.sum(F.col("w") * F.pow(F.col("y") - F.col("m"), 2)) / F.sum("w"))
    return s.join(m, "season").groupBy("season").agg(F.round(F.max("m"), 6).alias("mean"), F.round(F.when(std == 0, 1.0).otherwise(std), 6).alias("std"))


@query(f"{WITH} SELECT CAST(count(DISTINCT game_id) AS BIGINT) AS games, CAST(count(DISTINCT season) AS BIGINT) AS seasons, CAST(count(DISTINCT season_type) AS BIGINT) AS types FROM stints")
def distinct_counts(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d).agg(F.count_distinct("game_id").alias("games"), F.count_distinct("season").alias("seasons"), F.count_distinct("season_type").alias("types"))


@query(f"{WITH} SELECT max(CAST(left(season, 4) AS INTEGER) + 1) AS last_year FROM stints")
def last_season_year(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d).agg(F.max(end_year_col(F.col("season"))).alias("last_year"))


_COLS = """cols AS (
  SELECT poss, points, list_concat(list_transform(string_split(off_lineup, '-'), lambda x: CAST(x AS BIGINT) * 2), list_transform(string_split(def_lineup, '-'), lambda x: CAST(x AS BIGINT) * 2 + 1)) AS c,
         row_number() OVER () AS rn FROM stints WHERE poss > 0
), one AS (SELECT rn, poss, points, unnest(c) AS i FROM cols)"""


@query(f"{WITH}, {_COLS} SELECT a.i, b.i AS j, CAST(sum(a.poss) AS BIGINT) AS w FROM one a JOIN one b ON a.rn = b.rn AND a.i <= b.i GROUP BY ALL")
def gram_pairs(spark: SparkSession, d: str) -> DataFrame:
    return pair_sums(matchups(stints(spark, d), []), [])


@query(f"{WITH}, {_COLS} SELECT i, CAST(sum(poss) AS BIGINT) AS w, CAST(sum(points) AS BIGINT) AS p FROM one GROUP BY ALL")
def normal_rhs(spark: SparkSession, d: str) -> DataFrame:
    return column_sums(matchups(stints(spark, d), []), [])


# --- joins and sets ------------------------------------------------------------------------------------------------


def _manifest(spark, d) -> DataFrame:
    """Games whose number is even are processed, those divisible by 7 failed, the others unknown."""
    games = stints(spark, d).groupBy("game_id").agg(F.count("*").alias("rows"), F.sum("poss").alias("poss"), F.sum("points").alias("points"))
    number = F.regexp_extract("game_id", r"(\d+)$", 1).cast("int")
    return games.where((number % 2 == 0) | (number % 7 == 0)).select("game_id", F.when(number % 2 == 0, "processed").otherwise("failed").alias("status"), "rows", "poss", "points", F.array().cast("array<string>").alias("warnings"), F.lit(None).cast("string").alias("error"))


_MANIFEST = """manifest AS (
  SELECT DISTINCT game_id, CASE WHEN CAST(regexp_extract(game_id, '(\\d+)$', 1) AS INTEGER) % 2 = 0 THEN 'processed' ELSE 'failed' END AS status FROM stints
  WHERE CAST(regexp_extract(game_id, '(\\d+)$', 1) AS INTEGER) % 2 = 0 OR CAST(regexp_extract(game_id, '(\\d+)$', 1) AS INTEGER) % 7 = 0)"""


@query(f"{WITH}, {_MANIFEST} SELECT DISTINCT game_id FROM stints WHERE game_id NOT IN (SELECT game_id FROM manifest)")
def todo_anti(spark: SparkSession, d: str) -> DataFrame:
    return ingest.todo(stints(spark, d).select("game_id").distinct(), _manifest(spark, d))


@query(f"{WITH}, {_MANIFEST} SELECT game_id, CAST(sum(points) AS BIGINT) AS points FROM stints WHERE game_id IN (SELECT game_id FROM manifest WHERE status = 'processed') GROUP BY ALL")
def processed_semi(spark: SparkSession, d: str) -> DataFrame:
    from courtside.sources.stints import processed_only

    return processed_only(stints(spark, d), _manifest(spark, d)).groupBy("game_id").agg(F.sum("points").alias("points"))


def _official(spark, d) -> DataFrame:
    """Scores of all teams, one point off where the team number is divisible by 5, and a team without stints."""
    got = stints(spark, d).groupBy("game_id", F.col("off_team_id").alias("team_id")).agg(F.sum("points").alias("pts"))
    odd = got.select("game_id", "team_id", (F.col("pts") + F.when(F.col("team_id") % 5 == 0, 1).otherwise(0)).alias("pts"))
    return odd.unionByName(got.select("game_id").distinct().select("game_id", F.lit(99).cast("long").alias("team_id"), F.lit(3).cast("long").alias("pts")))


_OFFICIAL = """got AS (SELECT game_id, off_team_id AS team_id, CAST(sum(points) AS BIGINT) AS got FROM stints GROUP BY ALL),
official AS (SELECT game_id, team_id, got + CASE WHEN team_id % 5 = 0 THEN 1 ELSE 0 END AS pts FROM got UNION ALL SELECT DISTINCT game_id, 99, 3 FROM got)"""


@query(f"{WITH}, {_MANIFEST}, {_OFFICIAL} SELECT o.game_id, o.team_id, coalesce(g.got, 0) AS stints, CAST(o.pts AS BIGINT) AS official FROM official o LEFT JOIN got g USING (game_id, team_id) WHERE o.game_id IN (SELECT game_id FROM manifest WHERE status = 'processed') AND coalesce(g.got, 0) <> o.pts")
def score_mismatch(spark: SparkSession, d: str) -> DataFrame:
    return validate.score_mismatches(_official(spark, d), stints(spark, d), _manifest(spark, d))


@query(f"{WITH}, {_MANIFEST}, {_OFFICIAL} SELECT DISTINCT game_id FROM official WHERE game_id NOT IN (SELECT game_id FROM manifest)")
def games_missing(spark: SparkSession, d: str) -> DataFrame:
    return validate.missing_games(_official(spark, d), _manifest(spark, d))


@query(f"{WITH}, {_MANIFEST} SELECT CAST(count(*) AS BIGINT) AS checked FROM (SELECT DISTINCT game_id FROM stints) WHERE game_id IN (SELECT game_id FROM manifest WHERE status = 'processed')")
def score_checked(spark: SparkSession, d: str) -> DataFrame:
    done = _manifest(spark, d).where("status = 'processed'")
    return stints(spark, d).select("game_id").distinct().join(done, "game_id", "left_semi").agg(F.count("*").alias("checked"))


@query(f"WITH {FEATURES_SQL} SELECT player_id, minutes, box_PTS, box_AST, adv_NET_RATING, adv_PACE, round(pt_drives_DRIVES, 6) AS pt_drives_DRIVES, pt_drives_DRIVE_FG_PCT FROM wide")
def features_full_outer(spark: SparkSession, d: str) -> DataFrame:
    base, advanced, tracking = feature_frames(spark, d)
    return rounded(features.season_features(base, advanced, {"Drives": tracking}), "pt_drives_DRIVES")


@query(f"WITH {FEATURES_SQL} SELECT player_id, round(pt_drives_DRIVES, 6) AS pt_drives_DRIVES, pt_drives_DRIVE_FG_PCT FROM tracking")
def per36(spark: SparkSession, d: str) -> DataFrame:
    return rounded(features.prefixed(feature_frames(spark, d)[2], "pt_drives_", per_36=True), "pt_drives_DRIVES")


def _wide(frames) -> DataFrame:
    base, advanced, tracking = frames
    return features.season_features(base, advanced, {"Drives": tracking})


@query(f"WITH {FEATURES_SQL}, z AS (SELECT avg(box_PTS) AS m, CASE WHEN stddev_pop(box_PTS) = 0 THEN 1 ELSE stddev_pop(box_PTS) END AS s FROM wide) SELECT player_id, round(coalesce((box_PTS - m) / s, 0), 6) AS z FROM wide, z")
def feature_standardize(spark: SparkSession, d: str) -> DataFrame:
    wide = _wide(feature_frames(spark, d))
    row = wide.agg(F.avg("box_PTS").alias("m"), F.stddev_pop("box_PTS").alias("s")).first()
    return wide.select("player_id", F.round(F.get(priors.standardised(wide, ["box_PTS"], [row["m"]], [row["s"] or 1.0]), 0), 6).alias("z"))


@query(f"{WITH}, {FEATURES_SQL}, {_SIDES}, t AS (SELECT player_id, CAST(sum(poss) AS BIGINT) AS poss FROM players GROUP BY ALL) SELECT player_id, box_PTS, poss FROM wide JOIN t USING (player_id)")
def spm_inner_join(spark: SparkSession, d: str) -> DataFrame:
    sums = column_sums(matchups(stints(spark, d), []), []).groupBy(F.expr("i div 2").alias("player_id")).agg(F.sum("w").alias("poss"))
    return _wide(feature_frames(spark, d)).join(sums, "player_id").select("player_id", "box_PTS", "poss")


@query(f"WITH {FEATURES_SQL}, twice AS (SELECT player_id, minutes, box_PTS FROM wide UNION ALL SELECT player_id, minutes / 2, box_AST FROM wide) SELECT player_id, round(sum(coalesce(box_PTS, 0) * greatest(coalesce(minutes, 1), 1)) / sum(greatest(coalesce(minutes, 1), 1)), 6) AS o, round(sum((1 - coalesce(box_PTS, 0)) * greatest(coalesce(minutes, 1), 1)) / sum(greatest(coalesce(minutes, 1), 1)), 6) AS d FROM twice GROUP BY player_id")
def player_weighted_avg(spark: SparkSession, d: str) -> DataFrame:
    wide = _wide(feature_frames(spark, d))
    twice = wide.select("player_id", "minutes", "box_PTS").unionByName(wide.select("player_id", (F.col("minutes") / 2).alias("minutes"), F.col("box_AST").alias("box_PTS")))
    model = priors.SpmModel(["box_PTS"], [0.0], [1.0], [1.0], [-1.0], 0.0, 1.0, 1.0, 1.0)
    return rounded(priors.predict_spm(model, twice), "o", "d")


@query(f"{WITH} SELECT season, season_type, CAST(count(*) AS BIGINT) AS rows, CAST(sum(points) AS BIGINT) AS points FROM stints GROUP BY ALL")
def union_scopes(spark: SparkSession, d: str) -> DataFrame:
    """All scopes, stored as partitions and loaded again."""
    path = shared_folder(spark)
    store.write_partitioned(stints(spark, d), path)
    scopes = spark.read.parquet(path).select("season", "season_type").distinct().collect()
    loaded = store.load_partitioned(spark, path, sorted({r["season"] for r in scopes}), sorted({r["season_type"] for r in scopes}))
    return loaded.groupBy("season", "season_type").agg(F.count("*").alias("rows"), F.sum("points").alias("points"))


@query(f"{WITH} SELECT game_id, off_team_id, def_team_id, off_lineup, def_lineup, garbage, CAST(sum(poss) AS BIGINT) AS poss, CAST(sum(points) AS BIGINT) AS points, season, season_type FROM stints GROUP BY ALL")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Possession statistics as a stream of files, taken in batch by batch, and the table that results."""
    from courtside.streaming.ingest import SCOPED, ingest_stream

    path = shared_folder(spark)
    end = F.substring("game_id", 2, 4).cast("int")
    kind = F.when(F.substring("game_id", 7, 1) == "p", "Playoffs").otherwise("Regular Season")
    # whole games arrive in one file
    stats = statistics(spark, d, by_game=True).withColumns({"season": season_name_col(end), "season_type": kind})
    stats.select(*SCOPED.fieldNames()).write.parquet(f"{path}/in")
    ingest_stream(spark, f"{path}/in", f"{path}/out", f"{path}/checkpoint", files_per_batch=4).awaitTermination()
    return spark.read.parquet(f"{path}/out/stints").drop("batch").withColumn("season", F.col("season").cast("string"))


@query(f"{WITH}, {_MANIFEST}, t AS (SELECT game_id, count(*) AS n, sum(poss) AS s, sum(points) AS p FROM stints GROUP BY game_id) SELECT game_id, status, CAST(CASE WHEN status = 'processed' THEN n END AS BIGINT) AS rows, CAST(CASE WHEN status = 'processed' THEN s END AS BIGINT) AS poss, CAST(CASE WHEN status = 'processed' THEN p END AS BIGINT) AS points FROM manifest JOIN t USING (game_id)")
def manifest_stored(spark: SparkSession, d: str) -> DataFrame:
    """A manifest, written, read and taken as a table."""
    rows = _manifest(spark, d).collect()  # one row a game
    done = {r["game_id"]: {"rows": r["rows"], "poss": r["poss"], "points": r["points"], "warnings": []} for r in rows if r["status"] == "processed"}
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "manifest.json"
        store.write_manifest(path, {"processed": done, "failed": {r["game_id"]: "x" for r in rows if r["status"] == "failed"}})
        return store.manifest_frame(spark, store.read_manifest(path)).select("game_id", "status", "rows", "poss", "points")


def _game_log(spark: SparkSession, d: str) -> str:
    """The folder of a schedule as the league's API gives it, with all games and scores."""
    rows = _official(spark, d).select("game_id", "team_id", "pts")
    cell = lambda c: F.col(c).cast("string")
    row = F.array(cell("game_id"), cell("team_id"), F.when(F.col("team_id") % 7 == 0, F.lit(None)).otherwise(cell("pts")))
    sets = F.array(F.struct(F.lit("LeagueGameLog").alias("name"), F.array(*map(F.lit, ("GAME_ID", "TEAM_ID", "PTS"))).alias("headers"), F.collect_list(row).alias("rowSet")))
    path = shared_folder(spark)
    # one envelope per game: an envelope is read whole
    rows.groupBy("game_id").agg(F.to_json(F.struct(sets.alias("resultSets"))).alias("value")).repartition("game_id").select("value").write.text(path)
    return path


_LOG = "log AS (SELECT game_id, team_id, CASE WHEN team_id % 7 <> 0 THEN pts END AS pts FROM official)"


@query(f"{WITH}, {_OFFICIAL}, {_LOG} SELECT game_id, team_id, CAST(pts AS BIGINT) AS pts FROM log")
def schedule_points(spark: SparkSession, d: str) -> DataFrame:
    """Official points, read from JSON envelopes."""
    return schedule.points_of(result_lines(spark, _game_log(spark, d), schedule.COLUMNS))


@query(f"{WITH}, {_OFFICIAL}, {_LOG} SELECT DISTINCT game_id FROM log WHERE pts IS NOT NULL")
def schedule_games(spark: SparkSession, d: str) -> DataFrame:
    return schedule.final_games(schedule.points_of(result_lines(spark, _game_log(spark, d), schedule.COLUMNS)))


@query(f"{WITH}, m AS (SELECT game_id, off_lineup, def_lineup, garbage, sum(poss) AS poss FROM stints GROUP BY ALL) SELECT DISTINCT game_id FROM m WHERE CAST(regexp_extract(game_id, '(\\d+)$', 1) AS INTEGER) % 7 = 0 AND poss % 5 <> 0")
def inexact_games(spark: SparkSession, d: str) -> DataFrame:
    """Games that fail because a player's possessions are missing from a lineup's."""
    number = F.regexp_extract("game_id", r"(\d+)$", 1).cast("int")
    lost = (number % 7 == 0) & (F.col("stat_key") == "OffPoss") & (F.col("player_id") == F.split("lineup_id", "-")[0].cast("long"))
    return possessions.stints_and_failures(statistics(spark, d).where(~lost))[1].select("game_id")


@query(
    """WITH shots AS (
  SELECT l_orderkey AS o, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN l_linenumber % 3 = 0 THEN 1 WHEN l_quantity >= 40 THEN 3 ELSE 2 END) AS BIGINT) AS points FROM lineitem GROUP BY l_orderkey
) SELECT concat('O', o) AS game_id, 1 AS side, 5 + n + 1 AS poss, points FROM shots UNION ALL SELECT concat('O', o), 2, 5 + n, 0 FROM shots"""
)
def play_by_play_stints(spark: SparkSession, d: str) -> DataFrame:
    """A game for every order: each of the first team misses, is rebounded and gets the ball back by a turnover; every line item is
    a shot of two or three points or a trip to the line with one of two made, and another turnover."""
    turn = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o"), turn.alias("turn"), F.col("l_linenumber").cast("int").alias("n"), (F.col("l_quantity") >= 40).alias("far"))
    orders = items.select("o").distinct()

    def event(at, kind: int, team: int, player=1, text: str = "x", action: int = 1):
        named = F.lit(1600000000 + team) if player is None else (F.lit(player) if isinstance(player, int) else player) + 10 * team
        return F.struct(F.lit(at).alias("at") if isinstance(at, int) else at.alias("at"), F.lit(kind).alias("kind"), F.lit(action).alias("action"), named.cast("long").alias("player"), F.lit(None if player is None else 1600000000 + team).cast("long").alias("team"), F.lit(text).alias("text") if isinstance(text, str) else text.alias("text"))

    opening = [event(0, 12, 1, None)] + [e for p in range(1, 6) for e in (event(3 * p, 2, 1, p, "MISS"), event(3 * p + 1, 4, 2, p), event(3 * p + 2, 5, 2, p))]
    begin = orders.select("o", F.explode(F.array(*opening, event(10**6, 13, 1, None))).alias("e"))
    at = lambda k: (F.col("turn") * 10 + 100 + k).cast("int")
    shot = F.array(event(at(0), 1, 1, 1, F.when(F.col("far"), "3PT shot").otherwise("shot")), event(at(6), 5, 2))
    trip = F.array(event(at(0), 6, 2, 1, "x", 2), event(at(1), 3, 1, 2, "MISS Free Throw 1 of 2"), event(at(2), 4, 1, None), event(at(3), 3, 1, 2, "Free Throw 2 of 2"), event(at(6), 5, 2))
    all_ = begin.unionByName(items.select("o", F.explode(F.when(F.col("n") % 3 == 0, trip).otherwise(shot)).alias("e")))
    none = {f"PLAYER{k}_{x}": F.lit(None).cast("long") for k in (2, 3) for x in ("ID", "TEAM_ID")} | {f"PERSON{k}TYPE": F.lit(None).cast("int") for k in (1, 2, 3)}
    rows = all_.select(
        F.concat(F.lit("O"), F.col("o").cast("string")).alias("GAME_ID"), F.col("e.at").cast("long").alias("EVENTNUM"), F.col("e.kind").alias("EVENTMSGTYPE"), F.col("e.action").alias("EVENTMSGACTIONTYPE"), F.lit(1).alias("PERIOD"),
        F.concat(F.col("e.at").cast("string"), F.lit(":00")).alias("PCTIMESTRING"), F.col("e.text").alias("HOMEDESCRIPTION"), *[F.lit(None).cast("string").alias(c) for c in ("NEUTRALDESCRIPTION", "VISITORDESCRIPTION", "SCORE")],
        F.col("e.player").alias("PLAYER1_ID"), F.col("e.team").alias("PLAYER1_TEAM_ID"), *[v.alias(k) for k, v in none.items()],
    )
    good = possessions.stints_and_failures(events.possession_totals(rows))[0]
    return good.groupBy("game_id", (F.col("off_team_id") - 1600000000).cast("int").alias("side")).agg(F.sum("poss").alias("poss"), F.sum("points").alias("points"))


@query(f"WITH {FEATURES_SQL} SELECT player_id, minutes, box_PTS, box_AST, adv_NET_RATING, adv_PACE, '2000-01' AS season, 'Playoffs' AS season_type FROM wide WHERE box_PTS IS NOT NULL OR adv_PACE IS NOT NULL")
def features_stored(spark: SparkSession, d: str) -> DataFrame:
    """A scope's features, built from payloads, stored and loaded; its season has no tracking."""
    base, advanced, _ = feature_frames(spark, d)
    scope = ("2000-01", "Playoffs")
    payload = lambda df: {"resultSets": [{"headers": df.columns, "rowSet": df.toPandas().astype(object).where(df.toPandas().notna(), None).values.tolist()}]}
    frames = {"dash_base": base, "dash_advanced": advanced}
    with tempfile.TemporaryDirectory() as folder:
        features.build_season_features(spark, Path(folder), *scope, fetch=lambda name: payload(frames["_".join(name.split("_")[:2])]))
        wide = features.load_features(spark, Path(folder), [scope[0]], [scope[1]])
        rows = wide.select("player_id", "minutes", "box_PTS", "box_AST", "adv_NET_RATING", F.col("adv_PACE").cast("long").alias("adv_PACE"), "season", "season_type")
        return spark.createDataFrame(rows.collect(), rows.schema)  # a row for each player


@query("SELECT i AS player_id, concat('Player ', i) AS player_name, round(i / 7.0, 3) AS orapm, round(-i / 11.0, 3) AS drapm FROM range(1, 51) t(i)")
def result_csv(spark: SparkSession, d: str) -> DataFrame:
    """A result file of fixed ratings, written and read again."""
    import pandas as pd

    from courtside.sources.results import write_result

    p = range(1, 51)
    with tempfile.TemporaryDirectory() as folder:
        path = write_result(Path(folder), "x", pd.DataFrame({"player_id": p, "player_name": [f"Player {i}" for i in p], "orapm": [i / 7 for i in p], "drapm": [-i / 11 for i in p]}), {})
        return spark.createDataFrame(pd.read_csv(path))


@query(f"{WITH} SELECT DISTINCT season, CAST(left(season, 4) AS INTEGER) + 1 AS end_year FROM stints")
def season_parse(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d).select("season", end_year_col(F.col("season")).alias("end_year")).distinct()


# --- model pieces ----------------------------------------------------------------------------------------------------

_TALENT = {p: ((p % 7 - 3) / 2.0, (p % 5 - 2) / 2.0) for p in range(1, 61)}


def _features_sql() -> str:
    parts, k = [], 0
    for lineup, a, b in (("off_lineup", 7, 3), ("def_lineup", 5, 2)):
        t = f"list_reverse_sort(list_transform(string_split({lineup}, '-'), lambda x: greatest((CAST(x AS INTEGER) % {a} - {b}) / 2.0, 0.0)))"
        for c in (f"{t}[1] * {t}[2]", f"(power(list_sum({t}), 2) - list_sum(list_transform({t}, lambda v: v * v))) / 2", f"power(list_sum({t}), 2)"):
            parts.append(f"round(CAST({c} AS DOUBLE), 6) AS f{k}")
            k += 1
    return f"{WITH} SELECT DISTINCT off_lineup, def_lineup, {', '.join(parts)} FROM stints"


@query(_features_sql())
def concentration_features(spark: SparkSession, d: str) -> DataFrame:
    rows = stints(spark, d).select("off_lineup", "def_lineup").distinct()
    return rounded(interactions.raw_features(rows, _TALENT), *[f"f{k}" for k in range(6)])


_PREDICT = "(100.0 + list_sum(list_transform(string_split(off_lineup, '-'), lambda x: CASE WHEN CAST(x AS INTEGER) <= 50 THEN CAST(x AS INTEGER) / 10.0 ELSE 0.0 END)) - list_sum(list_transform(string_split(def_lineup, '-'), lambda x: CASE WHEN CAST(x AS INTEGER) <= 50 THEN CAST(x AS INTEGER) / 20.0 ELSE 0.0 END)))"


def _fixed_ratings() -> rapm.Ratings:
    import pandas as pd

    p = list(range(1, 51))
    return rapm.Ratings(pd.DataFrame({"player_id": p, "orapm": [x / 10 for x in p], "drapm": [x / 20 for x in p]}), {"intercept": 100.0})


@query(f"{WITH} SELECT game_id, off_lineup, def_lineup, garbage, round(CAST({_PREDICT} AS DOUBLE), 6) AS predicted FROM stints")
def predict_with_fixed_coefs(spark: SparkSession, d: str) -> DataFrame:
    return rounded(evaluate.predict_stints(_fixed_ratings(), stints(spark, d)).select("game_id", "off_lineup", "def_lineup", "garbage", "predicted"), "predicted")


@query(f"{WITH} SELECT season, round(sum(poss * power(100.0 * points / poss - {_PREDICT}, 2)) / sum(poss), 4) AS mse FROM stints WHERE poss > 0 GROUP BY season")
def weighted_mse(spark: SparkSession, d: str) -> DataFrame:
    scored = evaluate.predict_stints(_fixed_ratings(), evaluate.scorable(stints(spark, d)))
    y = per_100(F.col("points"), F.col("poss"))
    return scored.groupBy("season").agg(F.round(F.sum(F.col("poss") * F.pow(y - F.col("predicted"), 2)) / F.sum("poss"), 4).alias("mse"))


@query(f"{WITH}, b AS (SELECT sum(points) * 100.0 / sum(poss) AS m FROM stints WHERE poss > 0) SELECT round(max(m), 6) AS mean, round(sum(poss * power(100.0 * points / poss - m, 2)) / sum(poss), 4) AS mse FROM stints, b WHERE poss > 0 AND NOT garbage")
def intercept_baseline(spark: SparkSession, d: str) -> DataFrame:
    s = stints(spark, d)
    m = s.where("poss > 0").agg((F.sum("points") * 100.0 / F.sum("poss")).alias("m"))
    y = per_100(F.col("points"), F.col("poss"))
    scored = evaluate.scorable(s, score_garbage=False).crossJoin(F.broadcast(m))  # one row
    return scored.agg(F.round(F.max("m"), 6).alias("mean"), F.round(F.sum(F.col("poss") * F.pow(y - F.col("m"), 2)) / F.sum("poss"), 4).alias("mse"))


@query(f"{WITH}, {_SIDES} SELECT player_id, CAST(sum(poss) AS BIGINT) AS off_poss FROM players WHERE side = 0 GROUP BY ALL ORDER BY off_poss DESC, player_id LIMIT 10")
def top10(spark: SparkSession, d: str) -> DataFrame:
    return player_possessions(spark, d).select("player_id", "off_poss").orderBy(F.desc("off_poss"), "player_id").limit(10)


@query(f"{WITH}, {_SIDES}, u AS (SELECT DISTINCT player_id FROM players) SELECT player_id, coalesce(c_name, concat('Player ', player_id)) AS player_name FROM u LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = player_id")
def names_fallback(spark: SparkSession, d: str) -> DataFrame:
    names = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("player_id"), F.col("c_name").alias("name"))
    return with_names(player_universe(spark, d), names)


@query(f"{WITH}, {_SIDES}, p AS (SELECT player_id, coalesce(sum(poss) FILTER (side = 0), 0) AS o, coalesce(sum(poss) FILTER (side = 1), 0) AS f FROM players GROUP BY ALL) SELECT player_id, CAST(o AS BIGINT) AS off_poss, CAST(f AS BIGINT) AS def_poss FROM p WHERE (o + f) / 2.0 >= (SELECT avg((o + f) / 2.0) FROM p)")
def min_poss_filter(spark: SparkSession, d: str) -> DataFrame:
    p = player_possessions(spark, d)
    mean = p.agg(F.avg((F.col("off_poss") + F.col("def_poss")) / 2).alias("m"))
    return p.crossJoin(F.broadcast(mean)).where((F.col("off_poss") + F.col("def_poss")) / 2 >= F.col("m")).drop("m")  # one row


@query(f"{WITH}, g AS (SELECT game_id, row_number() OVER (ORDER BY count(*) DESC, game_id) - 1 AS rn FROM stints WHERE poss > 0 GROUP BY game_id) SELECT game_id, CAST(CASE WHEN (rn // 5) % 2 = 0 THEN rn % 5 ELSE 4 - rn % 5 END AS INTEGER) AS fold FROM g")
def fold_assign(spark: SparkSession, d: str) -> DataFrame:
    return rapm.fold_of_game(stints(spark, d), 5)


@query(f"{WITH}, s AS (SELECT season, round(sum(poss * power(100.0 * points / poss - {_PREDICT}, 2)) / sum(poss), 4) AS mse FROM stints WHERE poss > 0 GROUP BY season) SELECT season, mse, round(first_value(mse) OVER (ORDER BY season) - mse, 4) AS vs_baseline FROM s")
def vs_baseline(spark: SparkSession, d: str) -> DataFrame:
    w = Window.orderBy("season")  # one row per season
    return weighted_mse(spark, d).withColumn("vs_baseline", F.round(F.first("mse").over(w) - F.col("mse"), 4))


@query(f"{WITH} SELECT game_id FROM (SELECT DISTINCT game_id FROM stints) ORDER BY game_id LIMIT 25")
def game_limit(spark: SparkSession, d: str) -> DataFrame:
    return stints(spark, d).select("game_id").distinct().orderBy("game_id").limit(25)


@query(f"{WITH}, {_OFFICIAL}, w AS (SELECT o.game_id, max(CASE WHEN coalesce(g.got, 0) <> o.pts THEN 1 ELSE 0 END) AS bad FROM official o LEFT JOIN got g USING (game_id, team_id) WHERE o.team_id <> 99 GROUP BY o.game_id) SELECT CAST(count(*) FILTER (bad = 1) AS BIGINT) AS games_with_warnings, CAST(count(*) AS BIGINT) AS games FROM w")
def warned_games(spark: SparkSession, d: str) -> DataFrame:
    finals = _official(spark, d).where("team_id <> 99").groupBy("game_id").agg(F.map_from_entries(F.collect_list(F.struct(F.col("team_id").cast("string"), "pts"))).alias("score")).withColumn("event_order", F.lit(1))
    w = possessions.score_warnings(stints(spark, d), finals)
    return w.agg(F.count_if(F.size("warnings") > 0).alias("games_with_warnings"), F.count("*").alias("games"))


_TWO = "two AS (SELECT poss AS w, 100.0 * points / poss AS y, CAST(list_contains(string_split(off_lineup, '-'), '1') AS INTEGER) AS a, CAST(list_contains(string_split(def_lineup, '-'), '2') AS INTEGER) AS b FROM stints WHERE poss > 0)"


@query(
    f"""{WITH}, {_TWO}, m AS (SELECT sum(w) AS s, sum(w * y) / sum(w) AS my, sum(w * a) / sum(w) AS ma, sum(w * b) / sum(w) AS mb FROM two),
    k AS (SELECT sum(w * (a - ma) * (a - ma)) + 500 AS aa, sum(w * (b - mb) * (b - mb)) + 500 AS bb, sum(w * (a - ma) * (b - mb)) AS ab, sum(w * (a - ma) * (y - my)) AS ay, sum(w * (b - mb) * (y - my)) AS byy FROM two, m)
    SELECT round((ay * bb - byy * ab) / (aa * bb - ab * ab), 6) AS offence_1, round((byy * aa - ay * ab) / (aa * bb - ab * ab), 6) AS defence_2 FROM k"""
)
def ridge_two_columns(spark: SparkSession, d: str) -> DataFrame:
    """The ridge fit on the indicators of one offence and one defence player, which has a closed form."""
    import numpy as np

    st = Cube(stints(spark, d)).stats()
    at = [int(np.searchsorted(st.players, 1)), st.size + int(np.searchsorted(st.players, 2))]
    sub = type(st)(st.players[:1], st.G[np.ix_(at, at)], st.r[at], st.u[at], st.s, st.t, st.q)
    beta, _ = solve(sub, 500.0)
    return spark.createDataFrame([(round(float(beta[0]), 6), round(float(beta[1]), 6))], "offence_1 double, defence_2 double")


# --- whole models ----------------------------------------------------------------------------------------------------


@contextmanager
def kept(df: DataFrame):
    """df, stored while a fit reads it several times."""
    df = df.persist()
    try:
        yield df
    finally:
        df.unpersist()


def rounded_ratings(df: DataFrame) -> DataFrame:
    return rounded(df, "orapm", "drapm", "rapm")


@query(solve_sql.fit())
def rapm_fit(spark: SparkSession, d: str) -> DataFrame:
    with kept(stints(spark, d)) as s:
        return rounded_ratings(rapm.fit_rapm(s, lam=500.0).to_spark(spark))


@query(solve_sql.cross_validation(",".join(f"{x:.1f}" for x in LAMBDA_GRID)))
def rapm_cv(spark: SparkSession, d: str) -> DataFrame:
    with kept(stints(spark, d)) as s:
        return spark.createDataFrame([(t["lambda"], round(t["cv_mse"], 6)) for t in rapm.cross_validate_lambda(s)[1]], "lambda double, cv_mse double")


@query(solve_sql.fit(f"({_DECAY} * {_PLAYOFF} * CASE WHEN garbage THEN 0.5 ELSE 1.0 END)"))
def rapm_weighted(spark: SparkSession, d: str) -> DataFrame:
    with kept(stints(spark, d)) as s:
        return rounded_ratings(rapm.fit_rapm(s, lam=500.0, decay=0.9, playoff_weight=1.5, garbage_weight=0.5).to_spark(spark))


@query(solve_sql.two_phase())
def rapm_two_phase(spark: SparkSession, d: str) -> DataFrame:
    with kept(stints(spark, d)) as s:
        data = rapm.Data(s)
        prior = rapm.as_prior(rapm.fit_rapm(s, lam=500.0, data=data))
        return rounded_ratings(rapm.fit_rapm(s, lam=500.0, prior=prior, data=data).to_spark(spark))


@query(solve_sql.last_season())
def rapm_last_season(spark: SparkSession, d: str) -> DataFrame:
    """The ratings of every season that has a predecessor, shrunk towards the plain fit of that one."""
    with kept(stints(spark, d)) as s:
        data = rapm.Data(s)
    seasons = sorted({p.key["season"] for p in data.cube.parts}, key=end_year)
    out = spark.createDataFrame([], rapm.PLAYERS).select(F.lit("").alias("season"), "*")
    for season in seasons:
        before = season_name(end_year(season) - 1)
        if before not in seasons:
            continue
        only = lambda name: lambda key: key["season"] == name
        prior = rapm.as_prior(rapm.fit_rapm(None, lam=500.0, data=data, keep=only(before)), 0.7)
        fit = rapm.fit_rapm(None, lam=500.0, prior=prior, data=data, keep=only(season)).to_spark(spark)
        out = out.unionByName(fit.select(F.lit(season).alias("season"), "*"))
    return rounded_ratings(out)


@query()
def rapm_interactions(spark: SparkSession, d: str) -> DataFrame:
    with kept(stints(spark, d)) as s:
        return interactions.fit_interaction_rapm(s, lam=500.0).to_spark(spark)


@query()
def spm_fit(spark: SparkSession, d: str) -> DataFrame:
    with kept(stints(spark, d)) as s:
        fit = rapm.fit_rapm(s, lam=500.0).to_spark(spark)
    wide = _wide(feature_frames(spark, d))
    return priors.predict_spm(priors.fit_spm(wide, fit), wide)


@query(f"{WITH}, n AS (SELECT count(DISTINCT game_id) AS games, count(*) AS rows FROM stints) SELECT CAST(games AS BIGINT) AS games, CAST(greatest(1, floor(games * 0.2)) AS BIGINT) AS held, CAST(0 AS BIGINT) AS shared, CAST(rows AS BIGINT) AS rows FROM n")
def holdout_split(spark: SparkSession, d: str) -> DataFrame:
    """How many games there are and are held out, how many are in both parts, and the rows of both together."""
    with kept(stints(spark, d)) as s:
        train, test = evaluate.holdout_split(s, 0.2, 0)
        side = lambda df, k: df.groupBy("game_id").agg(F.count("*").alias("n")).withColumn("held", F.lit(k))
        games = side(train, 0).unionByName(side(test, 1)).groupBy("game_id").agg(F.sum("n").alias("n"), F.max("held").alias("held"), F.count("*").alias("parts"))
        row = games.agg(F.count("*").alias("games"), F.sum("held").cast("long").alias("held"), F.count_if(F.col("parts") > 1).alias("shared"), F.sum("n").alias("rows")).collect()
    return spark.createDataFrame(row, "games long, held long, shared long, rows long")


@query()
def evaluate_grid(spark: SparkSession, d: str) -> DataFrame:
    s = stints(spark, d).persist()
    try:
        variants = {"plain": None, "two-phase": lambda t: priors.two_phase_prior(t, lam=500.0), "interactions": {"interactions": True}}
        table_ = evaluate.evaluate_grid(s, variants, decays=(1.0, 0.9), garbage_weights=(1.0, 0.5), playoff_weights=(1.0, 1.5), lam=500.0)
    finally:
        s.unpersist()
    return spark.createDataFrame(table_)


@query()
def tune_search(spark: SparkSession, d: str) -> DataFrame:
    """What tune() tries, in its order: all coordinates on its three splits, from a fixed penalty; option is the configuration.

    The table has no season before its first, so last-season priors are left out as in tune().
    """
    s = stints(spark, d)
    with closing(Search(s, 3, 0.2)) as search:
        found = descend(search.score, TUNED_KEYS | {"lambda": 500.0}, search.grids(False))
    return spark.createDataFrame([(h["note"], str(h["config"]), h["mse"]) for h in found.tried], "coordinate string, option string, mse double")
