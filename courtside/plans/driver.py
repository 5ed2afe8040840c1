"""Stint tables and other inputs of the engine made from the driver's TPC-H-like tables, the same in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.seasons import season_name_col

# Steps between the players of a row (coprime to 60) and the numbers of players and games.
STEPS = (1, 7, 11, 13, 17, 19, 23, 29)
PLAYERS, GAMES = 60, 40
SCOPE_KEY = ["season", "season_type", "game_id", "off_lineup", "def_lineup", "garbage"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line item: scope, lineups, garbage, possessions and points."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    met = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    year = F.year("o_orderdate") + 15
    step = F.get(F.array(*map(F.lit, STEPS)), (F.col("l_suppkey") % 8).cast("int"))
    player = lambda k: ((F.col("l_partkey") + k * step) % PLAYERS + 1).cast("int")
    five = lambda a: F.array_join(F.transform(F.array_sort(F.array(*[player(k) for k in range(a, a + 5)])), lambda p: p.cast("string")), "-")
    poss = (F.floor("l_quantity") % 8).cast("long")
    points = poss * (F.floor("l_extendedprice") % 3) + F.when(F.col("l_partkey") % 50 == 0, 1).otherwise(0)
    playoff = F.col("o_orderstatus") == "P"
    return met.select(
        season_name_col(year).alias("season"),
        F.when(playoff, "Playoffs").otherwise("Regular Season").alias("season_type"),
        F.concat(F.lit("G"), year.cast("string"), F.when(playoff, "_p").otherwise("_r"), (F.col("o_custkey") % GAMES).cast("string")).alias("game_id"),
        five(0).alias("off_lineup"),
        five(5).alias("def_lineup"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linenumber") >= 4)).alias("garbage"),
        poss.alias("poss"),
        points.cast("long").alias("points"),
    )


def stints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stints with scope; team ids follow from the first player of each lineup."""
    added = plays(spark, sf_dir).groupBy(*SCOPE_KEY).agg(F.sum("poss").alias("poss"), F.sum("points").alias("points"))
    team = lambda c: (F.split(F.col(c), "-")[0].cast("long") % 30 + 1)
    return added.select("game_id", team("off_lineup").alias("off_team_id"), team("def_lineup").alias("def_team_id"), "off_lineup", "def_lineup", "garbage", "poss", "points", "season", "season_type")


def statistics(spark: SparkSession, sf_dir: str, by_game: bool = False) -> DataFrame:
    """Possession statistics, one row per play, player of the credited team and statistic; by_game: a game's in one partition."""
    own = plays(spark, sf_dir)
    # plays are dealt out, not the ten rows that each of them becomes
    own = (own.repartition("game_id") if by_game else own).withColumns({"off_team": F.split("off_lineup", "-")[0].cast("long") % 30 + 1, "def_team": F.split("def_lineup", "-")[0].cast("long") % 30 + 1})
    clock, margin, period = F.when(F.col("garbage"), "02:00").otherwise("10:00"), F.when(F.col("garbage"), 15).otherwise(0).cast("long"), F.lit(4)
    credit = lambda team, opp, lineup, opp_lineup, key, value: F.struct(F.col(team).alias("team_id"), F.col(opp).alias("opponent_team_id"), F.col(lineup).alias("lineup_id"), F.col(opp_lineup).alias("opponent_lineup_id"), F.lit(key).alias("stat_key"), F.col(value).alias("stat_value"))
    both = F.array(credit("off_team", "def_team", "off_lineup", "def_lineup", "OffPoss", "poss"), credit("def_team", "off_team", "def_lineup", "off_lineup", "OpponentPoints", "points"))
    base = own.select("game_id", F.lit(0).cast("long").alias("poss_idx"), period.alias("period"), clock.alias("start_time"), margin.alias("start_score_margin"), F.explode(both).alias("s"))
    players = F.explode(F.split("s.lineup_id", "-").cast("array<bigint>")).alias("player_id")
    return base.select("game_id", "poss_idx", "period", "start_time", "start_score_margin", players, "s.*")


def features(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(base, advanced, tracking) payload-like frames per player: customers, parts and suppliers folded onto players."""
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("PLAYER_ID"), F.lit(None).cast("string").alias("PLAYER_NAME"), (F.col("c_custkey") % 82 + 1).cast("double").alias("GP"), (F.col("c_custkey") % 36 + 4).cast("double").alias("MIN"), F.round(F.abs("c_acctbal") / 100, 2).alias("PTS"), (F.col("c_nationkey") * 1.0).alias("AST"), F.col("c_custkey").cast("int").alias("PTS_RANK"))
    advanced = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("PLAYER_ID"), F.round(F.col("p_retailprice") / 10, 2).alias("NET_RATING"), F.col("p_size").alias("PACE"), F.col("p_size").alias("PACE_RANK"))
    tracking = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("PLAYER_ID"), (F.col("s_suppkey") % 30 * 10).cast("double").alias("MIN"), F.round(F.abs("s_acctbal"), 2).alias("DRIVES"), F.round(F.abs("s_acctbal") / 10000, 4).alias("DRIVE_FG_PCT"))
    return base, advanced, tracking


STINTS_SQL = """
plays AS (
  SELECT concat(year(o_orderdate) + 14, '-', right(CAST(year(o_orderdate) + 15 AS VARCHAR), 2)) AS season,
         CASE WHEN o_orderstatus = 'P' THEN 'Playoffs' ELSE 'Regular Season' END AS season_type,
         concat('G', year(o_orderdate) + 15, CASE WHEN o_orderstatus = 'P' THEN '_p' ELSE '_r' END, o_custkey % 40) AS game_id,
         [1, 7, 11, 13, 17, 19, 23, 29][CAST(l_suppkey % 8 AS INTEGER) + 1] AS step, l_partkey,
         (l_returnflag = 'R' AND l_linenumber >= 4) AS garbage,
         CAST(floor(l_quantity) AS BIGINT) % 8 AS poss,
         CAST(floor(l_quantity) AS BIGINT) % 8 * (CAST(floor(l_extendedprice) AS BIGINT) % 3) + CASE WHEN l_partkey % 50 = 0 THEN 1 ELSE 0 END AS points
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), lined AS (
  SELECT season, season_type, game_id, garbage, poss, points,
         array_to_string(list_sort(list_transform(range(0, 5), lambda k: (l_partkey + k * step) % 60 + 1)), '-') AS off_lineup,
         array_to_string(list_sort(list_transform(range(5, 10), lambda k: (l_partkey + k * step) % 60 + 1)), '-') AS def_lineup
  FROM plays
), stints AS (
  SELECT season, season_type, game_id, off_lineup, def_lineup, garbage, CAST(sum(poss) AS BIGINT) AS poss, CAST(sum(points) AS BIGINT) AS points,
         CAST(split_part(off_lineup, '-', 1) AS BIGINT) % 30 + 1 AS off_team_id, CAST(split_part(def_lineup, '-', 1) AS BIGINT) % 30 + 1 AS def_team_id
  FROM lined GROUP BY ALL
)
"""
FEATURES_SQL = """
base AS (
  SELECT c_custkey AS player_id, CAST((c_custkey % 36 + 4) * (c_custkey % 82 + 1) AS DOUBLE) AS minutes,
         round(abs(c_acctbal) / 100, 2) AS box_PTS, CAST(c_nationkey AS DOUBLE) AS box_AST FROM customer
), advanced AS (
  SELECT p_partkey AS player_id, round(p_retailprice / 10, 2) AS adv_NET_RATING, p_size AS adv_PACE FROM part
), tracking AS (
  SELECT s_suppkey AS player_id, round(abs(s_acctbal), 2) / greatest(CAST(s_suppkey % 30 * 10 AS DOUBLE), 1.0) * 36.0 AS pt_drives_DRIVES,
         round(abs(s_acctbal) / 10000, 4) AS pt_drives_DRIVE_FG_PCT FROM supplier
), wide AS (
  SELECT player_id, minutes, box_PTS, box_AST, adv_NET_RATING, adv_PACE, pt_drives_DRIVES, pt_drives_DRIVE_FG_PCT
  FROM base FULL JOIN advanced USING (player_id) FULL JOIN tracking USING (player_id)
)
"""
