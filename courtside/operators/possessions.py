"""Possession statistics to stint rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions.columns import dashes, garbage_time
from courtside.schema import LINEUP_SIZE, STINT_COLUMNS

KEY = STINT_COLUMNS[:6]


def matchup_sums(stats: DataFrame, scope: list[str] = ()) -> DataFrame:
    """Raw sums per matchup, before the division by the lineup size; scope names columns of the game that stay.

    Possessions are credited to the offence; opponent points to the team that was scored on, so their roles are swapped.
    Both are summed in one pass, which also keeps matchups with points but no possession.
    """
    swap = F.col("stat_key") == "OpponentPoints"
    pick = lambda a, b: F.when(swap, F.col(b)).otherwise(F.col(a))
    rows = stats.where(F.col("stat_key").isin("OffPoss", "OpponentPoints")).select(
        *scope,
        "game_id",
        pick("team_id", "opponent_team_id").alias("off_team_id"),
        pick("opponent_team_id", "team_id").alias("def_team_id"),
        pick("lineup_id", "opponent_lineup_id").alias("off_lineup"),
        pick("opponent_lineup_id", "lineup_id").alias("def_lineup"),
        garbage_time(F.col("period"), F.col("start_time"), F.col("start_score_margin")).alias("garbage"),
        F.when(~swap, F.col("stat_value")).otherwise(0).alias("poss"),
        F.when(swap, F.col("stat_value")).otherwise(0).alias("points"),
    )
    return rows.groupBy(*KEY, *scope).agg(F.sum("poss").alias("poss5"), F.sum("points").alias("points5"))


def problem():
    """Why a raw matchup cannot be a stint row; null if it can."""
    return F.when((F.col("poss5") % LINEUP_SIZE != 0) | (F.col("points5") % LINEUP_SIZE != 0), F.concat(F.lit("ValueError: sums not divisible by 5 for "), F.col("off_lineup"), F.lit(" vs "), F.col("def_lineup"))).when(
        (dashes(F.col("off_lineup")) != LINEUP_SIZE - 1) | (dashes(F.col("def_lineup")) != LINEUP_SIZE - 1), F.concat(F.lit("ValueError: lineup without 5 players: "), F.col("off_lineup"), F.lit(" vs "), F.col("def_lineup"))
    )


def sound_and_failed(sums: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stint rows of sound games, (game_id, error) of the others) from matchup_sums(); one bad matchup fails its whole game."""
    scope = [c for c in sums.columns if c not in (*KEY, "poss5", "points5")]
    sums = sums.withColumn("error", problem())
    failed = sums.where("error is not null").groupBy("game_id").agg(F.min("error").alias("error"))
    # a window, not a join with the failed games: the sums are made once, and a game has a few thousand matchups at most
    sound = sums.withColumn("_bad", F.count("error").over(Window.partitionBy("game_id"))).where("_bad = 0")
    return sound.select(*KEY, F.expr("poss5 div 5").alias("poss"), F.expr("points5 div 5").alias("points"), *scope), failed


def stints_and_failures(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sound_and_failed() of possession statistics."""
    return sound_and_failed(matchup_sums(stats))


def stints_strict(stats: DataFrame) -> DataFrame:
    """Stint rows; running it fails on the first bad matchup."""
    sums = matchup_sums(stats)
    checked = sums.withColumn("ok", F.when(problem().isNull(), True).otherwise(F.raise_error(problem()).cast("boolean")))
    return checked.where("ok").select(*KEY, F.expr("poss5 div 5").alias("poss"), F.expr("points5 div 5").alias("points"))


def score_warnings(stints: DataFrame, finals: DataFrame) -> DataFrame:
    """(game_id, warnings): games whose stint points differ from the last score of finals(game_id, event_order, score).

    score is a map of team and points.
    """
    last = finals.groupBy("game_id").agg(F.max_by("score", "event_order").alias("score"))
    official = last.select("game_id", F.aggregate(F.map_values("score"), F.lit(0).cast("long"), lambda a, x: a + x.cast("long")).alias("official"))
    got = stints.groupBy("game_id").agg(F.sum("points").alias("points"))
    text = F.concat(F.lit("points "), F.col("points").cast("string"), F.lit(" != final score "), F.col("official").cast("string"))
    return got.join(official, "game_id").select("game_id", F.when(F.col("points") != F.col("official"), F.array(text)).otherwise(F.array().cast("array<string>")).alias("warnings"))


def game_totals(stints: DataFrame) -> DataFrame:
    return stints.groupBy("game_id").agg(F.count("*").alias("rows"), F.sum("poss").alias("poss"), F.sum("points").alias("points"))
