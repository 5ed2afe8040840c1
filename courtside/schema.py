"""Table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

LINEUP_SIZE = 5

STINTS = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("off_team_id", T.LongType()),
        T.StructField("def_team_id", T.LongType()),
        T.StructField("off_lineup", T.StringType()),
        T.StructField("def_lineup", T.StringType()),
        T.StructField("garbage", T.BooleanType()),
        T.StructField("poss", T.LongType()),
        T.StructField("points", T.LongType()),
    ]
)
STINT_COLUMNS = STINTS.fieldNames()

#: One row per possession, player of the credited team and statistic.
STAT_ROWS = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("poss_idx", T.LongType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("start_time", T.StringType()),
        T.StructField("start_score_margin", T.LongType()),
        T.StructField("player_id", T.LongType()),
        T.StructField("team_id", T.LongType()),
        T.StructField("opponent_team_id", T.LongType()),
        T.StructField("lineup_id", T.StringType()),
        T.StructField("opponent_lineup_id", T.StringType()),
        T.StructField("stat_key", T.StringType()),
        T.StructField("stat_value", T.LongType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("poss", T.LongType()),
        T.StructField("points", T.LongType()),
        T.StructField("warnings", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

PLAYERS = T.StructType(
    [
        T.StructField("player_id", T.LongType()),
        T.StructField("orapm", T.DoubleType()),
        T.StructField("drapm", T.DoubleType()),
        T.StructField("rapm", T.DoubleType()),
        T.StructField("off_poss", T.LongType()),
        T.StructField("def_poss", T.LongType()),
    ]
)
PRIOR = T.StructType([T.StructField("player_id", T.LongType()), T.StructField("o", T.DoubleType()), T.StructField("d", T.DoubleType())])
