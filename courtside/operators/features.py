"""Wide player features from box-score and tracking payloads."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions.seasons import end_year, features_path, scope_slug
from courtside.sources.payloads import cached_payload, result_frame

# Columns that are no features, names that mark rates, tracking measures and the first season that has them.
ID_COLUMNS = frozenset({"PLAYER_ID", "PLAYER_NAME", "NICKNAME", "TEAM_ID", "TEAM_ABBREVIATION", "TEAM_NAME", "AGE", "GP", "W", "L", "W_PCT", "MIN"})
NOT_FEATURES = ("_RANK", "FANTASY", "CFID", "CFPARAMS", "WNBA")
RATES = ("PCT", "AVG", "SPEED", "PER_")
TRACKING = ("Drives", "Possessions", "Passing", "Defense", "Rebounding", "SpeedDistance")
FIRST_TRACKING_YEAR = 2014


def feature_columns(table: DataFrame) -> list[str]:
    return [f.name for f in table.schema if isinstance(f.dataType, T.NumericType) and f.name not in ID_COLUMNS and not any(x in f.name for x in NOT_FEATURES)]


def prefixed(table: DataFrame, prefix: str, per_36: bool = False) -> DataFrame:
    """player_id and the features under a prefix; per_36 turns counts into rates per 36 minutes (at least one minute)."""
    minutes = F.greatest(F.col("MIN").cast("double"), F.lit(1.0))
    rate = lambda c: F.col(c) if not per_36 or any(x in c for x in RATES) else F.col(c).cast("double") / minutes * 36.0
    return table.select(F.col("PLAYER_ID").cast("long").alias("player_id"), *[rate(c).alias(prefix + c) for c in feature_columns(table)])


def season_features(base: DataFrame, advanced: DataFrame, tracking: dict[str, DataFrame]) -> DataFrame:
    """One wide row per player: minutes, box_*, adv_* and pt_<measure>_*, full outer on the player."""
    total = base.select(F.col("PLAYER_ID").cast("long").alias("player_id"), (F.col("MIN").cast("double") * F.col("GP").cast("double")).alias("minutes"))
    box = total.join(prefixed(base, "box_"), "player_id")
    parts = [box, prefixed(advanced, "adv_"), *[prefixed(t, f"pt_{m.lower()}_", per_36=True) for m, t in tracking.items()]]
    return reduce(lambda a, b: a.join(b, "player_id", "full_outer"), parts)


def build_season_features(spark: SparkSession, data_dir: Path, season: str, season_type: str, tracking: bool = True, fetch: Callable[[str], dict] | None = None) -> Path:
    """Write the feature table of a scope from its payloads (cached, or from fetch by name)."""
    slug, folder = scope_slug(season, season_type), Path(data_dir) / "raw" / "features"
    frame = lambda name: result_frame(spark, cached_payload(folder / f"{name}_{slug}.json", (lambda: fetch(f"{name}_{slug}")) if fetch else None))
    measures = TRACKING if tracking and end_year(season) >= FIRST_TRACKING_YEAR else ()
    wide = season_features(frame("dash_base"), frame("dash_advanced"), {m: frame(f"pt_{m.lower()}") for m in measures})
    path = features_path(data_dir, season, season_type)
    wide.write.mode("overwrite").parquet(str(path))
    return path


def load_features(spark: SparkSession, data_dir: Path, seasons: list[str], season_types: list[str]) -> DataFrame:
    """The union of stored features with season and season_type; a column that a scope lacks is null there."""
    out = None
    for season in seasons:
        for season_type in season_types:
            path = features_path(data_dir, season, season_type)
            if not path.exists():
                raise FileNotFoundError(f"no features for {season} {season_type} at {path}: run the features command first")
            one = spark.read.parquet(str(path)).withColumns({"season": F.lit(season), "season_type": F.lit(season_type)})
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
