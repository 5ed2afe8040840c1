"""Schedules: final games of a season and official team scores."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from courtside.functions.seasons import current_end_year, end_year, schedule_path
from courtside.sources.payloads import cached_payload, result_rows

# The columns of a game log that are used.
COLUMNS = {"GAME_ID": "string", "TEAM_ID": "long", "PTS": "long"}


def official_points(spark: SparkSession, data_dir: Path, season: str, season_type: str) -> DataFrame | None:
    """(game_id, team_id, pts) of the cached game log; None without one."""
    path = schedule_path(data_dir, season, season_type)
    if not path.exists():
        return None
    return points_of(result_rows(spark, str(path), COLUMNS))


def points_of(rows: DataFrame) -> DataFrame:
    """(game_id, team_id, pts) of the rows of a game log."""
    return rows.select(rows["GAME_ID"].alias("game_id"), rows["TEAM_ID"].alias("team_id"), rows["PTS"].alias("pts"))


def final_games(official: DataFrame) -> DataFrame:
    """The games that have a score."""
    return official.where("pts is not null").select("game_id").distinct()


def season_game_ids(spark: SparkSession, data_dir: Path, season: str, season_type: str, refresh: bool = False, fetch: Callable[[str, str], dict] | None = None) -> list[str]:
    """Sorted ids of the final games; the current season, or refresh, asks fetch again where there is one."""
    path = schedule_path(data_dir, season, season_type)
    if fetch is not None and (refresh or end_year(season) >= current_end_year()):
        path.unlink(missing_ok=True)
    cached_payload(path, (lambda: fetch(season, season_type)) if fetch else None)
    return [r[0] for r in final_games(official_points(spark, data_dir, season, season_type)).orderBy("game_id").collect()]
