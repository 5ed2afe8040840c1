"""Incremental, resumable building of stint tables from play-by-play.

A run takes the final games that the manifest has neither as processed nor as failed, in batches of ``FLUSH_EVERY``. A batch is
parsed in one job, bad games are kept apart with their error, points are checked against the final scores, and its rows are
appended before the manifest is written. If a run ends in between, the appended rows of games that the manifest doesn't confirm
are taken out by the next one before it starts, so nothing is counted twice.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.seasons import manifest_path, play_by_play_path, stints_path
from courtside.operators.events import final_scores, possession_totals, read_events, unsupported_games
from courtside.operators.possessions import game_totals, score_warnings, stints_and_failures
from courtside.schema import STINT_COLUMNS
from courtside.sources.payloads import cached_payload
from courtside.sources.schedule import season_game_ids
from courtside.sources.stints import manifest_frame, read_manifest, settle, write_manifest

logger = logging.getLogger(__name__)
GameIds = Callable[..., list[str]]
# Fixed value: games between two writes.
FLUSH_EVERY = 25


def todo(ids: DataFrame, manifest: DataFrame) -> DataFrame:
    """Games of ids(game_id) that the manifest has neither as processed nor as failed."""
    return ids.join(manifest.select("game_id"), "game_id", "left_anti")


def fetched(data_dir: Path, games: list[str], fetch: Callable[[str], dict] | None) -> dict[str, str]:
    """Bring the play-by-play of the games into the cache; {game_id: error} of those that aren't to be had."""
    failed = {}
    for game in games:
        try:
            path = play_by_play_path(data_dir, game)
            if not path.exists():
                cached_payload(path, (lambda game=game: fetch(game)) if fetch else None)
        except Exception as error:
            failed[game] = f"{type(error).__name__}: {error}"
    return failed


def parse_games(spark: SparkSession, data_dir: Path, games: list[str]) -> tuple[DataFrame, list[dict]]:
    """(stints, one report per game) of cached play-by-play: its totals and warnings, or its error. stints is persisted."""
    events = read_events(spark, [str(play_by_play_path(data_dir, g)) for g in games]).persist()
    stints, bad = stints_and_failures(possession_totals(events))
    errors = unsupported_games(events).unionByName(bad).groupBy("game_id").agg(F.min("error").alias("error"))
    sound = stints.select(*STINT_COLUMNS).join(errors.select("game_id"), "game_id", "left_anti").select(*STINT_COLUMNS).persist()
    asked = spark.createDataFrame([(g,) for g in games], "game_id string")
    totals = game_totals(sound).join(score_warnings(sound, final_scores(events)), "game_id", "left")
    reports = [r.asDict() for r in asked.join(totals, "game_id", "left").join(errors, "game_id", "left").orderBy("game_id").collect()]
    events.unpersist()
    return sound, reports


def take_in(spark: SparkSession, data_dir: Path, season: str, season_type: str, games: list[str], manifest: dict) -> None:
    """Append the stints of a batch of games and enter all of them in the manifest."""
    new, reports = parse_games(spark, data_dir, games)
    for r in reports:
        if r["rows"] is None:
            manifest["failed"][r["game_id"]] = r["error"] or "ValueError: no possessions"
            logger.warning("%s: failed (%s)", r["game_id"], manifest["failed"][r["game_id"]])
            continue
        manifest["processed"][r["game_id"]] = {k: r[k] for k in ("rows", "poss", "points")} | {"warnings": r["warnings"] or []}
        for warning in r["warnings"] or []:
            logger.warning("%s: %s", r["game_id"], warning)
    if any(r["rows"] for r in reports):
        new.write.mode("append").parquet(str(stints_path(data_dir, season, season_type)))
    new.unpersist()


def build_season(
    spark: SparkSession,
    data_dir: Path,
    season: str,
    season_type: str,
    game_limit: int | None = None,
    refresh_schedule: bool = False,
    retry_failed: bool = False,
    game_ids: GameIds = season_game_ids,
    fetch: Callable[[str], dict] | None = None,
    flush_every: int = FLUSH_EVERY,
) -> dict:
    """Bring a scope's stint table up to date; returns counts and the errors of failed games. game_ids is the source of final
    games, fetch that of play-by-play which isn't cached."""
    path = manifest_path(data_dir, season, season_type)
    manifest = read_manifest(path)
    if retry_failed:
        manifest["failed"] = {}
    ids = game_ids(spark, data_dir, season, season_type, refresh_schedule)[:game_limit]
    wanted = spark.createDataFrame([(g,) for g in ids], "game_id string")
    games = [r[0] for r in todo(wanted, manifest_frame(spark, manifest)).orderBy("game_id").collect()]
    if games:
        settle(spark, data_dir, season, season_type)
    for at in range(0, len(games), flush_every):
        batch = games[at : at + flush_every]
        missing = fetched(data_dir, batch, fetch)
        manifest["failed"] |= missing
        if present := [g for g in batch if g not in missing]:
            take_in(spark, data_dir, season, season_type, present, manifest)
        write_manifest(path, manifest)
    write_manifest(path, manifest)
    out = {"season": season, "season_type": season_type, "games_new": len(games), "games_processed": len(manifest["processed"]), "games_failed": len(manifest["failed"])}
    logger.info("%s", out)
    return out | {"failed": dict(manifest["failed"])}


def build_many(spark: SparkSession, data_dir: Path, seasons: list[str], season_types: list[str], **options) -> list[dict]:
    return [build_season(spark, data_dir, s, t, **options) for s in seasons for t in season_types]
