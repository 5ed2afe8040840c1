"""Stint tables and manifests on disk: one Parquet table and one JSON manifest per season and season type."""

from __future__ import annotations

import json
import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtside.functions.seasons import manifest_path, stints_path
from courtside.schema import MANIFEST, STINTS


def load_stints(spark: SparkSession, data_dir: Path, seasons: list[str], season_types: list[str]) -> DataFrame:
    """The union of the scopes' stints with season and season_type; FileNotFoundError that lists every missing scope."""
    scopes = [(s, t, stints_path(data_dir, s, t)) for s in seasons for t in season_types]
    if missing := [f"{s} {t}" for s, t, p in scopes if not p.exists()]:
        raise FileNotFoundError("no stints for " + ", ".join(missing))
    out = None
    for season, season_type, path in scopes:
        one = spark.read.parquet(str(path)).withColumns({"season": F.lit(season), "season_type": F.lit(season_type)})
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out


def load_partitioned(spark: SparkSession, path: str, seasons: list[str], season_types: list[str]) -> DataFrame:
    """Stints of one table partitioned by season and season_type; other partitions are pruned."""
    return spark.read.parquet(path).where(F.col("season").isin(seasons) & F.col("season_type").isin(season_types))


def write_partitioned(stints: DataFrame, path: str, mode: str = "append") -> None:
    stints.write.mode(mode).partitionBy("season", "season_type").parquet(path)


def empty_manifest() -> dict:
    return {"processed": {}, "failed": {}}


def read_manifest(path: Path) -> dict:
    return json.loads(Path(path).read_text()) if Path(path).exists() else empty_manifest()


def write_manifest(path: Path, manifest: dict) -> None:
    """Written beside its place and moved there, so that readers see the old or the new one."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    beside = path.with_suffix(".tmp")
    beside.write_text(json.dumps(manifest, sort_keys=True))
    os.replace(beside, path)


def manifest_frame(spark: SparkSession, manifest: dict) -> DataFrame:
    done = [(g, "processed", m["rows"], m["poss"], m["points"], m.get("warnings", []), None) for g, m in manifest["processed"].items()]
    failed = [(g, "failed", None, None, None, None, e) for g, e in manifest["failed"].items()]
    return spark.createDataFrame(done + failed, MANIFEST)


def processed_only(stints: DataFrame, manifest: DataFrame) -> DataFrame:
    """The stints of games that the manifest has as processed: rows of an interrupted run are left out."""
    return stints.join(manifest.where("status = 'processed'").select("game_id"), "game_id", "left_semi")


def stored_stints(spark: SparkSession, data_dir: Path, season: str, season_type: str) -> DataFrame:
    """What is stored and confirmed for a scope; empty where nothing is."""
    path = stints_path(data_dir, season, season_type)
    if not path.exists():
        return spark.createDataFrame([], STINTS)
    manifest = read_manifest(manifest_path(data_dir, season, season_type))
    return processed_only(spark.read.parquet(str(path)), manifest_frame(spark, manifest))


def settle(spark: SparkSession, data_dir: Path, season: str, season_type: str) -> None:
    """Leave a scope's table as a folder of confirmed rows, to which a run may append; it is rewritten only if it isn't one."""
    path = stints_path(data_dir, season, season_type)
    if not path.exists():
        return
    manifest = read_manifest(manifest_path(data_dir, season, season_type))
    stray = spark.read.parquet(str(path)).join(manifest_frame(spark, manifest).where("status = 'processed'").select("game_id"), "game_id", "left_anti")
    if path.is_file() or stray.limit(1).count():
        # what is read is what is replaced, so the rows are written beside it
        replace_stints(stored_stints(spark, data_dir, season, season_type), path)


def replace_stints(stints: DataFrame, path: Path) -> None:
    """Write a scope's table anew beside the old one and swap them; the old one may be among what is read."""
    import shutil

    path = Path(path)
    beside, old = path.with_name(path.name + ".new"), path.with_name(path.name + ".old")
    for p in (beside, old):
        shutil.rmtree(p, ignore_errors=True)
    stints.write.parquet(str(beside))
    if path.exists():
        os.replace(path, old)
    os.replace(beside, path)
    if old.is_dir():
        shutil.rmtree(old, ignore_errors=True)
    elif old.exists():
        old.unlink()
