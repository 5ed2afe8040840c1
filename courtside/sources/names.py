"""Player names: a cached id list, refreshed when ids are missing and the cache is old."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_AGE_DAYS = 7


def names_path(data_dir: Path) -> Path:
    return Path(data_dir) / "raw" / "commonallplayers.json"


def _parse(payload: dict) -> dict[int, str]:
    s = payload["resultSets"][0]
    at = {h: i for i, h in enumerate(s["headers"])}
    return {int(r[at["PERSON_ID"]]): r[at["DISPLAY_FIRST_LAST"]] for r in s["rowSet"]}


def player_names(data_dir: Path, ids: Iterable[int], season: str | None = None, fetch: Callable[[str | None], dict] | None = None) -> dict[int, str]:
    """A name for every id: from the cache, a fetch (only if ids are missing and the cache is absent or old), or 'Player <id>'."""
    path, ids = names_path(data_dir), [int(i) for i in ids]
    known = _parse(json.loads(path.read_text())) if path.exists() else {}
    old = not path.exists() or time.time() - path.stat().st_mtime > MAX_AGE_DAYS * 86400
    if fetch is not None and old and set(ids) - set(known):
        payload = fetch(season)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(payload))
        known = _parse(payload)
    return {i: known.get(i, f"Player {i}") for i in ids}


def with_names(players: DataFrame, names: DataFrame) -> DataFrame:
    """players with player_name from names(player_id, name), second column."""
    rest = [c for c in players.columns if c != "player_id"]
    return players.join(names, "player_id", "left").select("player_id", F.coalesce("name", F.concat(F.lit("Player "), F.col("player_id").cast("string"))).alias("player_name"), *rest)
