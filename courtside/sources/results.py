"""Result files: ratings as CSV, how they were made as JSON, tuned configurations and plus-minus models."""

from __future__ import annotations

import json
from pathlib import Path

import pandas as pd

from courtside.functions.seasons import results_dir, type_slug

# The keys of a tuned configuration with their defaults.
TUNED_KEYS = {"lambda": None, "garbage_weight": 1.0, "decay": 1.0, "playoff_weight": 1.0, "prior": "none", "prior_scale": 1.0, "interactions": False, "defense_curvature": "diminishing", "offense_curvature": "diminishing"}


def result_name(seasons: list[str], season_types: list[str], prior: str = "none", interactions: bool = False) -> str:
    span = seasons[0] if len(seasons) == 1 else f"{seasons[0]}_to_{seasons[-1]}"
    parts = ["rapm", span.replace("-", "_"), *map(type_slug, season_types)]
    if prior != "none":
        parts.append(prior.replace("-", ""))
    if interactions:
        parts.append("interactions")
    return "_".join(parts)


def write_result(out_dir: Path, name: str, players: pd.DataFrame, meta: dict) -> Path:
    """The CSV (three decimals, rounded as C does) and the JSON beside it; results are one row per player."""
    out_dir = Path(out_dir)
    out_dir.mkdir(parents=True, exist_ok=True)
    path = out_dir / f"{name}.csv"
    players.to_csv(path, index=False, float_format="%.3f")
    (out_dir / f"{name}.meta.json").write_text(json.dumps(meta, indent=1))
    return path


def tuned_path(data_dir: Path) -> Path:
    return results_dir(data_dir) / "tuned_config.json"


def write_tuned(data_dir: Path, config: dict) -> Path:
    path = tuned_path(data_dir)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(config, indent=1))
    return path


def read_tuned(data_dir: Path) -> dict:
    path = tuned_path(data_dir)
    if not path.exists():
        raise FileNotFoundError(f"no tuned configuration at {path}: run the tune command first")
    found = json.loads(path.read_text())
    return {k: found[k] for k in TUNED_KEYS}


def spm_path(data_dir: Path) -> Path:
    return results_dir(data_dir) / "spm_model.json"
