"""Seeded synthetic leagues for tests, benchmarks and trials."""

from __future__ import annotations

import json
from pathlib import Path

import numpy as np
import pandas as pd

PLAYERS = 60
BASE_RATE = 1.10


def make_league(seed: int = 7, players: int = PLAYERS) -> tuple[np.ndarray, np.ndarray]:
    """True offence and defence effects per possession."""
    rng = np.random.default_rng(seed)
    return rng.normal(0, 0.02, players), rng.normal(0, 0.015, players)


def simulate_stints(true_off: np.ndarray, true_def: np.ndarray, n_games: int = 400, stints_per_game: int = 25, seed: int = 1, prefix: str = "", garbage: float | None = None) -> pd.DataFrame:
    """Stint rows of random fives; defence effects lower what is scored. garbage is the share of garbage-time rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for g in range(n_games):
        for _ in range(stints_per_game):
            ten = rng.choice(len(true_off), 10, replace=False)
            off, deff = sorted(ten[:5] + 1), sorted(ten[5:] + 1)
            poss = int(rng.integers(2, 15))
            rate = BASE_RATE + true_off[ten[:5]].sum() - true_def[ten[5:]].sum()
            rows.append((f"{prefix}G{g:05d}", 1, 2, "-".join(map(str, off)), "-".join(map(str, deff)), poss, int(rng.poisson(max(rate, 0.05) * poss))))
    out = pd.DataFrame(rows, columns=["game_id", "off_team_id", "def_team_id", "off_lineup", "def_lineup", "poss", "points"])
    if garbage is not None:
        out.insert(5, "garbage", np.random.default_rng(seed + 1000).random(len(out)) < garbage)
    return out


def simulate_stars(n_games: int = 400, seed: int = 17, redundancy: float = 0.04) -> pd.DataFrame:
    """A league in which stars 1 and 2 lose value when they share the floor."""
    rng = np.random.default_rng(seed)
    off = rng.normal(0, 0.01, PLAYERS)
    off[:3] = (0.06, 0.055, 0.05)
    deff = rng.normal(0, 0.01, PLAYERS)
    rows = []
    for g in range(n_games):
        for _ in range(25):
            ten = rng.choice(np.arange(3, PLAYERS), 10, replace=False)
            u = rng.random()
            if u < 0.10:
                ten[:2] = (0, 1)
            elif u < 0.40:
                ten[0] = rng.integers(0, 3)
            poss = int(rng.integers(4, 15))
            rate = BASE_RATE + off[ten[:5]].sum() - deff[ten[5:]].sum() - redundancy * (u < 0.10)
            rows.append((f"G{g:05d}", 1, 2, "-".join(map(str, sorted(ten[:5] + 1))), "-".join(map(str, sorted(ten[5:] + 1))), poss, int(rng.poisson(max(rate, 0.05) * poss))))
    return pd.DataFrame(rows, columns=["game_id", "off_team_id", "def_team_id", "off_lineup", "def_lineup", "poss", "points"])


def write_scope(stints: pd.DataFrame, data_dir: Path, season: str, season_type: str) -> None:
    """A scope's stint table with a manifest that confirms its games."""
    from courtside.functions.seasons import manifest_path, stints_path

    path = stints_path(data_dir, season, season_type)
    path.parent.mkdir(parents=True, exist_ok=True)
    stints.to_parquet(path, index=False)
    totals = stints.groupby("game_id")[["poss", "points"]].sum()
    done = {g: {"rows": int((stints["game_id"] == g).sum()), "poss": int(r.poss), "points": int(r.points), "warnings": []} for g, r in totals.iterrows()}
    manifest_path(data_dir, season, season_type).write_text(json.dumps({"processed": done, "failed": {}}))
