"""An offline smoke test: invariants of a few built games and of a fit on them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from courtside.functions.columns import dashes
from courtside.operators.ingest import build_season
from courtside.operators.possessions import game_totals
from courtside.operators.rapm import fit_rapm
from courtside.sources.stints import load_stints

# Plausible sums of both teams in a game, and plausible league scoring in a handful of games.
GAME_POSSESSIONS, GAME_POINTS, LEAGUE = (150, 300), (120, 350), (60.0, 160.0)


def check_games(stints) -> list[str]:
    """What is wrong with built games; nothing if all is plausible."""
    problems = [f"{r['game_id']}: {r['poss']} possessions, {r['points']} points" for r in game_totals(stints).where(~F.col("poss").between(*GAME_POSSESSIONS) | ~F.col("points").between(*GAME_POINTS)).collect()]
    bad = stints.where((dashes(F.col("off_lineup")) != 4) | (dashes(F.col("def_lineup")) != 4)).count()
    return problems + ([f"{bad} rows without five players a side"] if bad else [])


def run_smoke_test(spark: SparkSession, data_dir: Path, season: str = "2023-24", regular_games: int = 3, playoff_games: int = 2, **options) -> list[str]:
    """Build a few games of each type from the cache, check them, fit them; the problems found."""
    problems = []
    for season_type, limit in (("Regular Season", regular_games), ("Playoffs", playoff_games)):
        report = build_season(spark, data_dir, season, season_type, game_limit=limit, **options)
        if report["games_failed"]:
            problems.append(f"{season_type}: {report['games_failed']} games failed")
    stints = load_stints(spark, data_dir, [season], ["Regular Season", "Playoffs"])
    problems += check_games(stints)
    result = fit_rapm(stints, lam=500.0)
    if not LEAGUE[0] <= result.meta["avg_points_per_100"] <= LEAGUE[1]:
        problems.append(f"{result.meta['avg_points_per_100']:.1f} points per 100 possessions")
    if result.players[["orapm", "drapm"]].isna().any().any():
        problems.append("ratings that are not numbers")
    return problems
