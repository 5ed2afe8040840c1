"""Command line: build, rapm, tune, validate, features, spm-train, evaluate, smoke-test."""

from __future__ import annotations

import argparse
import functools
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from courtside.functions.seasons import default_data_dir, parse_season_types, parse_seasons
from courtside.operators.ingest import build_many
from courtside.operators.interactions import BOUNDS
from courtside.operators.scopes import PRIOR_KINDS
from courtside.sources.schedule import season_game_ids
from courtside.sources.web import League


def penalty(text: str) -> float | str:
    return text if text == "cv" else float(text)


def numbers(text: str) -> list[float]:
    return [float(x) for x in text.split(",") if x.strip()]


def session() -> SparkSession:
    return SparkSession.builder.appName("courtside").config("spark.sql.session.timeZone", "UTC").getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="courtside", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, seasons: str = "all") -> argparse.ArgumentParser:
        p = commands.add_parser(name)
        p.set_defaults(run=run)
        p.add_argument("--data-dir", type=Path, default=default_data_dir())
        p.add_argument("--seasons", type=parse_seasons, default=seasons)
        p.add_argument("--season-types", type=parse_season_types, default="regular,playoffs")
        p.add_argument("--online", action="store_true", help="ask the league's statistics API for what isn't cached")
        return p

    p = command("build", cmd_build)
    p.add_argument("--game-limit", type=int)
    p.add_argument("--refresh-schedule", action="store_true")
    p.add_argument("--retry-failed", action="store_true")

    p = command("rapm", cmd_rapm)
    p.add_argument("--pool", action="store_true")
    p.add_argument("--combine-types", action="store_true")
    p.add_argument("--lambda", dest="lam", type=penalty, default="cv")
    p.add_argument("--min-poss", type=float, default=0)
    p.add_argument("--no-names", action="store_true")
    p.add_argument("--out-dir", type=Path)
    p.add_argument("--prior", choices=PRIOR_KINDS, default="none")
    p.add_argument("--prior-scale", type=float, default=1.0)
    p.add_argument("--decay", type=float, default=1.0)
    p.add_argument("--playoff-weight", type=float, default=1.5)
    p.add_argument("--garbage-weight", type=float, default=1.0)
    p.add_argument("--interactions", action="store_true")
    p.add_argument("--offense-curvature", choices=sorted(BOUNDS["off"]), default="diminishing")
    p.add_argument("--defense-curvature", choices=sorted(BOUNDS["def"]), default="diminishing")
    p.add_argument("--tuned", action="store_true", help="take the model's flags from the stored tuned configuration")

    p = command("tune", cmd_tune, seasons="recent-3")
    p.add_argument("--lambda", dest="lam", type=penalty, default="cv")
    p.add_argument("--seeds", type=int, default=3)
    p.add_argument("--test-frac", type=float, default=0.2)
    p.add_argument("--passes", type=int, default=1)

    command("validate", cmd_validate)

    p = command("features", cmd_features)
    p.add_argument("--no-tracking", action="store_true")

    p = command("spm-train", cmd_spm_train)
    p.add_argument("--lambda", dest="lam", type=penalty, default="cv")
    p.add_argument("--garbage-weight", type=float, default=1.0)

    p = command("evaluate", cmd_evaluate)
    p.add_argument("--lambda", dest="lam", type=penalty, default="cv")
    p.add_argument("--two-phase-scales", type=numbers, default=[1.0])
    p.add_argument("--last-season-scales", type=numbers, default=[])
    p.add_argument("--spm", action="store_true")
    p.add_argument("--interactions", action="store_true")
    p.add_argument("--decays", type=numbers, default=[1.0])
    p.add_argument("--garbage-weights", type=numbers, default=[1.0])
    p.add_argument("--playoff-weights", type=numbers, default=[1.0])
    p.add_argument("--holdout-no-garbage", action="store_true")
    p.add_argument("--test-frac", type=float, default=0.2)
    p.add_argument("--seed", type=int, default=0)

    p = commands.add_parser("smoke-test")
    p.set_defaults(run=cmd_smoke)
    p.add_argument("--data-dir", type=Path, default=default_data_dir())
    p.add_argument("--season", default="2023-24")
    p.add_argument("--regular-games", type=int, default=3)
    p.add_argument("--playoff-games", type=int, default=2)
    return top


def league(a) -> League | None:
    return League() if a.online else None


def cmd_build(a, spark) -> int:
    web, options = league(a), {}
    if web:
        options = {"fetch": web.play_by_play, "game_ids": functools.partial(season_game_ids, fetch=web.schedule)}
    reports = build_many(spark, a.data_dir, a.seasons, a.season_types, game_limit=a.game_limit, refresh_schedule=a.refresh_schedule, retry_failed=a.retry_failed, **options)
    for r in reports:
        print(f"{r['season']} {r['season_type']}: {r['games_new']} new, {r['games_processed']} processed, {r['games_failed']} failed")
    failed = {g: e for r in reports for g, e in r["failed"].items()}
    if failed:
        print(f"{len(failed)} games are left out, among them:")
        for game, error in sorted(failed.items())[:5]:
            print(f"  {game}: {error}")
        print("their errors are in the manifests; --retry-failed tries them again")
    return 0


def cmd_rapm(a, spark) -> int:
    from courtside.operators.scopes import run_rapm
    from courtside.sources.results import read_tuned

    model = {"lam": a.lam, "prior_kind": a.prior, "prior_scale": a.prior_scale, "decay": a.decay, "playoff_weight": a.playoff_weight, "garbage_weight": a.garbage_weight, "interactions": a.interactions, "offense_curvature": a.offense_curvature, "defense_curvature": a.defense_curvature}
    if a.tuned:
        found = read_tuned(a.data_dir)
        model |= {k: found[k] for k in model if k in found} | {"lam": found["lambda"], "prior_kind": found["prior"]}
    for path in run_rapm(spark, a.data_dir, a.seasons, a.season_types, a.pool, a.combine_types, min_poss=a.min_poss, fetch_names=not a.no_names, out_dir=a.out_dir, fetch=web.names if (web := league(a)) else None, **model):
        print(path)
    return 0


def cmd_tune(a, spark) -> int:
    from courtside.operators.tune import tune

    out = tune(spark, a.data_dir, a.seasons, a.season_types, a.seeds, a.test_frac, a.passes, a.lam)
    print({k: v for k, v in out.items() if k != "history"})
    return 0


def cmd_validate(a, spark) -> int:
    from courtside.operators.validate import validate_many

    reports, ok = validate_many(spark, a.data_dir, a.seasons, a.season_types)
    for r in reports:
        print(f"{r['season']} {r['season_type']}: {'; '.join(r['problems']) or 'ok'}")
        for m in r.get("score_mismatches", [])[:5]:
            print(f"  {m}")
    return int(not ok)


def cmd_features(a, spark) -> int:
    from courtside.operators.features import build_season_features

    for season in a.seasons:
        for season_type in a.season_types:
            web = league(a)
            print(build_season_features(spark, a.data_dir, season, season_type, not a.no_tracking, fetch=web.features(season, season_type) if web else None))
    return 0


def cmd_spm_train(a, spark) -> int:
    from courtside.operators.priors import train_spm

    print(train_spm(spark, a.data_dir, a.seasons, a.season_types, a.lam, a.garbage_weight))
    return 0


def cmd_evaluate(a, spark) -> int:
    from courtside.operators.evaluate import evaluate_grid
    from courtside.operators.priors import last_season_prior, spm_prior, two_phase_prior
    from courtside.sources.results import spm_path
    from courtside.sources.stints import load_stints

    if a.spm and not spm_path(a.data_dir).exists():
        print("no plus-minus model: run spm-train first", file=sys.stderr)
        return 1
    stints = load_stints(spark, a.data_dir, a.seasons, a.season_types)
    variants: dict = {"plain": None}
    for s in a.two_phase_scales:
        variants[f"two-phase-{s:g}"] = lambda train, s=s: two_phase_prior(train, lam=a.lam, scale=s)
    for s in a.last_season_scales:
        variants[f"last-season-{s:g}"] = lambda train, s=s: last_season_prior(spark, a.data_dir, a.seasons, a.season_types, lam=a.lam, scale=s)
    if a.spm:
        variants["spm"] = lambda train: spm_prior(spark, a.data_dir, a.seasons, a.season_types)
    if a.interactions:
        variants["interactions"] = {"prior_fn": None, "interactions": True}
    table = evaluate_grid(stints, variants, a.decays, a.garbage_weights, a.playoff_weights, lam=a.lam, test_frac=a.test_frac, seed=a.seed, score_garbage=not a.holdout_no_garbage)
    print(table.to_string(index=False))
    return 0


def cmd_smoke(a, spark) -> int:
    from courtside.smoke import run_smoke_test

    problems = run_smoke_test(spark, a.data_dir, a.season, a.regular_games, a.playoff_games)
    print("\n".join(problems) or "ok")
    return int(bool(problems))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(args, session())
