"""Hold-out evaluation: game splits, scoring of stints, comparison of variants."""

from __future__ import annotations

import functools
from collections.abc import Callable
from contextlib import closing
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions.columns import per_100, player_ids
from courtside.operators.cube import TooLarge
from courtside.operators.interactions import FEATURES, fit_interaction_rapm, raw_features
from courtside.operators.rapm import Data, Prior, Ratings, fit_rapm

PriorFn = Callable[[DataFrame], Prior | None]


def holdout_games(stints: DataFrame, test_frac: float = 0.2, seed: int = 0) -> list[str]:
    """The held-out games: the first of a seeded shuffle of all game ids in order."""
    games = [r[0] for r in stints.select("game_id").distinct().orderBy("game_id").collect()]
    order = np.array(games, dtype=object)
    np.random.default_rng(seed).shuffle(order)
    return order[: max(1, int(len(order) * test_frac))].tolist()


def holdout_split(stints: DataFrame, test_frac: float = 0.2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    picked = stints.sparkSession.createDataFrame([(g,) for g in holdout_games(stints, test_frac, seed)], "game_id string")
    return stints.join(picked, "game_id", "left_anti"), stints.join(picked, "game_id", "left_semi")


#: Entries of each of the maps that coefficients are dealt over, about; a map lookup walks over its entries.
ENTRIES = 4


def side_sum(lineup: str, coefficients: str):
    """The sum over a lineup of what an array of maps has, dealt by player; players it doesn't have count 0."""
    own = lambda p: F.get(F.col(coefficients), F.pmod(p, F.size(coefficients)).cast("int"))
    return F.aggregate(player_ids(F.col(lineup)), F.lit(0.0), lambda a, p: a + F.coalesce(F.try_element_at(own(p), p), F.lit(0.0)))


def coefficient_row(spark, result: Ratings) -> DataFrame:
    """One row: the offence and the defence of players, each as an array of small maps."""
    p = result.players
    size = max(1, len(p) // ENTRIES)

    def dealt(column: str) -> list[dict[int, float]]:
        out: list[dict[int, float]] = [{} for _ in range(size)]
        for i, v in zip(p["player_id"].tolist(), p[column].tolist(), strict=True):
            out[i % size][int(i)] = float(v)
        return out

    return spark.createDataFrame([(dealt("orapm"), dealt("drapm"))], "_o array<map<bigint,double>>, _d array<map<bigint,double>>")


def predict_stints(result: Ratings, stints: DataFrame) -> DataFrame:
    """stints with ``predicted`` points per 100 possessions."""
    # one row, as many entries as there are players
    met = stints.crossJoin(F.broadcast(coefficient_row(stints.sparkSession, result)))
    value = F.lit(result.meta["intercept"]) + side_sum("off_lineup", "_o") - side_sum("def_lineup", "_d")
    inter = result.meta.get("interaction")
    if inter:
        talent = {int(k): (v[0], v[1]) for k, v in inter["talent"].items()}
        met = raw_features(met, talent)
        for k, (side, gammas) in enumerate((("off", "gamma_off"), ("def", "gamma_def"))):
            for a, name in enumerate(FEATURES):
                i = inter["info"][side][a]
                value = value + (F.col(f"f{3 * k + a}") - i["m"]) / i["s"] * inter[gammas][name]
    return met.withColumn("predicted", value).select(*stints.columns, "predicted")


def weighted_mse(scored: DataFrame, predicted: str = "predicted") -> float:
    y = per_100(F.col("points"), F.col("poss"))
    return scored.agg((F.sum(F.col("poss") * F.pow(y - F.col(predicted), 2)) / F.sum("poss")).alias("m")).first()["m"]


def intercept_only(train: DataFrame) -> float:
    row = train.where("poss > 0").agg(F.sum("points").alias("p"), F.sum("poss").alias("n")).first()
    return 100.0 * row["p"] / row["n"]


def scorable(test: DataFrame, score_garbage: bool = True) -> DataFrame:
    test = test.where("poss > 0")
    return test if score_garbage or "garbage" not in test.columns else test.where(~F.coalesce("garbage", F.lit(False)))


def matchup_points(test: DataFrame) -> DataFrame:
    """Scorable rows added up per matchup, which is all that a prediction depends on."""
    return test.groupBy("off_lineup", "def_lineup").agg(F.sum("poss").alias("poss"), F.sum("points").alias("points"), F.sum(F.col("points").cast("double") * F.col("points") / F.col("poss")).alias("points2"))


def matchup_mse(scored: DataFrame, predicted: str = "predicted") -> float:
    """weighted_mse of the rows behind matchup_points()."""
    f = F.col(predicted)
    return scored.agg((F.sum(1e4 * F.col("points2") - 200.0 * F.col("points") * f + F.col("poss") * f * f) / F.sum("poss")).alias("m")).first()["m"]


class Split:
    """One split of the games: its training rows and test matchups are stored, and the cube, the priors and the baseline, which
    no weight changes, are made once for all fits."""

    def __init__(self, stints: DataFrame, variants: dict[str, PriorFn | dict | None], test_frac: float = 0.2, seed: int = 0, score_garbage: bool = True) -> None:
        train, test = holdout_split(stints, test_frac, seed)
        self.train, self.test = train.persist(), matchup_points(scorable(test, score_garbage)).persist()
        self.variants = {name: spec if isinstance(spec, dict) else {"prior_fn": spec} for name, spec in variants.items()}
        self.data = functools.cache(self._data)
        self.prior = functools.cache(lambda name: self.variants[name]["prior_fn"](self.train) if self.variants[name].get("prior_fn") else None)
        self.base = functools.cache(lambda: matchup_mse(self.test.withColumn("predicted", F.lit(intercept_only(self.train)))))

    def _data(self) -> Data | None:
        """None where the players are too many for a cube: each fit then goes its own way."""
        try:
            return Data(self.train)
        except TooLarge:
            return None

    def close(self) -> None:
        self.train.unpersist()
        self.test.unpersist()

    def table(self, lam: float | str, **weights: float) -> pd.DataFrame:
        rows = [("intercept-only", float("nan"), self.base())]
        for name, spec in self.variants.items():
            fit = fit_interaction_rapm if spec.get("interactions") else fit_rapm
            result = fit(self.train, lam=lam, prior=self.prior(name), data=self.data(), **weights)
            rows.append((name, result.meta["lambda"], matchup_mse(predict_stints(result, self.test))))
        table = pd.DataFrame(rows, columns=["variant", "lambda", "holdout_mse"])
        table["vs_baseline"] = self.base() - table["holdout_mse"]
        return table


def evaluate_variants(stints: DataFrame, variants: dict[str, PriorFn | dict | None], lam: float | str = "cv", test_frac: float = 0.2, seed: int = 0, decay: float = 1.0, playoff_weight: float = 1.0, garbage_weight: float = 1.0, score_garbage: bool = True) -> pd.DataFrame:
    """One row per variant with its error on held-out games, after that of the training mean; vs_baseline is the gain on it.

    A variant is a function of the training rows that gives a prior, None, or {"prior_fn": ..., "interactions": bool}.
    """
    with closing(Split(stints, variants, test_frac, seed, score_garbage)) as split:
        return split.table(lam, decay=decay, playoff_weight=playoff_weight, garbage_weight=garbage_weight)


def evaluate_grid(stints: DataFrame, variants: dict, decays=(1.0,), garbage_weights=(1.0,), playoff_weights=(1.0,), lam: float | str = "cv", **options) -> pd.DataFrame:
    """evaluate_variants for every combination of weights, best first. All combinations share one split: its rows are read into
    a cube and its priors fitted once, and a combination without interaction terms is algebra on the driver and a scan of the
    test matchups."""
    tables = []
    with closing(Split(stints, variants, **options)) as split:
        for decay, garbage, playoff in product(decays, garbage_weights, playoff_weights):
            table = split.table(lam, decay=decay, garbage_weight=garbage, playoff_weight=playoff)
            table.insert(0, "decay", decay)
            table.insert(1, "garbage_weight", garbage)
            table.insert(2, "playoff_weight", playoff)
            tables.append(table)
    return pd.concat(tables, ignore_index=True).sort_values("holdout_mse", kind="stable", ignore_index=True)
