"""Player ratings: offence and defence impact per 100 possessions by ridge regression on stints.

Order of work: weight multipliers, dropping of zero-weight and zero-possession rows, player universe, prior, penalty by
cross-validation, solve, adding the prior back, flipping defence so that positive is good.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from courtside.functions.seasons import end_year
from courtside.operators import ridge
from courtside.operators.cube import Cube, Stats, TooLarge
from courtside.operators.iterative import fit_iterative
from courtside.operators.weights import Knobs
from courtside.schema import PLAYERS

Prior = dict[int, tuple[float, float]]
SCOPE = ("season", "season_type", "garbage")


@dataclass
class Ratings:
    """players: one row per player, best first; meta: how the fit was made."""

    players: pd.DataFrame
    meta: dict = field(default_factory=dict)

    def to_spark(self, spark) -> DataFrame:
        return spark.createDataFrame(self.players[PLAYERS.fieldNames()], PLAYERS)


def scope_columns(stints: DataFrame) -> list[str]:
    return [c for c in SCOPE if c in stints.columns]


def fold_of_game(stints: DataFrame, folds: int) -> DataFrame:
    """(game_id, fold): games by falling number of rows, dealt to and fro over the folds."""
    sizes = stints.where("poss > 0").groupBy("game_id").agg(F.count("*").alias("n"))
    rn = F.row_number().over(Window.orderBy(F.desc("n"), "game_id")) - 1  # one row per game
    k = F.lit(folds)
    return sizes.withColumn("rn", rn).select("game_id", F.when(F.floor(F.col("rn") / k) % 2 == 0, F.col("rn") % k).otherwise(k - 1 - F.col("rn") % k).cast("int").alias("fold"))


class Data:
    """The statistics of a stint table, by scope and, where wanted, by fold; every fit on it is algebra on the driver."""

    def __init__(self, stints: DataFrame, by: list[str] = ()) -> None:
        self.stints = stints
        self.columns = stints.columns
        self.scope = scope_columns(stints)
        self.cube = Cube(stints, [*self.scope, *by])

    def use(self, knobs: Knobs, keep=lambda key: True):
        """The multiplier of a stratum under the knobs, 0 where keep says no."""
        knobs.check(self.columns)
        own = [p.key for p in self.cube.parts if keep(p.key)]
        last = max((end_year(k["season"]) for k in own if k.get("season")), default=0)
        several = len({k.get("season_type") for k in own}) > 1
        return lambda key: knobs.multiplier(key.get("season"), key.get("season_type"), key.get("garbage"), last, several) if keep(key) else 0.0


def prior_vector(players: np.ndarray, prior: Prior | None) -> np.ndarray:
    """Over offence and defence columns; defence columns measure points allowed, so its sign is turned."""
    out = np.zeros(2 * len(players))
    for k, p in enumerate(players.tolist()):
        if prior and p in prior:
            out[k], out[len(players) + k] = prior[p][0], -prior[p][1]
    return out


def rated(st: Stats, raw_u: np.ndarray, beta: np.ndarray) -> pd.DataFrame:
    n = st.size
    table = pd.DataFrame({"player_id": st.players.astype(np.int64), "orapm": beta[:n], "drapm": -beta[n:], "rapm": beta[:n] - beta[n:], "off_poss": raw_u[:n].astype(np.int64), "def_poss": raw_u[n:].astype(np.int64)})
    return table.sort_values(["rapm", "player_id"], ascending=[False, True], ignore_index=True)


def cv_folds(stints: DataFrame, knobs: Knobs, n_folds: int) -> list[Stats]:
    """The statistics of every fold, over the players of all of them."""
    games = kept_rows(stints, knobs).where("poss > 0").select("game_id").distinct().count()
    folds = min(n_folds, games)
    if folds < 2:
        raise ValueError("cross-validation needs at least 2 games")
    data = Data(stints.join(F.broadcast(fold_of_game(kept_rows(stints, knobs), folds)), "game_id"), ["fold"])
    use = data.use(knobs)
    players = data.cube.players(use)
    return [data.cube.stats(lambda k, f=f: use(k) if k["fold"] == f else 0.0, players) for f in range(folds)]


def kept_rows(stints: DataFrame, knobs: Knobs) -> DataFrame:
    knobs.check(stints.columns)
    return stints.where(~F.coalesce(F.col("garbage"), F.lit(False))) if knobs.garbage_weight == 0 else stints


def cross_validate_lambda(stints: DataFrame, lambdas=ridge.LAMBDA_GRID, n_folds: int = 5, prior: Prior | None = None, knobs: Knobs = Knobs()) -> tuple[float, list[dict]]:
    folds = cv_folds(stints, knobs, n_folds)
    return ridge.cross_validate(folds, lambdas, prior_vector(folds[0].players, prior))


def fit_rapm(stints: DataFrame, lam: float | str = "cv", lambdas=ridge.LAMBDA_GRID, n_folds: int = 5, prior: Prior | None = None, decay: float = 1.0, playoff_weight: float = 1.0, garbage_weight: float = 1.0, data: Data | None = None, keep=lambda key: True) -> Ratings:
    """Ratings of the players in stints; lam is a penalty or 'cv'. data and keep fit on some strata of a ready cube."""
    knobs = Knobs(decay, playoff_weight, garbage_weight)
    if data is None:
        try:
            data = Data(stints)
        except TooLarge:
            if lam == "cv":
                raise
            return fit_large(stints, float(lam), prior, knobs)
    use = data.use(knobs, keep)
    st = data.cube.stats(use)
    raw = data.cube.stats(lambda k: 1.0 if use(k) > 0 else 0.0, st.players)
    p = prior_vector(st.players, prior)
    table = None
    if lam == "cv":
        lam, table = cross_validate_lambda(stints, lambdas, n_folds, prior, knobs)
    beta, intercept = ridge.solve(st, float(lam), p)
    meta = {
        "lambda": float(lam),
        "cv": table,
        "n_stint_rows": int(st.rows),
        "n_players": int(st.size),
        "n_games": data.cube.games(use),
        "total_possessions": float(st.s),
        "raw_possessions": float(raw.s),
        "avg_points_per_100": float(st.t / st.s),
        "intercept": intercept,
        "dropped_orphan_points": int(data.cube.total("dropped", use)),
        "prior": "custom" if prior else None,
        "decay": decay,
        "playoff_weight": playoff_weight,
        "garbage_weight": garbage_weight,
    }
    return Ratings(rated(st, raw.u, beta), meta)


def fit_large(stints: DataFrame, lam: float, prior: Prior | None, knobs: Knobs) -> Ratings:
    """Ratings by conjugate gradients, for more players than a dense system is made for."""
    table, intercept = fit_iterative(stints, lam, prior, knobs)
    side = lambda k, c: F.coalesce(F.max(F.when(F.col("side") == k, F.col(c))), F.lit(0))
    wide = table.groupBy("player_id").agg(side(0, "coefficient").alias("orapm"), (-side(1, "coefficient")).alias("drapm"), side(0, "poss").alias("off_poss"), side(1, "poss").alias("def_poss")).toPandas()
    wide["rapm"] = wide["orapm"] + wide["drapm"]
    players = wide[PLAYERS.fieldNames()].sort_values(["rapm", "player_id"], ascending=[False, True], ignore_index=True)
    return Ratings(players, {"lambda": lam, "cv": None, "n_players": len(players), "intercept": intercept, "prior": "custom" if prior else None, **asdict(knobs)})


def as_prior(ratings: Ratings, scale: float = 1.0) -> Prior:
    return {int(i): (scale * float(o), scale * float(d)) for i, o, d in zip(ratings.players["player_id"], ratings.players["orapm"], ratings.players["drapm"], strict=True)}
