"""Shrinkage targets: two-phase, previous season, and a statistical plus-minus learned from features."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtside.functions.seasons import end_year, season_name
from courtside.operators.features import load_features
from courtside.operators.rapm import Prior, as_prior, fit_rapm
from courtside.sources.results import spm_path
from courtside.sources.stints import load_stints

# Penalties of the plus-minus model and the fewest rows it is fitted on.
ALPHAS = (0.1, 1.0, 10.0, 100.0, 1000.0)
LEAST_ROWS = 50
KEYS = ("player_id", "season", "season_type")


@dataclass
class SpmModel:
    feature_cols: list[str]
    mean: list[float]
    std: list[float]
    coef_o: list[float]
    coef_d: list[float]
    intercept_o: float
    intercept_d: float
    alpha_o: float
    alpha_d: float

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> SpmModel:
        return cls(**json.loads(text))


def two_phase_prior(stints: DataFrame, lam: float | str = "cv", scale: float = 1.0) -> Prior:
    """The unweighted plain fit of the same rows, scaled."""
    return as_prior(fit_rapm(stints, lam=lam), scale)


def last_season_prior(spark: SparkSession, data_dir: Path, seasons: list[str], season_types: list[str], lam: float | str = "cv", scale: float = 0.7) -> Prior:
    """The fit of the season before the earliest one, scaled."""
    before = season_name(min(map(end_year, seasons)) - 1)
    return as_prior(fit_rapm(load_stints(spark, data_dir, [before], season_types), lam=lam), scale)


def clean(column):
    """NaN as null."""
    return F.when(~F.isnan(column), column)


def standardised(features: DataFrame, cols: list[str], mean: list[float], std: list[float]):
    """The z-scores of a row as an array; what is missing counts as the mean."""
    own = lambda c: F.col(f"`{c}`").cast("double") if c in features.columns else F.lit(None).cast("double")
    return F.array(*[F.coalesce((clean(own(c)) - m) / s, F.lit(0.0)) for c, m, s in zip(cols, mean, std, strict=True)])


def _leave_one_out(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, float, float]:
    """(coefficients, intercept, penalty) of the ridge fit with the least weighted leave-one-out error."""
    s = w.sum()
    mx, my = w @ x / s, w @ y / s
    xc, yc = x - mx, y - my
    a, b = xc.T @ (w[:, None] * xc), xc.T @ (w * yc)
    best = None
    for alpha in ALPHAS:
        inverse = np.linalg.inv(a + alpha * np.eye(len(b)))
        coef = inverse @ b
        h = w * (1 / s + np.einsum("ij,jk,ik->i", xc, inverse, xc))
        error = (w * ((yc - xc @ coef) / (1 - h)) ** 2).sum() / s
        if best is None or error < best[0]:
            best = (error, coef, float(my - mx @ coef), alpha)
    return best[1], best[2], best[3]


def fit_spm(features: DataFrame, targets: DataFrame, weighted: bool = True) -> SpmModel:
    """The plus-minus model of matched player rows; weights are minutes (at least one). Rows are player-seasons, so few."""
    keys = [c for c in KEYS if c in features.columns and c in targets.columns]
    cols = [f.name for f in features.schema if isinstance(f.dataType, T.NumericType) and f.name not in (*KEYS, "minutes")]
    met = features.join(targets.select(*keys, "orapm", "drapm"), keys, "inner").persist()
    n = met.count()
    if n < LEAST_ROWS:
        met.unpersist()
        raise ValueError(f"only {n} matched player rows; {LEAST_ROWS} are needed")
    own = {c: clean(F.col(f"`{c}`").cast("double")) for c in cols}
    row = met.agg(*[F.avg(v).alias(f"m{k}") for k, v in enumerate(own.values())], *[F.stddev_pop(v).alias(f"s{k}") for k, v in enumerate(own.values())]).first()
    mean = [row[f"m{k}"] if row[f"m{k}"] is not None else 0.0 for k in range(len(cols))]
    std = [row[f"s{k}"] or 1.0 for k in range(len(cols))]
    w = F.greatest(F.coalesce(clean(F.col("minutes").cast("double")), F.lit(1.0)), F.lit(1.0)) if weighted and "minutes" in met.columns else F.lit(1.0)
    pdf = met.orderBy(*keys).select(standardised(met, cols, mean, std).alias("x"), "orapm", "drapm", w.alias("w")).toPandas()
    met.unpersist()
    x, weight = np.array(pdf["x"].tolist()), pdf["w"].to_numpy()
    co, io, ao = _leave_one_out(x, pdf["orapm"].to_numpy(), weight)
    cd, id_, ad = _leave_one_out(x, pdf["drapm"].to_numpy(), weight)
    return SpmModel(cols, mean, std, co.tolist(), cd.tolist(), io, id_, ao, ad)


def predict_spm(model: SpmModel, features: DataFrame) -> DataFrame:
    """(player_id, o, d): predictions averaged over a player's rows by minutes (at least one)."""
    z = features.withColumn("_z", standardised(features, model.feature_cols, model.mean, model.std))
    dot = lambda coef, b: F.lit(b) + F.aggregate(F.zip_with("_z", F.array(*map(F.lit, coef)), lambda a, c: a * c), F.lit(0.0), lambda a, v: a + v)
    w = F.greatest(F.coalesce(clean(F.col("minutes").cast("double")), F.lit(1.0)), F.lit(1.0)) if "minutes" in features.columns else F.lit(1.0)
    rows = z.select("player_id", dot(model.coef_o, model.intercept_o).alias("o"), dot(model.coef_d, model.intercept_d).alias("d"), w.alias("w"))
    return rows.groupBy("player_id").agg((F.sum(F.col("o") * F.col("w")) / F.sum("w")).alias("o"), (F.sum(F.col("d") * F.col("w")) / F.sum("w")).alias("d"))


def collect_prior(table: DataFrame) -> Prior:
    return {r["player_id"]: (r["o"], r["d"]) for r in table.collect()}


def train_spm(spark: SparkSession, data_dir: Path, seasons: list[str], season_types: list[str], lam: float | str = "cv", garbage_weight: float = 1.0) -> Path:
    """Ratings of every season and type against their features; the model is stored as JSON."""
    targets = None
    for season in seasons:
        for season_type in season_types:
            fit = fit_rapm(load_stints(spark, data_dir, [season], [season_type]), lam=lam, garbage_weight=garbage_weight)
            one = fit.to_spark(spark).select("player_id", "orapm", "drapm", F.lit(season).alias("season"), F.lit(season_type).alias("season_type"))
            targets = one if targets is None else targets.unionByName(one)
    model = fit_spm(load_features(spark, data_dir, seasons, season_types), targets)
    path = spm_path(data_dir)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(model.to_json())
    return path


def spm_prior(spark: SparkSession, data_dir: Path, seasons: list[str], season_types: list[str]) -> Prior:
    path = spm_path(data_dir)
    if not path.exists():
        raise FileNotFoundError(f"no plus-minus model at {path}: run the spm-train command first")
    return collect_prior(predict_spm(SpmModel.from_json(path.read_text()), load_features(spark, data_dir, seasons, season_types)))
