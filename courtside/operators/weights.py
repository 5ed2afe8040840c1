"""Row weight multipliers and row filters of a fit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions.seasons import REGULAR, end_year, end_year_col


@dataclass(frozen=True)
class Knobs:
    """How much rows count: older seasons, play-offs, garbage time."""

    decay: float = 1.0
    playoff_weight: float = 1.0
    garbage_weight: float = 1.0

    def needs(self) -> list[str]:
        return [c for c, v in (("season", self.decay), ("season_type", self.playoff_weight), ("garbage", self.garbage_weight)) if v != 1.0]

    def check(self, columns: list[str]) -> None:
        for c in self.needs():
            if c not in columns:
                raise ValueError(f"weighting needs a {c!r} column in the stints")

    def multiplier(self, season: str | None, season_type: str | None, garbage: bool | None, last_year: int, several_types: bool) -> float:
        m = 1.0
        if self.decay != 1.0:
            m *= self.decay ** (last_year - end_year(season))
        if self.playoff_weight != 1.0 and several_types and season_type != REGULAR:
            m *= self.playoff_weight
        if self.garbage_weight != 1.0 and garbage:
            m *= self.garbage_weight
        return m


def with_multiplier(stints: DataFrame, knobs: Knobs) -> DataFrame:
    """stints with weight_mult, without the rows whose multiplier is 0; unchanged where no knob is set."""
    knobs.check(stints.columns)
    if not knobs.needs():
        return stints
    m = F.lit(1.0)
    scalars = []
    if knobs.decay != 1.0:
        scalars.append(F.max(end_year_col(F.col("season"))).alias("_last"))
        m = m * F.pow(F.lit(knobs.decay), F.col("_last") - end_year_col(F.col("season")))
    if knobs.playoff_weight != 1.0:
        scalars.append((F.count_distinct("season_type") > 1).alias("_several"))
        m = m * F.when(F.col("_several") & (F.col("season_type") != REGULAR), knobs.playoff_weight).otherwise(1.0)
    if knobs.garbage_weight != 1.0:
        m = m * F.when(F.coalesce(F.col("garbage"), F.lit(False)), knobs.garbage_weight).otherwise(1.0)
    out = stints.crossJoin(F.broadcast(stints.agg(*scalars))) if scalars else stints  # one row of two scalars
    return out.withColumn("weight_mult", m).drop("_last", "_several").where("weight_mult > 0")
