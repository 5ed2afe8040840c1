"""Sufficient statistics of the lineup regression, per stratum, from one aggregation.

A stint is a row of ten ones: five offence and five defence columns (column 2 * player, plus 1 for defence), with weight
poss and target 100 * points / poss. Its contributions to the normal equations are sums of possessions and points over
rows, pairs of columns and columns, all of them integers, so fits do not depend on the order of summation. Weight
multipliers, folds and hold-outs are strata: any fit is a linear recombination of them, without another scan.

Stints are read once: equal matchups are added up, and all other sums are made from that table, pairs before the shuffle. What
reaches the driver is a number per game and stratum and at most the squared number of players per stratum, whatever the number of
rows; ``MAX_PLAYERS`` and ``MAX_CELLS`` guard that, and operators/iterative.py solves what lies beyond.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.functions.columns import player_ids

#: Players, and pairs of columns over all strata, that the driver takes.
MAX_PLAYERS, MAX_CELLS = 4000, 64 << 20


class TooLarge(ValueError):
    """More players than dense systems on the driver are made for."""


@dataclass
class Stats:
    """The statistics of one set of rows; G, r, u over columns [offence of players..., defence of players...]."""

    players: np.ndarray
    G: np.ndarray
    r: np.ndarray
    u: np.ndarray
    s: float
    t: float
    q: float
    rows: int = 0

    @property
    def size(self) -> int:
        return len(self.players)


@dataclass
class Stratum:
    key: dict
    i: np.ndarray
    j: np.ndarray
    w: np.ndarray
    col: np.ndarray
    col_w: np.ndarray
    col_points: np.ndarray
    poss: int
    points: int
    points2: float
    rows: int
    dropped: int
    #: Hashes of the games with possessions.
    games: np.ndarray


def columns_of(off: str = "off_lineup", deff: str = "def_lineup"):
    """The ten columns of a stint, ascending."""
    return F.array_sort(F.concat(F.transform(player_ids(F.col(off)), lambda p: p * 2), F.transform(player_ids(F.col(deff)), lambda p: p * 2 + 1)))


def matchup_table(stints: DataFrame, strata: list[str]) -> DataFrame:
    """Stints added up per stratum and matchup, with their columns; w is 0 where there are only points without possessions."""
    has = F.col("poss") > 0
    added = stints.groupBy(*strata, "off_lineup", "def_lineup").agg(
        F.sum(F.when(has, F.col("poss")).otherwise(0)).alias("w"),
        F.sum(F.when(has, F.col("points")).otherwise(0)).alias("p"),
        F.sum(F.when(has, F.col("points").cast("double") * F.col("points") / F.nullif(F.col("poss"), F.lit(0))).otherwise(0.0)).alias("p2"),
        F.count_if(has).alias("n"),
        F.sum(F.when(~has, F.col("points")).otherwise(0)).alias("dropped"),
    )
    return added.withColumn("cols", columns_of())


def matchups(stints: DataFrame, strata: list[str]) -> DataFrame:
    """The matchups with possessions."""
    return matchup_table(stints.where("poss > 0"), strata)


def column_sums(rows: DataFrame, strata: list[str]) -> DataFrame:
    return rows.select(*strata, "w", "p", F.explode("cols").alias("i")).groupBy(*strata, "i").agg(F.sum("w").alias("w"), F.sum("p").alias("p"))


def pair_sums(rows: DataFrame, strata: list[str]) -> DataFrame:
    """Sums of possessions over pairs of columns i <= j."""
    first = rows.select(*strata, "w", "cols", F.posexplode("cols").alias("at", "i"))
    pairs = first.select(*strata, "w", "i", F.explode(F.expr("slice(cols, at + 1, size(cols) - at)")).alias("j"))
    return pairs.groupBy(*strata, "i", "j").agg(F.sum("w").alias("w"))


class Cube:
    """All strata, on the driver."""

    def __init__(self, stints: DataFrame, strata: list[str] = (), max_players: int = MAX_PLAYERS, max_cells: int = MAX_CELLS) -> None:
        self.strata = list(strata)
        keys = [F.col(c) for c in self.strata]
        table = matchup_table(stints, self.strata).persist()
        try:
            rows = table.where("n > 0")
            sums = column_sums(rows, self.strata)
            sizes = sums.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n").alias("most"), F.sum(F.col("n").cast("double") * F.col("n") / 2).alias("cells")).first()
            if (sizes["most"] or 0) > 2 * max_players or (sizes["cells"] or 0) > max_cells:
                raise TooLarge(f"more than {max_players} players or {max_cells} pairs of columns: use operators.iterative")
            by_col = self._frames(sums)
            by_pair = self._frames(pair_sums(rows, self.strata))
            scalars = table.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("w", "p", "p2", "n", "dropped")]).collect()
        finally:
            table.unpersist()
        by_game = self._frames(stints.where("poss > 0").select(*keys, F.xxhash64("game_id").alias("game")).distinct())
        no = np.empty(0, np.int64)
        self.parts: list[Stratum] = []
        for r in sorted(scalars, key=lambda r: tuple(str(r[c]) for c in self.strata)):
            key = tuple(r[c] for c in self.strata)
            if r["w"] is None:
                continue
            pick = lambda frames, *cols, key=key: [frames[key][c].to_numpy(dtype=np.int64) if key in frames else no for c in cols]
            self.parts.append(Stratum(dict(zip(self.strata, key, strict=True)), *pick(by_pair, "i", "j", "w"), *pick(by_col, "i", "w", "p"), r["w"], r["p"], r["p2"], r["n"], r["dropped"], *pick(by_game, "game")))

    def _frames(self, sums: DataFrame) -> dict[tuple, pd.DataFrame]:
        """The rows of each stratum; its null keys are None."""
        frame = sums.toPandas()
        if not self.strata:
            return {(): frame}
        groups = frame.astype(dict.fromkeys(self.strata, object)).groupby(self.strata, dropna=False, sort=False)
        return {tuple(None if x is None or x != x else x for x in k): g for k, g in groups}

    def players(self, use: Callable[[dict], float] = lambda k: 1.0) -> np.ndarray:
        """Sorted ids of the players of all strata that count."""
        cols = [p.col for p in self.parts if use(p.key) > 0]
        return np.unique(np.concatenate([*cols, np.empty(0, np.int64)]) // 2)

    def stats(self, use: Callable[[dict], float] = lambda k: 1.0, players: np.ndarray | None = None) -> Stats:
        """The statistics of the strata, each times use(key); columns of other players than the given ones are left out."""
        players = self.players(use) if players is None else players
        n = len(players)
        out = Stats(players, np.zeros((2 * n, 2 * n)), np.zeros(2 * n), np.zeros(2 * n), 0.0, 0.0, 0.0)

        def column(c: np.ndarray) -> np.ndarray:
            """The places of columns, -1 for those of other players."""
            at = np.minimum(np.searchsorted(players, c // 2), max(n - 1, 0))
            return np.where(players[at] == c // 2, at + n * (c % 2), -1) if n else np.full(len(c), -1)

        for part in self.parts:
            m = use(part.key)
            if m <= 0:
                continue
            # columns and pairs are distinct within a stratum
            c = column(part.col)
            ok = c >= 0
            out.u[c[ok]] += m * part.col_w[ok]
            out.r[c[ok]] += m * 100.0 * part.col_points[ok]
            i, j = column(part.i), column(part.j)
            ok = (i >= 0) & (j >= 0)
            i, j, w = i[ok], j[ok], m * part.w[ok]
            out.G[i, j] += w
            off = i != j
            out.G[j[off], i[off]] += w[off]
            out.s += m * part.poss
            out.t += m * 100.0 * part.points
            out.q += m * 1e4 * part.points2
            out.rows += part.rows
        return out

    def games(self, use: Callable[[dict], float] = lambda k: 1.0) -> int:
        """The games with possessions in the strata that count."""
        own = [p.games for p in self.parts if use(p.key) > 0]
        return len(np.unique(np.concatenate(own))) if own else 0

    def total(self, field: str, use: Callable[[dict], float] = lambda k: 1.0) -> int:
        return sum(getattr(p, field) for p in self.parts if use(p.key) > 0)
