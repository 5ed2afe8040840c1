"""Ridge fits for more players than a dense system on the driver holds: conjugate gradients on the matchup table.

Each step multiplies the normal matrix with a vector: the vector's entries meet the exploded columns in an equi-join (a
column is met by many matchups, which AQE splits), are added per matchup, and weighted sums go back to the columns.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.operators.cube import columns_of
from courtside.operators.weights import Knobs, with_multiplier


def fit_iterative(stints: DataFrame, lam: float, prior: dict[int, tuple[float, float]] | None = None, knobs: Knobs = Knobs(), tol: float = 1e-8, rounds: int = 500) -> tuple[DataFrame, float]:
    """((player_id, side, coefficient, poss), intercept) of the weighted ridge fit with penalty lam; side 1 is defence.

    What the driver holds are vectors with an entry for each player and side.
    """
    spark = stints.sparkSession
    weighted = with_multiplier(stints, knobs).where("poss > 0")
    m = F.col("weight_mult") if "weight_mult" in weighted.columns else F.lit(1.0)
    added = weighted.groupBy("off_lineup", "def_lineup").agg(F.sum(F.col("poss") * m).alias("w"), F.sum(F.col("points") * m).alias("p"), F.sum("poss").alias("n"))
    row = ["off_lineup", "def_lineup"]
    rows = added.withColumn("cols", columns_of()).persist()
    exploded = rows.select(*row, "w", F.explode("cols").alias("i")).persist()
    sums = rows.select("w", "p", "n", F.explode("cols").alias("i")).groupBy("i").agg(F.sum("w").alias("w"), F.sum("p").alias("p"), F.sum("n").alias("n")).orderBy("i").toPandas()
    total = rows.agg(F.sum("w").alias("s"), F.sum("p").alias("p")).first()
    s, t = float(total["s"]), 100.0 * float(total["p"])
    cols, u, r = sums["i"].to_numpy(), sums["w"].to_numpy(dtype=float), 100.0 * sums["p"].to_numpy(dtype=float)
    start = np.array([(-1 if c % 2 else 1) * (prior or {}).get(int(c) // 2, (0.0, 0.0))[c % 2] for c in cols.tolist()])

    def times(v: np.ndarray) -> np.ndarray:
        entries = spark.createDataFrame(list(zip(cols.tolist(), v.tolist(), strict=True)), "i long, v double")
        met = exploded.join(entries, "i").groupBy(*row, "w").agg(F.sum("v").alias("x"))
        back = exploded.select(*row, "i").join(met, row).groupBy("i").agg(F.sum(F.col("w") * F.col("x")).alias("y")).orderBy("i").toPandas()
        return back["y"].to_numpy() - u * (u @ v) / s + lam * v

    b = r - u * (t / s)
    if start.any():  # the distance from the prior is what is penalised
        b = b - (times(start) - lam * start)
    x, res = np.zeros(len(b)), b.copy()
    d, rr = res.copy(), float(res @ res)
    limit = (tol * np.sqrt(rr)) ** 2
    for _ in range(rounds):
        if rr <= limit:
            break
        ad = times(d)
        step = rr / float(d @ ad)
        x, res = x + step * d, res - step * ad
        new = float(res @ res)
        d, rr = res + new / rr * d, new
    rows.unpersist()
    exploded.unpersist()
    x = x + start
    out = [(int(c) // 2, int(c) % 2, float(v), int(n)) for c, v, n in zip(cols, x, sums["n"], strict=True)]
    return spark.createDataFrame(out, "player_id long, side int, coefficient double, poss long"), float((t - u @ x) / s)
