import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from courtside.operators import ridge
from courtside.operators.cube import Cube
from courtside.operators.evaluate import evaluate_variants, holdout_split, predict_stints
from courtside.operators.interactions import fit_interaction_rapm
from courtside.operators.iterative import fit_iterative
from courtside.operators.rapm import as_prior, cross_validate_lambda, fit_rapm
from courtside.operators.weights import Knobs, with_multiplier
from courtside.synthetic import make_league, simulate_stars, simulate_stints

OFF, DEF = make_league()


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(simulate_stints(OFF, DEF, 40)).persist()


@pytest.fixture(scope="module")
def scoped(spark):
    parts = []
    for season, kind, seed, prefix in (("2023-24", "Regular Season", 21, "A"), ("2024-25", "Regular Season", 22, "B"), ("2024-25", "Playoffs", 23, "C")):
        parts.append(simulate_stints(OFF, DEF, 15, seed=seed, prefix=prefix, garbage=0.1).assign(season=season, season_type=kind))
    return spark.createDataFrame(pd.concat(parts)).persist()


def direct(pdf, lam, weight=None):
    """The same regression, row by row."""
    pdf = pdf[pdf.poss > 0]
    ids = sorted({int(p) for c in ("off_lineup", "def_lineup") for l in pdf[c] for p in l.split("-")})
    x = np.zeros((len(pdf), 2 * len(ids)))
    for i, (o, d) in enumerate(zip(pdf.off_lineup, pdf.def_lineup)):
        x[i, [ids.index(int(p)) for p in o.split("-")]] = 1
        x[i, [len(ids) + ids.index(int(p)) for p in d.split("-")]] = 1
    w = pdf.poss.to_numpy(float) * (1 if weight is None else weight)
    y = 100 * pdf.points.to_numpy() / pdf.poss.to_numpy()
    xc, yc = x - w @ x / w.sum(), y - w @ y / w.sum()
    b = np.linalg.solve(xc.T @ (w[:, None] * xc) + lam * np.eye(x.shape[1]), xc.T @ (w * yc))
    return ids, b


def test_fit_equals_row_by_row_solution(small):
    got = fit_rapm(small, lam=500.0).players.sort_values("player_id")
    ids, b = direct(small.toPandas(), 500.0)
    assert got.player_id.tolist() == ids
    assert np.allclose(got.orapm, b[: len(ids)], atol=1e-8) and np.allclose(got.drapm, -b[len(ids) :], atol=1e-8)
    assert got.off_poss.sum() == 5 * small.agg(F.sum("poss")).first()[0]


def test_recovers_true_effects(spark):
    got = fit_rapm(spark.createDataFrame(simulate_stints(OFF, DEF, 1000)), lam=200.0)
    p = got.players.sort_values("player_id")
    assert np.corrcoef(p.orapm, OFF)[0, 1] > 0.85 and np.corrcoef(p.drapm, DEF)[0, 1] > 0.70
    assert 100 < got.meta["avg_points_per_100"] < 120
    assert (got.players.rapm.diff().dropna() <= 0).all()


def test_iterative_equals_direct(small):
    table, intercept = fit_iterative(small, 500.0)
    got = {(r.player_id, r.side): r.coefficient for r in table.collect()}
    fit = fit_rapm(small, lam=500.0)
    assert abs(intercept - fit.meta["intercept"]) < 1e-4
    for r in fit.players.itertuples():
        assert abs(got.get((r.player_id, 0), 0) - r.orapm) < 1e-4 and abs(got.get((r.player_id, 1), 0) + r.drapm) < 1e-4


def test_large_player_sets_take_the_iterative_way(small, scoped, monkeypatch):
    from courtside.operators import cube, rapm

    prior = {p: (0.02 * p, -0.01 * p) for p in range(1, 40)}
    options = {"lam": 500.0, "prior": prior, "decay": 0.9, "playoff_weight": 1.5, "garbage_weight": 0.5}
    want = fit_rapm(scoped, **options).players.set_index("player_id").sort_index()
    monkeypatch.setattr(rapm, "Cube", lambda *a: cube.Cube(*a, max_players=5))
    got = fit_rapm(scoped, **options)
    table = got.players.set_index("player_id").sort_index()
    assert np.allclose(table[["orapm", "drapm", "rapm"]], want[["orapm", "drapm", "rapm"]], atol=1e-4) and (table.off_poss == want.off_poss).all()
    assert got.meta["decay"] == 0.9 and (got.players.rapm.diff().dropna() <= 0).all()
    with pytest.raises(cube.TooLarge):
        fit_rapm(scoped)
    with pytest.raises(cube.TooLarge):
        cube.Cube(small, max_cells=10)


def test_orphans_zero_prior_and_universe(spark, small):
    orphan = spark.createDataFrame([("G00000", 1, 2, "901-902-903-904-905", "1-2-3-4-5", 0, 1)], small.schema)
    got = fit_rapm(small.unionByName(orphan), lam=1000.0)
    plain = fit_rapm(small, lam=1000.0)
    assert got.meta["dropped_orphan_points"] == 1 and not (got.players.player_id > 900).any()
    zero = fit_rapm(small, lam=1000.0, prior={int(p): (0.0, 0.0) for p in plain.players.player_id})
    assert np.allclose(zero.players.rapm, plain.players.rapm, atol=1e-6)
    strong = fit_rapm(small, lam=1e9, prior={1: (3.0, 2.0)}).players.set_index("player_id")
    assert abs(strong.orapm[1] - 3) < 0.01 and abs(strong.drapm[1] - 2) < 0.01


def test_cross_validation(spark, small):
    lam, table = cross_validate_lambda(small)
    assert len(table) == len(ridge.LAMBDA_GRID) and all(np.isfinite(t["cv_mse"]) for t in table) and lam in ridge.LAMBDA_GRID
    with pytest.raises(ValueError):
        cross_validate_lambda(small.where("game_id = 'G00000'"))
    assert fit_rapm(small).meta["cv"] == table


def test_multipliers_match_row_weights(scoped):
    knobs = Knobs(0.8, 1.5, 0.5)
    pdf = with_multiplier(scoped, knobs).toPandas()
    expected = 0.8 ** (pdf.season == "2023-24") * np.where(pdf.season_type == "Playoffs", 1.5, 1) * np.where(pdf.garbage, 0.5, 1)
    assert np.allclose(pdf.weight_mult, expected)
    got = fit_rapm(scoped, lam=500.0, decay=0.8, playoff_weight=1.5, garbage_weight=0.5).players.sort_values("player_id")
    ids, b = direct(pdf, 500.0, pdf[pdf.poss > 0].weight_mult.to_numpy())
    assert np.allclose(got.orapm, b[: len(ids)], atol=1e-6)
    raw = fit_rapm(scoped, lam=500.0).players.sort_values("player_id")
    assert got.off_poss.tolist() == raw.off_poss.tolist()


def test_weight_zero_is_a_filter(scoped):
    a = fit_rapm(scoped, lam=500.0, garbage_weight=0.0).players
    b = fit_rapm(scoped.where("not garbage"), lam=500.0).players
    assert a.player_id.tolist() == b.player_id.tolist() and np.allclose(a.rapm, b.rapm, atol=1e-6)


def test_single_type_and_missing_columns(scoped, small):
    only = scoped.where("season_type = 'Playoffs'")
    assert np.allclose(fit_rapm(only, lam=500.0, playoff_weight=2.0).players.rapm, fit_rapm(only, lam=500.0).players.rapm, atol=1e-9)
    for knob, column in (("decay", "season"), ("playoff_weight", "season_type"), ("garbage_weight", "garbage")):
        with pytest.raises(ValueError, match=column):
            fit_rapm(small, lam=500.0, **{knob: 0.5})


def test_cube_recombines(scoped):
    cube = Cube(scoped, ["season", "season_type", "garbage"])
    whole = Cube(scoped.drop("season", "season_type", "garbage"))
    a, b = cube.stats(), whole.stats()
    assert np.array_equal(a.G, b.G) and np.array_equal(a.r, b.r) and abs(a.q - b.q) < 1e-6 * b.q
    beta, b0 = ridge.solve(a, 500.0)
    assert np.abs((a.G - np.outer(a.u, a.u) / a.s) @ beta + 500 * beta - (a.r - a.u * a.t / a.s)).max() < 1e-6


def test_bounded_least_squares_meets_its_conditions():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, y = rng.normal(size=(40, 6)), rng.normal(size=40)
        low, high = np.array([-np.inf] * 3 + [0.0] * 3), np.array([0.0] * 3 + [np.inf] * 3)
        d, h = a.T @ a, a.T @ y
        x = ridge.bounded_least_squares(d, h, low, high)
        g = d @ x - h
        assert (x[:3] <= 0).all() and (x[3:] >= 0).all()
        assert np.abs(g[np.abs(x) > 1e-9]).max(initial=0) < 1e-8
        assert (g[:3][x[:3] == 0] <= 1e-8).all() and (g[3:][x[3:] == 0] >= -1e-8).all()


def test_interactions(spark):
    stints = spark.createDataFrame(simulate_stars(150, 23)).persist()
    fit = fit_interaction_rapm(stints, lam=500.0)
    inter = fit.meta["interaction"]
    assert all(v <= 0 for v in inter["gamma_off"].values()) and all(v >= 0 for v in inter["gamma_def"].values())
    train, test = holdout_split(stints, 0.2, 0)
    table = evaluate_variants(stints, {"plain": None, "inter": {"interactions": True}}, lam=500.0).set_index("variant")
    assert table.holdout_mse["inter"] <= 1.02 * table.holdout_mse["plain"]
    off = fit_interaction_rapm(stints, lam=500.0, offense_curvature="none", defense_curvature="none").meta["interaction"]
    assert max(map(abs, [*off["gamma_off"].values(), *off["gamma_def"].values()])) <= 1e-12
    with pytest.raises(ValueError, match="curvature"):
        fit_interaction_rapm(stints, lam=500.0, offense_curvature="odd")


def test_holdout_and_prediction(spark, small):
    train, test = holdout_split(small, 0.2, 3)
    a, b = ({r[0] for r in t.select("game_id").distinct().collect()} for t in (train, test))
    assert not a & b and len(b) == 8 and len(a | b) == 40
    unseen = spark.createDataFrame([("X", 1, 2, "901-902-903-904-905", "1-2-3-4-5", 3, 1)], small.schema)
    fit = fit_rapm(small, lam=500.0)
    got = predict_stints(fit, unseen).first()["predicted"]
    d = fit.players.set_index("player_id").drapm
    assert abs(got - (fit.meta["intercept"] - sum(d[p] for p in range(1, 6)))) < 1e-9


def test_truth_prior_wins(spark):
    stints = spark.createDataFrame(simulate_stints(OFF, DEF, 120, seed=4))
    truth = {i + 1: (100 * OFF[i], 100 * DEF[i]) for i in range(len(OFF))}
    table = evaluate_variants(stints, {"plain": None, "truth": lambda train: truth}, lam=2000.0).set_index("variant")
    assert table.holdout_mse["truth"] < table.holdout_mse["plain"] < table.holdout_mse["intercept-only"] * 1.02
    assert abs(table.vs_baseline["intercept-only"]) < 1e-12
    assert as_prior(fit_rapm(stints, lam=500.0), 0.5)


def test_spm_fit_predicts_every_player_of_the_features(spark):
    from courtside.plans import queries

    d = "/root/testdata/sf0.01"
    keys = {r[0] for t, k in (("customer", "c_custkey"), ("part", "p_partkey"), ("supplier", "s_suppkey")) for r in spark.read.parquet(f"{d}/{t}.parquet").select(k).collect()}
    got = [r.player_id for r in queries.spm_fit(spark, d).collect()]
    assert len(got) == len(set(got)) and set(got) == keys


def test_last_season_and_grid_use_all_seasons(spark, monkeypatch, scoped):
    from courtside.plans import queries

    earlier = scoped.unionByName(scoped.where("season = '2023-24'").withColumns({"season": F.lit("2020-21"), "game_id": F.concat(F.lit("D"), "game_id")}))
    monkeypatch.setattr(queries, "stints", lambda spark, d: earlier)
    got = queries.rapm_last_season(spark, "").toPandas()
    assert set(got["season"]) == {"2024-25"}
    want = fit_rapm(earlier.where("season = '2024-25'"), lam=500.0, prior=as_prior(fit_rapm(earlier.where("season = '2023-24'"), lam=500.0), 0.7)).players
    np.testing.assert_allclose(got["rapm"], want["rapm"], atol=1e-6)
    grid = queries.evaluate_grid(spark, "").toPandas()
    assert len(grid) == 2 * 2 * 2 * 4 and set(grid["variant"]) == {"intercept-only", "plain", "two-phase", "interactions"}
    base = evaluate_variants(earlier, {}, lam=500.0)["holdout_mse"].iloc[0]
    np.testing.assert_allclose(grid.loc[grid["variant"] == "intercept-only", "holdout_mse"], base)


def test_tune_search_runs_the_whole_descent(spark, monkeypatch, scoped):
    from courtside.operators import tune
    from courtside.plans import queries

    seeds, tried = [], []
    monkeypatch.setattr(queries, "stints", lambda spark, d: scoped)
    monkeypatch.setattr(tune.Search, "_score", lambda self, c, seed: (seeds.append(seed), tried.append(c), 10.0 - (c["decay"] == 0.9) - bool(c["interactions"]))[2])
    got = queries.tune_search(spark, "").toPandas()
    assert set(seeds) == {0, 1, 2} and {"baseline", "garbage_weight", "decay", "playoff_weight", "prior", "interactions"} == set(got["coordinate"])
    assert all(c["decay"] == 0.9 for c in tried if c["interactions"]) and got["mse"].min() == 8.0


def test_grid_shares_cube_and_priors(monkeypatch, scoped):
    from courtside.operators.evaluate import evaluate_grid, scorable, weighted_mse

    made, own = [], Cube.__init__
    monkeypatch.setattr(Cube, "__init__", lambda self, *a, **b: (made.append(1), own(self, *a, **b))[1])
    variants = {"plain": None, "two-phase": lambda t: as_prior(fit_rapm(t, lam=500.0)), "interactions": {"interactions": True}}
    grid = evaluate_grid(scoped, variants, garbage_weights=(1.0, 0.5), lam=500.0)
    assert len(made) == 2  # one for all fits, one for the prior
    train, test = holdout_split(scoped, 0.2, 0)
    prior = as_prior(fit_rapm(train, lam=500.0))
    for garbage in (1.0, 0.5):
        got = grid[grid["garbage_weight"] == garbage].set_index("variant")["holdout_mse"]
        options = {"lam": 500.0, "garbage_weight": garbage}
        for name, fit in (("plain", fit_rapm(train, **options)), ("two-phase", fit_rapm(train, prior=prior, **options)), ("interactions", fit_interaction_rapm(train, **options))):
            np.testing.assert_allclose(got[name], weighted_mse(predict_stints(fit, scorable(test))), rtol=1e-9)
