"""Ridge solves on sufficient statistics: unpenalised intercept, priors, cross-validation, bounded least squares."""

from __future__ import annotations

from itertools import product

import numpy as np

from courtside.operators.cube import Stats

# The grid of penalties.
LAMBDA_GRID = (25, 50, 100, 250, 500, 1000, 2500, 5000, 10000)


def solve(st: Stats, lam: float, prior: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) that minimise the weighted squared error plus lam * |beta - prior|^2."""
    p = np.zeros(len(st.u)) if prior is None else prior
    r, t = st.r - st.G @ p, st.t - st.u @ p
    a = st.G - np.outer(st.u, st.u) / st.s
    b = r - st.u * (t / st.s)
    delta = np.linalg.solve(a + lam * np.eye(len(b)), b) if lam > 0 else np.linalg.lstsq(a, b, rcond=None)[0]
    return delta + p, float((t - st.u @ delta) / st.s)


def mse(st: Stats, beta: np.ndarray, intercept: float) -> float:
    """The weighted mean squared error of a fit on the rows of st."""
    return float((st.q - 2 * intercept * st.t - 2 * beta @ st.r + intercept**2 * st.s + 2 * intercept * (st.u @ beta) + beta @ st.G @ beta) / st.s)


def subtract(a: Stats, b: Stats) -> Stats:
    return Stats(a.players, a.G - b.G, a.r - b.r, a.u - b.u, a.s - b.s, a.t - b.t, a.q - b.q, a.rows - b.rows)


def cross_validate(folds: list[Stats], lambdas=LAMBDA_GRID, prior: np.ndarray | None = None) -> tuple[float, list[dict]]:
    """(best penalty, table of mean fold errors); of equal errors the earlier penalty wins."""
    whole = Stats(folds[0].players, sum(f.G for f in folds), sum(f.r for f in folds), sum(f.u for f in folds), sum(f.s for f in folds), sum(f.t for f in folds), sum(f.q for f in folds))
    train = [subtract(whole, f) for f in folds]
    table = []
    for lam in lambdas:
        errors = [mse(f, *solve(tr, float(lam), prior)) for tr, f in zip(train, folds, strict=True)]
        table.append({"lambda": float(lam), "cv_mse": float(np.mean(errors))})
    return min(table, key=lambda x: x["cv_mse"])["lambda"], table


def bounded_least_squares(D: np.ndarray, h: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The x within bounds that minimises x'Dx/2 - h'x, by trying every set of active bounds of these few variables."""
    n, best, value = len(h), np.clip(np.zeros(len(h)), low, high), None
    options = [[None, *{b for b in (lo, hi) if np.isfinite(b)}] for lo, hi in zip(low, high, strict=True)]
    for choice in product(*options):
        free = [k for k in range(n) if choice[k] is None]
        x = np.array([0.0 if c is None else c for c in choice])
        if free:
            fixed = [k for k in range(n) if k not in free]
            rhs = h[free] - D[np.ix_(free, fixed)] @ x[fixed]
            x[free] = np.linalg.lstsq(D[np.ix_(free, free)], rhs, rcond=None)[0]
        if (x < low - 1e-9).any() or (x > high + 1e-9).any():
            continue
        v = x @ D @ x / 2 - h @ x
        if value is None or v < value - 1e-12 * max(1.0, abs(value)):
            best, value = np.clip(x, low, high), v
    return best
