"""DuckDB statements that solve the normal equations of lineup regressions, by conjugate gradients in a recursive query."""

from __future__ import annotations

from courtside.plans.driver import STINTS_SQL

_COLUMNS = "list_concat(list_transform(string_split(off_lineup, '-'), lambda x: CAST(x AS BIGINT) * 2), list_transform(string_split(def_lineup, '-'), lambda x: CAST(x AS BIGINT) * 2 + 1))"


def rows(multiplier: str = "1.0", key: str = "''", where: str = "true") -> str:
    """The CTE of the regression's rows: weight, weighted target and columns, by system."""
    return f"""obs AS (
  SELECT row_number() OVER () AS rn, {key} AS key, poss, points, poss * CAST({multiplier} AS DOUBLE) AS w, 100.0 * points * CAST({multiplier} AS DOUBLE) AS wy, {_COLUMNS} AS c
  FROM stints WHERE poss > 0 AND {multiplier} > 0 AND {where}
)"""


#: From obs to the normal equations of every key, with an unpenalised intercept eliminated.
SYSTEM = """
one AS (SELECT key, rn, poss, w, wy, unnest(c) AS i FROM obs),
tot AS (SELECT key, sum(w) AS s, sum(wy) AS t FROM obs GROUP BY key),
col AS (SELECT key, i, sum(w) AS u, sum(wy) AS r, sum(poss) AS raw FROM one GROUP BY ALL),
pair AS (SELECT a.key, a.i, b.i AS j, sum(a.w) AS g FROM one a JOIN one b ON a.key = b.key AND a.rn = b.rn GROUP BY ALL),
entry AS (
  SELECT x.key, x.i, y.i AS j, coalesce(g, 0) - x.u * y.u / s AS a FROM col x JOIN col y ON x.key = y.key JOIN tot ON tot.key = x.key
  LEFT JOIN pair p ON p.key = x.key AND p.i = x.i AND p.j = y.i
)"""


def matrix(lams: str = "500.0") -> str:
    """The CTEs of the matrix for every key and penalty, and of the plain right-hand side."""
    values = ", ".join(f"({x})" for x in lams.split(","))
    return f"""
pen(lam) AS (VALUES {values}),
sys AS (
  SELECT key, lam, list(i ORDER BY i) AS ids, list(line ORDER BY i) AS a
  FROM (SELECT key, CAST(lam AS DOUBLE) AS lam, i, list(a + CASE WHEN i = j THEN lam ELSE 0 END ORDER BY j) AS line FROM entry, pen GROUP BY ALL) GROUP BY ALL
),
rhs AS (SELECT key, list(r - u * t / s ORDER BY i) AS b FROM col JOIN tot USING (key) GROUP BY key)"""


def solution(name: str, source: str) -> str:
    """The CTEs that end in name(key, lam, x), the solutions for the right-hand sides of source(key, lam, b)."""
    return f"""
{name}_steps(key, lam, k, x, r, p, rr) AS (
  SELECT key, lam, 0, list_transform(b, lambda v: CAST(0 AS DOUBLE)), b, b, list_dot_product(b, b) FROM ({source})
  UNION ALL
  SELECT key, lam, k + 1, x, r, list_transform(list_zip(r, p), lambda z: z[1] + list_dot_product(r, r) / rr * z[2]), list_dot_product(r, r) FROM (
    SELECT key, lam, k, p, rr, list_transform(list_zip(x, p), lambda z: z[1] + rr / pap * z[2]) AS x, list_transform(list_zip(r, ap), lambda z: z[1] - rr / pap * z[2]) AS r FROM (
      SELECT *, list_dot_product(p, ap) AS pap FROM (
        SELECT n.*, list_transform(m.a, lambda line: list_dot_product(line, n.p)) AS ap FROM {name}_steps n JOIN sys m ON m.key = n.key AND m.lam = n.lam WHERE k < 600 AND rr > 1e-12
  )))
), {name} AS (SELECT key, lam, arg_max(x, k) AS x FROM {name}_steps GROUP BY ALL)"""


def rated(values: str, columns: str = "") -> str:
    """The final select: the ratings of values(key, i, v)."""
    return f"""
SELECT {columns}i // 2 AS player_id, round(coalesce(max(v) FILTER (i % 2 = 0), 0), 6) AS orapm, round(-coalesce(max(v) FILTER (i % 2 = 1), 0), 6) AS drapm,
       round(coalesce(max(v) FILTER (i % 2 = 0), 0) - coalesce(max(v) FILTER (i % 2 = 1), 0), 6) AS rapm,
       CAST(coalesce(max(raw) FILTER (i % 2 = 0), 0) AS BIGINT) AS off_poss, CAST(coalesce(max(raw) FILTER (i % 2 = 1), 0) AS BIGINT) AS def_poss
FROM ({values}) JOIN col USING (key, i) GROUP BY key, i // 2"""


_PLAIN = "SELECT s.key, s.lam, b FROM sys s JOIN rhs USING (key)"
_EACH = "SELECT key, unnest(ids) AS i, unnest({x}) AS v FROM {f}"


def fit(multiplier: str = "1.0") -> str:
    """Ratings with a fixed penalty of 500."""
    values = _EACH.format(x="x", f="one_fit JOIN sys USING (key, lam)")
    return f"WITH RECURSIVE {STINTS_SQL}, {rows(multiplier)}, {SYSTEM}, {matrix()}, {solution('one_fit', _PLAIN)} {rated(values)}"


def two_phase() -> str:
    """Ratings shrunk toward those of the plain fit x: (A + lam I) (y - x) = b - A x, which is lam x."""
    second = "SELECT key, lam, list_transform(x, lambda v: lam * v) AS b FROM first_fit"
    values = _EACH.format(x="list_transform(list_zip(f.x, g.x), lambda z: z[1] + z[2])", f="first_fit f JOIN second_fit g USING (key, lam) JOIN sys USING (key, lam)")
    return f"WITH RECURSIVE {STINTS_SQL}, {rows()}, {SYSTEM}, {matrix()}, {solution('first_fit', _PLAIN)}, {solution('second_fit', second)} {rated(values)}"


def last_season(scale: float = 0.7) -> str:
    """Ratings of every season that has a predecessor, shrunk toward the scaled plain fit of that one."""
    return f"""WITH RECURSIVE {STINTS_SQL}, {rows(key="season")}, {SYSTEM}, {matrix()}, {solution("first_fit", _PLAIN)},
was AS (SELECT key, unnest(ids) AS i, unnest(x) AS v FROM first_fit JOIN sys USING (key, lam)),
prior AS (
  SELECT c.key, list(coalesce({scale} * v, 0) ORDER BY c.i) AS p FROM col c
  LEFT JOIN was ON was.i = c.i AND CAST(left(was.key, 4) AS INTEGER) + 1 = CAST(left(c.key, 4) AS INTEGER)
  WHERE CAST(left(c.key, 4) AS INTEGER) - 1 IN (SELECT CAST(left(key, 4) AS INTEGER) FROM tot) GROUP BY c.key
), {solution("second_fit", "SELECT s.key, s.lam, list_transform(list_zip(b, list_transform(s.a, lambda line: list_dot_product(line, p)), p), lambda z: z[1] - z[2] + s.lam * z[3]) AS b FROM sys s JOIN rhs USING (key) JOIN prior USING (key)")}
{rated(_EACH.format(x="list_transform(list_zip(x, p), lambda z: z[1] + z[2])", f="second_fit JOIN prior USING (key) JOIN sys USING (key, lam)"), "key AS season, ")}"""


def cross_validation(lams: str, folds: int = 5) -> str:
    """The mean error of every penalty over folds of games."""
    return f"""WITH RECURSIVE {STINTS_SQL},
g AS (SELECT game_id, row_number() OVER (ORDER BY count(*) DESC, game_id) - 1 AS n FROM stints WHERE poss > 0 GROUP BY game_id),
folds AS (SELECT game_id, CASE WHEN (n // {folds}) % 2 = 0 THEN n % {folds} ELSE {folds - 1} - n % {folds} END AS fold FROM g),
numbered AS (SELECT row_number() OVER () AS rn, fold, poss, points, poss AS w, 100.0 * points AS wy, {_COLUMNS} AS c FROM stints JOIN folds USING (game_id) WHERE poss > 0),
obs AS (SELECT n.* EXCLUDE (fold), k AS key FROM numbered n, range(0, {folds}) t(k) WHERE fold <> k),
{SYSTEM}, {matrix(lams)}, {solution("fits", _PLAIN)},
coef AS (SELECT key, lam, unnest(ids) AS i, unnest(x) AS v FROM fits JOIN sys USING (key, lam)),
start AS (SELECT key, lam, (t - sum(u * v)) / s AS c0 FROM coef JOIN col USING (key, i) JOIN tot USING (key) GROUP BY key, lam, t, s),
held AS (SELECT fold AS key, rn, w, wy, unnest(c) AS i FROM numbered),
said AS (SELECT key, lam, rn, any_value(w) AS w, any_value(wy) AS wy, sum(v) AS e FROM held JOIN coef USING (key, i) GROUP BY ALL),
errors AS (SELECT key, lam, sum(w * power(wy / w - c0 - e, 2)) / sum(w) AS mse FROM said JOIN start USING (key, lam) GROUP BY ALL)
SELECT lam AS lambda, round(avg(mse), 6) AS cv_mse FROM errors GROUP BY lam"""
