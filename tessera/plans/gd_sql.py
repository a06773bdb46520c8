"""DuckDB oracles for the regression jobs: recursive CTEs that carry the weight
list from round to round.  Every round takes the gradient row by row and every
RMSE is taken over the rows, so they share no algebra with the one-pass sums."""

from __future__ import annotations


def gd_cte(train_sql: str, d: int, rounds: int, alpha: float) -> str:
    """Defines ``tr(y, x, ...)`` and ``gd(k, w)`` for k = 0..rounds."""
    return f"""
WITH RECURSIVE tr AS MATERIALIZED ({train_sql}),
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tr),
gd(k, w) AS (
  SELECT 0, list_transform(range({d}), lambda i: CAST(0.0 AS DOUBLE))
  UNION ALL
  SELECT k + 1, list_transform(range({d}), lambda i: w[i + 1] - {float(alpha)} / (n * sqrt(k + 1)) * G[i + 1])
  FROM gd, nn, LATERAL (
    SELECT list(g ORDER BY i) AS G FROM (
      SELECT i, sum(r * v) AS g FROM (
        SELECT unnest(range({d})) AS i, unnest(x) AS v, r
        FROM (SELECT x, list_dot_product(x, gd.w) - y AS r FROM tr) q) u GROUP BY i) s) t
  WHERE k < {rounds})
"""


def gd_error_curve_sql(train_sql: str, d: int, rounds: int, alpha: float) -> str:
    return gd_cte(train_sql, d, rounds, alpha) + f"""
SELECT CAST(k AS INTEGER) AS iter,
       round(sqrt(avg(power(y - list_dot_product(x, w), 2))), 6) + 0.0 AS rmse
FROM gd, tr WHERE k < {rounds} GROUP BY k"""


def gd_weights_sql(train_sql: str, d: int, rounds: int, alpha: float) -> str:
    return gd_cte(train_sql, d, rounds, alpha) + f"""
SELECT CAST(a.i AS INTEGER) AS i, round(w[a.i + 1], 6) + 0.0 AS weight
FROM gd, range({d}) a(i) WHERE k = {rounds}"""


def gd_predict_sql(train_sql: str, test_sql: str, d: int, rounds: int, alpha: float) -> str:
    return gd_cte(train_sql, d, rounds, alpha) + f"""
SELECT t.vec_id, t.y AS label, round(list_dot_product(t.x, w), 6) + 0.0 AS prediction
FROM gd, ({test_sql}) t WHERE k = {rounds}"""


def cv_cte(rows_sql: str, fits_sql: str, max_rounds: int) -> str:
    """Cross-validated descent for several variants at once.

    ``rows_sql`` yields ``(s, fold, y, x)``: the training rows per feature set
    ``s``; ``fits_sql`` yields ``(v, s, alpha)``: a variant's feature set and step.
    For every variant and held-out fold ``f`` the rounds run over the other
    folds' rows; ``gd(v, f, k, w)`` holds every round and ``val`` the held-out
    RMSE.  Fold ``-1`` holds out nothing: it is the refit on all rows."""
    return f"""
WITH RECURSIVE tr AS MATERIALIZED ({rows_sql}),
va AS MATERIALIZED ({fits_sql}),
fl AS (SELECT DISTINCT fold AS f FROM tr UNION ALL SELECT -1),
st AS MATERIALIZED (SELECT va.v, va.s, va.alpha, fl.f, c.n, c.d FROM va, fl, LATERAL (
         SELECT CAST(count(*) AS DOUBLE) AS n, max(len(x)) AS d FROM tr WHERE tr.s = va.s AND tr.fold <> fl.f) c),
gd(v, f, k, w) AS (
  SELECT v, f, 0, list_transform(range(d), lambda q: CAST(0.0 AS DOUBLE)) FROM st
  UNION ALL
  SELECT g.v, g.f, g.k + 1, list_transform(range(len(g.w)), lambda i: g.w[i + 1] - st.alpha / (st.n * sqrt(g.k + 1)) * t.G[i + 1])
  FROM gd g JOIN st ON st.v = g.v AND st.f = g.f, LATERAL (
    SELECT list(gi ORDER BY i) AS G FROM (
      SELECT i, sum(r * xv) AS gi FROM (
        SELECT unnest(range(len(x))) AS i, unnest(x) AS xv, r
        FROM (SELECT x, list_dot_product(x, g.w) - y AS r FROM tr WHERE tr.s = st.s AND tr.fold <> g.f) q) u GROUP BY i) b) t
  WHERE g.k < {max_rounds}),
val AS (SELECT gd.v, gd.f, gd.k AS rounds, sqrt(avg(power(tr.y - list_dot_product(tr.x, gd.w), 2))) AS rmse
        FROM gd JOIN va ON va.v = gd.v JOIN tr ON tr.s = va.s AND tr.fold = gd.f GROUP BY gd.v, gd.f, gd.k)
"""


def standard_cte(rows_sql: str, d: int) -> str:
    """``tr(s, y, x)`` from ``rows_sql``, one set of rows per ``s``; their means and
    deviations ``mo(s, mx, sx)``, ``ym(s, my, sy, n)``; standardised rows ``zs(s, v, u)``; sums of
    products ``gr(s, A)``, ``gv(s, c)``."""
    return f"""tr AS MATERIALIZED ({rows_sql}),
el AS (SELECT s, y, unnest(range({d})) AS i, unnest(x) AS xv FROM tr),
mo AS MATERIALIZED (SELECT s, list(m ORDER BY i) AS mx, list(sd ORDER BY i) AS sx
       FROM (SELECT s, i, avg(xv) AS m, stddev_pop(xv) AS sd FROM el GROUP BY s, i) q GROUP BY s),
ym AS MATERIALIZED (SELECT s, avg(y) AS my, stddev_pop(y) AS sy, CAST(count(*) AS DOUBLE) AS n FROM tr GROUP BY s),
zs AS MATERIALIZED (SELECT tr.s, (y - my) / sy AS v, list_transform(range({d}), lambda i: (x[i + 1] - mx[i + 1]) / sx[i + 1]) AS u
       FROM tr JOIN mo ON mo.s = tr.s JOIN ym ON ym.s = tr.s),
gr AS MATERIALIZED (SELECT s, list(row ORDER BY i) AS A FROM (
         SELECT s, i, list(a ORDER BY j) AS row FROM (
           SELECT z.s, p.i, q.j, sum(z.u[p.i + 1] * z.u[q.j + 1]) AS a FROM zs z, range({d}) p(i), range({d}) q(j) GROUP BY z.s, p.i, q.j) c
         GROUP BY s, i) e GROUP BY s),
gv AS MATERIALIZED (SELECT s, list(a ORDER BY i) AS c FROM (
         SELECT z.s, p.i, sum(z.u[p.i + 1] * z.v) AS a FROM zs z, range({d}) p(i) GROUP BY z.s, p.i) e GROUP BY s)"""


def path_cte(rows_sql: str, d: int, regs: list[float], mix: float, most: int, tol: float) -> str:
    """Coordinate descent along the path of ``regs`` (descending) for every set of
    rows ``s``: ``it(s, g, k, b, done)`` holds the standardised coefficients after
    each sweep k of each reg g, up to ``most`` sweeps or a gap closed to ``tol``; a
    sweep folds over the columns, each taking its soft threshold.
    ``ap(s, g, m, k, done, w, b0)``: after m sweeps or the last one, on the rows' scale."""
    values = ", ".join(f"({i}, {r!r}::DOUBLE)" for i, r in enumerate(regs))
    z = "(c[CAST(e[1] AS INTEGER) + 1] - list_dot_product(A[CAST(e[1] AS INTEGER) + 1], acc) + A[CAST(e[1] AS INTEGER) + 1][CAST(e[1] AS INTEGER) + 1] * acc[CAST(e[1] AS INTEGER) + 1])"
    new = f"sign({z}) * greatest(abs({z}) - l1, 0.0) / (A[CAST(e[1] AS INTEGER) + 1][CAST(e[1] AS INTEGER) + 1] + l2)"
    return f"""
WITH RECURSIVE {standard_cte(rows_sql, d)},
pr AS MATERIALIZED (SELECT ym.s, list_transform(A, lambda r: list_transform(r, lambda t: t / n)) AS A, list_transform(c, lambda t: t / n) AS c, CAST(1.0 AS DOUBLE) AS vv, sy
       FROM ym JOIN gr ON gr.s = ym.s JOIN gv ON gv.s = ym.s),
rg AS (SELECT g, r FROM (VALUES {values}) t(g, r)),
it(s, g, k, b, done) AS (
  SELECT s, 0, 0, list_transform(c, lambda q: CAST(0.0 AS DOUBLE)), false FROM pr
  UNION ALL
  SELECT s, g, k, b, 0.5 * sq + l1 * l1n - (sc * (vv - cb) - 0.5 * sc * sc * sq) <= {tol!r} * 0.5 * vv
  FROM (SELECT *, vv - 2 * cb + bq + l2 * list_dot_product(b, b) AS sq, least(1.0, l1 / greatest(l1, mx, 1e-300)) AS sc
    FROM (SELECT *, list_dot_product(c, b) AS cb, list_dot_product(b, q) AS bq, list_sum(list_transform(b, lambda t: abs(t))) AS l1n,
            list_max(list_transform(range({d}), lambda i: abs(c[i + 1] - q[i + 1] - l2 * b[i + 1]))) AS mx
      FROM (SELECT *, list_transform(A, lambda r: list_dot_product(r, b)) AS q
        FROM (SELECT s, g, k, vv, A, c, l1, l2, list_reduce(list_transform(range({d}), lambda j: [CAST(j AS DOUBLE)]),
                lambda acc, e: list_concat(list_concat(acc[1:CAST(e[1] AS INTEGER)], [{new}]), acc[CAST(e[1] AS INTEGER) + 2:]), b) AS b
          FROM (SELECT n.*, pr.vv, pr.A, pr.c, rg.r * {mix!r} / pr.sy AS l1, rg.r * {1 - mix!r} / pr.sy AS l2
            FROM (SELECT s, CASE WHEN done OR k = {most} THEN g + 1 ELSE g END AS g, CASE WHEN done OR k = {most} THEN 1 ELSE k + 1 END AS k, b FROM it
                  WHERE NOT (g = {len(regs) - 1} AND (done OR k = {most}))) n JOIN pr ON pr.s = n.s JOIN rg ON rg.g = n.g) p) p) p) p) p),
ends AS (SELECT s, g, max(k) AS last FROM it WHERE k > 0 GROUP BY s, g)"""


def path_points_cte(iters: list[int]) -> str:
    """``ap(s, g, m, k, done, w, b0)`` for m in ``iters``, after ``path_cte``."""
    values = ", ".join(f"({m})" for m in iters)
    return f"""
ap AS MATERIALIZED (SELECT s, g, m, k, done, w, my - list_dot_product(w, mx) AS b0 FROM (
  SELECT it.s, it.g, ms.m, it.k, it.done, mo.mx, ym.my, list_transform(range(len(it.b)), lambda i: it.b[i + 1] * ym.sy / mo.sx[i + 1]) AS w
  FROM ends JOIN (VALUES {values}) ms(m) ON true JOIN it ON it.s = ends.s AND it.g = ends.g AND it.k = least(ms.m, ends.last)
  JOIN mo ON mo.s = it.s JOIN ym ON ym.s = it.s) f)"""


def proximal_cte(rows_sql: str, d: int, regs: list[float], mix: float, most: int) -> str:
    """Accelerated proximal gradient for wide rows, over the rows themselves: ``it(s, g, k, b, z)``
    for every set of rows s, reg g and step k up to ``most``.  Products go through lists of rows
    and of columns, of all regs at once; the step comes from the products of rows, whose
    eigenvalues are the columns'.  ``ap`` as in ``path_points_cte``."""
    each = lambda form: ", ".join(form.format(g=g) for g in range(len(regs)))
    zero = f"list_transform(range({d}), lambda i: CAST(0.0 AS DOUBLE))"
    limits = ", ".join(f"{r * mix!r} / sy AS l1_{g}, {r * (1 - mix)!r} / sy AS l2_{g}, top + {r * (1 - mix)!r} / sy AS L_{g}" for g, r in enumerate(regs))
    down = "(it.z{g}[i + 1] - (gg.g{g}[i + 1] + pr.l2_{g} * it.z{g}[i + 1]) / pr.L_{g})"
    return f"""
WITH RECURSIVE tr AS MATERIALIZED ({rows_sql}),
el AS MATERIALIZED (SELECT s, id, y, unnest(range({d})) AS i, unnest(x) AS xv FROM tr),
mo1 AS MATERIALIZED (SELECT s, i, avg(xv) AS m, stddev_pop(xv) AS sd FROM el GROUP BY s, i),
mo AS MATERIALIZED (SELECT s, list(m ORDER BY i) AS mx, list(sd ORDER BY i) AS sx FROM mo1 GROUP BY s),
ym AS MATERIALIZED (SELECT s, avg(y) AS my, stddev_pop(y) AS sy, CAST(count(*) AS DOUBLE) AS n FROM tr GROUP BY s),
us AS MATERIALIZED (SELECT el.s, el.id, el.i, (xv - m) / sd AS u, (y - my) / sy AS v FROM el JOIN mo1 ON mo1.s = el.s AND mo1.i = el.i JOIN ym ON ym.s = el.s),
ro AS MATERIALIZED (SELECT s, id, any_value(v) AS v, list(u ORDER BY i) AS u FROM us GROUP BY s, id),
co AS MATERIALIZED (SELECT s, i, list(u ORDER BY id) AS u FROM us GROUP BY s, i),
kr AS MATERIALIZED (SELECT a.s, a.id, list(list_dot_product(a.u, b.u) / ym.n ORDER BY b.id) AS k FROM ro a JOIN ro b ON b.s = a.s JOIN ym ON ym.s = a.s GROUP BY a.s, a.id),
st AS MATERIALIZED (SELECT a.s, sqrt(sqrt(sum(power(list_dot_product(a.k, b.k), 2)))) AS top FROM kr a JOIN kr b ON b.s = a.s GROUP BY a.s),
pr AS MATERIALIZED (SELECT ym.s, n, {limits} FROM ym JOIN st ON st.s = ym.s),
its(s, k, {each("b{g}")}, {each("z{g}")}) AS (
  SELECT s, 0, {each(zero)}, {each(zero)} FROM pr
  UNION ALL
  SELECT s, k + 1, {each("nb{g}")}, {each(f"list_transform(range({d}), lambda i: nb{{g}}[i + 1] + CAST(k AS DOUBLE) / (k + 3) * (nb{{g}}[i + 1] - b{{g}}[i + 1]))")}
  FROM (SELECT it.s, it.k, {each("it.b{g}")}, {each(f"list_transform(range({d}), lambda i: sign({down}) * greatest(abs({down}) - pr.l1_{{g}} / pr.L_{{g}}, 0.0)) AS nb{{g}}")}
        FROM its it JOIN pr ON pr.s = it.s, LATERAL (
          SELECT {each("list(list_dot_product(co.u, rr.r{g}) / pr.n ORDER BY co.i) AS g{g}")} FROM co, (
            SELECT {each("list(list_dot_product(ro.u, it.z{g}) - ro.v ORDER BY ro.id) AS r{g}")} FROM ro WHERE ro.s = it.s) rr WHERE co.s = it.s) gg
        WHERE it.k < {most}) nx),
it AS ({" UNION ALL ".join(f"SELECT s, {g} AS g, k, b{g} AS b FROM its" for g in range(len(regs)))})"""


def proximal_points_cte(iters: list[int]) -> str:
    """``ap(s, g, m, w, b0)`` for m in ``iters``, after ``proximal_cte``."""
    return f"""
ap AS MATERIALIZED (SELECT s, g, m, w, my - list_dot_product(w, mx) AS b0 FROM (
  SELECT it.s, it.g, it.k AS m, mo.mx, ym.my, list_transform(range(len(it.b)), lambda i: it.b[i + 1] * ym.sy / mo.sx[i + 1]) AS w
  FROM it JOIN mo ON mo.s = it.s JOIN ym ON ym.s = it.s WHERE it.k IN ({', '.join(map(str, iters))})) f)"""


def elastic_cte(rows_sql: str, fits_sql: str, d: int, rounds: int) -> str:
    """Elastic net with intercept on standardised features and label, as MLlib
    poses it: minimise ``|v - U b|^2 / (2 n) + reg (mix |b|_1 + (1 - mix) / 2 |b|^2)``
    by accelerated proximal gradient rounds, then back to the scale of the rows.

    ``rows_sql``: ``(s, y, x)``, one set of rows per ``s``; ``fits_sql``:
    ``(v, s, reg, mix)``.  Defines ``en(v, w, b0)``."""
    return f"""
WITH RECURSIVE {standard_cte(rows_sql, d)},
va AS MATERIALIZED ({fits_sql}),
pr AS MATERIALIZED (SELECT va.v, va.s, va.reg / ym.sy AS reg, va.mix, A, c, ym.n, ym.sy, ym.my,
         list_max(list_transform(A, lambda r: list_sum(list_transform(r, lambda t: abs(t))))) / ym.n + va.reg / ym.sy * (1 - va.mix) AS L
       FROM va JOIN gr ON gr.s = va.s JOIN gv ON gv.s = va.s JOIN ym ON ym.s = va.s),
it(v, k, b, z) AS (
  SELECT v, 0, list_transform(c, lambda q: CAST(0.0 AS DOUBLE)), list_transform(c, lambda q: CAST(0.0 AS DOUBLE)) FROM pr
  UNION ALL
  SELECT v, k + 1, nb, list_transform(range({d}), lambda i: nb[i + 1] + CAST(k AS DOUBLE) / (k + 3) * (nb[i + 1] - b[i + 1]))
  FROM (SELECT it.v, k, b, list_transform(range({d}), lambda i: sign(h[i + 1]) * greatest(abs(h[i + 1]) - reg * mix / L, 0.0)) AS nb
        FROM (SELECT it.v, it.k, it.b, pr.reg, pr.mix, pr.L, list_transform(range({d}), lambda i: it.z[i + 1]
                     - ((list_dot_product(pr.A[i + 1], it.z) - pr.c[i + 1]) / pr.n + pr.reg * (1 - pr.mix) * it.z[i + 1]) / pr.L) AS h
              FROM it JOIN pr ON pr.v = it.v WHERE it.k < {rounds}) it) st),
en AS MATERIALIZED (SELECT v, s, w, my - list_dot_product(w, mx) AS b0 FROM (
        SELECT it.v, pr.s, pr.my, mo.mx, list_transform(range({d}), lambda i: it.b[i + 1] * pr.sy / mo.sx[i + 1]) AS w
        FROM it JOIN pr ON pr.v = it.v JOIN mo ON mo.s = pr.s WHERE it.k = {rounds}) f)
"""
