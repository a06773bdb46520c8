"""DuckDB oracle for softmax training: a recursive CTE carrying, per run,
the weight lists (one list of d+1 values per class, bias last) and the Adam
moments; each step computes the mean gradient over the training rows in a
LATERAL subquery."""

from __future__ import annotations

B1 = "CAST(0.9 AS DOUBLE)"
B2 = "CAST(0.999 AS DOUBLE)"

SOFTMAX_P = ("list_transform(z, lambda v: exp(v - list_max(z)) / "
             "list_sum(list_transform(z, lambda u: exp(u - list_max(z)))))")


def xs_sql(where: str) -> str:
    return (f"SELECT vec_id, label, list_concat(list_transform(embedding, lambda v: CAST(v AS DOUBLE)), [1.0]) AS x "
            f"FROM embeddings WHERE {where}")


def standard_rows_sql(where: str, d: int = 64) -> str:
    """Rows with features divided by the training part's sample deviation
    (MLlib's scale for its penalty) after taking off its mean."""
    return f"""SELECT vec_id, label, list_concat(list_transform(range({d}), lambda i: (CAST(embedding[i + 1] AS DOUBLE) - mx[i + 1]) / sx[i + 1]), [1.0]) AS x
FROM embeddings, (SELECT list(m ORDER BY i) AS mx, list(sd ORDER BY i) AS sx FROM (
  SELECT i, avg(v) AS m, stddev_samp(v) AS sd FROM (
    SELECT unnest(range({d})) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings WHERE vec_id % 5 < 4) u GROUP BY i) q) sc WHERE {where}"""


def softmax_cte(runs_values: str, rounds: int, eps: bool, d: int = 64, c: int = 10, l2: float = 0.0,
                batch: int | None = None, rows=None) -> str:
    """``runs_values``: rows ``(run, rate, adam, decay_steps, decay_rate)``.
    Defines ``xs`` (training rows), ``te`` (test rows) and ``sm(run, k, W, M, V)``.
    ``l2`` weighs half the squares of the weights but the bias; with ``batch``
    round k takes the rows whose ``vec_id // batch`` is the least plus k, around."""
    rows = rows or xs_sql
    dd = d + 1
    factor = " * s.p[s.label + 1] / (s.p[s.label + 1] + 1e-5)" if eps else ""
    n = "nb" if batch else "n"
    g = f"(G[cc + 1][jj + 1] / {n})"
    if l2:
        g = f"({g} + {l2!r}::DOUBLE * CASE WHEN jj < {d} THEN W[cc + 1][jj + 1] ELSE 0.0 END)"
    pick = f"WHERE vec_id // {batch} = lo + sm.k % span" if batch else ""
    bats = f"bats AS (SELECT min(vec_id // {batch}) AS lo, max(vec_id // {batch}) - min(vec_id // {batch}) + 1 AS span FROM xs)," if batch else ""
    of = ", bats" if batch else ""
    count = f", LATERAL (SELECT CAST(count(*) AS DOUBLE) AS nb FROM xs {pick}) cb" if batch else ""
    rate_k = ("(CASE WHEN decay_steps IS NULL THEN rate "
              "ELSE rate * power(decay_rate, floor(k / decay_steps)) END)")
    m_new = f"({B1} * M[cc + 1][jj + 1] + (1.0 - {B1}) * {g})"
    v_new = f"({B2} * V[cc + 1][jj + 1] + (1.0 - {B2}) * {g} * {g})"
    lr_t = f"({rate_k} * sqrt(1.0 - power({B2}, k + 1)) / (1.0 - power({B1}, k + 1)))"
    w_new = (f"CASE WHEN adam = 1 THEN W[cc + 1][jj + 1] - {lr_t} * {m_new} / (sqrt({v_new}) + 1e-8) "
             f"ELSE W[cc + 1][jj + 1] - {rate_k} * {g} END")
    zeros = f"list_transform(range({c}), lambda cc: list_transform(range({dd}), lambda jj: CAST(0.0 AS DOUBLE)))"
    return f"""
WITH RECURSIVE xs AS MATERIALIZED ({rows('vec_id % 5 < 4')}),
te AS MATERIALIZED ({rows('vec_id % 5 >= 4')}),
{bats}
nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM xs),
runs AS (SELECT * FROM (VALUES {runs_values}) r(run, rate, adam, decay_steps, decay_rate)),
sm(run, k, W, M, V) AS (
  SELECT run, 0, {zeros}, {zeros}, {zeros} FROM runs
  UNION ALL
  SELECT sm.run, k + 1,
    list_transform(range({c}), lambda cc: list_transform(range({dd}), lambda jj: {w_new})),
    list_transform(range({c}), lambda cc: list_transform(range({dd}), lambda jj: {m_new})),
    list_transform(range({c}), lambda cc: list_transform(range({dd}), lambda jj: {v_new}))
  FROM sm JOIN runs ON runs.run = sm.run, nn{of}{count}, LATERAL (
     SELECT list(gc ORDER BY c) AS G FROM (
        SELECT c, list(gj ORDER BY j) AS gc FROM (
           SELECT ci.c, ji.j,
                  sum(s.x[ji.j + 1] * (s.p[ci.c + 1] - CAST(s.label = ci.c AS DOUBLE)){factor}) AS gj
           FROM (SELECT x, label, {SOFTMAX_P} AS p
                 FROM (SELECT x, label,
                              list_transform(range({c}), lambda q: list_dot_product(x, sm.W[q + 1])) AS z
                       FROM xs {pick}) q0) s,
                range({c}) ci(c), range({dd}) ji(j)
           GROUP BY ci.c, ji.j) a GROUP BY c) b) g
  WHERE k < {rounds})
"""


def eval_sql(rows: str, where_k: str) -> str:
    """Per (run, k): accuracy and the two loss forms over ``rows``."""
    return f"""
SELECT sm.run, sm.k,
       avg(CAST(list_position(z, list_max(z)) - 1 = r.label AS DOUBLE)) AS accuracy,
       avg(-ln(p[r.label + 1] + 1e-5)) AS loss,
       avg(list_max(z) + ln(list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) - z[r.label + 1]) AS loss_scores
FROM sm, (SELECT x, label FROM {rows}) r,
     LATERAL (SELECT list_transform(range(10), lambda q: list_dot_product(r.x, sm.W[q + 1])) AS z) zz,
     LATERAL (SELECT {SOFTMAX_P} AS p) pp
WHERE {where_k}
GROUP BY sm.run, sm.k"""
