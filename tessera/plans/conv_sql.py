"""DuckDB oracle for a round of training a stack of convolutions with two dense
layers: forward, deltas back through every layer as joins with the kernel's places, and
a step against the mean gradients."""

from __future__ import annotations

from tessera.operators.conv import same_geometry
from tessera.plans import weights as W


def _layer(j: int, size: int, k: int, co: int, stride: int) -> str:
    """``a{j}(id, y, x, c, v)`` from ``a{j-1}``, ``k{j}`` and ``b{j}``; every place of the output has a row."""
    out, pad = same_geometry(size, k, stride)
    return f"""a{j} AS MATERIALIZED (
  SELECT s.id, s.ny // {stride} AS y, s.nx // {stride} AS x, b.co AS c, greatest(s.v + b.w, 0.0) AS v FROM (
    SELECT a.id, a.y - k.ky + {pad} AS ny, a.x - k.kx + {pad} AS nx, k.co, sum(a.v * k.w) AS v
    FROM a{j - 1} a JOIN k{j} k ON k.ci = a.c
    WHERE a.y - k.ky + {pad} BETWEEN 0 AND {(out - 1) * stride} AND a.x - k.kx + {pad} BETWEEN 0 AND {(out - 1) * stride}
      AND (a.y - k.ky + {pad}) % {stride} = 0 AND (a.x - k.kx + {pad}) % {stride} = 0
    GROUP BY ALL) s JOIN b{j} b ON b.co = s.co)"""


def _back(j: int, size: int, k: int, stride: int, first: bool) -> list[str]:
    """``gk{j}``, ``gb{j}``: gradients of layer j from ``d{j}``; ``d{j-1}`` unless it is the first."""
    _, pad = same_geometry(size, k, stride)
    reach = f"d{j} d, range({k}) p(ky), range({k}) q(kx)"
    at = f"a.id = d.id AND a.y = d.y * {stride} + ky - {pad} AND a.x = d.x * {stride} + kx - {pad}"
    parts = [f"gk{j} AS MATERIALIZED (SELECT ky, kx, a.c AS ci, d.c AS co, sum(a.v * d.v) AS g FROM {reach}, a{j - 1} a WHERE {at} GROUP BY ALL)",
             f"gb{j} AS MATERIALIZED (SELECT c AS co, sum(v) AS g FROM d{j} GROUP BY c)"]
    if not first:
        parts.append(f"""d{j - 1} AS MATERIALIZED (
  SELECT a.id, a.y, a.x, a.c, s.v FROM (
    SELECT d.id, d.y * {stride} + k.ky - {pad} AS y, d.x * {stride} + k.kx - {pad} AS x, k.ci AS c, sum(d.v * k.w) AS v
    FROM d{j} d JOIN k{j} k ON k.co = d.c GROUP BY ALL) s
  JOIN a{j - 1} a ON a.id = s.id AND a.y = s.y AND a.x = s.x AND a.c = s.c AND a.v > 0)""")
    return parts


def conv_step_sql(rows_sql: str, convs, hidden: tuple[int, int], classes: int, rate: float, size: int = 8) -> str:
    """Weights after one gradient step: (layer, i, o, w), i over a kernel's places and
    channels or a dense layer's inputs, the bias last.  ``rows_sql``: (vec_id, label, x);
    ``convs``: (k, ci, co, stride, kernel SQL ``(ky, kx, ci, co, w)``, bias SQL over ``co``);
    ``hidden``: width and weights' salt of the hidden dense layer, the next salt being the last layer's."""
    m, (width, salt), dims = len(convs), hidden, [size]
    parts = [f"tr AS MATERIALIZED ({rows_sql})", "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tr)",
             f"a0 AS MATERIALIZED (SELECT vec_id AS id, (i - 1) // {size} AS y, (i - 1) % {size} AS x, 0 AS c, x[i] AS v FROM tr, range(1, {size * size + 1}) t(i))"]
    for j, (k, ci, co, stride, kernel, bias) in enumerate(convs, 1):
        parts += [f"k{j} AS MATERIALIZED ({kernel})", f"b{j} AS MATERIALIZED (SELECT co, {bias} AS w FROM range({co}) t(co))", _layer(j, dims[-1], k, co, stride)]
        dims.append(same_geometry(dims[-1], k, stride)[0])
    last, channels = dims[-1], convs[-1][2]
    flat = last * last * channels
    lists = lambda a, b, s: f"list_transform(range({b}), lambda o: list_transform(range({a}), lambda i: {W.layer_weights_sql('i', 'o', s)}))"
    soft = "list_transform(z, lambda v: exp(v - list_max(z)) / list_sum(list_transform(z, lambda u: exp(u - list_max(z)))))"
    parts += [
        f"w1 AS MATERIALIZED (SELECT {lists(flat, width, salt)} AS c)", f"w2 AS MATERIALIZED (SELECT {lists(width, classes, salt + 1)} AS c)",
        f"f AS MATERIALIZED (SELECT id, list(v ORDER BY y, x, c) AS f FROM a{m} GROUP BY id)",
        f"h AS MATERIALIZED (SELECT id, f, list_transform(range({width}), lambda o: greatest(list_dot_product(f, w1.c[o + 1]) + {W.layer_bias_sql('o', salt)}, 0.0)) AS h FROM f, w1)",
        f"z AS (SELECT h.*, label, list_transform(range({classes}), lambda o: list_dot_product(h, w2.c[o + 1]) + {W.layer_bias_sql('o', salt + 1)}) AS z FROM h JOIN tr ON tr.vec_id = h.id, w2)",
        f"e2 AS MATERIALIZED (SELECT id, f, h, list_transform(range({classes}), lambda o: p[o + 1] - CAST(label = o AS DOUBLE)) AS e2 FROM (SELECT *, {soft} AS p FROM z) q)",
        f"e1 AS MATERIALIZED (SELECT e2.*, list_transform(range({width}), lambda i: list_dot_product(e2, list_transform(w2.c, lambda r: r[i + 1])) * CAST(h[i + 1] > 0 AS DOUBLE)) AS e1 FROM e2, w2)",
        f"e0 AS MATERIALIZED (SELECT id, list_transform(range({flat}), lambda i: list_dot_product(e1, list_transform(w1.c, lambda r: r[i + 1])) * CAST(f[i + 1] > 0 AS DOUBLE)) AS e0 FROM e1, w1)",
        f"d{m} AS MATERIALIZED (SELECT id, i // {last * channels} AS y, i // {channels} % {last} AS x, i % {channels} AS c, e0[i + 1] AS v FROM e0, range({flat}) t(i))"]
    for j in range(m, 0, -1):
        parts += _back(j, dims[j - 1], convs[j - 1][0], convs[j - 1][3], j == 1)
    out = []
    for j, (k, ci, co, *_) in enumerate(convs, 1):
        out += [f"SELECT {j} AS layer, (k.ky * {k} + k.kx) * {ci} + k.ci AS i, k.co AS o, k.w - {rate!r} * coalesce(g.g, 0.0) / n AS w FROM k{j} k LEFT JOIN gk{j} g USING (ky, kx, ci, co), nn",
                f"SELECT {j}, {k * k * ci}, b.co, b.w - {rate!r} * coalesce(g.g, 0.0) / n FROM b{j} b LEFT JOIN gb{j} g USING (co), nn"]
    for l, (a, b, ins, outs) in enumerate([(flat, width, "f", "e1"), (width, classes, "h", "e2")]):
        s = salt + l
        column = lambda name, n: f"SELECT i, list(v ORDER BY id) AS v FROM (SELECT id, unnest(range({n})) AS i, unnest({name}) AS v FROM e1) q GROUP BY i"
        out += [f"SELECT {m + 1 + l}, x.i, d.i, {W.layer_weights_sql('x.i', 'd.i', s)} - {rate!r} * list_dot_product(x.v, d.v) / n FROM ({column(ins, a)}) x, ({column(outs, b)}) d, nn",
                f"SELECT {m + 1 + l}, {a}, d.i, {W.layer_bias_sql('d.i', s)} - {rate!r} * list_sum(d.v) / n FROM ({column(outs, b)}) d, nn"]
    return f"""WITH {", ".join(parts)}
SELECT CAST(layer AS INTEGER) AS layer, CAST(i AS INTEGER) AS i, CAST(o AS INTEGER) AS o, round(w, 6) + 0.0 AS w FROM ({" UNION ALL ".join(out)}) q"""
