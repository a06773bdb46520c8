"""DuckDB oracle for training a dense network: the rounds written out one after
the other, each a forward pass, the deltas layer by layer, gradients summed over
the rows, and an Adam step."""

from __future__ import annotations

from tessera.operators.lbfgs import SLACK
from tessera.operators.networks import MASK_MODULUS, MASK_STEPS
from tessera.plans import weights as W

B1, B2 = "0.9::DOUBLE", "0.999::DOUBLE"


def _mask_sql(layer: int, round_: int, seed: int, keep: float) -> str:
    """Keep-factor (1 / keep or 0) of unit ``u`` of row ``k``."""
    m, (a, b, c, d) = MASK_MODULUS, MASK_STEPS
    h = f"((((vec_id % {m}) * {a} + u * {b} + {layer * c + round_ * d + seed}) % {m}) * {a} % {m})"
    return f"(CASE WHEN (xor({h}, {h} >> 13) * {b}) % {m} < {keep * m!r}::DOUBLE THEN {1 / keep!r}::DOUBLE ELSE 0.0::DOUBLE END)"


def _fit_tables(rows_sql: str, sizes: list[int], rounds: int, rate: float, keep: float, seed: int,
                decay_steps: int | None, decay_rate: float | None) -> list[str]:
    """Tables ``w{k}_{l}(c, b, ...)`` of every round k and layer l: weights by
    output unit and the bias.  ``rows_sql``: (vec_id, label, x)."""
    L = len(sizes) - 1
    parts = [f"tr AS MATERIALIZED ({rows_sql})", "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM tr)"]
    pairs = list(enumerate(zip(sizes[:-1], sizes[1:]), 1))
    zeros = lambda a, b: f"list_transform(range({b}), lambda o: list_transform(range({a}), lambda i: 0.0::DOUBLE))"
    for l, (a, b) in pairs:
        parts.append(f"w0_{l} AS MATERIALIZED (SELECT list_transform(range({b}), lambda o: list_transform(range({a}), lambda i: "
                     f"{W.layer_weights_sql('i', 'o', l)})) AS c, list_transform(range({b}), lambda o: {W.layer_bias_sql('o', l)}) AS b, "
                     f"{zeros(a, b)} AS m, {zeros(a, b)} AS v, {zeros(1, b)} AS mb, {zeros(1, b)} AS vb)")
    for k in range(rounds):
        src = "SELECT vec_id, label, x AS h0 FROM tr"
        for l, (a, b) in pairs:
            pre = f"list_transform(range({b}), lambda o: list_dot_product(h{l - 1}, w.c[o + 1]) + w.b[o + 1])"
            carry = ", ".join(["vec_id", "label", *[f"h{j}" for j in range(l)], *[f"g{j}" for j in range(1, l)]])
            step = f"SELECT {carry}, {pre} AS a FROM ({src}) s, w{k}_{l} w"
            if l == L:
                src = f"SELECT {carry}, a AS z FROM ({step}) t"
            else:
                # g: the factor of unit u between a and h, for the way back
                mask = _mask_sql(l - 1, k, seed, keep) if keep < 1 else "1.0::DOUBLE"
                f = f"list_transform(range({b}), lambda u: CASE WHEN a[u + 1] > 0 THEN {mask} ELSE 0.0::DOUBLE END)"
                src = f"SELECT {carry}, list_transform(range({b}), lambda u: a[u + 1] * f[u + 1]) AS h{l}, f AS g{l} FROM (SELECT *, {f} AS f FROM ({step}) t) t2"
        soft = "list_transform(z, lambda v: exp(v - list_max(z)) / list_sum(list_transform(z, lambda u: exp(u - list_max(z)))))"
        hs = ", ".join([f"h{j}" for j in range(L)] + [f"g{j}" for j in range(1, L)])
        src = (f"SELECT {hs}, list_transform(range({sizes[-1]}), lambda o: p[o + 1] - CAST(label = o AS DOUBLE)) AS d{L} "
               f"FROM (SELECT *, {soft} AS p FROM ({src}) t) t2")
        for l in range(L, 1, -1):
            a = sizes[l - 1]
            back = f"list_transform(range({a}), lambda i: list_dot_product(d{l}, list_transform(w.c, lambda q: q[i + 1])) * g{l - 1}[i + 1])"
            src = f"SELECT s.*, {back} AS d{l - 1} FROM ({src}) s, w{k}_{l} w"
        parts.append(f"r{k} AS MATERIALIZED ({src})")
        lr = rate if not decay_steps else rate * decay_rate ** (k // decay_steps)
        lr_t = f"({lr!r}::DOUBLE * sqrt(1.0 - power({B2}, {k + 1})) / (1.0 - power({B1}, {k + 1})))"
        for l, (a, b) in pairs:
            grads = (f"SELECT list(row ORDER BY o) AS G FROM (SELECT o, list(s ORDER BY i) AS row FROM ("
                     f"SELECT o, i, sum(hv * dv) AS s FROM (SELECT o, dv, unnest(range({a})) AS i, unnest(h) AS hv FROM ("
                     f"SELECT h{l - 1} AS h, unnest(range({b})) AS o, unnest(d{l}) AS dv FROM r{k}) e) e2 GROUP BY o, i) s1 GROUP BY o) s2")
            bias = f"SELECT list([s] ORDER BY o) AS Gb FROM (SELECT o, sum(dv) AS s FROM (SELECT unnest(range({b})) AS o, unnest(d{l}) AS dv FROM r{k}) e GROUP BY o) s1"
            each = lambda x: f"list_transform(range({b}), lambda o: list_transform(range(len(G[o + 1])), lambda i: {x}))"
            each_b = lambda x: f"list_transform(range({b}), lambda o: list_transform(range(1), lambda i: {x}))"
            g, gb = "(G[o + 1][i + 1] / n)", "(Gb[o + 1][i + 1] / n)"
            moments = (f"SELECT w.c, w.b, {each(f'{B1} * w.m[o + 1][i + 1] + (1 - {B1}) * {g}')} AS m, {each(f'{B2} * w.v[o + 1][i + 1] + (1 - {B2}) * {g} * {g}')} AS v, "
                       f"{each_b(f'{B1} * w.mb[o + 1][i + 1] + (1 - {B1}) * {gb}')} AS mb, {each_b(f'{B2} * w.vb[o + 1][i + 1] + (1 - {B2}) * {gb} * {gb}')} AS vb "
                       f"FROM w{k}_{l} w, nn, ({grads}) gg, ({bias}) bb")
            parts.append(f"w{k + 1}_{l} AS MATERIALIZED (SELECT list_transform(range({b}), lambda o: list_transform(range({a}), lambda i: "
                         f"c[o + 1][i + 1] - {lr_t} * m[o + 1][i + 1] / (sqrt(v[o + 1][i + 1]) + 1e-8))) AS c, "
                         f"list_transform(range({b}), lambda o: b[o + 1] - {lr_t} * mb[o + 1][1] / (sqrt(vb[o + 1][1]) + 1e-8)) AS b, m, v, mb, vb FROM ({moments}) t)")
    return parts


def dense_fit_sql(rows_sql: str, sizes: list[int], rounds: int, *fit) -> str:
    """The weights after ``rounds``: (layer, i, o, w), the bias as input i = d."""
    parts = _fit_tables(rows_sql, sizes, rounds, *fit)
    out = " UNION ALL ".join(
        f"SELECT {l} AS layer, unnest(range({a + 1})) AS i, o, unnest(list_concat(c[o + 1], [b[o + 1]])) AS w FROM w{rounds}_{l}, range({b}) t(o)"
        for l, (a, b) in enumerate(zip(sizes[:-1], sizes[1:]), 1))
    return f"""WITH {", ".join(parts)}
SELECT CAST(layer AS INTEGER) AS layer, CAST(i AS INTEGER) AS i, CAST(o AS INTEGER) AS o, round(w, 6) + 0.0 AS w FROM ({out}) q"""


def dense_curve_sql(rows_sql: str, test_sql: str, sizes: list[int], rounds: int, rate: float) -> str:
    """Loss and accuracy of the training rows at the weights before each round's
    update, and of the test rows at those and the final weights."""
    parts = _fit_tables(rows_sql, sizes, rounds, rate, 1.0, 0, None, None)

    def metrics(src: str, split: str, k: int) -> str:
        h = f"SELECT label, x AS h FROM ({src}) s0"
        for l in range(1, len(sizes)):
            a = f"list_dot_product(h, w.c[o + 1]) + w.b[o + 1]"
            h = f"SELECT label, list_transform(range({sizes[l]}), lambda o: {a if l == len(sizes) - 1 else f'greatest({a}, 0.0)'}) AS h FROM ({h}) s, w{k}_{l} w"
        p = "exp(h[label + 1] - list_max(h)) / list_sum(list_transform(h, lambda u: exp(u - list_max(h))))"
        return (f"SELECT CAST({k} AS INTEGER) AS round, '{split}' AS split, round(avg(CAST(list_position(h, list_max(h)) - 1 = label AS DOUBLE)), 6) + 0.0 AS accuracy, "
                f"round(avg(-ln({p} + 1e-5)), 6) + 0.0 AS loss FROM ({h}) f")

    rows = [metrics("SELECT * FROM tr", "train", k) for k in range(rounds)] + [metrics(test_sql, "eval", k) for k in range(rounds + 1)]
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(rows)}"


def lbfgs_parts(rows_sql: str, sizes: list[int], iterations: int, ladder, armijo: float):
    """Tables ``t{k}(x, f, g, step)`` of L-BFGS iterations on a sigmoid network, written
    out one after the other: weights in one list (per layer and unit its weights and its bias), mean
    cross-entropy, its gradient and the step that led there.  No pairs are dropped."""
    pairs = list(enumerate(zip(sizes[:-1], sizes[1:]), 1))
    L, N = len(sizes) - 1, sum((a + 1) * b for a, b in zip(sizes[:-1], sizes[1:]))
    offs = {l: sum((a + 1) * b for _, (a, b) in pairs[:l - 1]) for l, _ in pairs}
    parts = [f"tr AS MATERIALIZED ({rows_sql})"]

    def units(src: str) -> str:
        """Per point its units' weights by layer; ``src``: (id, x)."""
        return "SELECT id, " + ", ".join(f"list_transform(range({b}), lambda o: x[{offs[l]} + o * {a + 1} + 1:{offs[l]} + (o + 1) * {a + 1}]) AS c{l}" for l, (a, b) in pairs) + f" FROM ({src}) u"

    def forward(rows: str, w: str, keep: bool) -> str:
        src = f"SELECT w.id, r.vec_id, r.label, list_append(r.x, 1.0::DOUBLE) AS h0 FROM ({rows}) r, {w} w"
        for l, (a, b) in pairs:
            pre = f"list_transform(range({b}), lambda o: list_dot_product(h{l - 1}, w.c{l}[o + 1]))"
            carry = ", ".join(["s.id", "s.vec_id", "s.label", *([f"s.h{j}" for j in range(l)] if keep else [])])
            step = f"SELECT {carry}, {pre} AS a FROM ({src}) s JOIN {w} w ON w.id = s.id"
            carry = carry.replace("s.", "")
            src = f"SELECT {carry}, " + ("a AS z" if l == L else "list_append(list_transform(a, lambda v: 1.0 / (1.0 + exp(-v))), 1.0::DOUBLE) AS h" + str(l)) + f" FROM ({step}) f"
        return src

    def loss(w: str) -> str:
        return (f"SELECT id, avg(list_max(z) + ln(list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) - z[label + 1]) AS f "
                f"FROM ({forward('SELECT * FROM tr', w, False)}) q GROUP BY id")

    def gradient(k: int) -> None:
        """Tables for the gradient at ``p{k}(id, x)``: ``g{k}(g)``."""
        parts.append(f"v{k} AS MATERIALIZED (SELECT *, " + ", ".join(
            f"list_transform(range({a}), lambda i: list_transform(c{l}, lambda q: q[i + 1])) AS ct{l}" for l, (a, _) in pairs if l > 1) + f" FROM ({units(f'SELECT id, x FROM p{k}')}) q)")
        hs = ", ".join(f"h{j}" for j in range(L))
        soft = "list_transform(z, lambda v: exp(v - list_max(z)) / list_sum(list_transform(z, lambda u: exp(u - list_max(z)))))"
        src = (f"SELECT id, vec_id, {hs}, list_transform(range({sizes[-1]}), lambda o: p[o + 1] - CAST(label = o AS DOUBLE)) AS d{L} "
               f"FROM (SELECT *, {soft} AS p FROM ({forward('SELECT * FROM tr', f'v{k}', True)}) q) q2")
        for l in range(L, 1, -1):
            back = f"list_transform(range({sizes[l - 1]}), lambda i: list_dot_product(d{l}, v.ct{l}[i + 1]) * h{l - 1}[i + 1] * (1.0 - h{l - 1}[i + 1]))"
            src = f"SELECT s.*, {back} AS d{l - 1} FROM ({src}) s JOIN v{k} v ON v.id = s.id"
        parts.append(f"r{k} AS MATERIALIZED ({src})")
        cols = lambda name, width: f"SELECT i, list(e ORDER BY vec_id) AS e FROM (SELECT vec_id, unnest(range({width})) AS i, unnest({name}) AS e FROM r{k}) q GROUP BY i"
        dots = " UNION ALL ".join(f"SELECT {l} AS l, d.i AS o, h.i AS i, list_dot_product(d.e, h.e) / len(d.e) AS g FROM ({cols(f'd{l}', b)}) d, ({cols(f'h{l - 1}', a + 1)}) h" for l, (a, b) in pairs)
        parts.append(f"g{k} AS MATERIALIZED (SELECT list(g ORDER BY l, o, i) AS g FROM ({dots}) q)")

    each = lambda form: f"list_transform(range({N}), lambda i: {form})"
    start = "SELECT 0 AS id, flatten([" + ", ".join(
        f"flatten(list_transform(range({b}), lambda o: list_append(list_transform(range({a}), lambda i: {W.layer_weights_sql('i', 'o', l)}), {W.layer_bias_sql('o', l)})))" for l, (a, b) in pairs) + "]) AS x"
    parts.append(f"p0 AS MATERIALIZED ({start})")
    parts.append(f"w0 AS MATERIALIZED ({units('SELECT * FROM p0')})")
    gradient(0)
    parts.append(f"t0 AS MATERIALIZED (SELECT p0.x, q.f, g0.g, 0.0::DOUBLE AS step FROM p0, g0, ({loss('w0')}) q)")
    for k in range(1, iterations + 1):
        b = k - 1
        src = f"SELECT g AS q FROM t{b}"
        for j in range(b, 0, -1):  # newest pair first
            src = f"SELECT q.* EXCLUDE (q), al AS a{j}, {each('q.q[i + 1] - al * y[i + 1]')} AS q FROM (SELECT q.*, u.y, list_dot_product(u.s, q.q) / u.sy AS al FROM ({src}) q, u{j} u) q".replace("q.* EXCLUDE (q)", "q.* EXCLUDE (q, y, al)")
        parts.append(f"a{k} AS MATERIALIZED ({src})")
        src = f"SELECT q.* EXCLUDE (q), {each(f'q.q[i + 1] * u.sy / u.yy')} AS q FROM a{k} q, u{b} u" if b else f"SELECT {each('q[i + 1] / m')} AS q FROM (SELECT q, greatest(1.0, sqrt(list_dot_product(q, q))) AS m FROM a{k}) q"
        for j in range(1, b + 1):
            src = f"SELECT q.* EXCLUDE (q, s, be), {each(f'q.q[i + 1] + (a{j} - be) * s[i + 1]')} AS q FROM (SELECT q.*, u.s, list_dot_product(u.y, q.q) / u.sy AS be FROM ({src}) q, u{j} u) q"
        parts.append(f"d{k} AS MATERIALIZED (SELECT list_transform(q, lambda v: -v) AS d FROM ({src}) q)")
        steps = ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(ladder))
        parts.append(f"c{k} AS MATERIALIZED (SELECT s.id, s.t, {each('t.x[i + 1] + s.t * d.d[i + 1]')} AS x, t.f + {armijo!r} * s.t * list_dot_product(t.g, d.d) + {SLACK!r} * abs(t.f) AS most FROM t{b} t, d{k} d, (VALUES {steps}) s(id, t))")
        parts.append(f"w{k} AS MATERIALIZED ({units(f'SELECT id, x FROM c{k}')})")
        parts.append(f"b{k} AS MATERIALIZED (SELECT c.id, c.t, c.x, l.f FROM c{k} c JOIN ({loss(f'w{k}')}) l ON l.id = c.id WHERE l.f <= c.most ORDER BY c.id LIMIT 1)")
        parts.append(f"p{k} AS MATERIALIZED (SELECT id, x FROM b{k})")
        gradient(k)
        parts.append(f"t{k} AS MATERIALIZED (SELECT b.x, b.f, g{k}.g, b.t AS step FROM b{k} b, g{k})")
        parts.append(f"u{k} AS MATERIALIZED (SELECT s, y, list_dot_product(s, y) AS sy, list_dot_product(y, y) AS yy FROM (SELECT {each('t.x[i + 1] - o.x[i + 1]')} AS s, {each('t.g[i + 1] - o.g[i + 1]')} AS y FROM t{k} t, t{b} o) q)")
    parts.append(f"wz AS MATERIALIZED ({units(f'SELECT 0 AS id, x FROM t{iterations}')})")
    return parts, forward


def lbfgs_curve_sql(rows_sql: str, sizes: list[int], iterations: int, ladder, armijo: float) -> str:
    parts, _ = lbfgs_parts(rows_sql, sizes, iterations, ladder, armijo)
    out = " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS iteration, round(f, 6) + 0.0 AS loss, round(list_max(list_transform(g, lambda v: abs(v))), 6) + 0.0 AS gradient, step FROM t{k}" for k in range(iterations + 1))
    return f"WITH {', '.join(parts)} {out}"


def lbfgs_scores_sql(rows_sql: str, test_sql: str, sizes: list[int], iterations: int, ladder, armijo: float) -> str:
    parts, forward = lbfgs_parts(rows_sql, sizes, iterations, ladder, armijo)
    return f"""WITH {', '.join(parts)}
SELECT vec_id, label, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS prediction, list_transform(z, lambda v: round(v, 5) + 0.0) AS scores
FROM ({forward(test_sql, 'wz', False)}) q"""
