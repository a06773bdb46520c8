"""Softmax regression trained by full-batch (or key-batched) gradient
descent or Adam, with stepped learning-rate decay, and its metrics.

Each round is one distributed job over persisted rows: every task scores
its Arrow batches with the current weights (a broadcast variable of
size ``runs x (d+1) x c``), forms ``X'(P - Y)`` and the loss / hit counts,
and emits one block vector; blocks are summed in parallel
(``operators.aggregates``).  Several runs (a sweep) share the same pass.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import arrow_batches as AB
from tessera.operators.aggregates import BLOCK_SCHEMA, Shared, emit_blocks, sum_blocks
from tessera.operators.batches import batch_of, store_batches  # noqa: F401
from tessera.operators.lbfgs import minimise
from tessera.operators.stages import as_array_col

EPS = 1e-5  # the constant inside log(p + eps) of the first classifier's loss


def stepped_rate(rate: float, step: int, decay_steps: int | None, decay_rate: float | None) -> float:
    """``rate * decay_rate ** floor(step / decay_steps)`` (staircase decay)."""
    if not decay_steps or decay_rate is None:
        return rate
    return rate * decay_rate ** (step // decay_steps)


def stepped_rate_col(rate, step_col, decay_steps: int, decay_rate: float):
    """The same schedule as a column expression over a step column."""
    return F.lit(rate) * F.pow(F.lit(decay_rate), F.floor(F.col(step_col) / F.lit(decay_steps)))


def softmax_np(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    e = np.exp(z)
    return e / e.sum(axis=-1, keepdims=True)


def prepare_rows(df: DataFrame, label: str = "label", features: str = "x",
                 key: str | None = None) -> DataFrame:
    """``(k, label int, x array<double>)`` - the shape the passes read."""
    k = F.col(key).cast("long") if key else F.lit(0).cast("long")
    return df.select(k.alias("k"), F.col(label).cast("int").alias("label"),
                     as_array_col(df, features).alias("x"))


def softmax_pass(rows: DataFrame, Ws: np.ndarray, bs: np.ndarray, eps: float | None = None,
                 with_grad: bool = True, n_splits: int = 1) -> dict:
    """One job for ``R`` weight sets at once.

    ``Ws``: (R, d, c), ``bs``: (R, c).  Returns summed gradients of the
    per-row loss over split 0 (``gW`` (R, d, c), ``gb`` (R, c)) and, per
    split (rows carry a ``split`` column when ``n_splits > 1``), the summed
    loss under both forms (``loss_eps`` uses ``-log(p_y + 1e-5)``,
    ``loss_scores`` uses ``logsumexp(z) - z_y``), hit counts and ``n``
    (arrays of shape (n_splits, R) / (n_splits,)).  With ``eps`` the row
    gradient is ``(P - Y) * p_y / (p_y + eps)`` (the gradient of the
    ``log(p + eps)`` loss), else ``P - Y``.
    """
    Ws = np.asarray(Ws, dtype=np.float64)
    bs = np.asarray(bs, dtype=np.float64)
    R, d, c = Ws.shape
    S = n_splits
    shared = Shared(rows.sparkSession, (Ws.transpose(1, 0, 2).reshape(d, R * c), bs))
    weights = shared.handle

    def per_task(batches):
        Wcat, bs = weights.value
        gW = np.zeros((R, d, c))
        gb = np.zeros((R, c))
        le = np.zeros((S, R))
        ls = np.zeros((S, R))
        hit = np.zeros((S, R))
        n = np.zeros(S)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = AB.matrix(batch, "x", d)
            y = AB.vector(batch, "label", np.int64)
            sp = AB.vector(batch, "split", np.int64) if S > 1 else np.zeros(len(y), dtype=np.int64)
            rows_ = np.arange(len(y))
            # all runs in one matmul: (n, d) @ (d, R*c)
            Z = (X @ Wcat).reshape(len(y), R, c) + bs[None, :, :]
            P = softmax_np(Z)
            py = P[rows_, :, y]                                  # (n, R)
            zmax = Z.max(axis=2)
            l_eps = -np.log(py + EPS)
            l_sc = zmax + np.log(np.exp(Z - zmax[:, :, None]).sum(axis=2)) - Z[rows_, :, y]
            h = (np.argmax(Z, axis=2) == y[:, None])
            for k in range(S):
                m = sp == k
                if m.any():
                    le[k] += l_eps[m].sum(axis=0)
                    ls[k] += l_sc[m].sum(axis=0)
                    hit[k] += h[m].sum(axis=0)
                    n[k] += m.sum()
            if with_grad:
                m = sp == 0
                Xt, yt, Pt = (X, y, P) if m.all() else (X[m], y[m], P[m])
                D = Pt.copy()
                D[np.arange(len(yt)), :, yt] -= 1.0
                if eps is not None:
                    pyt = py[m] if not m.all() else py
                    D = D * (pyt / (pyt + eps))[:, :, None]
                gW += (Xt.T @ D.reshape(len(yt), R * c)).reshape(d, R, c).transpose(1, 0, 2)
                gb += D.sum(axis=0)
        parts = [le, ls, hit, n]
        if with_grad:
            parts = [gW, gb] + parts
        yield emit_blocks(np.concatenate([np.asarray(p, dtype=np.float64).ravel() for p in parts]))

    cols = ["label", "x"] + (["split"] if S > 1 else [])
    try:
        total = sum_blocks(rows.select(*cols).mapInArrow(per_task, BLOCK_SCHEMA))
    finally:
        shared.release()
    v = total.get(0)
    if v is None:  # not even an empty task
        v = np.zeros((R * (d + 1) * c if with_grad else 0) + (3 * R + 1) * S)
    out, o = {}, 0
    if with_grad:
        out["gW"] = v[o:o + R * d * c].reshape(R, d, c)
        o += R * d * c
        out["gb"] = v[o:o + R * c].reshape(R, c)
        o += R * c
    for name in ("loss_eps", "loss_scores", "hits"):
        out[name] = v[o:o + S * R].reshape(S, R)
        o += S * R
    out["n"] = v[o:o + S]
    if S == 1:
        for name in ("loss_eps", "loss_scores", "hits"):
            out[name] = out[name][0]
        out["n"] = out["n"][0]
    return out


@dataclass
class Run:
    """One training configuration of a sweep."""
    rate: float
    optimizer: str = "gd"            # "gd" or "adam"
    decay_steps: int | None = None
    decay_rate: float | None = None


class _Adam:
    """Adam with the constants of the original paper (b1 0.9, b2 0.999,
    eps 1e-8), in the form with the bias correction folded into the rate."""

    def __init__(self, shapes):
        self.m = [np.zeros(s) for s in shapes]
        self.v = [np.zeros(s) for s in shapes]
        self.t = 0

    def step(self, params, grads, rate, b1=0.9, b2=0.999, eps=1e-8):
        self.t += 1
        lr_t = rate * math.sqrt(1 - b2 ** self.t) / (1 - b1 ** self.t)
        out = []
        for i, (p, g) in enumerate(zip(params, grads)):
            self.m[i] = b1 * self.m[i] + (1 - b1) * g
            self.v[i] = b2 * self.v[i] + (1 - b2) * g * g
            out.append(p - lr_t * self.m[i] / (np.sqrt(self.v[i]) + eps))
        return out


def train_softmax(rows: DataFrame, runs: list[Run], rounds: int, d: int, c: int = 10,
                  eps: float | None = None, eval_sets: dict[str, DataFrame] | None = None,
                  eval_every: int = 1, batch_size: int | None = None):
    """Train every run for ``rounds`` rounds from zero weights; the gradient
    is the mean over the round's rows.  With ``batch_size`` the batch of a
    row is ``k div batch_size`` (its key) and round ``i`` uses batch
    ``min + i mod (max - min + 1)``; the rows are first stored by batch
    (``operators.batches``), so a round opens its batch only.  (Small batches suit
    one machine; on a cluster the full-batch form is the efficient one.)

    Evaluation shares the training scan: the rows of every eval set ride
    along in each round's pass (split ids 1..), which yields their metrics
    at the pass's weights; the metrics after round ``i``'s update are those
    of pass ``i + 1``, and one metrics-only pass follows the last round.

    Returns the final ``(Ws, bs)`` and a metrics list of
    ``(run, round, split, accuracy, loss_eps, loss_scores)`` taken after the
    update of every round ``i`` with ``i % eval_every == 0``; with batches also
    split "batch": each round's own batch before its update.
    """
    R = len(runs)
    Ws = np.zeros((R, d, c))
    bs = np.zeros((R, c))
    adams = {r: _Adam([(d, c), (c,)]) for r, run in enumerate(runs) if run.optimizer == "adam"}
    names = list(eval_sets or {})
    S = 1 + len(names)
    store = store_batches(rows, "k", batch_size) if batch_size is not None else None

    def source(i, evaluate):
        src = (store.rows(i) if store else rows).withColumn("split", F.lit(0))
        for j, name in enumerate(names if evaluate else []):
            src = src.unionByName(eval_sets[name].withColumn("split", F.lit(j + 1)))
        return src

    wanted = {i + 1 for i in range(rounds) if i % eval_every == 0} if names else set()
    metrics = []

    def record(res, after_round):
        for j, name in enumerate(names):
            nn = res["n"][j + 1]
            for r in range(R):
                metrics.append((r, after_round, name, res["hits"][j + 1][r] / nn,
                                res["loss_eps"][j + 1][r] / nn, res["loss_scores"][j + 1][r] / nn))

    try:
        for i in range(rounds + (1 if rounds in wanted else 0)):
            last = i == rounds
            res = softmax_pass(source(i, i in wanted), Ws, bs, eps=eps, with_grad=not last, n_splits=S)
            if i in wanted:
                record(res, i - 1)
            if last:
                break
            n = res["n"][0] if S > 1 else res["n"]
            if n == 0 and store is None:
                raise ValueError("no rows")
            if n == 0:
                continue  # a batch id with no rows (a gap in the keys): no step
            if batch_size is not None:
                own = [res[k][0] if S > 1 else res[k] for k in ("hits", "loss_eps", "loss_scores")]
                metrics += [(r, i, "batch", *(float(v[r]) / n for v in own)) for r in range(R)]
            for r, run in enumerate(runs):
                gW, gb = res["gW"][r] / n, res["gb"][r] / n
                rate = stepped_rate(run.rate, i, run.decay_steps, run.decay_rate)
                if run.optimizer == "adam":
                    Ws[r], bs[r] = adams[r].step([Ws[r], bs[r]], [gW, gb], rate)
                else:
                    Ws[r], bs[r] = Ws[r] - rate * gW, bs[r] - rate * gb
    finally:
        if store:
            store.drop()
    metrics.sort(key=lambda t: (t[1], ["batch", *names].index(t[2]), t[0]))
    return Ws, bs, metrics


def fit_softmax(rows: DataFrame, d: int, c: int = 10, l2: float = 0.0, max_iter: int = 100, tol: float = 1e-9):
    """Softmax regression to its optimum by L-BFGS from zero weights: mean
    cross-entropy (from scores) plus ``l2 / 2`` times the squared weights, without the
    bias.  ``rows`` as in ``softmax_pass``, best persisted.  Returns ``(W, b, Minimum)``."""
    def parts(x):
        return x[:d * c].reshape(d, c), x[d * c:]

    def losses(points):
        Ws, bs = zip(*(parts(x) for x in points))
        res = softmax_pass(rows, np.stack(Ws), np.stack(bs), with_grad=False)
        if res["n"] == 0:
            raise ValueError("no rows")
        return res["loss_scores"] / res["n"] + np.array([0.5 * l2 * (W * W).sum() for W in Ws])

    def gradient(x):
        W, b = parts(x)
        res = softmax_pass(rows, W[None], b[None])
        return np.concatenate([(res["gW"][0] / res["n"] + l2 * W).ravel(), res["gb"][0] / res["n"]])

    found = minimise(losses, gradient, np.zeros((d + 1) * c), max_iter, tol=tol)
    return *parts(found.x), found


def weights_long(W: np.ndarray, b: np.ndarray, digits: int = 6):
    """``(j, c, w)`` rows with the bias as feature ``j = d``."""
    d, c = W.shape
    full = np.vstack([W, b[None, :]])
    return [(int(j), int(k), float(round(full[j, k], digits)) + 0.0)
            for j in range(d + 1) for k in range(c)]
