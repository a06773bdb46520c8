"""Dense networks: layered scoring in Arrow batches, and training by
summed per-task back-propagation gradients (GD or Adam, optional dropout).

Scoring is one ``mapInArrow`` over the rows with the layer weights captured
in the closure (their size is fixed by the architecture).  Training runs one
job per round; each task back-propagates its own rows and emits one flat
gradient vector, summed block-wise in parallel reducers.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import arrow_batches as AB
from tessera.operators.aggregates import BLOCK_SCHEMA, Shared, emit_blocks, sum_blocks
from tessera.operators.classification import EPS, _Adam, softmax_np, stepped_rate
from tessera.operators.lbfgs import Minimum, minimise


def _act(name):
    if name == "relu":
        return (lambda a: np.maximum(a, 0.0)), (lambda a, h: (a > 0).astype(np.float64))
    if name == "sigmoid":
        return (lambda a: 1.0 / (1.0 + np.exp(-a))), (lambda a, h: h * (1.0 - h))
    raise ValueError(f"unknown activation {name}")


def forward_np(X, layers, hidden="relu"):
    """Scores of the last layer (no softmax) for a batch."""
    f, _ = _act(hidden)
    h = X
    for i, (W, b) in enumerate(layers):
        a = h @ W + b
        h = a if i == len(layers) - 1 else f(a)
    return h


def score_rows(rows: DataFrame, layers, hidden: str = "relu", key: str = "vec_id",
               features: str = "x", out: str = "scores", digits: int | None = 6,
               carry: tuple[str, ...] = ()) -> DataFrame:
    """``(key, *carry, scores array<double>)`` by the network ``layers``;
    ``carry`` columns pass through the batch untouched (no re-join)."""
    # the scan may run one task per input split: large weights go out once
    # per executor (kept for the life of the returned DataFrame)
    weights = Shared(rows.sparkSession, [(np.asarray(W, float), np.asarray(b, float))
                                         for W, b in layers]).handle
    keep = [key, *carry]

    def per_batch(batches):
        layers = weights.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            Z = forward_np(AB.matrix(batch, features), layers, hidden)
            if digits is not None:
                Z = np.round(Z, digits) + 0.0
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(cols + [AB.list_column(Z)], names=keep + [out])

    fields = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    return rows.select(*keep, features).mapInArrow(per_batch, f"{fields}, `{out}` array<double>")


def truncated_normal(rng, shape, std=0.1):
    """Normal draws re-drawn until within two standard deviations."""
    out = rng.normal(0.0, std, size=shape)
    bad = np.abs(out) > 2 * std
    while bad.any():
        out[bad] = rng.normal(0.0, std, size=bad.sum())
        bad = np.abs(out) > 2 * std
    return out


def init_layers(sizes, seed=0, std=0.1, bias=0.0):
    rng = np.random.default_rng(seed)
    return [(truncated_normal(rng, (a, b), std), np.full(b, float(bias)))
            for a, b in zip(sizes[:-1], sizes[1:])]


#: Modulus and multipliers of the mask's hash: small enough for 64-bit products.
MASK_MODULUS = (1 << 31) - 1
MASK_STEPS = (48271, 69621, 40692, 16807)


def dropout_mask(keys, layer: int, width: int, round_: int, seed: int, keep: float):
    """Keep-mask from a hash of (row key, unit, layer, round, seed): the same
    on every re-execution of a task, so a lost executor changes nothing."""
    m, (a, b, c, d) = MASK_MODULUS, MASK_STEPS
    k = np.asarray(keys, dtype=np.int64)[:, None] % m
    u = np.arange(width, dtype=np.int64)[None, :]
    h = (k * a + u * b + layer * c + round_ * d + seed) % m
    h = h * a % m
    h = (h ^ (h >> 13)) * b % m
    return h < keep * m


def backprop_np(X, y, keys, layers, hidden, keep, round_, seed, c, inputs=False):
    """Summed gradients of the mean-less cross-entropy (from scores) for a
    batch, plus loss and hits; dropout after every hidden layer.  With ``inputs``
    also the gradient by ``X``."""
    f, df = _act(hidden)
    hs, acts, masks = [X], [], []
    h = X
    for i, (W, b) in enumerate(layers):
        a = h @ W + b
        acts.append(a)
        if i == len(layers) - 1:
            h = a
        else:
            h = f(a)
            if keep < 1.0:
                m = dropout_mask(keys, i, h.shape[1], round_, seed, keep)
                masks.append(m)
                h = h * m / keep
            else:
                masks.append(None)
        hs.append(h)
    P = softmax_np(h)
    Y = np.zeros_like(P)
    Y[np.arange(len(y)), y] = 1.0
    D = P - Y
    grads = []
    for i in range(len(layers) - 1, -1, -1):
        W, b = layers[i]
        grads.append((hs[i].T @ D, D.sum(axis=0)))
        if i > 0 or inputs:
            D = D @ W.T
        if i > 0:
            if masks[i - 1] is not None:
                D = D * masks[i - 1] / keep
            D = D * df(acts[i - 1], f(acts[i - 1]))
    grads.reverse()
    py = P[np.arange(len(y)), y]
    out = grads, float(-np.log(py + EPS).sum()), float((P.argmax(axis=1) == y).sum())
    return (*out, D) if inputs else out


@dataclass
class DenseRun:
    """One configuration of a dense network's training."""
    rate: float
    keep_prob: float = 1.0
    optimizer: str = "adam"
    decay_steps: int | None = None
    decay_rate: float | None = None


def dense_nets_fit(rows: DataFrame, sizes, rounds: int, runs: list[DenseRun], hidden: str = "relu", seed: int = 0,
                   start=None, eval_rows: DataFrame | None = None, eval_every: int = 1):
    """Train a dense network per run; ``rows`` has ``(k, label, x)`` (see
    ``classification.prepare_rows``) and should be persisted by the caller.
    All runs share one job a round, and the rows of ``eval_rows`` ride along:
    what a pass says of them belongs to the weights before its update, and one
    more pass follows the last round.

    ``start``: the layers to begin with (default: truncated normal draws by
    ``seed``).  Returns the layers per run and metrics ``(run, round, split,
    loss, accuracy)``: split "train" from the pass of each round, under its
    dropout; "eval" at keep probability 1 for rounds divisible by ``eval_every``
    and for ``round = rounds``, the final weights."""
    first = start if start is not None else init_layers(sizes, seed)
    return nets_fit(rows, first, rounds, runs,
                    lambda net, X, y, keys, keep, i: backprop_np(X, y, keys, net, hidden, keep, i, seed, sizes[-1]),
                    lambda net, X: forward_np(X, net, hidden), eval_rows, eval_every)


def nets_fit(rows: DataFrame, first, rounds: int, runs: list[DenseRun], gradient, scores,
             eval_rows: DataFrame | None = None, eval_every: int = 1):
    """The rounds of ``dense_nets_fit`` for networks of any kind.  ``first``: the
    start as (weights, bias) of any shape; ``gradient(net, X, y, keys, keep, round)``
    gives a batch's summed gradients in that form, its loss and its hits;
    ``scores(net, X)`` the scores.  Both run inside the tasks."""
    nets = [[(W.copy(), b.copy()) for W, b in first] for _ in runs]
    shapes = [s for W, b in first for s in (W.shape, b.shape)]
    flat_size = sum(int(np.prod(s)) for s in shapes)
    adams = [_Adam(shapes) if run.optimizer == "adam" else None for run in runs]
    metrics, R = [], len(runs)
    both = rows.select("k", "label", "x").withColumn("split", F.lit(0))
    if eval_rows is not None:
        both = both.unionByName(eval_rows.select("k", "label", "x").withColumn("split", F.lit(1)))
    for i in range(rounds + (eval_rows is not None)):
        last = i == rounds
        evaluate = eval_rows is not None and (last or i % eval_every == 0)
        src = both if evaluate else both.filter("split = 0")
        if last:
            src = both.filter("split = 1")
        shared = Shared(rows.sparkSession, nets)
        weights = shared.handle

        def per_task(batches, weights=weights, i=i):
            grads, stats, n = np.zeros((R, flat_size)), np.zeros((R, 2, 2)), np.zeros(2)
            for batch in batches:
                if batch.num_rows == 0:
                    continue
                split = AB.vector(batch, "split", np.int64)
                X_all, y_all, k_all = AB.matrix(batch, "x"), AB.vector(batch, "label", np.int64), AB.vector(batch, "k", np.int64)
                for part in (0, 1):
                    own = split == part
                    if not own.any():
                        continue
                    X, y, keys = X_all[own], y_all[own], k_all[own]
                    n[part] += len(y)
                    for r, net in enumerate(weights.value):
                        if part == 0:
                            g, loss, hits = gradient(net, X, y, keys, runs[r].keep_prob, i)
                            grads[r] += np.concatenate([a.ravel() for pair in g for a in pair])
                        else:
                            P = softmax_np(scores(net, X))
                            loss, hits = -np.log(P[np.arange(len(y)), y] + EPS).sum(), (P.argmax(axis=1) == y).sum()
                        stats[r, part] += loss, hits
            yield emit_blocks(np.concatenate([grads.ravel(), stats.ravel(), n]))

        try:
            v = sum_blocks(src.mapInArrow(per_task, BLOCK_SCHEMA))[0]
        finally:
            shared.release()
        n = v[-2:]
        stats = v[R * flat_size:-2].reshape(R, 2, 2)
        if n[0] == 0 and not last:
            raise ValueError("no training rows")
        for part, name in ((0, "train"), (1, "eval")):
            if n[part]:
                metrics += [(r, i, name, *(stats[r, part] / n[part])) for r in range(R)]
        if last:
            break
        grads = v[:R * flat_size].reshape(R, flat_size) / n[0]
        for r, run in enumerate(runs):
            parts, o = [], 0
            for s in shapes:
                size = int(np.prod(s))
                parts.append(grads[r, o:o + size].reshape(s))
                o += size
            params = [a for W, b in nets[r] for a in (W, b)]
            lr = stepped_rate(run.rate, i, run.decay_steps, run.decay_rate)
            params = adams[r].step(params, parts, lr) if adams[r] else [p - lr * g for p, g in zip(params, parts)]
            nets[r] = [(params[2 * j], params[2 * j + 1]) for j in range(len(first))]
    return nets, metrics


def dense_net_fit(rows: DataFrame, sizes, rounds: int, rate: float, optimizer: str = "adam",
                  hidden: str = "relu", keep_prob: float = 1.0, seed: int = 0,
                  decay_steps: int | None = None, decay_rate: float | None = None,
                  init_bias: float = 0.0, start=None):
    """One run of ``dense_nets_fit``: its layers and a per-round
    ``(round, loss, accuracy)`` list of the training pass (under dropout,
    before the update)."""
    first = start if start is not None else init_layers(sizes, seed, bias=init_bias)
    nets, metrics = dense_nets_fit(rows, sizes, rounds, [DenseRun(rate, keep_prob, optimizer, decay_steps, decay_rate)],
                                   hidden, seed, first)
    return nets[0], [(i, loss, hits) for _, i, _, loss, hits in metrics]


def flat(layers) -> np.ndarray:
    """All weights in one vector: per layer and output unit its weights, then its bias."""
    return np.concatenate([np.vstack([W, b]).T.ravel() for W, b in layers])


def layered(x: np.ndarray, sizes):
    """The layers of a vector as ``flat`` makes it."""
    out, at = [], 0
    for a, b in zip(sizes[:-1], sizes[1:]):
        unit = x[at:at + (a + 1) * b].reshape(b, a + 1)
        out.append((unit[:, :a].T, unit[:, a]))
        at += (a + 1) * b
    return out


def dense_net_lbfgs(rows: DataFrame, start, max_iter: int, hidden: str = "sigmoid", memory: int = 10, tol: float = 1e-9) -> tuple[list, Minimum]:
    """Train a dense network on all rows (``label``, ``x``) by L-BFGS from the layers
    ``start``; the loss is the mean cross-entropy from scores.  Two jobs an iteration:
    the losses at all tried steps, and the gradient.  ``rows`` are best persisted."""
    sizes = [start[0][0].shape[0], *[len(b) for _, b in start]]
    c = sizes[-1]

    def run(points, kernel, width):
        shared = Shared(rows.sparkSession, [layered(x, sizes) for x in points])
        nets = shared.handle

        def per_task(batches):
            total = np.zeros(width + 1)
            for batch in batches:
                if batch.num_rows:
                    X, y = AB.matrix(batch, "x", sizes[0]), AB.vector(batch, "label", np.int64)
                    total[:-1] += kernel(nets.value, X, y)
                    total[-1] += len(y)
            yield emit_blocks(total)

        try:
            v = sum_blocks(rows.select("label", "x").mapInArrow(per_task, BLOCK_SCHEMA)).get(0, np.zeros(width + 1))
        finally:
            shared.release()
        if not v[-1]:
            raise ValueError("no training rows")
        return v[:-1] / v[-1]

    def loss_kernel(nets, X, y):
        out = []
        for net in nets:
            Z = forward_np(X, net, hidden)
            top = Z.max(axis=1)
            out.append((top + np.log(np.exp(Z - top[:, None]).sum(axis=1)) - Z[np.arange(len(y)), y]).sum())
        return np.array(out)

    def gradient_kernel(nets, X, y):
        return flat(backprop_np(X, y, None, nets[0], hidden, 1.0, 0, 0, c)[0])

    first = flat(start)
    found = minimise(lambda points: run(points, loss_kernel, len(points)), lambda x: run([x], gradient_kernel, len(first)),
                     first, max_iter, memory, tol)
    return layered(found.x, sizes), found
