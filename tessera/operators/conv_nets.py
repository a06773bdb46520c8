"""Training of stacked convolutions with dense layers on top.

A network is a list of ``(weights, bias)``: kernels ``(k, k, ci, co)`` first, then
dense matrices; ReLU follows every layer but the last, dropout every hidden dense
layer.  A round is one job as in ``networks.nets_fit``: tasks take their images some
at a time forward and back, add the gradients up and emit them once as blocks, so
nothing but weights and their gradients travels, and all runs of a sweep share the pass.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tessera.operators.conv import conv2d_back, conv2d_np, conv_stack_forward
from tessera.operators.networks import DenseRun, backprop_np, nets_fit, truncated_normal

IMAGES_AT_ONCE = 512  # forward and back through all layers; bounds a task's memory


def init_conv_net(kernels, dense_sizes, h: int, w: int, strides, seed: int = 0, std: float = 0.1, bias: float = 0.1):
    """Truncated normal weights and constant biases.  ``kernels``: ``(k, ci, co)`` of every
    convolution; ``dense_sizes``: the widths after the flattened last one."""
    rng = np.random.default_rng(seed)
    for s in strides:
        h, w = -(-h // s), -(-w // s)
    shapes = [(k, k, ci, co) for k, ci, co in kernels]
    widths = [h * w * kernels[-1][2], *dense_sizes]
    return [(truncated_normal(rng, s, std), np.full(s[-1], float(bias))) for s in shapes + list(zip(widths[:-1], widths[1:]))]


def conv_scores(X: np.ndarray, net, strides, h: int, w: int) -> np.ndarray:
    """Scores of a batch of flat images, ``IMAGES_AT_ONCE`` at a time."""
    convs = [(W, b, s) for (W, b), s in zip(net, strides)]
    parts = [conv_stack_forward(X[lo:lo + IMAGES_AT_ONCE], convs, net[len(convs):], h, w) for lo in range(0, len(X), IMAGES_AT_ONCE)]
    return np.concatenate(parts) if parts else np.zeros((0, len(net[-1][1])))


def _backprop_some(X, y, keys, net, strides, h, w, keep, round_, seed):
    m = len(strides)
    acts = [X.reshape(len(X), h, w, -1)]
    for (W, b), s in zip(net, strides):
        acts.append(np.maximum(conv2d_np(acts[-1], W, s) + b, 0.0))
    top, loss, hits, D = backprop_np(acts[-1].reshape(len(X), -1), y, keys, net[m:], "relu", keep, round_, seed, len(net[-1][1]), inputs=True)
    D, grads = D.reshape(acts[-1].shape), []
    for j in range(m - 1, -1, -1):
        D = D * (acts[j + 1] > 0)
        gW, back = conv2d_back(acts[j], net[j][0], strides[j], D, inputs=j > 0)
        grads.append((gW, D.sum(axis=(0, 1, 2))))
        D = back
    return grads[::-1] + top, loss, hits


def conv_backprop(X, y, keys, net, strides, h: int, w: int, keep: float = 1.0, round_: int = 0, seed: int = 0):
    """Summed gradients of the cross-entropy for a batch of flat images, in the form of
    ``net``, with the summed loss and the hits."""
    total, loss, hits = [(np.zeros_like(W, dtype=float), np.zeros(len(b))) for W, b in net], 0.0, 0.0
    for lo in range(0, len(X), IMAGES_AT_ONCE):
        part = slice(lo, lo + IMAGES_AT_ONCE)
        g, one, right = _backprop_some(X[part], y[part], keys[part], net, strides, h, w, keep, round_, seed)
        for (tW, tb), (gW, gb) in zip(total, g):
            tW += gW
            tb += gb
        loss, hits = loss + one, hits + right
    return total, loss, hits


def conv_nets_fit(rows: DataFrame, start, strides, h: int, w: int, rounds: int, runs: list[DenseRun], seed: int = 0,
                  eval_rows: DataFrame | None = None, eval_every: int = 1):
    """Train a network per run from ``start`` (see ``init_conv_net``) on ``rows`` of ``(k, label, x)``,
    ``x`` flat row-major images of ``h`` by ``w``, channels last; ``len(strides)`` layers are
    convolutions.  Rows are best persisted, since a round is a job over them.  Returns the networks and the
    metrics ``(run, round, split, loss, accuracy)``, as ``networks.dense_nets_fit`` does."""
    strides = tuple(strides)
    return nets_fit(rows, start, rounds, runs,
                    lambda net, X, y, keys, keep, i: conv_backprop(X, y, keys, net, strides, h, w, keep, i, seed),
                    lambda net, X: conv_scores(X, net, strides, h, w), eval_rows, eval_every)
