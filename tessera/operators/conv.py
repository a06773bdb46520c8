"""2-D convolution with SAME padding over images stored as rows.

An image arrives as one row, so a layer is numpy per Arrow batch, without join
or shuffle; its result leaves as one flat array per image, taken apart by
``posexplode`` where rows per position are wanted.  SAME padding:
``out = ceil(in / s)``, ``pad = max((out - 1) s + k - in, 0)``, the smaller half
before; the kernel is not flipped.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import arrow_batches as AB
from tessera.operators.aggregates import Shared


def same_geometry(size: int, k: int, stride: int):
    out = math.ceil(size / stride)
    pad = max((out - 1) * stride + k - size, 0)
    return out, pad // 2


def grid_rows(rows: DataFrame, key: str, vec: str, w: int) -> DataFrame:
    """Flat row-major arrays to one row per grid line: ``(id, r, grid_row)``;
    slices of the array, no shuffle."""
    n_rows = F.ceil(F.size(vec) / F.lit(w)).cast("int")
    lines = F.transform(F.sequence(F.lit(0), n_rows - 1), lambda i: F.slice(vec, i * w + 1, w))
    return rows.select(F.col(key).alias("id"), F.posexplode(lines).alias("r", "grid_row"))


def grid_flatten(lines: DataFrame) -> DataFrame:
    """Back from grid lines to flat arrays: ``(id, flat)``.  One group per
    image (its lines only), ordered by line number before concatenating."""
    g = lines.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("r", "grid_row"))).alias("ls"))
    return g.select("id", F.flatten(F.transform("ls", lambda t: t["grid_row"])).alias("flat"))


def _padded(X: np.ndarray, k: int, stride: int):
    """``X`` with its SAME padding, the output's height and width, and the
    padding above and to the left."""
    n, h, w, ci = X.shape
    oh, pt = same_geometry(h, k, stride)
    ow, pl = same_geometry(w, k, stride)
    ph = max((oh - 1) * stride + k - h, 0)
    pw = max((ow - 1) * stride + k - w, 0)
    Xp = np.zeros((n, h + ph, w + pw, ci))
    Xp[:, pt:pt + h, pl:pl + w, :] = X
    return Xp, oh, ow, pt, pl


def _taps(k: int, oh: int, ow: int, stride: int):
    """Every kernel place with the slices of the padded image that it meets."""
    for ky in range(k):
        for kx in range(k):
            yield ky, kx, slice(ky, ky + (oh - 1) * stride + 1, stride), slice(kx, kx + (ow - 1) * stride + 1, stride)


def conv2d_np(X: np.ndarray, W: np.ndarray, stride: int) -> np.ndarray:
    """Batch ``X`` (n, h, w, ci), kernel (k, k, ci, co) -> (n, oh, ow, co)."""
    Xp, oh, ow, _, _ = _padded(X, W.shape[0], stride)
    out = np.zeros((len(X), oh, ow, W.shape[3]))
    for ky, kx, ys, xs in _taps(W.shape[0], oh, ow, stride):
        out += Xp[:, ys, xs, :] @ W[ky, kx]
    return out


def conv2d_back(X: np.ndarray, W: np.ndarray, stride: int, D: np.ndarray, inputs: bool = True):
    """Back through ``conv2d_np``: the loss's gradients by the kernel and (unless
    not ``inputs``) by ``X``, from those by the output, ``D`` (n, oh, ow, co).  A tap's
    kernel gradient is its patches times the deltas; the deltas times its weights
    are scattered to the places that the tap read, and the padding is cut off."""
    Xp, oh, ow, pt, pl = _padded(X, W.shape[0], stride)
    flat = D.reshape(-1, D.shape[3])
    gW, gXp = np.zeros_like(W), np.zeros_like(Xp) if inputs else None
    for ky, kx, ys, xs in _taps(W.shape[0], oh, ow, stride):
        gW[ky, kx] = Xp[:, ys, xs, :].reshape(-1, X.shape[3]).T @ flat
        if inputs:
            gXp[:, ys, xs, :] += D @ W[ky, kx].T
    return gW, gXp[:, pt:pt + X.shape[1], pl:pl + X.shape[2], :] if inputs else None


def conv_stack_forward(X: np.ndarray, convs, dense, h: int, w: int) -> np.ndarray:
    """Convolutions (each ``(W, b, stride)`` with ReLU), flatten, dense ReLU
    layers, and a final linear layer: the scores."""
    a = X.reshape(len(X), h, w, -1)
    for W, b, s in convs:
        a = np.maximum(conv2d_np(a, W, s) + b, 0.0)
    a = a.reshape(len(a), -1)
    for i, (W, b) in enumerate(dense):
        a = a @ W + b
        if i < len(dense) - 1:
            a = np.maximum(a, 0.0)
    return a


def score_conv_stack(rows: DataFrame, convs, dense, h: int, w: int, key: str = "vec_id",
                     features: str = "x", digits: int = 6) -> DataFrame:
    """``(key, scores)`` by the stacked network, one numpy pass per batch."""
    shared = Shared(rows.sparkSession, (list(convs), list(dense))).handle

    def per_batch(batches):
        convs_, dense_ = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = AB.matrix(batch, features)
            Z = np.round(conv_stack_forward(X, convs_, dense_, h, w), digits) + 0.0
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)),
                                              AB.list_column(Z)], names=[key, "scores"])

    kt = rows.schema[key].dataType.simpleString()
    return rows.select(key, features).mapInArrow(per_batch, f"{key} {kt}, scores array<double>")


def conv2d_rows(rows: DataFrame, kernel: np.ndarray, h: int, w: int, stride: int, bias: np.ndarray | None = None,
                relu: bool = False, key: str = "vec_id", features: str = "x") -> DataFrame:
    """One SAME convolution of flat row-major images (channels last):
    ``(key, oy, ox, co, value)``."""
    co = kernel.shape[3]
    ow = same_geometry(w, kernel.shape[0], stride)[0]
    shared = Shared(rows.sparkSession, (kernel, np.zeros(co) if bias is None else np.asarray(bias, float))).handle

    def per_batch(batches):
        kern, b = shared.value
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = AB.matrix(batch, features)
            Z = conv2d_np(X.reshape(len(X), h, w, -1), kern, stride) + b
            Z = np.maximum(Z, 0.0) if relu else Z
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)),
                                              AB.list_column(Z.reshape(len(Z), -1))], names=[key, "flat"])

    kt = rows.schema[key].dataType.simpleString()
    flat = rows.select(key, features).mapInArrow(per_batch, f"{key} {kt}, flat array<double>")
    line = ow * co
    return flat.select(key, F.posexplode("flat").alias("pos", "value")).select(
        key, F.expr(f"cast(pos div {line} as int)").alias("oy"), F.expr(f"cast(pos % {line} div {co} as int)").alias("ox"),
        F.expr(f"pos % {co}").alias("co"), "value")
