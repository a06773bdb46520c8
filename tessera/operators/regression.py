"""Linear regression by gradient descent, in one pass over the data.

With rows and labels taken relative to a centre ``(c, c0)`` - one of the rows -
the residual is ``k + u.w - v`` (``u = x - c``, ``v = y - c0``, ``k = c.w - c0``),
so the gradient and the squared error of any weights follow from
``n, sum u, sum v, U'U, U'v, v'v``.  One distributed pass (``mapInArrow``
partial sums per task, summed per block id) yields them; every round then runs
on the driver in ``d x d`` - a size bound set by the width, never by the row
count.  The caller may ask for ``solver="rounds"`` instead: one distributed
gradient job per round, with nothing wider than ``d``; the right choice where
``d x d`` numbers per task or on the driver are too many.  Grouping the pass by
fold gives every cross-validation fit from the same scan: training sums are
total minus fold.  Reported errors come from a direct pass over the rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasLabelCol, HasMaxIter,
                                     HasPredictionCol, HasStepSize)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import arrow_batches as AB
from tessera.operators.aggregates import BLOCK_SCHEMA, Shared, emit_blocks, sum_blocks
from tessera.operators.stages import as_array_col
from tessera.session import materialize, release

SOLVERS = ("gram", "rounds")


# ---------------------------------------------------------------- sums pass --

@dataclass
class GramStats:
    """Sufficient statistics of a least-squares problem without intercept,
    as sums relative to the centre ``(c, c0)``."""
    c: np.ndarray
    c0: float
    n: float
    su: np.ndarray
    sv: float
    uu: np.ndarray
    uv: np.ndarray
    vv: float

    @property
    def d(self) -> int:
        return len(self.c)

    def _combine(self, o: "GramStats", sign: float) -> "GramStats":
        if not (np.array_equal(self.c, o.c) and self.c0 == o.c0):
            raise ValueError("sums around different centres")
        return GramStats(self.c, self.c0, self.n + sign * o.n, self.su + sign * o.su, self.sv + sign * o.sv,
                         self.uu + sign * o.uu, self.uv + sign * o.uv, self.vv + sign * o.vv)

    def __add__(self, o: "GramStats") -> "GramStats":
        return self._combine(o, 1.0)

    def __sub__(self, o: "GramStats") -> "GramStats":
        return self._combine(o, -1.0)

    def subset(self, idx) -> "GramStats":
        i = np.asarray(idx)
        return GramStats(self.c[i], self.c0, self.n, self.su[i], self.sv, self.uu[np.ix_(i, i)], self.uv[i], self.vv)

    @property
    def G(self) -> np.ndarray:
        """``X'X`` of the rows as they are."""
        cross = np.outer(self.su, self.c)
        return self.uu + cross + cross.T + self.n * np.outer(self.c, self.c)

    def gradient(self, w: np.ndarray) -> np.ndarray:
        """``sum (w.x - y) x``."""
        k = self.c @ w - self.c0
        return self.c * (self.n * k + self.su @ w - self.sv) + k * self.su + self.uu @ w - self.uv

    def sse(self, w: np.ndarray) -> float:
        """``sum (w.x - y)^2``; raises where rounding has left nothing of it."""
        k = self.c @ w - self.c0
        parts = (self.n * k * k, 2.0 * k * (self.su @ w - self.sv), w @ self.uu @ w, -2.0 * (w @ self.uv), self.vv)
        total, size = float(sum(parts)), float(sum(abs(p) for p in parts))
        if total < -1e-9 * size:
            raise FloatingPointError("squared error below zero: the sums do not belong together")
        return max(total, 0.0)

    def rmse(self, w: np.ndarray) -> float:
        return math.sqrt(self.sse(w) / self.n)


def _prepared(df: DataFrame, label: str, features: str, group: str | None) -> DataFrame:
    g = F.col(group).cast("int") if group else F.lit(0)
    return df.select(g.alias("grp"), F.col(label).cast("double").alias("y"),
                     as_array_col(df, features).alias("x"))


_WIDTH_KEY = 1 << 24  # key = group * 2^24 + width
MAX_GROUPS = 4096     # of a grouped pass, by default: each brings d^2 / 2 numbers to the driver
ROWS_AT_ONCE = 2048   # that are expanded at a time


def _centre(prepared: DataFrame) -> tuple[np.ndarray, float]:
    """Features and label of one row, to take the sums around."""
    first = prepared.select("x", "y").head(1)
    if not first:
        raise ValueError("no training rows")
    x, y = first[0]
    if x is None or any(v is None for v in x):
        raise ValueError("null feature vectors or elements")
    if y is None:
        raise ValueError("null labels")
    return np.array(x, dtype=np.float64), float(y)


def gram_sums(df: DataFrame, label: str = "label", features: str = "features",
              group: str | None = None, centre: tuple[np.ndarray, float] | None = None, degree: int = 1) -> DataFrame:
    """Per-task partial sums of ``[upper-triangle U'U, U'v, sum u, sum v, v'v, n]``,
    one block vector per group and task, keyed ``(key, blk, salt, part)`` with
    ``key = group * 2^24 + width``.  A task emits a handful of rows whatever
    its size, and partial aggregation happens before the shuffle.

    With ``degree=2`` the rows stay as wide as they are: they are expanded inside the
    task, some at a time.  The sums are then far larger than a row, so scan tasks
    are combined, without a shuffle, to one for each core, and each emits its blocks once."""
    prepared = _prepared(df, label, features, group)
    x, y = centre or _centre(prepared)
    shared = Shared(df.sparkSession, (AB.expanded(x[None, :], degree)[0], y)).handle
    width = len(x)
    if degree > 1:
        prepared = prepared.coalesce(df.sparkSession.sparkContext.defaultParallelism)

    def per_task(batches):
        c, c0 = shared.value
        d = len(c)
        acc: dict[int, list] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE if degree > 1 else max(batch.num_rows, 1)):
                part = batch.slice(lo, ROWS_AT_ONCE) if degree > 1 else batch
                grp = AB.vector(part, "grp", np.int64)
                v_all = AB.vector(part, "y") - c0
                if np.isnan(v_all).any():
                    raise ValueError("labels that are not numbers")
                u_all = AB.expanded(AB.matrix(part, "x", width), degree) - c
                for g in np.unique(grp):
                    sel = grp == g
                    U, v = (u_all, v_all) if sel.all() else (u_all[sel], v_all[sel])
                    cur = acc.setdefault(int(g), [np.zeros((d, d)), np.zeros(d), np.zeros(d), 0.0, 0.0, 0.0])
                    for i, add in enumerate((U.T @ U, U.T @ v, U.sum(axis=0), float(v.sum()), float(v @ v), float(len(v)))):
                        cur[i] += add
        iu, ju = np.triu_indices(d)
        for g in list(acc):
            uu, uv, su, sv, vv, n = acc.pop(g)
            yield emit_blocks(np.concatenate([uu[iu, ju], uv, su, [sv, vv, n]]), key=g * _WIDTH_KEY + d)

    return prepared.mapInArrow(per_task, BLOCK_SCHEMA)


def gram_stats(df: DataFrame, label: str = "label", features: str = "features",
               group: str | None = None, degree: int = 1, max_groups: int = MAX_GROUPS) -> dict[int, GramStats]:
    """The summary per group (key 0 without one): ``#groups x d^2 / 2`` numbers
    reach the driver, bounded by the (expanded) width and ``max_groups``; more
    groups are an error before the pass begins."""
    prepared = _prepared(df, label, features, group)
    x, c0 = _centre(prepared)
    if group and (found := prepared.agg(F.approx_count_distinct("grp")).first()[0]) > max_groups:
        raise ValueError(f"about {found} groups; at most {max_groups} summaries fit the driver")
    c = AB.expanded(x[None, :], degree)[0]
    out: dict[int, GramStats] = {}
    d = len(c)
    t = d * (d + 1) // 2
    iu, ju = np.triu_indices(d)
    for key, s in sum_blocks(gram_sums(df, label, features, group, (x, c0), degree)).items():
        uu = np.zeros((d, d))
        uu[iu, ju] = uu[ju, iu] = s[:t]
        uv, su = s[t:t + d].copy(), s[t + d:t + 2 * d].copy()
        sv, vv, n = (float(v) for v in s[t + 2 * d:])
        out[int(key) // _WIDTH_KEY] = GramStats(c, c0, n, su, sv, uu, uv, vv)
    return out


def added(per_group: dict[int, GramStats]) -> GramStats:
    """The sums of all groups, in the order of their keys."""
    keys = sorted(per_group)
    total = per_group[keys[0]]
    for g in keys[1:]:
        total = total + per_group[g]
    return total


# ------------------------------------------------------------- descent rounds --

def _step(w, gradient, n, i, alpha):
    w = w - (alpha / (n * math.sqrt(i + 1))) * gradient
    if not np.all(np.isfinite(w)):
        raise FloatingPointError(f"weights diverged at round {i + 1}; scale the features")
    return w


def descend(stats: GramStats, iters: int, alpha: float = 1.0,
            record: set[int] | None = None):
    """Rounds of ``w -= alpha / (n sqrt(i+1)) X'(Xw - y)`` from ``w = 0``; the
    error curve holds the training RMSE before each update.  Returns the
    final weights, the curve and the weights after each round in ``record``."""
    if stats.n <= 0:
        raise ValueError("no training rows")
    w = np.zeros(stats.d)
    err = np.empty(iters)
    kept = {}
    # overflow on the way to divergence is expected; it is reported below
    with np.errstate(over="ignore", invalid="ignore"):
        for i in range(iters):
            err[i] = stats.rmse(w)
            w = _step(w, stats.gradient(w), stats.n, i, alpha)
            if record and (i + 1) in record:
                kept[i + 1] = w.copy()
    return w, err, kept


def gradient_pass(df: DataFrame, W: np.ndarray, label: str = "y", features: str = "x", degree: int = 1):
    """One distributed job for the runs ``W`` (runs x d): per run the sums of
    ``(w.x - y) x`` and ``(w.x - y)^2``, and the number of rows."""
    W = np.atleast_2d(np.asarray(W, dtype=np.float64))
    runs, d = W.shape
    shared = Shared(df.sparkSession, W)
    weights = shared.handle

    def per_task(batches):
        W = weights.value
        g, sse, n = np.zeros((runs, d)), np.zeros(runs), 0.0
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(lo, ROWS_AT_ONCE)
                X = AB.expanded(AB.matrix(batch, features, d if degree == 1 else None), degree)
                R = X @ W.T - AB.vector(batch, label)[:, None]
                g += R.T @ X
                sse += (R * R).sum(axis=0)
                n += len(X)
        yield emit_blocks(np.concatenate([g.ravel(), sse, [n]]))

    try:
        v = sum_blocks(df.select(label, features).mapInArrow(per_task, BLOCK_SCHEMA))[0]
    finally:
        shared.release()
    return v[:runs * d].reshape(runs, d), v[runs * d:-1], float(v[-1])


def descend_distributed(df: DataFrame, iters: int, alpha: float = 1.0, degree: int = 1):
    """The same rounds with one gradient job per round over persisted rows
    (``y``, ``x``): nothing wider than ``d`` leaves a task."""
    d = AB.expanded(_centre(df)[0][None, :], degree).shape[1]
    w = np.zeros(d)
    err = np.empty(iters)
    for i in range(iters):
        g, sse, n = gradient_pass(df, w, degree=degree)
        err[i] = math.sqrt(sse[0] / n)
        w = _step(w, g[0], n, i, alpha)
    return w, err


def fold_errors(df: DataFrame, weights: dict[int, np.ndarray], label: str, features: str, fold_col: str,
                intercepts: dict[int, np.ndarray] | None = None, degree: int = 1):
    """One pass: per fold the squared errors of its own runs (``weights[fold]``,
    runs x d, and ``intercepts[fold]``) summed over the fold's rows, and its rows:
    ``{fold: (sse, n)}``."""
    shifts = intercepts or {f: np.zeros(len(w)) for f, w in weights.items()}
    shared = Shared(df.sparkSession, {f: (w, shifts[f]) for f, w in weights.items()})
    runs = len(next(iter(weights.values())))
    handle = shared.handle

    def per_task(batches):
        acc: dict[int, np.ndarray] = {}
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(lo, ROWS_AT_ONCE)
                grp, y = AB.vector(batch, "grp", np.int64), AB.vector(batch, "y")
                X = AB.expanded(AB.matrix(batch, "x"), degree)
                for g in np.unique(grp):
                    sel = grp == g
                    W, b0 = handle.value[int(g)]
                    R = X[sel] @ W.T + b0 - y[sel][:, None]
                    acc[int(g)] = acc.get(int(g), 0.0) + np.concatenate([(R * R).sum(axis=0), [sel.sum()]])
        for g, v in acc.items():
            yield emit_blocks(v, key=g)

    try:
        sums = sum_blocks(_prepared(df, label, features, fold_col).mapInArrow(per_task, BLOCK_SCHEMA))
    finally:
        shared.release()
    return {g: (v[:runs], float(v[runs])) for g, v in sums.items()}


# ---------------------------------------------------------- estimator / model --

class _GDParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasStepSize):
    solver = Param(Params._dummy(), "solver", "gram: one pass, d x d sums; rounds: a pass per round, d sums",
                   typeConverter=TypeConverters.toString)
    degree = Param(Params._dummy(), "degree", "1: the features as they are; 2: with all their products, made inside the pass",
                   typeConverter=TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(maxIter=100, stepSize=1.0, solver="gram", degree=1,
                         featuresCol="features", labelCol="label", predictionCol="prediction")


class GDLinearRegression(Estimator, _GDParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear regression without intercept by batch gradient descent
    (``w = 0``, step ``stepSize / (n sqrt(i+1))``, ``maxIter`` rounds).
    ``solver`` is the caller's choice and never changes with the data.  With
    ``degree=2`` rows are read, kept and shuffled at their own width and expanded
    where the sums are made."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction",
                 maxIter=100, stepSize=1.0, solver="gram", degree=1):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "GDLinearRegressionModel":
        solver = self.getOrDefault(self.solver)
        if solver not in SOLVERS:
            raise ValueError(f"solver is one of {SOLVERS}")
        degree = self.getOrDefault(self.degree)
        prepared = _prepared(df, self.getLabelCol(), self.getFeaturesCol(), None).drop("grp")
        if solver == "gram":
            w, err, _ = descend(gram_stats(prepared, "y", "x", degree=degree)[0], self.getMaxIter(), self.getStepSize())
        else:
            prepared = materialize(prepared)
            try:
                w, err = descend_distributed(prepared, self.getMaxIter(), self.getStepSize(), degree)
            finally:
                release(prepared)
        return self._copyValues(GDLinearRegressionModel(w, err))


class GDLinearRegressionModel(Model, _GDParams, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted weights and the training RMSE before each round; both are
    params, so ``save`` and ``load`` keep them."""

    fitted = Param(Params._dummy(), "fitted", "weights", typeConverter=TypeConverters.toListFloat)
    curve = Param(Params._dummy(), "curve", "training RMSE before each round", typeConverter=TypeConverters.toListFloat)

    def __init__(self, weights=None, trainingError=None):
        super().__init__()
        self._setDefault(fitted=[], curve=[])
        if weights is not None:
            self._set(fitted=[float(v) for v in weights])
        if trainingError is not None:
            self._set(curve=[float(v) for v in trainingError])

    @property
    def weights(self) -> np.ndarray:
        return np.array(self.getOrDefault(self.fitted), dtype=np.float64)

    @property
    def trainingError(self) -> np.ndarray:
        return np.array(self.getOrDefault(self.curve), dtype=np.float64)

    def _transform(self, df: DataFrame) -> DataFrame:
        return with_prediction(df, self.weights, self.getFeaturesCol(), self.getPredictionCol(), degree=self.getOrDefault(self.degree))


def with_prediction(df: DataFrame, weights, features: str, out: str = "prediction", intercept: float = 0.0, degree: int = 1) -> DataFrame:
    """``df`` with ``w . x`` (and the intercept) added; the weights come as a
    broadcast one-row table, not as literals in the plan."""
    one = df.sparkSession.createDataFrame([([float(v) for v in weights],)], "__w array<double>")
    x = as_array_col(df, features)
    value = V.dot("__w", x if degree == 1 else V.poly_expand_2(x))
    return df.crossJoin(F.broadcast(one)).withColumn(out, value + F.lit(float(intercept)) if intercept else value).drop("__w")


# -------------------------------------------------------------------- metrics --

def rmse(df: DataFrame, label: str = "label", prediction: str = "prediction",
         alias: str = "rmse") -> DataFrame:
    """``sqrt(avg((label - prediction)^2))`` as a one-row table."""
    return df.agg(F.sqrt(F.avg(F.pow(F.col(label) - F.col(prediction), 2))).alias(alias))


def in_train(key: str, modulus: int = 5, keep: int = 4):
    return F.coalesce(F.pmod(F.col(key), F.lit(modulus)) < keep, F.lit(False))


def key_split(df: DataFrame, key: str, modulus: int = 5, keep: int = 4):
    """Deterministic train/test split by key: stable under repartitioning
    and re-execution after a lost executor (a seeded ``randomSplit`` is not).
    Rows with a null key are in the second part."""
    cond = in_train(key, modulus, keep)
    return df.filter(cond), df.filter(~cond)


# --------------------------------------------------------- one-pass searching --

def param_grid(spark, axes: dict[str, list]) -> DataFrame:
    """A parameter grid as a table ``(grid_id, <axis>...)``: the cross
    product of the value lists, in PySpark ``ParamGridBuilder``'s order (the
    first axis added varies slowest).  Its size is the product of the list
    lengths, fixed by the caller."""
    import itertools

    names = list(axes)
    rows = [(i, *c) for i, c in enumerate(itertools.product(*[axes[n] for n in names]))]
    return spark.createDataFrame(rows, ["grid_id", *names])


def cv_one_pass(df: DataFrame, fold_col: str, grid: list[dict], label: str = "label",
                features: str = "features", feature_sets: dict | None = None):
    """Cross-validate gradient descent over ``grid`` (dicts with ``rounds``,
    ``alpha`` and optionally ``features`` naming an entry of ``feature_sets``).

    One pass grouped by fold gives the summaries; each fold's fits run on total
    minus fold, and one more pass takes the squared errors of all fits on their
    held-out rows.  Returns ``(results, total)``: a row per grid point with the
    mean RMSE over folds, and the summary of all rows."""
    per_fold = gram_stats(df, label, features, fold_col)
    folds = sorted(per_fold)
    if len(folds) < 2:
        raise ValueError("cross-validation needs at least two non-empty folds")
    total = added(per_fold)
    points = _grid_points(grid)
    weights = {f: np.zeros((len(grid), total.d)) for f in folds}
    for (name, alpha), rounds in points.items():
        idx = (feature_sets or {}).get(name) if name is not None else None
        for f in folds:
            train = total - per_fold[f]
            _, _, kept = descend(train if idx is None else train.subset(idx), max(rounds), alpha, record=set(rounds))
            for r, ids in rounds.items():
                for i in ids:
                    weights[f][i, slice(None) if idx is None else idx] = kept[r]
    return _mean_errors(df, weights, grid, label, features, fold_col), total


def cv_rounds(df: DataFrame, fold_col: str, grid: list[dict], label: str = "label", features: str = "features",
              feature_sets: dict | None = None) -> pd.DataFrame:
    """``cv_one_pass`` for features too many for ``d x d`` sums: every round is
    one distributed job in which all fits (grid x folds, a longer fit giving the
    shorter ones too) take their gradients together.  ``df`` should be persisted."""
    rows = _prepared(df, label, features, fold_col)
    d = len(_centre(rows)[0])
    folds = [r[0] for r in rows.groupBy("grp").count().orderBy("grp").limit(MAX_GROUPS + 1).select("grp").collect()]
    if not 2 <= len(folds) <= MAX_GROUPS:
        raise ValueError(f"cross-validation needs 2 to {MAX_GROUPS} non-empty folds")
    fits = [(name, alpha, rounds, f) for (name, alpha), rounds in _grid_points(grid).items() for f in folds]
    masks = np.zeros((len(fits), d))
    for k, (name, *_) in enumerate(fits):
        masks[k, (feature_sets or {}).get(name, slice(None)) if name is not None else slice(None)] = 1.0
    held = np.array([f for *_, f in fits])
    W = np.zeros((len(fits), d))
    weights = {f: np.zeros((len(grid), d)) for f in folds}
    for i in range(max(r for _, _, rounds, _ in fits for r in rounds)):
        grad, n = _held_out_gradients(rows, W, held)
        for k, (_, alpha, rounds, f) in enumerate(fits):
            if i < max(rounds):
                W[k] = _step(W[k], grad[k] * masks[k], n[k], i, alpha)
            for point in rounds.get(i + 1, ()):
                weights[f][point] = W[k]
    return _mean_errors(df, weights, grid, label, features, fold_col)


def _held_out_gradients(rows: DataFrame, W: np.ndarray, held: np.ndarray):
    """Per fit k the gradient at W[k] over the rows of all folds but held[k],
    and their number, in one job."""
    runs, d = W.shape
    shared = Shared(rows.sparkSession, (W, held))
    handle = shared.handle

    def per_task(batches):
        W, held = handle.value
        g, n = np.zeros((runs, d)), np.zeros(runs)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X, grp = AB.matrix(batch, "x", d), AB.vector(batch, "grp", np.int64)
            inside = grp[:, None] != held
            R = (X @ W.T - AB.vector(batch, "y")[:, None]) * inside
            g += R.T @ X
            n += inside.sum(axis=0)
        yield emit_blocks(np.concatenate([g.ravel(), n]))

    try:
        v = sum_blocks(rows.mapInArrow(per_task, BLOCK_SCHEMA))[0]
    finally:
        shared.release()
    return v[:runs * d].reshape(runs, d), v[runs * d:]


def _grid_points(grid: list[dict]) -> dict[tuple, dict[int, list[int]]]:
    """(features, alpha) -> rounds -> the grid points that ask for them."""
    out: dict[tuple, dict[int, list[int]]] = {}
    for i, p in enumerate(grid):
        out.setdefault((p.get("features"), float(p["alpha"])), {}).setdefault(int(p["rounds"]), []).append(i)
    return out


def _mean_errors(df, weights, grid, label, features, fold_col) -> pd.DataFrame:
    errors = fold_errors(df, weights, label, features, fold_col)
    rmse = np.mean([np.sqrt(sse / n) for sse, n in errors.values()], axis=0)
    return pd.DataFrame([{**p, "grid_id": i, "avg_rmse": float(rmse[i])} for i, p in enumerate(grid)])


def cv_refit_best(df: DataFrame, fold_col: str, grid: list[dict], label: str = "label",
                  features: str = "features", feature_sets: dict | None = None,
                  digits: int = 6):
    """Search the grid, then refit the best point (lowest mean RMSE, rounded
    to ``digits``; ties to the lower grid id) on all training rows, from the
    summary the search has made.
    Returns ``(results, best row, GDLinearRegressionModel)``."""
    res, total = cv_one_pass(df, fold_col, grid, label, features, feature_sets)
    ranked = res.assign(_r=res["avg_rmse"].round(digits)).sort_values(["_r", "grid_id"])
    best = ranked.drop(columns="_r").iloc[0]
    idx = (feature_sets or {}).get(best.get("features")) if "features" in best else None
    w, err, _ = descend(total.subset(idx) if idx is not None else total, int(best["rounds"]), float(best["alpha"]))
    model = GDLinearRegressionModel(w, err)
    model._set(featuresCol=features, labelCol=label)
    return res, best, model
