"""Elastic-net linear regression from distributed sums.

The objective is that of MLlib's normal solver, its default up to 4,096 columns: with
columns u and label v standardised by their population deviations,

    1/(2n) |v - U b|^2 + l1 |b|_1 + l2/2 |b|^2,   l1 = reg mix / sd(y), l2 = reg (1 - mix) / sd(y)

and needs the rows only through n, means and products, which one pass collects
(``regression.gram_stats``, by fold if searched).  Two solvers work on these sums:

* ``coordinate``: cyclic coordinate descent with soft thresholds; one iteration is
  one sweep over the columns.  It stops when the duality gap falls to ``tol``
  times the null model's loss.  A regularisation path goes from the largest to
  the smallest penalty and starts each from the one before.
* ``proximal``: accelerated proximal gradient; one iteration is one product with the
  Gram matrix, shared by all penalties.  For wide expansions, where a sweep over
  the columns one by one is slow.

Both report every fit after each asked number of iterations, so a grid over the
iterations costs no more than its largest value.  Errors come from a direct pass over
the rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasElasticNetParam, HasFeaturesCol, HasLabelCol, HasMaxIter,
                                     HasPredictionCol, HasRegParam, HasTol)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from tessera.operators import regression as RG

SOLVERS = ("coordinate", "proximal")
TOL = 1e-9


@dataclass
class Standardised:
    """Means of products of standardised columns (``A``), of columns and label
    (``c``) and of the label (``vv``), with what leads back to the rows' scale.
    Columns without spread have no part in a fit."""
    A: np.ndarray
    c: np.ndarray
    vv: float
    mx: np.ndarray
    scale: np.ndarray
    my: float
    sy: float

    def weights(self, b: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and intercept on the scale of the rows."""
        w = b * self.sy * self.scale
        return w, float(self.my - w @ self.mx)

    def penalties(self, reg: float, mix: float) -> tuple[float, float]:
        return (reg * mix / self.sy, reg * (1.0 - mix) / self.sy) if self.sy > 0 else (0.0, 1.0)


def standardised(stats: RG.GramStats) -> Standardised:
    n = stats.n
    if n < 2:
        raise ValueError("a fit needs two rows or more")
    S = stats.uu - np.outer(stats.su, stats.su / n)
    s = stats.uv - stats.su * (stats.sv / n)
    spread = np.diag(S)
    # the sums are relative to a row: a constant column's are exactly zero
    sx = np.sqrt(np.maximum(spread, 0.0) / n)
    scale = np.divide(1.0, sx, out=np.zeros_like(sx), where=sx > 0)
    sy = float(np.sqrt(max(stats.vv - stats.sv ** 2 / n, 0.0) / n))
    by = 1.0 / sy if sy > 0 else 0.0
    S *= scale
    S *= scale[:, None]
    S /= n
    return Standardised(S, s * scale * by / n, 1.0 if sy > 0 else 0.0, stats.c + stats.su / n, scale, stats.c0 + stats.sv / n, sy)


def _soft(z, limit):
    return np.sign(z) * np.maximum(np.abs(z) - limit, 0.0)


def duality_gap(p: Standardised, b: np.ndarray, l1: float, l2: float) -> float:
    """Objective at ``b`` less the dual objective at the residual, scaled until feasible: at
    least the distance to the optimum.  The square penalty counts as more rows."""
    q = p.A @ b
    rest = p.c - q - l2 * b                                     # columns times residual
    square = p.vv - 2.0 * (p.c @ b) + b @ q + l2 * (b @ b)      # residual squared
    along = p.vv - p.c @ b                                      # residual times label
    most = np.abs(rest).max(initial=0.0)
    s = 1.0 if most <= l1 else l1 / most
    return 0.5 * square + l1 * np.abs(b).sum() - (s * along - 0.5 * s * s * square)


@dataclass
class Fit:
    """Standardised coefficients, iterations made, and whether the gap is closed."""
    b: np.ndarray
    iterations: int
    converged: bool


def coordinate_path(p: Standardised, regs: list[float], mix: float, iters: list[int], tol: float = TOL) -> dict[tuple[float, int], Fit]:
    """(reg, m) -> fit after m sweeps (fewer, if the gap closes) for every reg and m.
    From the largest reg down, each starts from the last fit of the one before."""
    A, c, diag = p.A, p.c.tolist(), np.diag(p.A).tolist()
    live = [j for j in range(len(c)) if diag[j] > 0]
    out: dict[tuple[float, int], Fit] = {}
    b, q = np.zeros(len(c)), np.zeros(len(c))
    for reg in sorted(set(regs), reverse=True):
        l1, l2 = p.penalties(reg, mix)
        done, sweeps = False, 0
        while sweeps < max(iters) and not done:
            for j in live:
                old = float(b[j])
                z = c[j] - float(q[j]) + diag[j] * old
                new = ((z - l1) if z > l1 else (z + l1) if z < -l1 else 0.0) / (diag[j] + l2)
                if new != old:
                    q += A[j] * (new - old)
                    b[j] = new
            sweeps += 1
            done = duality_gap(p, b, l1, l2) <= tol * 0.5 * p.vv
            for m in iters:
                if m == sweeps or done and m > sweeps:
                    out[reg, m] = Fit(b.copy(), sweeps, done)
    return out


def proximal_path(p: Standardised, regs: list[float], mix: float, iters: list[int], tol: float = TOL) -> dict[tuple[float, int], Fit]:
    """(reg, m) -> fit after m accelerated proximal gradient steps from zero, all
    regs in one product a step.  The step is that of (sum of fourth powers of the
    eigenvalues)^(1/4), at least the largest eigenvalue; momentum k / (k + 3)."""
    regs = sorted(set(regs), reverse=True)
    l1, l2 = (np.array(v) for v in zip(*(p.penalties(r, mix) for r in regs)))
    L = np.sqrt(np.linalg.norm(p.A @ p.A)) + l2
    L[L == 0] = 1.0
    B, Z = (np.zeros((len(p.c), len(regs))) for _ in range(2))
    out: dict[tuple[float, int], Fit] = {}
    for k in range(max(iters)):
        new = _soft(Z - (p.A @ Z - p.c[:, None] + l2 * Z) / L, l1 / L)
        Z = new + k / (k + 3.0) * (new - B)
        B = new
        if k + 1 in iters:
            for i, reg in enumerate(regs):
                gap = duality_gap(p, B[:, i], float(l1[i]), float(l2[i]))
                out[reg, k + 1] = Fit(B[:, i].copy(), k + 1, gap <= tol * 0.5 * p.vv)
    return out


PATHS = {"coordinate": coordinate_path, "proximal": proximal_path}


def elastic_grid(iters: list[int], regs: list[float]) -> list[dict]:
    """Grid points in ``ParamGridBuilder``'s order, iterations slowest."""
    return [{"maxIter": int(m), "regParam": float(r)} for m in iters for r in regs]


def search(df: DataFrame, fold_col: str, iters: list[int], regs: list[float], mix: float = 0.1, label: str = "label", features: str = "features",
           degree: int = 1, solver: str = "coordinate", tol: float = TOL, digits: int = 6) -> tuple[pd.DataFrame, dict, "ElasticNetModel"]:
    """Cross-validate ``iters`` x ``regs`` in two passes: the sums by fold (training
    sums are total minus fold), and the errors on the held-out rows.  The best point
    (lowest mean RMSE, rounded to ``digits``; ties to the lower grid id) is fitted to all rows from
    the sums that are there.

    Returns the grid with mean RMSE, mean iterations made and the number of folds whose gap
    closed; the best point; its model."""
    path = PATHS[solver]
    per_fold = RG.gram_stats(df, label, features, fold_col, degree=degree)
    if len(per_fold) < 2:
        raise ValueError("cross-validation needs at least two non-empty folds")
    total = RG.added(per_fold)
    grid = elastic_grid(iters, regs)
    weights, shifts, fits = {}, {}, []
    for fold in sorted(per_fold):
        p = standardised(total - per_fold[fold])
        found = path(p, regs, mix, iters, tol)
        own = [found[g["regParam"], g["maxIter"]] for g in grid]
        fits.append(own)
        scaled = [p.weights(f.b) for f in own]
        weights[fold], shifts[fold] = np.stack([w for w, _ in scaled]), np.array([b0 for _, b0 in scaled])
    errors = RG.fold_errors(df, weights, label, features, fold_col, intercepts=shifts, degree=degree)
    rmse = np.mean([np.sqrt(sse / n) for sse, n in errors.values()], axis=0)
    res = pd.DataFrame([{"grid_id": i, **g, "avg_rmse": float(rmse[i]), "iterations": float(np.mean([f[i].iterations for f in fits])),
                         "converged": sum(f[i].converged for f in fits)} for i, g in enumerate(grid)])
    best = res.assign(_r=res["avg_rmse"].round(digits)).sort_values(["_r", "grid_id"]).drop(columns="_r").iloc[0].to_dict()
    p = standardised(total)
    fit = path(p, regs, mix, iters, tol)[best["regParam"], int(best["maxIter"])]
    model = ElasticNetModel(*p.weights(fit.b), fit.iterations)
    model._set(featuresCol=features, labelCol=label, degree=degree, maxIter=int(best["maxIter"]), regParam=float(best["regParam"]), elasticNetParam=mix,
               solver=solver, tol=tol)
    return res, best, model


class _ElasticParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasMaxIter, HasRegParam, HasElasticNetParam, HasTol):
    solver = Param(Params._dummy(), "solver", "coordinate: sweeps over the columns; proximal: products with the Gram matrix",
                   typeConverter=TypeConverters.toString)
    degree = RG._GDParams.degree

    def __init__(self):
        super().__init__()
        self._setDefault(maxIter=100, regParam=0.0, elasticNetParam=0.0, tol=TOL, solver="coordinate", degree=1,
                         featuresCol="features", labelCol="label", predictionCol="prediction")


class ElasticNetRegression(Estimator, _ElasticParams, DefaultParamsReadable, DefaultParamsWritable):
    """Linear regression with intercept and elastic-net penalty on standardised
    columns, from one pass over the rows.  ``degree=2`` expands the features inside the pass."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=100, regParam=0.0, elasticNetParam=0.0,
                 tol=TOL, solver="coordinate", degree=1):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "ElasticNetModel":
        solver = self.getOrDefault(self.solver)
        if solver not in SOLVERS:
            raise ValueError(f"solver is one of {SOLVERS}")
        stats = RG.gram_stats(df, self.getLabelCol(), self.getFeaturesCol(), degree=self.getOrDefault(self.degree))[0]
        p = standardised(stats)
        reg, m = self.getRegParam(), self.getMaxIter()
        fit = PATHS[solver](p, [reg], self.getElasticNetParam(), [m], self.getTol())[reg, m]
        return self._copyValues(ElasticNetModel(*p.weights(fit.b), fit.iterations))


class ElasticNetModel(Model, _ElasticParams, DefaultParamsReadable, DefaultParamsWritable):
    """Weights, intercept and the iterations made; params, so ``save`` and ``load`` keep them."""

    fitted = Param(Params._dummy(), "fitted", "weights", typeConverter=TypeConverters.toListFloat)
    shift = Param(Params._dummy(), "shift", "intercept", typeConverter=TypeConverters.toFloat)
    made = Param(Params._dummy(), "made", "iterations made", typeConverter=TypeConverters.toInt)

    def __init__(self, weights=None, intercept=0.0, iterations=0):
        super().__init__()
        self._setDefault(fitted=[], shift=0.0, made=0)
        if weights is not None:
            self._set(fitted=[float(v) for v in weights], shift=float(intercept), made=int(iterations))

    @property
    def weights(self) -> np.ndarray:
        return np.array(self.getOrDefault(self.fitted), dtype=np.float64)

    @property
    def intercept(self) -> float:
        return self.getOrDefault(self.shift)

    @property
    def iterations(self) -> int:
        return self.getOrDefault(self.made)

    @property
    def numFeatures(self) -> int:
        return len(self.getOrDefault(self.fitted))

    def _transform(self, df: DataFrame) -> DataFrame:
        return RG.with_prediction(df, self.weights, self.getFeaturesCol(), self.getPredictionCol(),
                                  intercept=self.intercept, degree=self.getOrDefault(self.degree))
