"""Per-row vector math on ``array<double>`` columns.

Higher-order functions (``transform``, ``zip_with``, ``aggregate``) keep the
work in the JVM; size mismatches raise like ``require`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_array(values: Sequence[float]) -> Column:
    """A literal ``array<double>``."""
    return F.array(*[F.lit(float(v)) for v in values])


def _require_same_size(a: Column, b: Column, what: str, value: Column) -> Column:
    return F.when(F.size(a) == F.size(b), value).otherwise(
        F.raise_error(F.lit(f"{what}: vector sizes differ")))


def dot(a, b) -> Column:
    """Dot product; sizes must match."""
    a, b = _c(a), _c(b)
    prod = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x)
    return _require_same_size(a, b, "dot", prod)


def scale(a, s) -> Column:
    """Multiply every element by a number."""
    s = s if isinstance(s, Column) else F.lit(float(s))
    return F.transform(_c(a), lambda x: x * s)


def add(a, b) -> Column:
    """Element-wise sum; sizes must match."""
    a, b = _c(a), _c(b)
    return _require_same_size(a, b, "add", F.zip_with(a, b, lambda x, y: x + y))


def fill(size, value: float) -> Column:
    """Constant vector of a positive size."""
    n = size if isinstance(size, Column) else F.lit(int(size))
    return F.when(n > 0, F.array_repeat(F.lit(float(value)), n)).otherwise(
        F.raise_error(F.lit("fill: size must be positive")))


def predict_linear(weights: Sequence[float] | Column, features) -> Column:
    """``w . x`` with no intercept."""
    w = weights if isinstance(weights, Column) else as_array(weights)
    return dot(w, features)


def gradient_summand(weights, features, label) -> Column:
    """Per-row gradient of the squared loss, ``(w . x - y) x``."""
    return scale(features, predict_linear(weights, features) - _c(label))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once a row (an expression inside
    a lambda would be computed per element)."""
    return F.transform(F.array(value), use)[0]


def softmax(z) -> Column:
    """``exp(z - max z) / sum(exp(z - max z))`` per row."""
    z = _c(z)
    total = lambda e: F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    shifted = _bind(F.array_max(z), lambda m: F.transform(z, lambda x: F.exp(x - m)))
    return _bind(shifted, lambda e: _bind(total(e), lambda t: F.transform(e, lambda x: x / t)))


def log_sum_exp(z) -> Column:
    z = _c(z)
    return _bind(F.array_max(z), lambda m: m + F.log(F.aggregate(F.transform(z, lambda x: F.exp(x - m)),
                                 F.lit(0.0).cast("double"), lambda acc, x: acc + x)))


def relu(a) -> Column:
    return F.transform(_c(a), lambda x: F.greatest(x, F.lit(0.0)))


def sigmoid(a) -> Column:
    return F.transform(_c(a), lambda x: F.lit(1.0) / (F.lit(1.0) + F.exp(-x)))


def argmax(a) -> Column:
    """0-based position of the largest element, first one on ties."""
    a = _c(a)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def one_hot(label, num_classes: int = 10) -> Column:
    """Label id to a one-hot ``array<double>``."""
    lab = _c(label)
    return F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                       lambda c: (c == lab).cast("double"))


def one_hot_decode(v) -> Column:
    """Position of the first 1 in a one-hot vector."""
    return (F.array_position(_c(v), F.lit(1.0)) - 1).cast("int")


def poly_expand_2(a) -> Column:
    """Degree-2 polynomial expansion in MLlib's order.

    For inputs x0..x(d-1) the output is, for each k in order, the degree-1
    term xk followed by the products x(i)*xk for i <= k, i.e.
    ``x, x^2, y, xy, y^2, z, xz, yz, z^2`` for three inputs.
    """
    a = _c(a)
    idx = F.sequence(F.lit(0), F.size(a) - 1)
    return F.flatten(F.transform(
        idx,
        lambda k: F.concat(
            F.array(F.element_at(a, k + 1)),
            F.transform(F.sequence(F.lit(0), k),
                        lambda i: F.element_at(a, i + 1) * F.element_at(a, k + 1)))))


def slice_positions(a, positions: Sequence[int]) -> Column:
    """Pick elements by 0-based position (``VectorSlicer.setIndices``)."""
    a = _c(a)
    return F.array(*[a[int(p)] for p in positions])


def round_array(a, digits: int = 6) -> Column:
    """Round each element; ``+ 0.0`` folds a negative zero into zero."""
    return F.transform(_c(a), lambda x: F.round(x, digits) + F.lit(0.0))
