"""Limited-memory BFGS over distributed sums.

Weights and the last few steps are on the driver (their size is the model's); the
rows are only seen by two jobs an iteration: one that takes the losses at
several steps along the search direction at once, and one that takes the gradient at the step
chosen.  The step is the largest of 1, 1/2, 1/4, ... with enough descent (Armijo)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np

LADDER = tuple(0.5 ** i for i in range(6))  # steps tried in one job
ARMIJO = 1e-4
SLACK = 1e-13  # of the loss: near the optimum rounding hides the descent of a good step
LEAST_STEP = 2.0 ** -40


@dataclass
class Minimum:
    """Weights, their loss, and after each iteration (iteration, loss, largest
    gradient component, step); ``converged`` if the gradient fell to the tolerance."""
    x: np.ndarray
    loss: float
    curve: list[tuple[int, float, float, float]] = field(default_factory=list)
    converged: bool = False


def direction(g: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Minus the inverse Hessian that the pairs (step, gradient change) stand for, times ``g``: the two-loop recursion."""
    q, alphas = g.copy(), []
    for s, y in reversed(pairs):
        a = (s @ q) / (s @ y)
        alphas.append(a)
        q -= a * y
    if pairs:
        s, y = pairs[-1]
        q *= (s @ y) / (y @ y)
    for (s, y), a in zip(pairs, reversed(alphas)):
        q += (a - (y @ q) / (s @ y)) * s
    return -q


def minimise(losses: Callable[[list[np.ndarray]], np.ndarray], gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray,
             max_iter: int, memory: int = 10, tol: float = 1e-9) -> Minimum:
    """``losses`` takes several points in one job, ``gradient`` one.  Ends after
    ``max_iter`` iterations, when no gradient component exceeds ``tol``, or when no step
    goes down any more."""
    x = np.array(start, dtype=np.float64)
    f, g = float(losses([x])[0]), gradient(x)
    if not np.isfinite(f):
        raise FloatingPointError("the loss at the start is not a number")
    out = Minimum(x, f, [(0, f, float(np.abs(g).max(initial=0.0)), 0.0)])
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for k in range(1, max_iter + 1):
        if np.abs(g).max(initial=0.0) <= tol:
            break
        d = direction(g, pairs)
        if g @ d >= 0:  # rounding has spoilt the pairs
            pairs, d = [], -g
        if not pairs:  # nothing is known of the curvature: a step of length 1 at most
            d = d / max(1.0, float(np.sqrt(g @ g)))
        slope = float(g @ d)
        step, scale = None, 1.0
        while step is None and scale >= LEAST_STEP:
            tried = [scale * t for t in LADDER]
            with np.errstate(invalid="ignore"):
                at = losses([x + t * d for t in tried])
                good = [i for i, t in enumerate(tried) if at[i] <= f + ARMIJO * t * slope + SLACK * abs(f)]
            step, new = (tried[good[0]], float(at[good[0]])) if good else (None, f)
            scale *= LADDER[-1] / 2
        if step is None:
            break
        after = x + step * d
        g_after = gradient(after)
        s, y = after - x, g_after - g
        if s @ y > 1e-12 * np.sqrt((s @ s) * (y @ y)):
            pairs = [*pairs, (s, y)][-memory:]
        x, f, g = after, new, g_after
        out.curve.append((k, f, float(np.abs(g).max()), step))
    out.x, out.loss, out.converged = x, f, bool(np.abs(g).max(initial=0.0) <= tol)
    return out
