"""Deterministic weights for scoring queries, built from a rule so that the
Spark plan (numpy / literals) and the DuckDB oracle (the same arithmetic in
SQL) see bit-identical numbers: every value is a small dyadic fraction."""

from __future__ import annotations

import numpy as np


def linear_weights(d: int) -> np.ndarray:
    """``w_j = ((j mod 5) - 2) / 4``."""
    j = np.arange(d)
    return ((j % 5) - 2) / 4.0


def linear_weights_sql(j: str) -> str:
    return f"((({j}) % 5) - 2) / 4.0"


def class_weights(d: int, c: int = 10, salt: int = 0) -> np.ndarray:
    """``W[j, k] = (((7j + 3k + salt) mod 11) - 5) / 8``, shape (d, c)."""
    j = np.arange(d)[:, None]
    k = np.arange(c)[None, :]
    return (((7 * j + 3 * k + salt) % 11) - 5) / 8.0


def class_weights_sql(j: str, k: str, salt: int = 0) -> str:
    return f"(((7 * ({j}) + 3 * ({k}) + {salt}) % 11) - 5) / 8.0"


def class_bias(c: int = 10) -> np.ndarray:
    """``b_k = (k - 4) / 16``."""
    return (np.arange(c) - 4) / 16.0


def class_bias_sql(k: str) -> str:
    return f"(({k}) - 4) / 16.0"


def layer_weights(d_in: int, d_out: int, salt: int) -> np.ndarray:
    """Dense-layer weights ``(((5i + 3o + salt) mod 13) - 6) / 64``: small
    enough that activations stay in range through five layers."""
    i = np.arange(d_in)[:, None]
    o = np.arange(d_out)[None, :]
    return (((5 * i + 3 * o + salt) % 13) - 6) / 64.0


def layer_weights_sql(i: str, o: str, salt: int) -> str:
    return f"(((5 * ({i}) + 3 * ({o}) + {salt}) % 13) - 6) / 64.0"


def layer_bias(d_out: int, salt: int) -> np.ndarray:
    o = np.arange(d_out)
    return (((o + salt) % 7) - 3) / 32.0


def layer_bias_sql(o: str, salt: int) -> str:
    return f"(((({o}) + {salt}) % 7) - 3) / 32.0"
