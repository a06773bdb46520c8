"""Rows stored by batch: what a round opens."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import batches as BT
from tessera.operators import classification as CL


def opened(df):
    """Rows that the scan of a collected plan gave, and the folders it opened."""
    df.collect()
    metrics = df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
    return metrics.apply("numOutputRows").value(), metrics.apply("numPartitions").value()


def test_a_round_opens_its_batch_only(spark):
    n, size = 40_000, 100
    rows = spark.range(n).select(F.col("id").alias("k"), F.array(*[F.rand(i) for i in range(32)]).alias("x")).repartition(4)
    store = BT.store_batches(rows, "k", size, folders=8)
    try:
        assert (store.first, store.span, store.per_folder) == (0, 400, 50)
        for r in (0, 57, 399, 400):
            got = store.rows(r)
            seen, folders = opened(got)
            assert sorted(v[0] for v in got.collect()) == list(range(r % 400 * size, (r % 400 + 1) * size))
            assert folders == 1 and seen <= n / 8
        seen, _ = opened(store.rows(57))
        assert seen < n / 16  # row groups of the folder are skipped too
    finally:
        store.drop()


def test_gaps_negative_and_null_keys(spark):
    rows = spark.createDataFrame([(-250, 1), (-1, 2), (5, 3), (1005, 4), (None, 5), (5, 6)], "k long, v int")
    store = BT.store_batches(rows, "k", 100, folders=3)
    try:
        found = [sorted(r.v for r in store.rows(i).collect()) for i in range(store.span)]
        assert store.first == -2 and found[0] == [1] and found[2] == [2, 3, 6] and found[12] == [4] and sum(map(len, found)) == 5
    finally:
        store.drop()
    with pytest.raises(ValueError, match="no training rows"):
        BT.store_batches(rows.filter("k is null"), "k", 100)


def test_training_by_batches_with_a_gap(spark):
    rng = np.random.default_rng(1)
    X, y = rng.normal(size=(30, 4)), rng.integers(0, 3, 30)
    keys = [i if i < 20 else i + 20 for i in range(30)]
    df = spark.createDataFrame([(k, int(b), [float(v) for v in a]) for k, a, b in zip(keys, X, y)], "k long, label int, x array<double>")
    Ws, bs, _ = CL.train_softmax(df, [CL.Run(rate=0.5)], 6, 4, 3, batch_size=10)
    W, b = np.zeros((4, 3)), np.zeros(3)
    for i in range(6):
        own = [j for j, k in enumerate(keys) if k // 10 == i % 5]
        if own:
            D = CL.softmax_np(X[own] @ W + b) - np.eye(3)[y[own]]
            W, b = W - 0.5 * X[own].T @ D / len(own), b - 0.5 * D.sum(0) / len(own)
    assert np.allclose(Ws[0], W) and np.allclose(bs[0], b)
