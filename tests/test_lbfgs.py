"""L-BFGS: the driver's part by itself, and the fits it makes over rows."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector

from tessera.operators import classification as CL
from tessera.operators import lbfgs as LB
from tessera.operators import networks as NN


def rows(spark, n=90, d=5, c=3, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    y = (X @ rng.normal(size=(d, c)) + rng.normal(size=(n, c))).argmax(axis=1)
    df = spark.createDataFrame([(i, int(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(X, y))], "k long, label int, x array<double>")
    return df.repartition(4), X, y


def test_quadratic_is_minimised_and_memory_is_bounded():
    rng = np.random.default_rng(1)
    Q = rng.normal(size=(30, 30))
    Q = Q @ Q.T + np.eye(30)
    b = rng.normal(size=30)
    seen = []
    f = lambda points: seen.append(len(points)) or np.array([0.5 * x @ Q @ x - b @ x for x in points])
    for memory in (3, 10):
        out = LB.minimise(f, lambda x: Q @ x - b, np.zeros(30), 400, memory, tol=1e-6)
        assert out.converged and np.allclose(out.x, np.linalg.solve(Q, b), atol=1e-5)
    assert max(seen) == len(LB.LADDER)
    losses = [v[1] for v in out.curve]
    assert all(b <= a + 1e-12 * abs(a) for a, b in zip(losses, losses[1:])) and losses[5] < losses[4] < losses[3]


def test_direction_is_the_inverse_of_a_known_hessian():
    H = np.diag([1.0, 4.0, 9.0])
    pairs = [(s, H @ s) for s in np.eye(3)]
    g = np.array([3.0, -2.0, 5.0])
    assert np.allclose(LB.direction(g, pairs), -np.linalg.solve(H, g))
    assert np.allclose(LB.direction(g, []), -g)


def test_steep_start_takes_a_small_step_and_nothing_lower_ends():
    out = LB.minimise(lambda p: np.array([5e5 * x[0] ** 2 for x in p]), lambda x: 1e6 * x, np.array([1e-3]), 60, tol=1e-3)
    assert out.converged and abs(out.x[0]) <= 1e-9 and out.curve[1][3] < LB.LADDER[-1]
    still = LB.minimise(lambda p: np.array([3.0 if x.any() else 2.0 for x in p]), lambda x: np.ones(1), np.zeros(1), 5)
    assert len(still.curve) == 1 and not still.converged
    with pytest.raises(FloatingPointError):
        LB.minimise(lambda p: np.full(len(p), np.nan), lambda x: np.ones(1), np.zeros(1), 5)


def test_softmax_reaches_the_librarys_optimum(spark):
    df, X, y = rows(spark)
    X = X / X.std(axis=0, ddof=1)
    df = spark.createDataFrame([(i, int(b), [float(v) for v in a]) for i, (a, b) in enumerate(zip(X, y))], "k long, label int, x array<double>")
    W, b, found = CL.fit_softmax(df, 5, 3, l2=0.1)
    assert found.converged

    def loss(W, b):
        Z = X @ W + b
        return (np.log(np.exp(Z).sum(axis=1)) - Z[np.arange(len(y)), y]).mean() + 0.05 * (W * W).sum()

    theirs = LogisticRegression(family="multinomial", regParam=0.1, maxIter=200, tol=1e-12, standardization=False).fit(df.select("label", array_to_vector("x").alias("features")))
    assert loss(W, b) <= loss(theirs.coefficientMatrix.toArray().T, theirs.interceptVector.toArray()) + 1e-9
    assert np.allclose(W, theirs.coefficientMatrix.toArray().T, atol=1e-4)


@pytest.mark.parametrize("hidden", ["sigmoid", "relu"])
def test_network_follows_the_plain_program(spark, hidden):
    df, X, y = rows(spark, 60)
    start = NN.init_layers([5, 6, 4, 3], seed=3, std=0.7)
    sizes = [5, 6, 4, 3]
    assert all(np.array_equal(a, b) for p, q in zip(start, NN.layered(NN.flat(start), sizes)) for a, b in zip(p, q))

    def losses(points):
        out = []
        for x in points:
            Z = NN.forward_np(X, NN.layered(x, sizes), hidden)
            out.append((np.log(np.exp(Z).sum(axis=1)) - Z[np.arange(len(y)), y]).mean())
        return np.array(out)

    def gradient(x):
        return NN.flat(NN.backprop_np(X, y, None, NN.layered(x, sizes), hidden, 1.0, 0, 0, 3)[0]) / len(y)

    x0 = NN.flat(start)
    if hidden == "sigmoid":
        bumps = [(losses([x0 + 1e-6 * e])[0] - losses([x0 - 1e-6 * e])[0]) / 2e-6 for e in np.eye(len(x0))]
        assert np.allclose(bumps, gradient(x0), atol=1e-7)
    layers, found = NN.dense_net_lbfgs(df, start, 12, hidden)
    want = LB.minimise(losses, gradient, x0, 12)
    assert np.allclose([c[1] for c in found.curve], [c[1] for c in want.curve], atol=1e-7) and found.loss < 0.8 * found.curve[0][1]
    assert np.allclose(NN.flat(layers), want.x, atol=1e-5)


def test_two_jobs_an_iteration(spark):
    df, _, _ = rows(spark)
    df = df.persist()
    df.count()
    sc = spark.sparkContext
    found = {}
    for m in (2, 4):
        sc.setJobGroup(f"net-{m}", "net")
        _, out = NN.dense_net_lbfgs(df, NN.init_layers([5, 4, 3], seed=1, std=0.7), m)
        assert len(out.curve) == m + 1
        found[m] = len(sc.statusTracker().getJobIdsForGroup(f"net-{m}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    df.unpersist()
    each = found[2] / (2 + 2 * 2)  # jobs of one sum: loss and gradient at the start, two sums an iteration
    assert found[4] == each * (2 + 2 * 4)


def test_no_rows(spark):
    df, _, _ = rows(spark)
    with pytest.raises(ValueError, match="no training rows"):
        NN.dense_net_lbfgs(df.filter("false"), NN.init_layers([5, 4, 3]), 2)
    with pytest.raises(ValueError, match="no rows"):
        CL.fit_softmax(df.filter("false"), 5, 3)
