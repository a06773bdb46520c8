"""Training of stacked convolutions: gradients by finite differences, whole fits
against a plain loop, runs that share passes, and results that don't hang on partitions."""

import numpy as np
import pytest
from tessera.operators import conv as CV
from tessera.operators import conv_nets as CN
from tessera.operators import networks as NN

H, W, STRIDES = 5, 6, (1, 2)


def small_net(seed=0):
    return CN.init_conv_net([(3, 2, 3), (2, 3, 4)], [7, 3], H, W, STRIDES, seed, std=0.4, bias=0.05)


def images(n, seed=1):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, H * W * 2)), rng.integers(0, 3, n), np.arange(n)


def loss(X, y, net):
    Z = CN.conv_scores(X, net, STRIDES, H, W)
    top = Z.max(axis=1)
    return (top + np.log(np.exp(Z - top[:, None]).sum(axis=1)) - Z[np.arange(len(y)), y]).sum()


@pytest.mark.parametrize("size,k,stride", [(5, 3, 1), (6, 2, 2), (5, 4, 2), (7, 3, 3)])
def test_convolution_back_by_finite_differences(size, k, stride):
    rng = np.random.default_rng(k)
    X, K = rng.normal(size=(3, size, size + 1, 2)), rng.normal(size=(k, k, 2, 3))
    D = rng.normal(size=CV.conv2d_np(X, K, stride).shape)
    gK, gX = CV.conv2d_back(X, K, stride, D)
    value = lambda X, K: float((CV.conv2d_np(X, K, stride) * D).sum())
    for a, g, f in ((K, gK, lambda v: value(X, v)), (X, gX, lambda v: value(v, K))):
        for at in rng.integers(0, a.size, 25):
            e = np.zeros(a.size)
            e[at] = 1e-5
            e = e.reshape(a.shape)
            assert np.isclose((f(a + e) - f(a - e)) / 2e-5, g.ravel()[at], atol=1e-6)
    assert CV.conv2d_back(X, K, stride, D, inputs=False)[1] is None


def test_network_gradients_by_finite_differences():
    X, y, keys = images(6)
    net = small_net()
    grads, total, hits = CN.conv_backprop(X, y, keys, net, STRIDES, H, W)
    rng = np.random.default_rng(3)
    for layer, pair in enumerate(net):
        for part in (0, 1):
            for at in rng.integers(0, pair[part].size, 12):
                kept = pair[part].ravel()[at]
                got = []
                for e in (1e-6, -1e-6):
                    pair[part].reshape(-1)[at] = kept + e
                    got.append(loss(X, y, net))
                pair[part].reshape(-1)[at] = kept
                assert np.isclose((got[0] - got[1]) / 2e-6, grads[layer][part].ravel()[at], atol=1e-5)
    assert hits == (CN.conv_scores(X, net, STRIDES, H, W).argmax(axis=1) == y).sum()
    assert abs(total - loss(X, y, net)) < 1e-2  # the metric's loss holds a small constant


def test_batches_of_images_add_up(monkeypatch):
    X, y, keys = images(11)
    whole = CN.conv_backprop(X, y, keys, small_net(), STRIDES, H, W, keep=0.5, round_=2, seed=4)
    monkeypatch.setattr(CN, "IMAGES_AT_ONCE", 4)
    parts = CN.conv_backprop(X, y, keys, small_net(), STRIDES, H, W, keep=0.5, round_=2, seed=4)
    for a, b in zip(whole[0], parts[0]):
        np.testing.assert_allclose(a[0], b[0], atol=1e-12)
        np.testing.assert_allclose(a[1], b[1], atol=1e-12)
    assert np.isclose(whole[1], parts[1]) and whole[2] == parts[2]


def frame(spark, n, parts, seed=1):
    X, y, keys = images(n, seed)
    rows = [(int(k), int(label), [float(v) for v in x]) for k, label, x in zip(keys, y, X)]
    return spark.createDataFrame(rows, "k long, label int, x array<double>").repartition(parts)


def test_fit_follows_a_plain_loop_whatever_the_partitions(spark):
    X, y, keys = images(40)
    net = small_net()
    for i in range(4):
        g, _, _ = CN.conv_backprop(X, y, keys, net, STRIDES, H, W, keep=0.5, round_=i, seed=9)
        net = [(Wl - 0.1 * gW / 40, b - 0.1 * gb / 40) for (Wl, b), (gW, gb) in zip(net, g)]
    for parts in (1, 5):
        got, _ = CN.conv_nets_fit(frame(spark, 40, parts), small_net(), STRIDES, H, W, 4, [NN.DenseRun(0.1, 0.5, "gd")], seed=9)
        for (a, b), (c, d) in zip(net, got[0]):
            np.testing.assert_allclose(a, c, atol=1e-10)
            np.testing.assert_allclose(b, d, atol=1e-10)


def test_runs_share_passes_and_learn(spark):
    rows, held = frame(spark, 60, 3).persist(), frame(spark, 20, 2, seed=2)
    runs = [NN.DenseRun(0.02), NN.DenseRun(0.02, 0.5, "adam", 2, 0.5)]
    nets, metrics = CN.conv_nets_fit(rows, small_net(), STRIDES, H, W, 12, runs, seed=5, eval_rows=held, eval_every=4)
    for r, run in enumerate(runs):
        alone, m = CN.conv_nets_fit(rows, small_net(), STRIDES, H, W, 12, [run], seed=5, eval_rows=held, eval_every=4)
        np.testing.assert_allclose(alone[0][0][0], nets[r][0][0], atol=1e-12)
        np.testing.assert_allclose([x[3:] for x in m], [x[3:] for x in metrics if x[0] == r], atol=1e-12)
    losses = [x[3] for x in metrics if x[0] == 0 and x[2] == "train"]
    assert len(losses) == 12 and losses[-1] < 0.7 * losses[0]
    assert [x[1] for x in metrics if x[0] == 0 and x[2] == "eval"] == [0, 4, 8, 12]
    rows.unpersist()


def test_no_rows_and_uneven_images_raise(spark):
    with pytest.raises(Exception, match="no training rows"):
        CN.conv_nets_fit(frame(spark, 4, 1).filter("k < 0"), small_net(), STRIDES, H, W, 1, [NN.DenseRun(0.1)])
    uneven = spark.createDataFrame([(1, 0, [1.0] * 60), (2, 0, [1.0] * 59)], "k long, label int, x array<double>").coalesce(1)
    with pytest.raises(Exception, match="uneven"):
        CN.conv_nets_fit(uneven, small_net(), STRIDES, H, W, 1, [NN.DenseRun(0.1)])
