import math

import numpy as np
import pytest

from tessera.operators import classification as CL
from tessera.operators import conv as CV
from tessera.operators import networks as NN
from tessera.operators.regression import key_split
from tessera.plans import inputs as I
from pyspark.sql import functions as F  # noqa: F401

import conv_join as CJ
from paths import SF


def _rows(spark):
    r = CL.prepare_rows(I.embedding_rows(spark, SF), "label", "x", key="vec_id")
    tr, te = key_split(r, "k")
    pdf = tr.toPandas()
    return tr, np.stack(pdf["x"].to_numpy()), pdf["label"].to_numpy()


def brute_softmax(X, y, rounds, rate, eps=None, adam=False, decay=None):
    n, d = X.shape
    W, b = np.zeros((d, 10)), np.zeros(10)
    Y = np.eye(10)[y]
    m = [np.zeros_like(W), np.zeros_like(b)]
    v = [np.zeros_like(W), np.zeros_like(b)]
    for i in range(rounds):
        P = CL.softmax_np(X @ W + b)
        D = P - Y
        if eps:
            py = P[np.arange(n), y]
            D = D * (py / (py + eps))[:, None]
        g = [X.T @ D / n, D.sum(0) / n]
        lr = rate if decay is None else rate * decay[1] ** (i // decay[0])
        if adam:
            t = i + 1
            lr_t = lr * math.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
            out = []
            for k, (p, gg) in enumerate(zip([W, b], g)):
                m[k] = 0.9 * m[k] + (1 - 0.9) * gg
                v[k] = 0.999 * v[k] + (1 - 0.999) * gg * gg
                out.append(p - lr_t * m[k] / (np.sqrt(v[k]) + 1e-8))
            W, b = out
        else:
            W, b = W - lr * g[0], b - lr * g[1]
    return W, b


@pytest.mark.parametrize("adam,eps,decay", [(False, 1e-5, None), (True, None, (2, 0.5)), (False, None, None)])
def test_softmax_training_matches_numpy(spark, adam, eps, decay):
    tr, X, y = _rows(spark)
    run = CL.Run(rate=0.5 if not adam else 0.01, optimizer="adam" if adam else "gd",
                 decay_steps=decay[0] if decay else None, decay_rate=decay[1] if decay else None)
    Ws, bs, _ = CL.train_softmax(tr, [run], 4, 64, 10, eps=eps)
    W, b = brute_softmax(X, y, 4, run.rate, eps, adam, decay)
    assert np.allclose(Ws[0], W, atol=1e-12) and np.allclose(bs[0], b, atol=1e-12)


def test_sweep_runs_share_a_pass_and_match_single_runs(spark):
    tr, _, _ = _rows(spark)
    runs = [CL.Run(rate=0.1), CL.Run(rate=0.01, optimizer="adam")]
    Ws, bs, _ = CL.train_softmax(tr, runs, 3, 64, 10)
    for i, r in enumerate(runs):
        W1, b1, _ = CL.train_softmax(tr, [r], 3, 64, 10)
        assert np.allclose(Ws[i], W1[0]) and np.allclose(bs[i], b1[0])


def test_backprop_matches_finite_differences():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(6, 5))
    y = rng.integers(0, 3, size=6)
    layers = NN.init_layers([5, 4, 3], seed=1)

    def loss(ls):
        P = CL.softmax_np(NN.forward_np(X, ls, "sigmoid"))
        return -np.log(P[np.arange(6), y]).sum()

    grads, _, _ = NN.backprop_np(X, y, np.arange(6), layers, "sigmoid", 1.0, 0, 0, 3)
    h = 1e-6
    W0 = layers[0][0].copy()
    W0[1, 2] += h
    up = loss([(W0, layers[0][1]), layers[1]])
    W0[1, 2] -= 2 * h
    down = loss([(W0, layers[0][1]), layers[1]])
    assert abs((up - down) / (2 * h) - grads[0][0][1, 2]) < 1e-6


def test_dropout_mask_is_deterministic():
    a = NN.dropout_mask(np.arange(100), 1, 30, 5, 7, 0.75)
    b = NN.dropout_mask(np.arange(100), 1, 30, 5, 7, 0.75)
    c = NN.dropout_mask(np.arange(100), 1, 30, 6, 7, 0.75)
    assert np.array_equal(a, b) and not np.array_equal(a, c)
    assert 0.65 < a.mean() < 0.85


@pytest.mark.parametrize("k,co,stride", [(3, 2, 1), (5, 2, 2), (4, 3, 2)])
def test_conv_join_matches_dense(spark, k, co, stride):
    r = I.embedding_rows(spark, SF).limit(20)
    pdf = r.toPandas()
    Wk = np.random.default_rng(k).normal(size=(k, k, 1, co))
    px = CJ.pixels_long(r, "vec_id", "x", 8, 8, 1)
    got = CJ.conv2d_join(px, CJ.kernel_table(spark, Wk), 8, 8, k, stride).toPandas()
    X = np.stack(pdf["x"].to_numpy()).reshape(-1, 8, 8, 1)
    dense = CV.conv2d_np(X, Wk, stride)
    pos = {v: i for i, v in enumerate(pdf["vec_id"])}
    for t in got.itertuples():
        assert abs(dense[pos[t.id], t.oy, t.ox, t.co] - t.value) < 1e-9
    oh = math.ceil(8 / stride)
    assert len(got) == len(pdf) * oh * oh * co
    rows = CV.conv2d_rows(r, Wk, 8, 8, stride).toPandas()
    assert len(rows) == len(got)
    for t in rows.itertuples():
        assert abs(dense[pos[t.vec_id], t.oy, t.ox, t.co] - t.value) < 1e-9


def test_same_geometry():
    assert CV.same_geometry(8, 5, 2) == (4, 1)
    assert CV.same_geometry(28, 5, 1) == (28, 2)
    assert CV.same_geometry(28, 4, 2) == (14, 1)


def test_stepped_rate():
    assert CL.stepped_rate(0.1, 0, 2, 0.5) == 0.1
    assert CL.stepped_rate(0.1, 3, 2, 0.5) == 0.05
    assert CL.stepped_rate(0.1, 4, 2, 0.5) == 0.025


def test_softmax_pass_unchanged_under_repartitioning(spark):
    tr, _, _ = _rows(spark)
    W = np.random.default_rng(3).normal(size=(2, 64, 10)) * 0.1
    b = np.zeros((2, 10))
    base = CL.softmax_pass(tr, W, b, eps=1e-5)
    for n in (1, 7):
        other = CL.softmax_pass(tr.repartition(n), W, b, eps=1e-5)
        assert np.allclose(base["gW"], other["gW"]) and np.allclose(base["gb"], other["gb"])
        assert np.array_equal(base["hits"], other["hits"]) and base["n"] == other["n"]


def test_shared_eval_pass_matches_separate_evaluation(spark):
    r = CL.prepare_rows(I.embedding_rows(spark, SF), "label", "x", key="vec_id")
    tr, te = key_split(r, "k")
    Ws, bs, metrics = CL.train_softmax(tr, [CL.Run(rate=0.5)], 4, 64, 10, eps=1e-5,
                                       eval_sets={"test": te}, eval_every=2)
    assert [(m[1], m[2]) for m in metrics] == [(0, "test"), (2, "test")]
    # the metric after the last recorded round equals a direct evaluation
    W2, b2, _ = CL.train_softmax(tr, [CL.Run(rate=0.5)], 3, 64, 10, eps=1e-5)
    ev = CL.softmax_pass(te, W2, b2, with_grad=False)
    assert abs(metrics[-1][3] - ev["hits"][0] / ev["n"]) < 1e-12
    assert abs(metrics[-1][4] - ev["loss_eps"][0] / ev["n"]) < 1e-12


def test_dense_fit_unchanged_under_repartitioning(spark):
    tr, _, _ = _rows(spark)
    a, _ = NN.dense_net_fit(tr, [64, 16, 10], 3, 0.01, keep_prob=0.75, seed=5)
    b, _ = NN.dense_net_fit(tr.repartition(7), [64, 16, 10], 3, 0.01, keep_prob=0.75, seed=5)
    for (W1, b1), (W2, b2) in zip(a, b):
        assert np.allclose(W1, W2) and np.allclose(b1, b2)


def test_minibatch_rounds_match_numpy(spark):
    tr, _, _ = _rows(spark)
    pdf = tr.toPandas()
    k = pdf["k"].to_numpy()
    X, y = np.stack(pdf["x"].to_numpy()), pdf["label"].to_numpy()
    Ws, bs, _ = CL.train_softmax(tr, [CL.Run(rate=0.5)], 5, 64, 10, batch_size=100)
    ids = sorted(set(k // 100))
    W, b = np.zeros((64, 10)), np.zeros(10)
    for i in range(5):
        m = (k // 100) == ids[i % len(ids)]
        P = CL.softmax_np(X[m] @ W + b)
        D = P - np.eye(10)[y[m]]
        W, b = W - 0.5 * X[m].T @ D / m.sum(), b - 0.5 * D.sum(0) / m.sum()
    assert np.allclose(Ws[0], W, atol=1e-12) and np.allclose(bs[0], b, atol=1e-12)


def test_two_layer_join_stack_matches_dense(spark):
    r = I.embedding_rows(spark, SF).limit(10)
    pdf = r.toPandas()
    rng = np.random.default_rng(9)
    W1, b1 = rng.normal(size=(3, 3, 1, 2)), rng.normal(size=2)
    W2, b2 = rng.normal(size=(3, 3, 2, 3)), rng.normal(size=3)
    px = CJ.pixels_long(r, "vec_id", "x", 8, 8, 1)
    l1 = CJ.conv2d_join(px, CJ.kernel_table(spark, W1), 8, 8, 3, 1, bias=b1, relu=True)
    l2 = CJ.conv2d_join(CJ.as_pixels(l1), CJ.kernel_table(spark, W2), 8, 8, 3, 2, bias=b2, relu=True)
    got = l2.toPandas()
    X = np.stack(pdf["x"].to_numpy()).reshape(-1, 8, 8, 1)
    a1 = np.maximum(CV.conv2d_np(X, W1, 1) + b1, 0)
    a2 = np.maximum(CV.conv2d_np(a1, W2, 2) + b2, 0)
    pos = {v: i for i, v in enumerate(pdf["vec_id"])}
    assert len(got) == 10 * 4 * 4 * 3
    for t in got.itertuples():
        assert abs(a2[pos[t.id], t.oy, t.ox, t.co] - t.value) < 1e-9


def test_one_class_labels_train(spark):
    r = CL.prepare_rows(I.embedding_rows(spark, SF).withColumn("label", F.lit(3)), "label", "x", key="vec_id")
    Ws, bs, _ = CL.train_softmax(r, [CL.Run(rate=0.5)], 3, 64, 10)
    assert np.argmax(bs[0]) == 3 and np.all(np.isfinite(Ws))


def test_stepped_rate_column_matches_driver_schedule(spark):
    df = spark.range(25).withColumnRenamed("id", "step")
    got = df.select("step", CL.stepped_rate_col(0.005, "step", 10, 0.96).alias("r")).orderBy("step").collect()
    for r in got:
        assert abs(r.r - CL.stepped_rate(0.005, r.step, 10, 0.96)) < 1e-18


def test_sums_do_not_depend_on_the_partitions(spark):
    tr, _, _ = _rows(spark)
    W, b = np.random.default_rng(4).normal(size=(3, 64, 10)) * 0.1, np.zeros((3, 10))
    one = CL.softmax_pass(tr.repartition(1), W, b, eps=1e-5)
    many = CL.softmax_pass(tr.repartition(70), W, b, eps=1e-5)
    assert np.allclose(one["gW"], many["gW"]) and np.allclose(one["hits"], many["hits"]) and np.isclose(one["n"], many["n"])


def test_batches_are_whole_numbers(spark):
    df = spark.createDataFrame([((1 << 60) + 199,), (99,), (100,)], "k long")
    assert [r[0] for r in df.select(CL.batch_of("k", 100)).collect()] == [((1 << 60) + 199) // 100, 0, 1]


def test_grid_reshape_round_trip(spark):
    r = I.embedding_rows(spark, SF)
    lines = CV.grid_rows(r, "vec_id", "x", 8)
    assert lines.count() == r.count() * 8
    back = CV.grid_flatten(lines.repartition(5)).withColumnRenamed("id", "vec_id")
    joined = back.join(r, "vec_id")
    assert joined.filter("flat != x").count() == 0 and joined.count() == r.count()


def test_dense_runs_share_a_pass_and_match_single_runs(spark):
    tr, X, y = _rows(spark)
    te = CL.prepare_rows(I.embedding_rows(spark, SF), "label", "x", key="vec_id").filter("k % 5 = 4")
    pdf = te.toPandas()
    Xt, yt = np.stack(pdf["x"].to_numpy()), pdf["label"].to_numpy()
    sizes, runs = [64, 12, 10], [NN.DenseRun(0.01), NN.DenseRun(0.02, 0.5, "adam", 1, 0.5), NN.DenseRun(0.1, 1.0, "gd")]
    nets, metrics = NN.dense_nets_fit(tr, sizes, 2, runs, seed=3, eval_rows=te)
    for r, run in enumerate(runs):
        one, hist = NN.dense_net_fit(tr, sizes, 2, run.rate, run.optimizer, keep_prob=run.keep_prob, seed=3,
                                     decay_steps=run.decay_steps, decay_rate=run.decay_rate)
        assert all(np.allclose(a, b) for p, q in zip(nets[r], one) for a, b in zip(p, q))
        mine = [m for m in metrics if m[0] == r]
        assert np.allclose([(i, loss, acc) for _, i, split, loss, acc in mine if split == "train"], hist)
        P = CL.softmax_np(NN.forward_np(Xt, one))
        last = [m for m in mine if m[1:3] == (2, "eval")][0]
        assert last[3] == pytest.approx(-np.log(P[np.arange(len(yt)), yt] + CL.EPS).mean())
        assert last[4] == pytest.approx((P.argmax(axis=1) == yt).mean())


def test_dense_fit_matches_numpy(spark):
    tr, X, y = _rows(spark)
    keys = np.array([r.k for r in tr.select("k").collect()])
    layers = NN.init_layers([64, 9, 10], seed=5)
    got, _ = NN.dense_net_fit(tr, [64, 9, 10], 3, 0.05, "gd", keep_prob=0.5, seed=2, start=layers)
    for i in range(3):
        grads, _, _ = NN.backprop_np(X, y, keys, layers, "relu", 0.5, i, 2, 10)
        layers = [(W - 0.05 * gW / len(y), b - 0.05 * gb / len(y)) for (W, b), (gW, gb) in zip(layers, grads)]
    assert all(np.allclose(a, b, atol=1e-12) for p, q in zip(got, layers) for a, b in zip(p, q))


def test_library_network_scores_and_learns(spark):
    """The sigmoid network of the library: its weights, laid out by layer, give
    its predictions by our forward pass, and a lower loss than at the start."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors

    tr, X, y = _rows(spark)
    sizes = [64, 12, 10]
    start = NN.init_layers(sizes, seed=4)
    flat = np.concatenate([np.concatenate([W.ravel(), b]) for W, b in start])
    m = MultilayerPerceptronClassifier(layers=sizes, maxIter=30, initialWeights=Vectors.dense(flat)).fit(
        tr.select("k", "label", array_to_vector("x").alias("features")))

    def unpack(v):
        out, o = [], 0
        for a, b in zip(sizes[:-1], sizes[1:]):
            out.append((v[o:o + a * b].reshape(a, b), v[o + a * b:o + a * b + b]))
            o += a * b + b
        return out

    def loss(net):
        P = CL.softmax_np(NN.forward_np(X, net, "sigmoid"))
        return -np.log(P[np.arange(len(y)), y]).mean()

    net = unpack(m.weights.toArray())
    assert loss(net) < 0.8 * loss(start)
    pred = m.transform(tr.select("k", array_to_vector("x").alias("features"))).select("prediction").toPandas()["prediction"]
    assert (pred.to_numpy() == NN.forward_np(X, net, "sigmoid").argmax(axis=1)).all()
