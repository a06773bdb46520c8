"""Classification jobs on the 10-class image stand-in (embeddings as 64
pixels / an 8x8 grid): scoring, softmax training (GD, Adam, decay), metrics,
sweeps, dense networks, convolution and the idx image source."""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import classification as CL
from tessera.operators import conv as CV
from tessera.operators import conv_nets as CN
from tessera.operators import lbfgs as LB
from tessera.operators import networks as NN
from tessera.operators.regression import key_split
from tessera.plans import inputs as I
from tessera.plans import weights as W
from tessera.plans.conv_sql import conv_step_sql
from tessera.plans.dense_sql import dense_curve_sql, dense_fit_sql, lbfgs_curve_sql, lbfgs_scores_sql
from tessera.plans.registry import register
from tessera.plans.softmax_sql import SOFTMAX_P, eval_sql, softmax_cte, standard_rows_sql
from tessera.plans.vectors import EMB, SCORES_SQL
from tessera.session import drop_at_exit, materialize, release, shared_dir, table
from tessera.sources import idx as idx_src

D = 64
C = 10


def _rows(spark, sf_dir):
    return I.embedding_rows(spark, sf_dir)


def _fixed_layer():
    return [(W.class_weights(D), W.class_bias())]


def _scores(spark, sf_dir):
    """C1 scoring: one numpy matmul per Arrow batch (weights in the closure)."""
    r = _rows(spark, sf_dir).withColumn("label", F.col("label").cast("int"))
    return NN.score_rows(r, _fixed_layer(), digits=None, carry=("label",))


def _r6(c):
    return F.round(c, 6) + F.lit(0.0)


# -- C1 -----------------------------------------------------------------------------------

@register("class_scores", f"""
  SELECT vec_id, list_transform({SCORES_SQL}, lambda q: round(q, 6) + 0.0) AS scores FROM {EMB}""")
def class_scores(spark, sf_dir):
    return NN.score_rows(_rows(spark, sf_dir), _fixed_layer())


# -- C5 / C6 with fixed weights -------------------------------------------------------

SCORED = f"(SELECT vec_id, ilabel AS label, {SCORES_SQL} AS z FROM {EMB}) s"


@register("cross_entropy_eps", f"""
  SELECT round(avg(-ln(p[label + 1] + 1e-5)), 6) + 0.0 AS loss
  FROM (SELECT label, {SOFTMAX_P} AS p FROM {SCORED}) t""")
def cross_entropy_eps(spark, sf_dir):
    s = _scores(spark, sf_dir).select("label", V.softmax("scores").alias("p"))
    return s.agg(_r6(F.avg(-F.log(F.element_at("p", F.col("label") + 1) + F.lit(CL.EPS)))).alias("loss"))


@register("cross_entropy_scores", f"""
  SELECT round(avg(list_max(z) + ln(list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) - z[label + 1]), 6) + 0.0 AS loss
  FROM {SCORED}""")
def cross_entropy_scores(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.agg(_r6(F.avg(V.log_sum_exp("scores") - F.element_at("scores", F.col("label") + 1))).alias("loss"))


@register("accuracy", f"""
  SELECT round(avg(CAST(list_position(z, list_max(z)) - 1 = label AS DOUBLE)), 6) + 0.0 AS accuracy
  FROM {SCORED}""")
def accuracy(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.agg(_r6(F.avg((V.argmax("scores") == F.col("label")).cast("double"))).alias("accuracy"))


@register("accuracy_by_class", f"""
  SELECT label, count(*) AS n,
         round(avg(CAST(list_position(z, list_max(z)) - 1 = label AS DOUBLE)), 6) + 0.0 AS accuracy
  FROM {SCORED} GROUP BY label""")
def accuracy_by_class(spark, sf_dir):
    s = _scores(spark, sf_dir)
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                  _r6(F.avg((V.argmax("scores") == F.col("label")).cast("double"))).alias("accuracy"))


# -- C2 / C3: softmax regression trained in rounds -------------------------------------

SM_ROUNDS = 5


def _train_rows(spark, sf_dir):
    r = CL.prepare_rows(_rows(spark, sf_dir), "label", "x", key="vec_id")
    train, test = key_split(r, "k")
    return train, test


def _run_softmax(spark, sf_dir, runs, rounds, eps, eval_every=None):
    train, test = _train_rows(spark, sf_dir)
    train, test = materialize(train), materialize(test)
    try:
        evals = {"train": train, "test": test} if eval_every else None
        return CL.train_softmax(train, runs, rounds, D, C, eps=eps, eval_sets=evals,
                                eval_every=eval_every or 1)
    finally:
        release(train)
        release(test)


def _weights_sql(runs_values, eps):
    return softmax_cte(runs_values, SM_ROUNDS, eps) + f"""
SELECT CAST(jj.j AS INTEGER) AS j, CAST(cc.c AS INTEGER) AS c, round(W[cc.c + 1][jj.j + 1], 6) + 0.0 AS w
FROM sm, range({C}) cc(c), range({D + 1}) jj(j) WHERE k = {SM_ROUNDS}"""


@register("softmax_gd", _weights_sql("(0, 0.5, 0, NULL, NULL)", eps=True))
def softmax_gd(spark, sf_dir):
    Ws, bs, _ = _run_softmax(spark, sf_dir, [CL.Run(rate=0.5)], SM_ROUNDS, eps=CL.EPS)
    return spark.createDataFrame(CL.weights_long(Ws[0], bs[0]), "j int, c int, w double")


@register("softmax_adam", _weights_sql("(0, 0.005, 1, NULL, NULL)", eps=True))
def softmax_adam(spark, sf_dir):
    Ws, bs, _ = _run_softmax(spark, sf_dir, [CL.Run(rate=0.005, optimizer="adam")], SM_ROUNDS, eps=CL.EPS)
    return spark.createDataFrame(CL.weights_long(Ws[0], bs[0]), "j int, c int, w double")


ML_L2 = 0.5  # a penalty, so that the optimum is one


@register("softmax_mllib", softmax_cte("(0, 0.6, 0, NULL, NULL)", 150, False, l2=ML_L2, rows=standard_rows_sql) + f"""
SELECT vec_id, label, CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS prediction
FROM (SELECT te.vec_id, te.label, list_transform(range({C}), lambda q: list_dot_product(te.x, sm.W[q + 1])) AS z
      FROM te, sm WHERE sm.k = 150) s""")
def softmax_mllib(spark, sf_dir):
    r = _rows(spark, sf_dir).select("vec_id", "label", array_to_vector("x").alias("features"))
    train, test = key_split(r, "vec_id")
    train = materialize(train)  # L-BFGS reads the rows once per iteration
    try:
        m = LogisticRegression(family="multinomial", maxIter=200, regParam=ML_L2, tol=1e-10).fit(train)
    finally:
        release(train)
    return m.transform(test).select("vec_id", F.col("label").cast("int").alias("label"),
                                    F.col("prediction").cast("int").alias("prediction"))


@register("softmax_lbfgs", softmax_cte("(0, 3.0, 0, NULL, NULL)", 80, False, l2=ML_L2) + f"""
SELECT CAST(jj.j AS INTEGER) AS j, CAST(cc.c AS INTEGER) AS c, round(W[cc.c + 1][jj.j + 1], 6) + 0.0 AS w
FROM sm, range({C}) cc(c), range({D + 1}) jj(j) WHERE k = 80""")
def softmax_lbfgs(spark, sf_dir):
    """Own L-BFGS to the optimum, which the SQL reaches by gradient rounds."""
    train = materialize(_train_rows(spark, sf_dir)[0])
    try:
        Wm, b, _ = CL.fit_softmax(train, D, C, l2=ML_L2)
    finally:
        release(train)
    return spark.createDataFrame(CL.weights_long(Wm, b), "j int, c int, w double")


# -- C9: batches and the training curve ---------------------------------------------------

@register("minibatch_ids", """
  SELECT vec_id, CAST(vec_id // 100 AS BIGINT) AS batch_id FROM embeddings""")
def minibatch_ids(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", CL.batch_of("vec_id", 100).alias("batch_id"))


CURVE_ROUNDS, CURVE_EVERY = 6, 2


@register("softmax_training_curve", softmax_cte("(0, 0.5, 0, NULL, NULL)", CURVE_ROUNDS, True) + f"""
, ev AS ({eval_sql('xs', 'sm.k IN (1, 3, 5)')}),
  evt AS ({eval_sql('te', 'sm.k IN (1, 3, 5)')})
SELECT CAST(k - 1 AS INTEGER) AS round, 'train' AS split, round(accuracy, 6) + 0.0 AS accuracy,
       round(loss, 6) + 0.0 AS loss FROM ev
UNION ALL
SELECT CAST(k - 1 AS INTEGER), 'test', round(accuracy, 6) + 0.0, round(loss, 6) + 0.0 FROM evt""")
def softmax_training_curve(spark, sf_dir):
    _, _, metrics = _run_softmax(spark, sf_dir, [CL.Run(rate=0.5)], CURVE_ROUNDS, eps=CL.EPS,
                                 eval_every=CURVE_EVERY)
    rows = [(int(i), split, float(round(a, 6)) + 0.0, float(round(le, 6)) + 0.0)
            for _, i, split, a, le, _ in metrics]
    return spark.createDataFrame(rows, "round int, split string, accuracy double, loss double")


BATCH, BATCH_ROUNDS = 100, 6  # rounds: a setting
_BATCH_TEST = eval_sql("te", f"sm.k BETWEEN 1 AND {BATCH_ROUNDS}")
_BATCH_OWN = eval_sql(f"(SELECT x, label, vec_id // {BATCH} - lo AS b, span FROM xs, bats)", f"sm.k < {BATCH_ROUNDS} AND r.b = sm.k % r.span").replace("SELECT x, label FROM", "SELECT * FROM")


@register("softmax_minibatch", softmax_cte("(0, 0.5, 0, NULL, NULL)", BATCH_ROUNDS, True, batch=BATCH) + f"""
, own AS ({_BATCH_OWN}), evt AS ({_BATCH_TEST})
SELECT CAST(k AS INTEGER) AS round, 'batch' AS split, round(accuracy, 6) + 0.0 AS accuracy, round(loss, 6) + 0.0 AS loss FROM own
UNION ALL SELECT CAST(k - 1 AS INTEGER), 'test', round(accuracy, 6) + 0.0, round(loss, 6) + 0.0 FROM evt""")
def softmax_minibatch(spark, sf_dir):
    """Batches of 100 in turn, stored by batch: metrics of each round's batch
    before its update, and of the whole test part after it."""
    train, test = _train_rows(spark, sf_dir)
    test = materialize(test)
    try:
        _, _, metrics = CL.train_softmax(train, [CL.Run(rate=0.5)], BATCH_ROUNDS, D, C, eps=CL.EPS,
                                         eval_sets={"test": test}, batch_size=BATCH)
    finally:
        release(test)
    rows = [(int(i), split, float(round(a, 6)) + 0.0, float(round(le, 6)) + 0.0)
            for _, i, split, a, le, _ in metrics]
    return spark.createDataFrame(rows, "round int, split string, accuracy double, loss double")


# -- C10: sweep sharing one pass per round --------------------------------------------

SWEEP_RATES = [0.005, 0.01, 0.05]
SWEEP_STEPS = [2, 4]
SWEEP_DECAY = [0.9, 0.5]
SWEEP_ROUNDS = 6
SWEEP = [(r, s, d) for r in SWEEP_RATES for s in SWEEP_STEPS for d in SWEEP_DECAY]
SWEEP_VALUES = ", ".join(f"({i}, {r}, 1, {s}, {d})" for i, (r, s, d) in enumerate(SWEEP))
SWEEP_SQL = softmax_cte(SWEEP_VALUES, SWEEP_ROUNDS, False) + f"""
, evt AS ({eval_sql('te', f'sm.k >= 1')})"""


def _sweep_metrics(spark, sf_dir):
    runs = [CL.Run(rate=r, optimizer="adam", decay_steps=s, decay_rate=d) for r, s, d in SWEEP]
    train, test = _train_rows(spark, sf_dir)
    train, test = materialize(train), materialize(test)
    try:
        _, _, metrics = CL.train_softmax(train, runs, SWEEP_ROUNDS, D, C, eps=None,
                                         eval_sets={"test": test}, eval_every=1)
    finally:
        release(train)
        release(test)
    rows = [(int(r), int(i), float(round(a, 6)) + 0.0, float(round(ls, 6)) + 0.0)
            for r, i, _, a, _, ls in metrics]
    return spark.createDataFrame(rows, "run_id int, round int, test_accuracy double, test_loss double")


@register("sweep_softmax", SWEEP_SQL + """
SELECT CAST(run AS INTEGER) AS run_id, CAST(k - 1 AS INTEGER) AS round,
       round(accuracy, 6) + 0.0 AS test_accuracy, round(loss_scores, 6) + 0.0 AS test_loss FROM evt""")
def sweep_softmax(spark, sf_dir):
    return _sweep_metrics(spark, sf_dir)


@register("sweep_report", SWEEP_SQL + """
, rep AS (SELECT run, max(round(accuracy, 6) + 0.0) AS max_accuracy,
                 max_by(round(accuracy, 6) + 0.0, k) AS last_accuracy FROM evt GROUP BY run)
SELECT CAST(rep.run AS INTEGER) AS run_id, CAST(runs.rate AS DOUBLE) AS rate, CAST(runs.decay_steps AS INTEGER) AS decay_steps,
       CAST(runs.decay_rate AS DOUBLE) AS decay_rate, last_accuracy, max_accuracy
FROM rep JOIN runs ON runs.run = rep.run ORDER BY max_accuracy DESC, run_id""")
def sweep_report(spark, sf_dir):
    m = _sweep_metrics(spark, sf_dir)
    grid = spark.createDataFrame([(i, float(r), int(s), float(d)) for i, (r, s, d) in enumerate(SWEEP)],
                                 "run_id int, rate double, decay_steps int, decay_rate double")
    rep = m.groupBy("run_id").agg(F.max_by("test_accuracy", "round").alias("last_accuracy"),
                                  F.max("test_accuracy").alias("max_accuracy"))
    return rep.join(grid, "run_id").select("run_id", "rate", "decay_steps", "decay_rate",
                                           "last_accuracy", "max_accuracy") \
        .orderBy(F.desc("max_accuracy"), "run_id")


# -- C7: dense network scoring (fixed weights) and fitting ------------------------------

MLP_SIZES = [64, 200, 100, 60, 30, 10]


def mlp_layers():
    return [(W.layer_weights(a, b, salt=i + 1), W.layer_bias(b, salt=i + 1))
            for i, (a, b) in enumerate(zip(MLP_SIZES[:-1], MLP_SIZES[1:]))]


def _mlp_sql(hidden: str) -> str:
    act = {"relu": "greatest({a}, 0.0)", "sigmoid": "1.0 / (1.0 + exp(-({a})))"}[hidden]
    q = f"SELECT vec_id, x AS h0 FROM {EMB}"
    n_layers = len(MLP_SIZES) - 1
    for li, (a, b) in enumerate(zip(MLP_SIZES[:-1], MLP_SIZES[1:])):
        salt = li + 1
        pre = (f"list_dot_product(h{li}, list_transform(range({a}), lambda i: {W.layer_weights_sql('i', 'o', salt)}))"
               f" + {W.layer_bias_sql('o', salt)}")
        expr = pre if li == n_layers - 1 else act.format(a=pre)
        q = f"SELECT vec_id, list_transform(range({b}), lambda o: {expr}) AS h{li + 1} FROM ({q}) l{li}"
    return f"SELECT vec_id, list_transform(h{n_layers}, lambda q: round(q, 6) + 0.0) AS scores FROM ({q}) fin"


@register("mlp_forward_relu", _mlp_sql("relu"))
def mlp_forward_relu(spark, sf_dir):
    return NN.score_rows(_rows(spark, sf_dir), mlp_layers(), hidden="relu")


@register("mlp_forward_sigmoid", _mlp_sql("sigmoid"))
def mlp_forward_sigmoid(spark, sf_dir):
    return NN.score_rows(_rows(spark, sf_dir), mlp_layers(), hidden="sigmoid")


_DENSE_ROWS = "SELECT vec_id, label, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings WHERE vec_id % 5 < 4"
_DENSE_TEST = _DENSE_ROWS.replace("% 5 < 4", "% 5 >= 4")
NEWTON_ITERS = 10  # a setting: the oracle writes every iteration out
_NEWTON = (MLP_SIZES, NEWTON_ITERS, LB.LADDER, LB.ARMIJO)


def _sigmoid_fit(spark, sf_dir):
    train, _ = _train_rows(spark, sf_dir)
    train = materialize(train)  # two jobs an iteration read them
    try:
        return NN.dense_net_lbfgs(train, mlp_layers(), NEWTON_ITERS, "sigmoid")
    finally:
        release(train)


@register("mlp_fit_sigmoid", lbfgs_scores_sql(_DENSE_ROWS, _DENSE_TEST, *_NEWTON))
def mlp_fit_sigmoid(spark, sf_dir):
    """Scores of the test rows after ten L-BFGS iterations from weights by rule."""
    layers, _ = _sigmoid_fit(spark, sf_dir)
    _, test = key_split(_rows(spark, sf_dir).withColumn("label", F.col("label").cast("int")), "vec_id")
    s = NN.score_rows(test, layers, "sigmoid", digits=None, carry=("label",))
    return s.select("vec_id", "label", V.argmax("scores").alias("prediction"), V.round_array("scores", 5).alias("scores"))


@register("mlp_sigmoid_curve", lbfgs_curve_sql(_DENSE_ROWS, *_NEWTON))
def mlp_sigmoid_curve(spark, sf_dir):
    """Loss, largest gradient component and step of every iteration."""
    rows = [(k, float(round(f, 6)) + 0.0, float(round(g, 6)) + 0.0, float(t)) for k, f, g, t in _sigmoid_fit(spark, sf_dir)[1].curve]
    return spark.createDataFrame(rows, "iteration int, loss double, gradient double, step double")


FIT_ROUNDS = 2    # a setting: the oracle writes every round out
FIT_SEED = 11
FIT_RATE = 0.005


def _dense_fit(spark, sf_dir, keep_prob, decay=(None, None)):
    train, _ = _train_rows(spark, sf_dir)
    train = materialize(train)
    try:
        layers, _ = NN.dense_net_fit(train, MLP_SIZES, FIT_ROUNDS, rate=FIT_RATE, keep_prob=keep_prob, seed=FIT_SEED,
                                     decay_steps=decay[0], decay_rate=decay[1], start=mlp_layers())
    finally:
        release(train)
    rows = [(li + 1, int(i), int(o), float(round(v, 6)) + 0.0) for li, (Wl, bl) in enumerate(layers)
            for i, line in enumerate(np.vstack([Wl, bl[None, :]])) for o, v in enumerate(line)]
    return spark.createDataFrame(rows, "layer int, i int, o int, w double")


@register("mlp_fit_relu", dense_fit_sql(_DENSE_ROWS, MLP_SIZES, FIT_ROUNDS, FIT_RATE, 1.0, FIT_SEED, None, None))
def mlp_fit_relu(spark, sf_dir):
    """Weights after two Adam rounds from weights by rule (bias as input ``i = d``)."""
    return _dense_fit(spark, sf_dir, keep_prob=1.0)


@register("mlp_fit_dropout", dense_fit_sql(_DENSE_ROWS, MLP_SIZES, FIT_ROUNDS, FIT_RATE, 0.75, FIT_SEED, 1, 0.96))
def mlp_fit_dropout(spark, sf_dir):
    """The same under dropout by a hash rule, with a decaying rate."""
    return _dense_fit(spark, sf_dir, keep_prob=0.75, decay=(1, 0.96))


# -- C9/C10 on the dense network: its curve, and a sweep with dropout -------------------

NET_ROUNDS = 6  # a setting


def _dense_metrics(spark, sf_dir, runs, eval_every):
    train, test = (materialize(r) for r in _train_rows(spark, sf_dir))
    try:
        return NN.dense_nets_fit(train, MLP_SIZES, NET_ROUNDS, runs, seed=FIT_SEED, start=mlp_layers(),
                                 eval_rows=test, eval_every=eval_every)[1]
    finally:
        release(train)
        release(test)


@register("mlp_training_curve", dense_curve_sql(_DENSE_ROWS, _DENSE_ROWS.replace("% 5 < 4", "% 5 >= 4"), MLP_SIZES, NET_ROUNDS, FIT_RATE))
def mlp_training_curve(spark, sf_dir):
    """Loss and accuracy of the training pass and of the test part by round."""
    rows = [(int(i), split, float(round(a, 6)) + 0.0, float(round(loss, 6)) + 0.0)
            for _, i, split, loss, a in _dense_metrics(spark, sf_dir, [NN.DenseRun(FIT_RATE)], 1)]
    return spark.createDataFrame(rows, "round int, split string, accuracy double, loss double")


DROPOUT_SWEEP = [(r, k, s, d) for r in (0.001, 0.005, 0.01) for k in (0.5, 0.75, 1.0) for s in (2, 4) for d in (0.9, 0.5)]


@register("sweep_dropout")
def sweep_dropout(spark, sf_dir):
    """36 runs (rate, keep probability, decay steps, decay rate) that share each
    pass: last and best test accuracy."""
    runs = [NN.DenseRun(r, k, "adam", s, d) for r, k, s, d in DROPOUT_SWEEP]
    rows = [(int(r), int(i), float(round(a, 6)) + 0.0) for r, i, split, _, a in _dense_metrics(spark, sf_dir, runs, 2) if split == "eval"]
    grid = spark.createDataFrame([(i, *g) for i, g in enumerate(DROPOUT_SWEEP)], "run_id int, rate double, keep_prob double, decay_steps int, decay_rate double")
    m = spark.createDataFrame(rows, "run_id int, round int, accuracy double").groupBy("run_id").agg(
        F.max_by("accuracy", "round").alias("last_accuracy"), F.max("accuracy").alias("max_accuracy"))
    return m.join(grid, "run_id").select("run_id", "rate", "keep_prob", "decay_steps", "decay_rate", "last_accuracy", "max_accuracy")


# -- C11: convolution per image; C12: a stack of them, scored densely ------------------

def conv_kernel(k, ci, co, salt):
    a = np.arange(k)[:, None, None, None]
    b = np.arange(k)[None, :, None, None]
    c = np.arange(ci)[None, None, :, None]
    d = np.arange(co)[None, None, None, :]
    return (((3 * a + 5 * b + 7 * c + 11 * d + salt) % 9) - 4) / 8.0


def conv_kernel_sql(k, ci, co, salt):
    return (f"SELECT CAST(a.ky AS INTEGER) AS ky, CAST(b.kx AS INTEGER) AS kx, CAST(c.ci AS INTEGER) AS ci, "
            f"CAST(d.co AS INTEGER) AS co, "
            f"(((3 * a.ky + 5 * b.kx + 7 * c.ci + 11 * d.co + {salt}) % 9) - 4) / 8.0 AS w "
            f"FROM range({k}) a(ky), range({k}) b(kx), range({ci}) c(ci), range({co}) d(co)")


def conv_bias(co, salt):
    return (((np.arange(co) + salt) % 5) - 2) / 16.0


def _conv_sql(k, co, stride, salt):
    out, pad = CV.same_geometry(8, k, stride)
    return f"""
WITH px AS (SELECT vec_id AS id, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x,
                   0 AS ci, CAST(embedding[i] AS DOUBLE) AS v
            FROM embeddings, range(1, 65) t(i)),
kr AS ({conv_kernel_sql(k, 1, co, salt)}),
j AS (SELECT id, co, y - ky + {pad} AS ny, x - kx + {pad} AS nx, v * w AS vw FROM px JOIN kr USING (ci))
SELECT id AS vec_id, CAST(ny // {stride} AS INTEGER) AS oy, CAST(nx // {stride} AS INTEGER) AS ox,
       CAST(co AS INTEGER) AS co,
       round(greatest(sum(vw) + ((((co + {salt}) % 5) - 2) / 16.0), 0.0), 6) + 0.0 AS value
FROM j WHERE ny >= 0 AND nx >= 0 AND ny % {stride} = 0 AND nx % {stride} = 0
  AND ny < {out * stride} AND nx < {out * stride}
GROUP BY id, ny // {stride}, nx // {stride}, co"""


def _conv_query(spark, sf_dir, k, co, stride, salt):
    out = CV.conv2d_rows(_rows(spark, sf_dir), conv_kernel(k, 1, co, salt), 8, 8, stride, bias=conv_bias(co, salt), relu=True)
    return out.select("vec_id", "oy", "ox", "co", _r6(F.col("value")).alias("value"))


@register("grid_conv2d_s1", _conv_sql(3, 4, 1, 1))
def grid_conv2d_s1(spark, sf_dir):
    return _conv_query(spark, sf_dir, 3, 4, 1, 1)


@register("grid_conv2d_s2", _conv_sql(5, 2, 2, 2))
def grid_conv2d_s2(spark, sf_dir):
    return _conv_query(spark, sf_dir, 5, 2, 2, 2)


def conv_stack():
    """Three convolutions 5x5x1x4 (s1), 5x5x4x8 (s2), 4x4x8x12 (s2) on 8x8,
    then dense 48 -> 200 ReLU -> 10."""
    convs = [(conv_kernel(5, 1, 4, 1), conv_bias(4, 1), 1),
             (conv_kernel(5, 4, 8, 2) / 4.0, conv_bias(8, 2), 2),
             (conv_kernel(4, 8, 12, 3) / 8.0, conv_bias(12, 3), 2)]
    dense = [(W.layer_weights(2 * 2 * 12, 200, 4), W.layer_bias(200, 4)),
             (W.layer_weights(200, 10, 5), W.layer_bias(10, 5))]
    return convs, dense


def _conv_layer_sql(src: str, h: int, k: int, ci: int, co: int, stride: int, salt: int, div: float) -> str:
    """One SAME convolution + bias + ReLU over ``src(id, y, x, ci, v)`` as a
    join with the kernel and a grouped sum; yields ``(id, y, x, ci, v)``."""
    out, pad = CV.same_geometry(h, k, stride)
    kern = conv_kernel_sql(k, ci, co, salt).replace(" AS w ", f" / {div} AS w ", 1)
    return f"""(SELECT id, CAST(ny // {stride} AS INTEGER) AS y, CAST(nx // {stride} AS INTEGER) AS x,
       CAST(co AS INTEGER) AS ci, greatest(sum(vw) + ((((co + {salt}) % 5) - 2) / 16.0), 0.0) AS v
  FROM (SELECT id, co, y - ky + {pad} AS ny, x - kx + {pad} AS nx, v * w AS vw
        FROM {src} s JOIN ({kern}) kr USING (ci)) j
  WHERE ny >= 0 AND nx >= 0 AND ny % {stride} = 0 AND nx % {stride} = 0
    AND ny < {out * stride} AND nx < {out * stride}
  GROUP BY id, ny // {stride}, nx // {stride}, co)"""


def _conv_stack_sql() -> str:
    px = ("(SELECT vec_id AS id, CAST((i - 1) // 8 AS INTEGER) AS y, CAST((i - 1) % 8 AS INTEGER) AS x, "
          "0 AS ci, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) t(i))")
    l1 = _conv_layer_sql(px, 8, 5, 1, 4, 1, 1, 1.0)
    l2 = _conv_layer_sql(l1, 8, 5, 4, 8, 2, 2, 4.0)
    l3 = _conv_layer_sql(l2, 4, 4, 8, 12, 2, 3, 8.0)
    h1 = (f"list_transform(range(200), lambda o: greatest(list_dot_product(f, list_transform(range(48), "
          f"lambda i: {W.layer_weights_sql('i', 'o', 4)})) + {W.layer_bias_sql('o', 4)}, 0.0))")
    z = (f"list_transform(range(10), lambda o: list_dot_product(h, list_transform(range(200), "
         f"lambda i: {W.layer_weights_sql('i', 'o', 5)})) + {W.layer_bias_sql('o', 5)})")
    return f"""
SELECT vec_id, list_transform(z, lambda q: round(q, 6) + 0.0) AS scores FROM (
  SELECT vec_id, {z} AS z FROM (
    SELECT vec_id, {h1} AS h FROM (
      SELECT id AS vec_id, list(v ORDER BY y, x, ci) AS f FROM {l3} l3 GROUP BY id) fl) hh) zz"""


@register("conv_stack_scores", _conv_stack_sql())
def conv_stack_scores(spark, sf_dir):
    convs, dense = conv_stack()
    return CV.score_conv_stack(_rows(spark, sf_dir), convs, dense, 8, 8)


# -- C10/C12: training of that stack -----------------------------------------------------

CONV_RATE = 0.05
CONV_SHAPES = [(5, 1, 4, 1, 1, 1.0), (5, 4, 8, 2, 2, 4.0), (4, 8, 12, 2, 3, 8.0)]  # k, ci, co, stride, salt, divisor
CONV_STRIDES = [s for _, _, _, s, _, _ in CONV_SHAPES]
_CONV_LAYERS = [(k, ci, co, s, conv_kernel_sql(k, ci, co, salt).replace(" AS w ", f" / {div} AS w ", 1), f"((((co + {salt}) % 5) - 2) / 16.0)")
                for k, ci, co, s, salt, div in CONV_SHAPES]


def conv_net():
    """The layers of ``conv_stack`` as a start for training."""
    convs, dense = conv_stack()
    return [(Wc, b) for Wc, b, _ in convs] + dense


def _conv_fit(spark, sf_dir, rounds, runs, test_too=False):
    train, test = (materialize(r) for r in _train_rows(spark, sf_dir))
    try:
        return CN.conv_nets_fit(train, conv_net(), CONV_STRIDES, 8, 8, rounds, runs, FIT_SEED, test if test_too else None)
    finally:
        release(train)
        release(test)


@register("conv_fit", conv_step_sql(_DENSE_ROWS, _CONV_LAYERS, (200, 4), C, CONV_RATE))
def conv_fit(spark, sf_dir):
    """Weights of three convolutions and two dense layers after one step against
    the mean gradient, from weights by rule (the bias as the last input)."""
    nets, _ = _conv_fit(spark, sf_dir, 1, [NN.DenseRun(CONV_RATE, optimizer="gd")])
    rows = [(li + 1, int(i), int(o), float(round(v, 6)) + 0.0) for li, (Wl, bl) in enumerate(nets[0])
            for i, line in enumerate(np.vstack([Wl.reshape(-1, len(bl)), bl[None, :]])) for o, v in enumerate(line)]
    return spark.createDataFrame(rows, "layer int, i int, o int, w double")


# -- S4: idx image files written from the table and read back --------------------------

IDX_SQL = """
  SELECT label, list_transform(embedding, lambda v: round(floor(abs(CAST(v AS DOUBLE)) * 255) / 255.0, 6) + 0.0) AS pixels
  FROM embeddings"""


def _idx_images(spark, sf_dir, compress, records_per_task):
    r = _rows(spark, sf_dir).select(
        F.transform("x", lambda v: F.floor(F.abs(v) * 255).cast("int")).alias("pixels"),
        F.col("label").cast("int").alias("label"))
    path = shared_dir(spark, "idx")
    idx_src.write_idx(r, path, "pixels", "label", 8, 8, compress=compress)
    back = idx_src.read_idx(spark, path, records_per_task=records_per_task)
    return drop_at_exit(back.select("label", V.round_array("pixels").alias("pixels")), path)


@register("src_idx_images", IDX_SQL)
def src_idx_images(spark, sf_dir):
    """gzip files, one task each."""
    return _idx_images(spark, sf_dir, True, idx_src.RECORDS_PER_TASK)


@register("src_idx_ranges", IDX_SQL)
def src_idx_ranges(spark, sf_dir):
    """Plain files, a task for every 4,096 records."""
    return _idx_images(spark, sf_dir, False, 4096)
