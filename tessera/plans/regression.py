"""Regression jobs: stages and pipelines, the one-pass gradient descent, the elastic
net, and cross-validation from one scan."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import RegexTokenizer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tessera.operators import elastic as EL
from tessera.operators import kept_sums as KS
from tessera.operators import regression as RG
from tessera.operators import sampling as SA
from tessera.operators import stages as S
from tessera.plans import inputs as I
from tessera.plans import weights as W
from tessera.plans.gd_sql import (cv_cte, elastic_cte, gd_cte, gd_error_curve_sql, gd_predict_sql, gd_weights_sql,
                                  path_cte, path_points_cte, proximal_cte, proximal_points_cte)
from tessera.plans.registry import register
from tessera.session import drop_dir, shared_dir, table

D = 64            # all elements of an embedding
D2 = D * (D + 3) // 2  # and of their degree-2 expansion
ROUNDS = 100      # rounds of the hand-written descent
ALPHA = 1.0


def _r6(c):
    return (F.round(c, 6) + F.lit(0.0))


X_SQL = "list_transform(embedding, lambda v: CAST(v AS DOUBLE))"
ALL_SQL = f"SELECT vec_id, CAST(label AS DOUBLE) AS y, {X_SQL} AS x FROM embeddings"
TRAIN_SQL = f"{ALL_SQL} WHERE vec_id % 5 < 4"


def _train(spark, sf_dir):
    return RG.key_split(I.embedding_rows(spark, sf_dir), "vec_id")[0]


def _curve_df(spark, err):
    rows = [(int(i), float(round(e, 6)) + 0.0) for i, e in enumerate(err)]
    return spark.createDataFrame(rows, "iter int, rmse double")


def _weights_df(spark, w):
    rows = [(int(i), float(round(v, 6)) + 0.0) for i, v in enumerate(w)]
    return spark.createDataFrame(rows, "i int, weight double")


# -- R1: key split ------------------------------------------------------------------

@register("key_split", """
  SELECT CASE WHEN vec_id % 5 < 4 THEN 'train' ELSE 'test' END AS part, count(*) AS n
  FROM embeddings GROUP BY 1""")
def key_split(spark, sf_dir):
    train, test = RG.key_split(table(spark, sf_dir, "embeddings").select("vec_id"), "vec_id")
    both = train.withColumn("part", F.lit("train")).union(test.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


SPLIT_SEED = 11
_SPLIT_ORDER = f"(o_orderkey * 48271 + {SPLIT_SEED}) % 2147483647"


@register("split_exact", f"""
  SELECT o_orderkey, o_orderpriority,
         CAST(CASE WHEN r < floor(n * 0.8 + 0.5) THEN 0 ELSE 1 END AS INTEGER) AS part
  FROM (SELECT o_orderkey, o_orderpriority, count(*) OVER (PARTITION BY o_orderpriority) AS n,
               row_number() OVER (PARTITION BY o_orderpriority ORDER BY {_SPLIT_ORDER}) - 1 AS r FROM orders) t""")
def split_exact(spark, sf_dir):
    """80/20, exactly so in every priority, by the order of a hash of the key."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return SA.exact_split(rows, [0.8, 0.2], F.expr(_SPLIT_ORDER), "o_orderpriority", SPLIT_SEED)


# -- U1: double -> double function as a stage ------------------------------------------

@register("udf_double", """
  SELECT o_orderkey, round(o_totalprice / 1000.0 - 250.0, 6) + 0.0 AS price_k FROM orders""")
def udf_double(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    st = S.ColumnTransform(inputCol="o_totalprice", outputCol="price_k",
                           expr="round({x} / 1000.0 - 250.0, 6) + 0.0")
    return st.transform(o).select("o_orderkey", "price_k")


# -- U2: vector -> double function as a stage (vectorised Python) ---------------------

@register("udf_vector", """
  SELECT vec_id, round(sqrt(list_dot_product(x, x)), 6) + 0.0 AS norm
  FROM (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings) e""")
def udf_vector(spark, sf_dir):
    r = I.embedding_rows(spark, sf_dir)
    st = S.PandasColumnTransform(lambda m: np.round(np.sqrt((m * m).sum(axis=1)), 6) + 0.0,
                                 inputCol="x", outputCol="norm", rowwise_arrays=True)
    return st.transform(r).select("vec_id", "norm")


@S.column_function(rowwise_arrays=True)
def vector_norm(m):
    """Euclidean norms of a batch of vectors."""
    return np.round(np.sqrt((m * m).sum(axis=1)), 6) + 0.0


@register("udf_vector_saved", """
  SELECT vec_id, 2.0 * (round(sqrt(list_dot_product(x, x)), 6) + 0.0) AS twice
  FROM (SELECT vec_id, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x FROM embeddings) e""")
def udf_vector_saved(spark, sf_dir):
    """The vector function as a stage of a pipeline that is saved and loaded again."""
    stages = [S.NamedColumnTransform(inputCol="x", outputCol="norm", function=f"{__name__}:vector_norm"),
              S.ColumnTransform(inputCol="norm", outputCol="twice", expr="2.0D * {x}")]
    rows, path = I.embedding_rows(spark, sf_dir), shared_dir(spark, "pipeline")
    Pipeline(stages=stages).fit(rows).save(path)
    try:
        return PipelineModel.load(path).transform(rows).select("vec_id", "twice")
    finally:
        drop_dir(spark, path)


# -- U3: label shift with the minimum of the training part --------------------------

@register("label_shift", """
  SELECT o_orderkey, y AS year, CAST(y AS DOUBLE) - min(y) FILTER (WHERE o_orderkey % 5 < 4) OVER () AS label
  FROM (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders) o""")
def label_shift(spark, sf_dir):
    songs = I.song_table(spark, sf_dir).select("o_orderkey", "year")
    train, _ = RG.key_split(songs, "o_orderkey")
    model = S.LabelShift(inputCol="year", outputCol="label").fit(train)
    return model.transform(songs).select("o_orderkey", "year", "label")


# -- R2: preparation pipeline: text row -> label + features ---------------------------

def prep_stages(features_out="features", start=1):
    return [
        RegexTokenizer(inputCol="value", outputCol="tokens", pattern=","),
        S.Array2Vector(inputCol="tokens", outputCol="vector"),
        S.ArraySlicer(inputCol="vector", outputCol="year", indices=[0]),
        S.FirstElement(inputCol="year", outputCol="double"),
        S.LabelShift(inputCol="double", outputCol="label"),
        S.ArraySlicer(inputCol="vector", outputCol=features_out, start=start),
    ]


@register("prep_stages_fit", """
  SELECT vec_id, CAST(label AS DOUBLE) - min(CAST(label AS DOUBLE)) FILTER (WHERE vec_id % 5 < 4) OVER () AS label,
         list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS features
  FROM embeddings""")
def prep_stages_fit(spark, sf_dir):
    lines = I.embedding_lines(spark, sf_dir)
    train, _ = RG.key_split(lines, "vec_id")
    model = Pipeline(stages=prep_stages()).fit(train)
    return model.transform(lines).select("vec_id", "label", "features")


# -- R5: RMSE of (label, prediction) ----------------------------------------------------

W_LIN_SQL = f"list_transform(range({D}), lambda j: {W.linear_weights_sql('j')})"


@register("rmse", f"""
  SELECT round(sqrt(avg(power(y - list_dot_product(x, {W_LIN_SQL}), 2))), 6) + 0.0 AS rmse
  FROM ({ALL_SQL}) t""")
def rmse(spark, sf_dir):
    r = I.embedding_rows(spark, sf_dir)
    return RG.rmse(RG.with_prediction(r, W.linear_weights(D), "x")).select(_r6(F.col("rmse")).alias("rmse"))


# -- R6: Gram summary and the gradient at fixed weights --------------------------------

@register("gram_matrix", f"""
  SELECT CAST(a.i AS INTEGER) AS i, CAST(b.j AS INTEGER) AS j,
         round(sum(x[a.i + 1] * x[b.j + 1]), 6) + 0.0 AS g
  FROM ({ALL_SQL}) t, range({D}) a(i), range({D}) b(j) GROUP BY a.i, b.j""")
def gram_matrix(spark, sf_dir):
    """Runs the pass when called; returns its d x d numbers."""
    G = RG.gram_stats(I.embedding_rows(spark, sf_dir), "label", "x")[0].G
    rows = [(i, j, float(round(G[i, j], 6)) + 0.0) for i in range(D) for j in range(D)]
    return spark.createDataFrame(rows, "i int, j int, g double")


@register("gradient", f"""
  SELECT CAST(a.i AS INTEGER) AS i,
         round(sum(x[a.i + 1] * (list_dot_product(x, {W_LIN_SQL}) - y)), 6) + 0.0 AS g
  FROM ({ALL_SQL}) t, range({D}) a(i) GROUP BY a.i""")
def gradient(spark, sf_dir):
    """Runs the pass when called; returns its d numbers."""
    g = RG.gradient_pass(I.embedding_rows(spark, sf_dir), W.linear_weights(D), "label", "x")[0][0]
    return spark.createDataFrame([(i, float(round(v, 6)) + 0.0) for i, v in enumerate(g)],
                                 "i int, g double")


# -- R7: gradient descent, one pass --------------------------------------------------

def _fit_gd(spark, sf_dir):
    est = RG.GDLinearRegression(featuresCol="x", labelCol="label", maxIter=ROUNDS, stepSize=ALPHA)
    return est.fit(_train(spark, sf_dir))


@register("gd_weights", gd_weights_sql(TRAIN_SQL, D, ROUNDS, ALPHA))
def gd_weights(spark, sf_dir):
    return _weights_df(spark, _fit_gd(spark, sf_dir).weights)


COPY_ROUNDS = 20


@register("gd_copied_learner", " UNION ALL ".join(
    f"SELECT '{name}' AS learner, i, weight FROM ({gd_weights_sql(TRAIN_SQL, D, n, ALPHA)}) {name}"
    for name, n in (("first", COPY_ROUNDS), ("copied", 2 * COPY_ROUNDS))))
def gd_copied_learner(spark, sf_dir):
    """A learner, and its copy with other rounds: each fits by its own parameters."""
    train = _train(spark, sf_dir)
    first = RG.GDLinearRegression(featuresCol="x", labelCol="label", maxIter=COPY_ROUNDS, stepSize=ALPHA)
    copied = first.copy({first.maxIter: 2 * COPY_ROUNDS})
    fits = [_weights_df(spark, est.fit(train).weights).select(F.lit(name).alias("learner"), "i", "weight")
            for name, est in (("copied", copied), ("first", first))]
    return fits[0].unionByName(fits[1])


KEPT_PARTS = 4


def _kept_sql():
    states = [f"vec_id % {KEPT_PARTS} <= {k}" for k in range(KEPT_PARTS)] + [f"vec_id % {KEPT_PARTS} > 0"]
    return " UNION ALL ".join(f"SELECT CAST({k} AS INTEGER) AS state, i, weight FROM ({gd_weights_sql(f'{TRAIN_SQL} AND {own}', D, ROUNDS, ALPHA)}) s{k}"
                              for k, own in enumerate(states))


@register("gd_kept_sums", _kept_sql())
def gd_kept_sums(spark, sf_dir):
    """The weights after each of four parts of the training rows has arrived, and after the
    first is taken away again: every part is read once, fits start from the kept sums."""
    train = _train(spark, sf_dir)
    kept, rows = KS.KeptSums(spark, shared_dir(spark, "kept-sums")), []

    def fit(state):
        w, _, _ = RG.descend(kept.stats()[0], ROUNDS, ALPHA)
        rows.extend((state, int(i), float(round(v, 6)) + 0.0) for i, v in enumerate(w))

    try:
        for k in range(KEPT_PARTS):
            kept.append(train.filter(F.col("vec_id") % KEPT_PARTS == k), k, "label", "x")
            fit(k)
        kept.remove(0)
        fit(KEPT_PARTS)
    finally:
        kept.drop()
    return spark.createDataFrame(rows, "state int, i int, weight double")


@register("gd_error_curve", gd_error_curve_sql(TRAIN_SQL, D, ROUNDS, ALPHA))
def gd_error_curve(spark, sf_dir):
    return _curve_df(spark, _fit_gd(spark, sf_dir).trainingError)


@register("gd_rmse_parts", gd_cte(TRAIN_SQL, D, ROUNDS, ALPHA) + f"""
SELECT CASE WHEN a.vec_id % 5 < 4 THEN 'train' ELSE 'test' END AS part,
       round(sqrt(avg(power(a.y - list_dot_product(a.x, gd.w), 2))), 6) + 0.0 AS rmse
FROM gd, ({ALL_SQL}) a WHERE gd.k = {ROUNDS} GROUP BY 1""")
def gd_rmse_parts(spark, sf_dir):
    """RMSE of the fitted model on both parts, in one grouped pass."""
    model = _fit_gd(spark, sf_dir)
    rows = I.embedding_rows(spark, sf_dir)
    pred = model.transform(rows).select(
        F.when(RG.in_train("vec_id"), "train").otherwise("test").alias("part"), "label", "prediction")
    return pred.groupBy("part").agg(
        _r6(F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2)))).alias("rmse"))


# -- R8/R9: text rows -> prep -> polynomial features -> descent, then test rows ------

def poly_sql(x: str) -> str:
    """The degree-2 expansion of a list in SQL, MLlib's order."""
    return (f"flatten(list_transform(range(len({x})), lambda k: list_concat([{x}[k + 1]], "
            f"list_transform(range(k + 1), lambda i: {x}[i + 1] * {x}[k + 1]))))")


POLY_ROWS = f"""SELECT vec_id, CAST(label AS DOUBLE) - (SELECT min(label) FROM embeddings WHERE vec_id % 5 < 4) AS y,
       {poly_sql('x')} AS x FROM (SELECT vec_id, label, {X_SQL} AS x FROM embeddings) e"""
POLY_TRAIN = f"SELECT * FROM ({POLY_ROWS}) p WHERE vec_id % 5 < 4"
POLY_TEST = f"SELECT * FROM ({POLY_ROWS}) p WHERE vec_id % 5 >= 4"


def poly_stages():
    """The expansion is part of the learner: rows keep 64 features up to the sums
    and are expanded to 2,144 where these are made."""
    return Pipeline(stages=prep_stages() + [RG.GDLinearRegression(maxIter=ROUNDS, stepSize=ALPHA, degree=2)])


def _fit_poly(spark, sf_dir):
    lines = I.embedding_lines(spark, sf_dir)
    train, test = RG.key_split(lines, "vec_id")
    return poly_stages().fit(train), test


@register("gd_poly_fit", gd_weights_sql(POLY_TRAIN, D2, ROUNDS, ALPHA))
def gd_poly_fit(spark, sf_dir):
    model, _ = _fit_poly(spark, sf_dir)
    return _weights_df(spark, model.stages[-1].weights)


@register("gd_test_predictions", gd_predict_sql(POLY_TRAIN, POLY_TEST, D2, ROUNDS, ALPHA))
def gd_test_predictions(spark, sf_dir):
    model, test = _fit_poly(spark, sf_dir)
    return model.transform(test).select("vec_id", "label", _r6(F.col("prediction")).alias("prediction"))


# -- R10-R12: grid x folds from one scan ----------------------------------------------

CV_ROUNDS = [10, 20, 30, 40, 50, 60]
CV_ALPHAS = [0.25, 0.5, 0.75, 1.0, 1.5, 2.0]
CV_FOLDS = 6
CV_GRID = [{"rounds": r, "alpha": a} for a in CV_ALPHAS for r in CV_ROUNDS]


def _grid_values(grid, cols):
    return ", ".join("(" + ", ".join([str(i)] + [repr(g[c]) for c in cols]) + ")"
                     for i, g in enumerate(grid))


CV_ROWS = f"SELECT 0 AS s, CAST(vec_id % {CV_FOLDS} AS INTEGER) AS fold, y, x FROM ({TRAIN_SQL}) t"
CV_FITS = f"SELECT v, 0 AS s, CAST(alpha AS DOUBLE) AS alpha FROM (VALUES {', '.join(f'({i}, {a})' for i, a in enumerate(CV_ALPHAS))}) al(v, alpha)"

CV_GRID_SQL = cv_cte(CV_ROWS, CV_FITS, max(CV_ROUNDS)) + f"""
, res AS (
  SELECT g.grid_id, CAST(g.rounds AS INTEGER) AS rounds, CAST(g.alpha AS DOUBLE) AS alpha, round(avg(val.rmse), 6) + 0.0 AS avg_rmse
  FROM val JOIN va USING (v)
  JOIN (VALUES {_grid_values(CV_GRID, ['rounds', 'alpha'])}) g(grid_id, rounds, alpha)
    ON g.rounds = val.rounds AND g.alpha = va.alpha
  GROUP BY g.grid_id, g.rounds, g.alpha)
"""


def _cv_rows(spark, sf_dir):
    return _train(spark, sf_dir).withColumn("fold", F.pmod("vec_id", F.lit(CV_FOLDS)).cast("int"))


def _cv_result(spark, sf_dir):
    res, _ = RG.cv_one_pass(_cv_rows(spark, sf_dir), "fold", CV_GRID, "label", "x")
    rows = [(int(t.grid_id), int(t.rounds), float(t.alpha), float(round(t.avg_rmse, 6)) + 0.0)
            for t in res.itertuples()]
    return spark.createDataFrame(rows, "grid_id int, rounds int, alpha double, avg_rmse double")


CV_BEST_SQL = CV_GRID_SQL + """
, best AS (SELECT grid_id, rounds, alpha, avg_rmse FROM res ORDER BY avg_rmse, grid_id LIMIT 1),
  bw AS (SELECT gd.w FROM gd JOIN va USING (v) JOIN best ON best.alpha = va.alpha AND best.rounds = gd.k WHERE gd.f = -1)
"""


@register("cv_best_test_predictions", CV_BEST_SQL + f"""
SELECT t.vec_id, t.y AS label, round(list_dot_product(t.x, bw.w), 6) + 0.0 AS prediction
FROM ({ALL_SQL} WHERE vec_id % 5 >= 4) t, bw""")
def cv_best_test_predictions(spark, sf_dir):
    """Test predictions from the tuned model (the best grid point refit on
    all training rows), not from an untuned one."""
    _, test = RG.key_split(I.embedding_rows(spark, sf_dir), "vec_id")
    _, _, model = RG.cv_refit_best(_cv_rows(spark, sf_dir), "fold", CV_GRID, "label", "x")
    return model.transform(test).select("vec_id", "label", _r6(F.col("prediction")).alias("prediction"))


@register("cv_best_summary", CV_BEST_SQL + f"""
SELECT CAST(grid_id AS INTEGER) AS grid_id, rounds, alpha, avg_rmse,
       (SELECT round(sqrt(avg(power(y - list_dot_product(x, bw.w), 2))), 6) + 0.0 FROM ({TRAIN_SQL}) t) AS train_rmse,
       (SELECT round(sqrt(avg(power(y - list_dot_product(x, bw.w), 2))), 6) + 0.0 FROM ({ALL_SQL} WHERE vec_id % 5 >= 4) t) AS test_rmse
FROM best, bw""")
def cv_best_summary(spark, sf_dir):
    """The best grid point with the refit model's RMSE on both parts."""
    _, best, model = RG.cv_refit_best(_cv_rows(spark, sf_dir), "fold", CV_GRID, "label", "x")
    pred = model.transform(I.embedding_rows(spark, sf_dir))
    part = F.pow(F.col("label") - F.col("prediction"), 2)
    out = pred.agg(_r6(F.sqrt(F.avg(F.when(RG.in_train("vec_id"), part)))).alias("train_rmse"),
                   _r6(F.sqrt(F.avg(F.when(~RG.in_train("vec_id"), part)))).alias("test_rmse"))
    return out.select(F.lit(int(best["grid_id"])).alias("grid_id"), F.lit(int(best["rounds"])).alias("rounds"),
                      F.lit(float(best["alpha"])).alias("alpha"), F.lit(float(round(best["avg_rmse"], 6)) + 0.0).alias("avg_rmse"),
                      "train_rmse", "test_rmse")


@register("cv_gd_grid", CV_GRID_SQL + "SELECT CAST(grid_id AS INTEGER) AS grid_id, rounds, alpha, avg_rmse FROM res")
def cv_gd_grid(spark, sf_dir):
    return _cv_result(spark, sf_dir)


@register("cv_best", CV_GRID_SQL + """SELECT CAST(grid_id AS INTEGER) AS grid_id, rounds, alpha, avg_rmse
  FROM res ORDER BY avg_rmse, grid_id LIMIT 1""")
def cv_best(spark, sf_dir):
    return _cv_result(spark, sf_dir).orderBy("avg_rmse", "grid_id").limit(1)


# -- R11-R13: the elastic net searched over iterations and penalties -----------------

NET_ITERS = [10, 50, 100, 150, 200, 250]
NET_REGS = [0.1, 0.25, 0.4, 0.6, 0.75, 0.9]
NET_MIX = 0.1
NET_FALL = sorted(NET_REGS, reverse=True)  # the path's order
POLY_FOLDS = 3


def _held_sql(rows: str, folds: int) -> str:
    """Training rows of every fold s (key % folds <> s) and all of them (s = -1)."""
    return f"SELECT f.s, vec_id AS id, y, x FROM ({rows}) t, (SELECT unnest(range(-1, {folds})) AS s) f WHERE f.s = -1 OR t.vec_id % {folds} <> f.s"


def _grid_sql(rows: str, folds: int, more: str) -> str:
    """``res``: a row per grid point, after ``ap``."""
    points = ", ".join(f"({i}, {g['maxIter']}, {NET_FALL.index(g['regParam'])}, {g['regParam']!r}::DOUBLE)" for i, g in enumerate(EL.elastic_grid(NET_ITERS, NET_REGS)))
    return f"""
, er AS MATERIALIZED (SELECT ap.s, ap.g, ap.m, {more} sqrt(avg(power(t.y - list_dot_product(t.x, ap.w) - ap.b0, 2))) AS rmse
    FROM ap JOIN ({rows}) t ON t.vec_id % {folds} = ap.s WHERE ap.s >= 0 GROUP BY ALL)
, pt AS (SELECT * FROM (VALUES {points}) p(grid_id, m, g, reg))
"""


NET_CTE = path_cte(_held_sql(TRAIN_SQL, CV_FOLDS), D, NET_FALL, NET_MIX, max(NET_ITERS), EL.TOL) + "," + path_points_cte(NET_ITERS) + _grid_sql(TRAIN_SQL, CV_FOLDS, "ap.k, ap.done,") + """
, res AS (SELECT CAST(pt.grid_id AS INTEGER) AS grid_id, CAST(pt.m AS INTEGER) AS max_iter, pt.reg AS reg_param, round(avg(rmse), 6) + 0.0 AS avg_rmse,
            round(avg(er.k), 6) + 0.0 AS iterations, CAST(sum(CAST(er.done AS INTEGER)) AS INTEGER) AS converged
          FROM pt JOIN er ON er.m = pt.m AND er.g = pt.g GROUP BY ALL)"""
POLY_ALL = f"SELECT vec_id, CAST(label AS DOUBLE) AS y, {poly_sql('x')} AS x FROM (SELECT vec_id, label, {X_SQL} AS x FROM embeddings) e"
POLY_CTE = proximal_cte(_held_sql(f"{POLY_ALL} WHERE vec_id % 5 < 4", POLY_FOLDS), D2, NET_FALL, NET_MIX, max(NET_ITERS)) + "," + proximal_points_cte(NET_ITERS) + _grid_sql(f"{POLY_ALL} WHERE vec_id % 5 < 4", POLY_FOLDS, "") + """
, res AS (SELECT CAST(pt.grid_id AS INTEGER) AS grid_id, CAST(pt.m AS INTEGER) AS max_iter, pt.reg AS reg_param, round(avg(rmse), 6) + 0.0 AS avg_rmse
          FROM pt JOIN er ON er.m = pt.m AND er.g = pt.g GROUP BY ALL)"""


def _best_sql(all_rows: str, digits: int = 6) -> str:
    return f"""
, best AS (SELECT * FROM res ORDER BY avg_rmse, grid_id LIMIT 1)
, bw AS (SELECT ap.w, ap.b0 FROM ap JOIN pt ON pt.m = ap.m AND pt.g = ap.g JOIN best USING (grid_id) WHERE ap.s = -1)
, pd AS (SELECT vec_id, y, list_dot_product(x, bw.w) + bw.b0 AS p FROM ({all_rows}) t, bw)"""


_PREDICT_SQL = "SELECT vec_id, y AS label, round(p, 6) + 0.0 AS prediction FROM pd WHERE vec_id % 5 >= 4"
_SUMMARY_SQL = """SELECT grid_id, max_iter, reg_param, avg_rmse, (SELECT round(sqrt(avg(power(y - p, 2))), 6) + 0.0 FROM pd WHERE vec_id % 5 < 4) AS train_rmse,
  (SELECT round(sqrt(avg(power(y - p, 2))), 6) + 0.0 FROM pd WHERE vec_id % 5 >= 4) AS test_rmse, CAST(len(bw.w) AS INTEGER) AS num_features,
  CAST(len(list_filter(bw.w, lambda v: abs(v) > 1e-9)) AS INTEGER) AS num_nonzero FROM best, bw"""


def _net_search(spark, sf_dir, folds, degree):
    rows = _train(spark, sf_dir).withColumn("fold", F.pmod("vec_id", F.lit(folds)).cast("int"))
    solver = "coordinate" if degree == 1 else "proximal"
    return EL.search(rows, "fold", NET_ITERS, NET_REGS, NET_MIX, "label", "x", degree, solver)


def _net_grid(spark, res, *more):
    cols = {"iterations": "iterations double", "converged": "converged int"}
    rows = [(int(t.grid_id), int(t.maxIter), float(t.regParam), float(round(t.avg_rmse, 6)) + 0.0,
             *[float(round(t.iterations, 6)) if c == "iterations" else int(t.converged) for c in more]) for t in res.itertuples()]
    return spark.createDataFrame(rows, ", ".join(["grid_id int, max_iter int, reg_param double, avg_rmse double", *[cols[c] for c in more]]))


def _net_predictions(spark, sf_dir, model):
    _, test = RG.key_split(I.embedding_rows(spark, sf_dir), "vec_id")
    return model.transform(test).select("vec_id", "label", _r6(F.col("prediction")).alias("prediction"))


def _net_summary(spark, sf_dir, best, model):
    part = F.pow(F.col("label") - F.col("prediction"), 2)
    out = model.transform(I.embedding_rows(spark, sf_dir)).agg(
        _r6(F.sqrt(F.avg(F.when(RG.in_train("vec_id"), part)))).alias("train_rmse"),
        _r6(F.sqrt(F.avg(F.when(~RG.in_train("vec_id"), part)))).alias("test_rmse"))
    return out.select(F.lit(int(best["grid_id"])).alias("grid_id"), F.lit(int(best["maxIter"])).alias("max_iter"), F.lit(float(best["regParam"])).alias("reg_param"),
                      F.lit(float(round(best["avg_rmse"], 6)) + 0.0).alias("avg_rmse"), "train_rmse", "test_rmse",
                      F.lit(model.numFeatures).alias("num_features"), F.lit(int((np.abs(model.weights) > 1e-9).sum())).alias("num_nonzero"))


@register("cv_elastic", NET_CTE + " SELECT * FROM res")
def cv_elastic(spark, sf_dir):
    """6 x 6 settings and 6 folds from two passes; sweeps made and folds whose
    duality gap closed show what the limit on the iterations does."""
    return _net_grid(spark, _net_search(spark, sf_dir, CV_FOLDS, 1)[0], "iterations", "converged")


@register("cv_elastic_best", NET_CTE + _best_sql(ALL_SQL) + _SUMMARY_SQL)
def cv_elastic_best(spark, sf_dir):
    """The best setting, fitted to all training rows, with its errors on both parts."""
    _, best, model = _net_search(spark, sf_dir, CV_FOLDS, 1)
    return _net_summary(spark, sf_dir, best, model)


@register("cv_elastic_test_predictions", NET_CTE + _best_sql(ALL_SQL) + _PREDICT_SQL)
def cv_elastic_test_predictions(spark, sf_dir):
    return _net_predictions(spark, sf_dir, _net_search(spark, sf_dir, CV_FOLDS, 1)[2])


@register("cv_poly", POLY_CTE + " SELECT * FROM res")
def cv_poly(spark, sf_dir):
    """6 x 6 settings and 3 folds over the whole degree-2 expansion (2,144 columns): one
    pass for the Gram sums, one for the held-out errors."""
    return _net_grid(spark, _net_search(spark, sf_dir, POLY_FOLDS, 2)[0])


@register("cv_poly_summary", POLY_CTE + _best_sql(POLY_ALL) + _SUMMARY_SQL)
def cv_poly_summary(spark, sf_dir):
    _, best, model = _net_search(spark, sf_dir, POLY_FOLDS, 2)
    return _net_summary(spark, sf_dir, best, model)


@register("cv_poly_test_predictions", POLY_CTE + _best_sql(POLY_ALL) + _PREDICT_SQL)
def cv_poly_test_predictions(spark, sf_dir):
    return _net_predictions(spark, sf_dir, _net_search(spark, sf_dir, POLY_FOLDS, 2)[2])


# -- R3/R4: elastic net with its summary, ordinary least squares -----------------------

def _elastic():
    return EL.ElasticNetRegression(featuresCol="x", labelCol="label", maxIter=50, regParam=0.1, elasticNetParam=0.1)


ELASTIC_SQL = elastic_cte(f"SELECT 0 AS s, y, x FROM ({TRAIN_SQL}) t", "SELECT 0 AS v, 0 AS s, 0.1::DOUBLE AS reg, 0.1::DOUBLE AS mix", D, 800)
_FIT_SQL = "list_dot_product(t.x, en.w) + en.b0"


@register("linreg_elastic", ELASTIC_SQL + f"""
SELECT t.vec_id, t.y AS label, round({_FIT_SQL}, 6) + 0.0 AS prediction FROM ({ALL_SQL} WHERE vec_id % 5 >= 4) t, en""")
def linreg_elastic(spark, sf_dir):
    """Coordinate descent on the Gram sums until its duality gap closes; the SQL
    takes proximal gradient rounds to the same optimum."""
    train, test = RG.key_split(I.embedding_rows(spark, sf_dir), "vec_id")
    return _elastic().fit(train).transform(test).select("vec_id", "label", _r6(F.col("prediction")).alias("prediction"))


@register("linreg_summary", ELASTIC_SQL + f"""
SELECT (SELECT round(sqrt(avg(power(y - ({_FIT_SQL}), 2))), 6) + 0.0 FROM ({TRAIN_SQL}) t, en) AS train_rmse,
       (SELECT round(sqrt(avg(power(y - ({_FIT_SQL}), 2))), 6) + 0.0 FROM ({ALL_SQL} WHERE vec_id % 5 >= 4) t, en) AS test_rmse,
       50 AS max_iter, 0.1::DOUBLE AS reg_param, {D} AS num_features,
       (SELECT CAST(len(list_filter(w, lambda v: abs(v) > 1e-9)) AS INTEGER) FROM en) AS num_nonzero""")
def linreg_summary(spark, sf_dir):
    train, _ = RG.key_split(I.embedding_rows(spark, sf_dir), "vec_id")
    model = _elastic().fit(train)
    part = F.pow(F.col("label") - F.col("prediction"), 2)
    out = model.transform(I.embedding_rows(spark, sf_dir)).agg(
        _r6(F.sqrt(F.avg(F.when(RG.in_train("vec_id"), part)))).alias("train_rmse"),
        _r6(F.sqrt(F.avg(F.when(~RG.in_train("vec_id"), part)))).alias("test_rmse"))
    return out.select("train_rmse", "test_rmse", F.lit(model.getMaxIter()).alias("max_iter"), F.lit(model.getRegParam()).alias("reg_param"),
                      F.lit(model.numFeatures).alias("num_features"), F.lit(int((np.abs(model.weights) > 1e-9).sum())).alias("num_nonzero"))


@register("linreg_ols", """
  SELECT round(regr_slope(l_extendedprice, l_quantity), 4) + 0.0 AS slope,
         round(regr_intercept(l_extendedprice, l_quantity), 4) + 0.0 AS intercept
  FROM lineitem""")
def linreg_ols(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_quantity", "l_extendedprice")
    va = VectorAssembler(inputCols=["l_quantity"], outputCol="features")
    lr = LinearRegression(featuresCol="features", labelCol="l_extendedprice",
                          solver="normal", regParam=0.0)
    m = lr.fit(va.transform(li))
    return spark.createDataFrame(
        [(float(round(m.coefficients[0], 4)) + 0.0, float(round(m.intercept, 4)) + 0.0)],
        "slope double, intercept double")
