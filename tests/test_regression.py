import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import regression as RG
from tessera.plans import inputs as I

from paths import SF, SF01


def brute_gd(X, y, iters, alpha=1.0):
    """The per-round loop: RMSE before each update, gradient sum of
    (w.x - y) x, step alpha / (n sqrt(i+1))."""
    n, d = X.shape
    w = np.zeros(d)
    err = []
    for i in range(iters):
        err.append(math.sqrt(np.mean((X @ w - y) ** 2)))
        g = ((X @ w - y)[:, None] * X).sum(axis=0)
        w = w - alpha / (n * math.sqrt(i + 1)) * g
    return w, np.array(err)


def _data(spark, sf=SF01, d=8):
    r = I.embedding_rows(spark, sf, d).filter(RG.in_train("vec_id"))
    pdf = r.toPandas()
    return r, np.stack(pdf["x"].to_numpy()), pdf["label"].to_numpy(float)


def test_one_pass_matches_per_round_loop(spark):
    r, X, y = _data(spark)
    m = RG.GDLinearRegression(featuresCol="x", maxIter=100).fit(r)
    w, err = brute_gd(X, y, 100)
    assert np.allclose(m.weights, w, rtol=1e-10, atol=1e-12)
    assert np.allclose(m.trainingError, err, rtol=1e-10)


def test_both_solvers_agree(spark):
    r, X, y = _data(spark, SF, 8)
    a = RG.GDLinearRegression(featuresCol="x", maxIter=20).fit(r)
    b = RG.GDLinearRegression(featuresCol="x", maxIter=20, solver="rounds").fit(r)
    assert np.allclose(a.weights, b.weights, rtol=1e-10)
    assert np.allclose(a.trainingError, b.trainingError, rtol=1e-10)


def test_same_result_under_repartitioning(spark):
    r, _, _ = _data(spark, SF)
    base = RG.gram_stats(r, "label", "x")[0]
    for n in (1, 7):
        other = RG.gram_stats(r.repartition(n), "label", "x")[0]
        assert np.allclose(base.G, other.G) and np.allclose(base.gradient(np.ones(base.d)), other.gradient(np.ones(base.d)))
        assert other.n == base.n


def test_uneven_width_raises(spark):
    df = spark.createDataFrame([(1.0, [1.0, 2.0]), (2.0, [1.0])], "label double, x array<double>")
    with pytest.raises(Exception):
        RG.gram_stats(df.coalesce(1), "label", "x")


def test_divergence_is_reported(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet").select(
        F.col("l_extendedprice").alias("label"), F.array("l_quantity", "l_extendedprice").alias("x"))
    with pytest.raises(Exception):
        RG.GDLinearRegression(featuresCol="x", maxIter=100).fit(li)


def test_cv_one_pass_matches_direct_loops(spark):
    r, X, y = _data(spark, SF01, 4)
    r = r.withColumn("fold", I.fold_of("vec_id"))
    folds = r.select("fold").toPandas()["fold"].to_numpy()
    grid = [{"rounds": 10, "alpha": 1.0}, {"rounds": 30, "alpha": 0.5}]
    res, _ = RG.cv_one_pass(r, "fold", grid, "label", "x")
    by_rounds = RG.cv_rounds(r, "fold", grid, "label", "x")
    assert np.allclose(res["avg_rmse"], by_rounds["avg_rmse"], rtol=1e-10)
    for p, got in zip(grid, res["avg_rmse"]):
        scores = []
        for f in range(3):
            w, _ = brute_gd(X[folds != f], y[folds != f], p["rounds"], p["alpha"])
            scores.append(math.sqrt(np.mean((X[folds == f] @ w - y[folds == f]) ** 2)))
        assert abs(np.mean(scores) - got) < 1e-9


def test_model_copy_keeps_weights(spark):
    r, _, _ = _data(spark, SF, 4)
    m = RG.GDLinearRegression(featuresCol="x", maxIter=5).fit(r)
    c = m.copy()
    assert np.array_equal(c.weights, m.weights) and c.getMaxIter() == 5


def test_label_shift_uses_fit_minimum(spark):
    from tessera.operators.stages import LabelShift

    tr = spark.createDataFrame([(5.0,), (7.0,)], "v double")
    te = spark.createDataFrame([(3.0,)], "v double")
    m = LabelShift(inputCol="v", outputCol="l").fit(tr)
    assert m.getOrDefault(m.minimum) == 5.0
    assert m.transform(te).first()["l"] == -2.0


def test_key_split_is_stable(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    a, b = RG.key_split(e, "vec_id")
    a2, _ = RG.key_split(e.repartition(5), "vec_id")
    assert sorted(r[0] for r in a.select("vec_id").collect()) == sorted(r[0] for r in a2.select("vec_id").collect())
    assert a.count() + b.count() == e.count()


def test_cv_needs_two_folds(spark):
    r, _, _ = _data(spark, SF, 4)
    one = r.withColumn("fold", F.lit(0))
    with pytest.raises(ValueError):
        RG.cv_one_pass(one, "fold", [{"rounds": 5, "alpha": 1.0}], "label", "x")


def test_cv_with_an_empty_fold_uses_the_others(spark):
    r, _, _ = _data(spark, SF, 4)
    # folds 0 and 2 only: the search runs over the folds that have rows
    two = r.withColumn("fold", F.when(I.fold_of("vec_id") == 1, 0).otherwise(I.fold_of("vec_id")))
    res, _ = RG.cv_one_pass(two, "fold", [{"rounds": 5, "alpha": 1.0}], "label", "x")
    assert len(res) == 1 and np.isfinite(res["avg_rmse"][0])


def test_cv_refit_best_equals_direct_fit(spark):
    r, X, y = _data(spark, SF01, 4)
    r = r.withColumn("fold", I.fold_of("vec_id"))
    grid = [{"rounds": 10, "alpha": 1.0}, {"rounds": 40, "alpha": 1.0}, {"rounds": 20, "alpha": 0.5}]
    res, best, model = RG.cv_refit_best(r, "fold", grid, "label", "x")
    assert best["grid_id"] == res.assign(q=res["avg_rmse"].round(6)).sort_values(["q", "grid_id"]).iloc[0]["grid_id"]
    w, _ = brute_gd(X, y, int(best["rounds"]), float(best["alpha"]))
    assert np.allclose(model.weights, w, rtol=1e-10)


def test_param_grid_matches_param_grid_builder(spark):
    from pyspark.ml.regression import LinearRegression
    from pyspark.ml.tuning import ParamGridBuilder

    iters, regs = [5, 15, 25, 35, 45, 55], [0.01, 0.02, 0.04, 0.08, 0.16, 0.32]
    lr = LinearRegression()
    maps = ParamGridBuilder().addGrid(lr.maxIter, iters).addGrid(lr.regParam, regs).build()
    t = RG.param_grid(spark, {"max_iter": iters, "reg_param": regs}).orderBy("grid_id").collect()
    assert len(t) == len(maps) == 36
    assert [(r.max_iter, r.reg_param) for r in t] == [(m[lr.maxIter], m[lr.regParam]) for m in maps]


def test_error_of_a_good_fit_far_from_zero(spark):
    """Raw sums would cancel: labels near 1e8, residuals near 0.003."""
    rng = np.random.default_rng(0)
    X = np.c_[np.ones(400), rng.normal(size=400)]
    y = X @ np.array([1e8, 2.0]) + rng.normal(scale=0.003, size=400)
    df = spark.createDataFrame([(float(b), a.tolist()) for a, b in zip(X, y)], "label double, x array<double>").repartition(3)
    st = RG.gram_stats(df, "label", "x")[0]
    w = np.linalg.lstsq(X, y, rcond=None)[0]
    direct = math.sqrt(np.mean((X @ w - y) ** 2))
    assert st.rmse(w) == pytest.approx(direct, rel=1e-3)
    assert np.allclose(st.gradient(w + [0.0, 1.0]), X.T @ (X @ (w + [0.0, 1.0]) - y), rtol=1e-6, atol=1e-3)


def test_models_keep_what_they_learned_when_saved(spark, tmp_path):
    from tessera.operators.stages import LabelShift, LabelShiftModel

    tr = spark.createDataFrame([(5.0, [1.0, 2.0]), (9.0, [2.0, 1.0])], "v double, x array<double>")
    LabelShift(inputCol="v", outputCol="l").fit(tr).write().overwrite().save(f"{tmp_path}/shift")
    back = LabelShiftModel.load(f"{tmp_path}/shift")
    assert sorted(r.l for r in back.transform(tr).collect()) == [0.0, 4.0]
    m = RG.GDLinearRegression(featuresCol="x", labelCol="v", maxIter=5).fit(tr)
    m.write().overwrite().save(f"{tmp_path}/gd")
    again = RG.GDLinearRegressionModel.load(f"{tmp_path}/gd")
    assert np.array_equal(again.weights, m.weights) and np.array_equal(again.trainingError, m.trainingError)


def test_null_keys_are_in_the_second_part(spark):
    df = spark.createDataFrame([(0,), (4,), (None,)], "k long")
    a, b = RG.key_split(df, "k")
    assert [r.k for r in a.collect()] == [0] and sorted(str(r.k) for r in b.collect()) == ["4", "None"]


@pytest.mark.parametrize("rows", [[(1.0, [1.0, None], 0)], [(1.0, None, 0)], [(None, [1.0, 1.0], 0)], [(1.0, [1.0, 1.0], None)],
                                  [(1.0, [1.0, 1.0], 0), (1.0, [1.0, None], 1)]])
def test_nulls_raise(spark, rows):
    df = spark.createDataFrame(rows, "label double, x array<double>, fold int").coalesce(1)
    with pytest.raises(Exception, match="null"):
        RG.gram_stats(df, "label", "x", "fold")


def test_block_sums_are_spark_aggregates_in_two_levels(spark):
    from tessera.operators.aggregates import block_sums

    parts = RG.gram_sums(I.embedding_rows(spark, SF, 8).repartition(5), "label", "x")
    plan = block_sums(parts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ObjectHashAggregate") == 4 and "salt" in plan
