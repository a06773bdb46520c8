"""The elastic net against MLlib, its optimality conditions and plain numpy fits."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tessera.functions import vectors as V
from tessera.operators import arrow_batches as AB
from tessera.operators import elastic as EL
from tessera.operators import regression as RG
from tessera.plans import inputs as I

from paths import SF


def frame(spark, X, y, fold=None):
    rows = [(float(b), [float(v) for v in a], int(i % 3 if fold is None else fold[i])) for i, (a, b) in enumerate(zip(X, y))]
    return spark.createDataFrame(rows, "label double, x array<double>, fold int").repartition(3)


def data(n=120, d=6, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d)) * np.linspace(0.1, 20, d) + 1000.0
    y = X @ np.r_[np.ones(d - 2), 0, 0] + rng.normal(size=n) + 5.0
    return X, y


def objective(X, y, w, b0, reg, mix):
    """MLlib's objective on standardised columns and label."""
    sx, sy = X.std(axis=0), y.std()
    b = w * sx / sy
    r = (y - y.mean() - (X - X.mean(axis=0)) @ w) / sy
    return 0.5 * (r @ r) / len(y) + reg / sy * (mix * np.abs(b).sum() + 0.5 * (1 - mix) * b @ b)


@pytest.mark.parametrize("reg,mix", [(0.1, 0.1), (0.5, 1.0), (2.0, 0.0), (0.0, 0.0), (40.0, 0.5)])
def test_coordinate_descent_reaches_mllibs_optimum(spark, reg, mix):
    X, y = data()
    df = frame(spark, X, y)
    own = EL.ElasticNetRegression(featuresCol="x", maxIter=2000, regParam=reg, elasticNetParam=mix, tol=1e-12).fit(df)
    theirs = LinearRegression(maxIter=500, regParam=reg, elasticNetParam=mix, tol=1e-12).fit(df.select("label", array_to_vector("x").alias("features")))
    ours = objective(X, y, own.weights, own.intercept, reg, mix)
    assert ours <= objective(X, y, theirs.coefficients.toArray(), theirs.intercept, reg, mix) + 1e-10
    sx = X.std(axis=0)
    assert np.allclose(own.weights * sx, theirs.coefficients.toArray() * sx, atol=2e-5 * y.std())
    assert abs((y - X @ own.weights - own.intercept).mean()) < 1e-8


def test_gap_bounds_the_distance_and_closes(spark):
    X, y = data(80, 5, 1)
    p = EL.standardised(RG.gram_stats(frame(spark, X, y), "label", "x")[0])
    l1, l2 = p.penalties(0.3, 0.4)
    value = lambda b: 0.5 * (p.vv - 2 * p.c @ b + b @ p.A @ b) + l1 * np.abs(b).sum() + 0.5 * l2 * b @ b
    best = EL.coordinate_path(p, [0.3], 0.4, [5000], 1e-14)[0.3, 5000].b
    rng = np.random.default_rng(3)
    for _ in range(50):
        b = best + rng.normal(size=5) * rng.choice([1e-6, 1e-2, 1.0])
        assert EL.duality_gap(p, b, l1, l2) >= value(b) - value(best) - 1e-12
    assert EL.duality_gap(p, best, l1, l2) < 1e-12
    fits = EL.coordinate_path(p, [0.3], 0.4, [1, 2, 3, 400])
    assert [fits[0.3, m].iterations for m in (1, 2, 3)] == [1, 2, 3] and fits[0.3, 400].converged and fits[0.3, 400].iterations < 400
    assert value(fits[0.3, 1].b) > value(fits[0.3, 2].b) > value(fits[0.3, 3].b) >= value(fits[0.3, 400].b)


def test_path_and_proximal_steps_meet_the_cold_fits(spark):
    X, y = data(100, 5, 2)
    p = EL.standardised(RG.gram_stats(frame(spark, X, y), "label", "x")[0])
    regs = [0.1, 1.0, 0.5]
    path = EL.coordinate_path(p, regs, 0.2, [3000], 1e-13)
    near = EL.proximal_path(p, regs, 0.2, [3000], 1e-13)
    for r in regs:
        cold = EL.coordinate_path(p, [r], 0.2, [3000], 1e-13)[r, 3000].b
        assert np.allclose(path[r, 3000].b, cold, atol=1e-7) and np.allclose(near[r, 3000].b, cold, atol=1e-6)
    assert path[0.1, 3000].iterations <= EL.coordinate_path(p, [0.1], 0.2, [3000], 1e-13)[0.1, 3000].iterations


def test_constant_columns_and_labels(spark):
    X, y = data(40, 4, 3)
    X[:, 1] = 7.0
    for solver in EL.SOLVERS:
        m = EL.ElasticNetRegression(featuresCol="x", maxIter=50, regParam=0.1, elasticNetParam=0.5, solver=solver).fit(frame(spark, X, y))
        assert m.weights[1] == 0.0 and np.all(np.isfinite(m.weights)) and np.any(m.weights != 0)
        flat = EL.ElasticNetRegression(featuresCol="x", maxIter=50, regParam=0.1, solver=solver).fit(frame(spark, X, np.full(40, 3.0)))
        assert not flat.weights.any() and flat.intercept == pytest.approx(3.0)
    with pytest.raises(ValueError, match="two rows"):
        EL.ElasticNetRegression(featuresCol="x").fit(frame(spark, X[:1], y[:1]))
    with pytest.raises(ValueError, match="solver"):
        EL.ElasticNetRegression(featuresCol="x", solver="other").fit(frame(spark, X, y))


@pytest.mark.parametrize("degree,solver", [(1, "coordinate"), (2, "proximal"), (2, "coordinate")])
def test_search_equals_fits_one_by_one(spark, degree, solver):
    X, y = data(90, 4, 4)
    X = X / 1000.0
    fold = np.arange(90) % 4
    df = frame(spark, X, y, fold)
    iters, regs = [3, 40], [0.05, 0.5]
    res, best, model = EL.search(df, "fold", iters, regs, 0.3, "label", "x", degree, solver)
    Z = AB.expanded(X, degree)
    assert list(zip(res["maxIter"], res["regParam"])) == [(m, r) for m in iters for r in regs]
    if solver == "proximal":  # from zero, so one by one is the same
        for row in res.itertuples():
            errors = []
            for f in range(4):
                keep = fold != f
                own = EL.ElasticNetRegression(featuresCol="x", maxIter=row.maxIter, regParam=row.regParam, elasticNetParam=0.3, solver=solver, degree=degree).fit(df.filter(F.col("fold") != f))
                errors.append(np.sqrt(np.mean((y[~keep] - Z[~keep] @ own.weights - own.intercept) ** 2)))
            assert row.avg_rmse == pytest.approx(np.mean(errors), rel=1e-6)
    pick = res.assign(r=res["avg_rmse"].round(6)).sort_values(["r", "grid_id"]).iloc[0]
    assert best["grid_id"] == pick["grid_id"]
    pred = model.transform(df).select("label", "x", "prediction").collect()
    want = {tuple(r["x"]): AB.expanded(np.array([r["x"]]), degree)[0] @ model.weights + model.intercept for r in pred}
    assert all(r["prediction"] == pytest.approx(want[tuple(r["x"])], rel=1e-9) for r in pred)
    again, _, _ = EL.search(df.repartition(7), "fold", iters, regs, 0.3, "label", "x", degree, solver)
    assert np.allclose(res["avg_rmse"], again["avg_rmse"], rtol=1e-9) and (res["iterations"] == again["iterations"]).all()


def test_search_takes_two_passes(spark):
    rows = I.embedding_rows(spark, SF, 8).withColumn("fold", I.fold_of("vec_id"))
    sc = spark.sparkContext
    sc.setJobGroup("search", "search")
    EL.search(rows, "fold", [10, 50, 250], [0.1, 0.5, 0.9], 0.1, "label", "x")
    one = len(sc.statusTracker().getJobIdsForGroup("search"))
    sc.setJobGroup("larger", "larger")
    EL.search(rows, "fold", [10, 20, 30, 50, 100, 250], [0.1, 0.2, 0.3, 0.5, 0.7, 0.9], 0.1, "label", "x")
    assert len(sc.statusTracker().getJobIdsForGroup("larger")) == one
    sc.setLocalProperty("spark.jobGroup.id", None)


def test_fused_expansion_equals_expanded_rows(spark):
    df = I.embedding_rows(spark, SF, 7)
    wide = df.select("label", V.poly_expand_2("x").alias("x"))
    a, b = RG.gram_stats(df, "label", "x", degree=2)[0], RG.gram_stats(wide, "label", "x")[0]
    assert a.n == b.n and np.allclose(a.G, b.G) and np.allclose(a.uv, b.uv)
    m = np.random.default_rng(0).normal(size=(3, 5))
    native = spark.createDataFrame([(r.tolist(),) for r in m], "x array<double>").select(V.poly_expand_2("x")).collect()
    assert np.array_equal(AB.expand_2(m), np.array([r[0] for r in native]))
    one, two = (RG.GDLinearRegression(featuresCol="x", maxIter=6, solver=s, degree=2).fit(df) for s in RG.SOLVERS)
    assert np.allclose(one.weights, two.weights) and len(one.weights) == 35
    got, want = one.transform(df).select("prediction").collect(), RG.GDLinearRegression(featuresCol="x", maxIter=6).fit(wide).transform(wide).select("prediction").collect()
    assert np.allclose([r[0] for r in got], [r[0] for r in want])


def test_only_narrow_rows_reach_python_and_nothing_is_kept(spark):
    parts = RG.gram_sums(I.embedding_rows(spark, SF, 9), "label", "x", degree=2)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce" in plan and "Exchange" not in plan and "flatten" not in plan


def test_model_saves_and_copies(spark, tmp_path):
    X, y = data(50, 3, 6)
    df = frame(spark, X, y)
    model = Pipeline(stages=[EL.ElasticNetRegression(featuresCol="x", maxIter=30, regParam=0.2, elasticNetParam=0.5, degree=2)]).fit(df).stages[0]
    model.write().overwrite().save(str(tmp_path / "m"))
    back = EL.ElasticNetModel.load(str(tmp_path / "m"))
    assert np.array_equal(back.weights, model.weights) and back.intercept == model.intercept and back.iterations == model.iterations
    assert back.transform(df).select("prediction").collect() == model.transform(df).select("prediction").collect()
    first = EL.ElasticNetRegression(featuresCol="x", maxIter=30)
    twin = first.copy({first.maxIter: 7})
    assert twin.getMaxIter() == 7 and twin.getFeaturesCol() == "x"


@pytest.mark.parametrize("bad", [(None, [1.0, 2.0], 0), (1.0, None, 0), (1.0, [1.0, None], 0), (1.0, [1.0, 2.0], None), (1.0, [1.0], 1)])
def test_nulls_and_uneven_rows_raise(spark, bad):
    df = spark.createDataFrame([(1.0, [1.0, 3.0], 0), (2.0, [2.0, 1.0], 1), bad], "label double, x array<double>, fold int").coalesce(1)
    with pytest.raises(Exception, match="null|uneven"):
        EL.search(df, "fold", [5], [0.1], 0.1, "label", "x", 2)
