"""Stages of free code that are saved by name, and what may be named."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from tessera.operators import stages as S
from tessera.session import drop_dir, shared_dir


@S.column_function()
def halved(s):
    return s / 2


def unmarked(s):
    return s


def test_saved_pipelines_find_their_function(spark):
    rows = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "id long, x array<double>")
    stages = [S.NamedColumnTransform(inputCol="x", outputCol="norm", function="tessera.plans.regression:vector_norm"),
              S.ColumnTransform(inputCol="norm", outputCol="half", expr="{x} / 2")]
    path = shared_dir(spark, "test-pipeline")
    Pipeline(stages=stages).fit(rows).save(path)
    got = PipelineModel.load(path).transform(rows).orderBy("id").collect()
    drop_dir(spark, path)
    assert [r.half for r in got] == [2.5, 0.0]
    copy = stages[0].copy({stages[0].outputCol: "other"})
    assert copy.getOutputCol() == "other" and stages[0].getOutputCol() == "norm"
    empty = PipelineModel(stages).transform(rows.limit(0))
    assert empty.columns == ["id", "x", "norm", "half"] and empty.collect() == []


@pytest.mark.parametrize("name", ["os:system", f"{__name__}:unmarked", f"{__name__}:missing", "tessera.plans.regression", "no_such_module:f"])
def test_other_code_is_refused(spark, name):
    rows = spark.createDataFrame([(1.0,)], "x double")
    with pytest.raises((ValueError, ModuleNotFoundError)):
        S.NamedColumnTransform(inputCol="x", outputCol="y", function=name).transform(rows)


def test_functions_stay_plain_functions():
    assert np.allclose(halved(np.array([2.0, 4.0])), [1.0, 2.0])
