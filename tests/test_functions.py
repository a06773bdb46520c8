import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import vectors as V


def one(spark, expr, schema="s string", row=("",)):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def test_tokenizer_lowercases_and_drops_empty_tokens(spark):
    r = one(spark, T.regex_tokenize("s", ","), row=("2001.0,0.5,Abc,,3",))
    assert r == ["2001.0", "0.5", "abc", "3"]


def test_truncation_toward_zero(spark):
    df = spark.createDataFrame([("1998.9",), ("-1.7",)], "s string")
    assert [r[0] for r in df.select(T.truncate_to_int("s")).collect()] == [1998, -1]


def test_polynomial_order(spark):
    r = one(spark, V.poly_expand_2(F.col("a")), "a array<double>", ([2.0, 3.0, 5.0],))
    assert r == [2, 4, 3, 6, 9, 5, 10, 15, 25]


def test_polynomial_matches_mllib(spark):
    from pyspark.ml.feature import PolynomialExpansion
    from pyspark.ml.functions import array_to_vector, vector_to_array

    df = spark.createDataFrame([([0.5, -1.5, 2.0, 3.0],)], "a array<double>")
    ml = PolynomialExpansion(degree=2, inputCol="v", outputCol="p").transform(
        df.select(array_to_vector("a").alias("v"))).select(vector_to_array("p")).first()[0]
    ours = df.select(V.poly_expand_2("a")).first()[0]
    assert np.allclose(ml, ours)


def test_argmax_first_on_ties(spark):
    assert one(spark, V.argmax("a"), "a array<double>", ([1.0, 5.0, 5.0],)) == 1


def test_non_numeric_token_raises(spark):
    df = spark.createDataFrame([(["1.0", "abc"],)], "t array<string>")
    with pytest.raises(Exception):
        df.select(T.parse_doubles("t")).collect()
    assert df.select(T.parse_doubles("t", strict=False)).first()[0] == [1.0, None]


def test_vector_size_checks(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(Exception):
        df.select(V.dot("a", "b")).collect()
    with pytest.raises(Exception):
        df.select(V.add("a", "b")).collect()
    with pytest.raises(Exception):
        df.select(V.fill(0, 1.0)).collect()
    assert df.select(V.dot("a", "a")).first()[0] == 5.0
    assert df.select(V.fill(3, 0.5)).first()[0] == [0.5] * 3


def test_softmax_and_activations(spark):
    z = [1.0, 2.0, -3.0]
    r = one(spark, V.softmax("a"), "a array<double>", (z,))
    e = np.exp(np.array(z) - max(z))
    assert np.allclose(r, e / e.sum())
    assert one(spark, V.relu("a"), "a array<double>", (z,)) == [1.0, 2.0, 0.0]
    assert np.allclose(one(spark, V.sigmoid("a"), "a array<double>", (z,)), 1 / (1 + np.exp(-np.array(z))))


def test_one_hot_roundtrip(spark):
    r = one(spark, V.one_hot(F.lit(3)), "s string", ("",))
    assert r == [0.0, 0.0, 0.0, 1.0] + [0.0] * 6
    df = spark.createDataFrame([(r,)], "v array<double>")
    assert df.select(V.one_hot_decode("v")).first()[0] == 3


def test_split_fields_keeps_every_field(spark):
    assert one(spark, T.split_fields("s", ","), row=("a,,b,",)) == ["a", "", "b", ""]