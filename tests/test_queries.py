"""Every registered query against its DuckDB oracle (sf0.001), DataFrame
forms against SQL forms, and the no-oracle queries against their checks."""

import duckdb
import numpy as np
import pytest

import __spark_entry__ as E
from tessera.plans import ORACLES, QUERIES
from tools.check_oracles import TABLES, rows_of

from paths import SF


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def no_row_python(df):
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return "BatchEvalPython" not in plan


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert no_row_python(df), "row-at-a-time Python UDF in the plan"
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(ORACLES[name])
    cols = [d[0] for d in rel.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == rows_of(cols, rel.fetchall())


@pytest.mark.parametrize("a,b", [("songs_per_year", "songs_per_year_sql"), ("count_songs", "count_songs_sql"),
                                 ("songs_in_range", "songs_in_range_sql"), ("year_stats", "year_stats_sql")])
def test_dataframe_form_equals_sql_form(spark, a, b):
    assert QUERIES[a](spark, SF).collect() == QUERIES[b](spark, SF).collect()


def test_every_query_without_oracle_runs(spark):
    for name in sorted(set(QUERIES) - set(ORACLES)):
        df = QUERIES[name](spark, SF)
        assert no_row_python(df), name
        assert df.count() >= 1, name


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["iter", "rmse"] and df.count() == 100


def test_conv_stack_scores_match_dense_numpy(spark):
    from tessera.operators import conv as CV
    from tessera.plans import classification as PC
    from tessera.plans import inputs as I

    pdf = I.embedding_rows(spark, SF).toPandas().sort_values("vec_id")
    convs, dense = PC.conv_stack()
    want = CV.conv_stack_forward(np.stack(pdf["x"].to_numpy()), convs, dense, 8, 8)
    got = QUERIES["conv_stack_scores"](spark, SF).toPandas().sort_values("vec_id")
    assert np.allclose(np.stack(got["scores"].to_numpy()), want, atol=1e-6)
