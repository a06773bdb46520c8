"""The physical plans keep the properties the design relies on."""

import re

import pytest

from tessera.operators import regression as RG
from tessera.plans import QUERIES
from tessera.plans import inputs as I

from paths import SF


def formatted(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def nodes(plan: str) -> list[str]:
    return [h.split()[0] for h in re.findall(r"^\(\d+\) (.+?)\s*$", plan, flags=re.M)]


@pytest.mark.parametrize("name", ["songs_per_year", "songs_per_year_sql"])
def test_year_range_reaches_the_scan(spark, name):
    plan = formatted(QUERIES[name](spark, SF))
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(o_orderdate,2000-01-01", plan)
    assert re.search(r"ReadSchema: struct<o_orderdate:timestamp(_ntz)?>", plan)


def test_gram_pass_shape(spark):
    plan = formatted(RG.gram_sums(I.embedding_rows(spark, SF, 8), "label", "x"))
    n = nodes(plan)
    assert "MapInArrow" in n and "Coalesce" not in n  # as many tasks as the input has splits
    assert n.count("Exchange") == 0  # the pass itself ends before any shuffle


def test_convolution_has_no_join_and_no_shuffle(spark):
    for name in ("grid_conv2d_s1", "grid_conv2d_s2"):
        n = nodes(formatted(QUERIES[name](spark, SF)))
        assert "Exchange" not in n and not any("Join" in x for x in n), name


def test_text_is_not_shuffled(spark):
    for name in ("split_fields", "regex_tokenize"):
        assert "Exchange" not in nodes(formatted(QUERIES[name](spark, SF))), name


def test_scoring_has_no_self_join(spark):
    for name in ("class_scores", "accuracy_by_class", "mlp_forward_relu", "conv_stack_scores"):
        n = nodes(formatted(QUERIES[name](spark, SF)))
        assert not any("Join" in x for x in n), name


def test_group_counts_aggregate_before_the_shuffle(spark):
    # a hot key (a third of the rows in one label or year) costs one partial
    # row per task, not a third of the rows in one reducer
    for name in ("vector_sum", "songs_per_year", "accuracy_by_class", "src_inline_rows"):
        plan = formatted(QUERIES[name](spark, SF))
        assert re.search(r"Functions \[\d+\]: \[partial_", plan), name
