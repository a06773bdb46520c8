"""Exact shares: sizes per stratum, order by the hash, ties, copies, nulls, and rows whole."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F
from tessera.operators.sampling import exact_split


def sizes(n, shares):
    ends, total = [], 0.0
    for v in shares[:-1]:
        total += v
        ends.append(min(n, math.floor(n * total + 0.5)))
    ends = [0, *ends, n]
    return [b - a for a, b in zip(ends, ends[1:])]


def check_sizes(split, shares, strata):
    per = {}
    for r in split.groupBy(*strata, "part").count().collect():
        per.setdefault(tuple(r[c] for c in strata), Counter())[r["part"]] = r["count"]
    for counts in per.values():
        want = sizes(sum(counts.values()), shares)
        assert [counts.get(i, 0) for i in range(len(shares))] == want


@pytest.mark.parametrize("shares", [[0.8, 0.2], [0.7, 0.1, 0.2], [0.0, 1.0], [1.0, 0.0], [0.25, 0.25, 0.25, 0.25]])
def test_shares_are_exact_in_every_stratum(spark, shares):
    rows = spark.range(2003).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") < 40, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("g"))
    split = exact_split(rows, shares, "id", "g", seed=3)
    check_sizes(split, shares, ["g"])
    assert sorted(r["id"] for r in split.select("id").collect()) == list(range(2003))
    again = exact_split(rows.repartition(7), shares, "id", "g", seed=3)
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, again.collect()), key=str)


def test_the_first_part_has_the_least_hashes(spark):
    rows = spark.range(5000).withColumn("h", F.xxhash64(F.lit(5), "id"))
    split = exact_split(rows.select("id"), [0.3, 0.5, 0.2], "id", seed=5).join(rows, "id")
    ends = split.groupBy("part").agg(F.min("h").alias("lo"), F.max("h").alias("hi")).orderBy("part").collect()
    assert ends[0]["hi"] < ends[1]["lo"] and ends[1]["hi"] < ends[2]["lo"]


def test_key_patterns_make_no_difference(spark):
    rows = spark.range(1000).select((F.col("id") * 5).alias("id"))  # key % 5 would take all
    check_sizes(exact_split(rows, [0.8, 0.2], "id"), [0.8, 0.2], [])


def test_one_key_in_all_rows_is_split_by_the_rows(spark):
    rows = spark.range(999).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("part_of"))
    split = exact_split(rows, [0.5, 0.5], "k")
    check_sizes(split, [0.5, 0.5], [])
    assert split.select("part_of").distinct().count() == 999


def test_copies_are_dealt_by_count(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 2000, 7).otherwise(F.col("id")).alias("id"), F.lit("x").alias("s"))
    split = exact_split(rows, [0.1, 0.3, 0.35, 0.25], "id")
    check_sizes(split, [0.1, 0.3, 0.35, 0.25], [])
    assert Counter(r["id"] for r in split.collect())[7] == 2000
    alone = exact_split(spark.range(70_001).select(F.lit(1).alias("x")), [0.5, 0.5])
    check_sizes(alone, [0.5, 0.5], [])


def test_order_by_an_expression_and_small_hashes(spark):
    rows = spark.range(100).withColumn("row", F.col("id") * 2).withColumn("s", F.lit(1)).withColumn("h1", F.lit(0))
    split = exact_split(rows, [0.33, 0.67], F.expr("100 - id"))
    assert sorted(r["id"] for r in split.filter("part = 0").collect()) == list(range(67, 100))
    assert split.columns == ["id", "row", "s", "h1", "part"]


def test_empty_single_and_refused(spark):
    assert exact_split(spark.range(0), [0.8, 0.2], "id").collect() == []
    assert [r["part"] for r in exact_split(spark.range(1), [0.8, 0.2], "id").collect()] == [0]
    assert [r["part"] for r in exact_split(spark.range(3), [1.0], "id").collect()] == [0, 0, 0]
    for bad in ([0.5, 0.6], [-0.5, 1.5], []):
        with pytest.raises(ValueError):
            exact_split(spark.range(3), bad, "id")
    with pytest.raises(ValueError, match="column"):
        exact_split(spark.range(3).withColumnRenamed("id", "part"), [0.5, 0.5])
