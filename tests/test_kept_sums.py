"""Kept sums: equal to a fit over all rows, rows read once, parts replaced and removed,
and additions that round nothing off."""

from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tessera.operators import regression as RG
from tessera.operators.kept_sums import Compensated, KeptSums
from tessera.session import shared_dir


@pytest.fixture
def kept(spark):
    store = KeptSums(spark, shared_dir(spark, "test-kept"))
    yield store
    store.drop()


def frame(spark, n, seed=0, d=90, fold=3):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, d))
    rows = [(i, float(i % fold), float(y), x.tolist()) for i, (x, y) in enumerate(zip(X, X @ np.arange(d) + 2000 + rng.normal(size=n)))]
    return spark.createDataFrame(rows, "id long, fold double, label double, features array<double>").repartition(3)


def test_sums_of_parts_equal_one_pass(spark, kept):
    rows = frame(spark, 400).persist()
    for k in range(4):
        kept.append(rows.filter(F.col("id") % 4 == k), f"day {k}/4", group="fold")
    got, want = kept.stats(), RG.gram_stats(rows, group="fold")
    assert sorted(got) == sorted(want) == [0, 1, 2]
    for g in want:
        assert got[g].n == want[g].n
        np.testing.assert_allclose(got[g].G, want[g].G, rtol=1e-10, atol=1e-8)
    w, _, _ = RG.descend(RG.added(got), 30)
    v, _, _ = RG.descend(RG.added(want), 30)
    np.testing.assert_allclose(w, v, atol=1e-8)
    rows.unpersist()


def test_only_new_rows_are_read(spark, kept):
    rows = frame(spark, 60)
    kept.append(rows.filter("id < 30"), 1)
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    kept.append(rows.filter("id >= 30").mapInArrow(seen, rows.schema).persist(), 2)
    before = read.value
    assert before == 30
    assert kept.stats()[0].n == 60 and kept.stats([1])[0].n == 30 and kept.stats([2, "none"])[0].n == 30
    assert read.value == before


def test_parts_are_replaced_and_removed(spark, kept):
    rows = frame(spark, 40)
    kept.append(rows, "a")
    kept.append(rows.filter("id < 15"), "b")
    kept.append(rows, "a")  # repeated after a failure
    assert kept.stats()[0].n == 55
    kept.remove("a")
    assert kept.stats()[0].n == 15
    np.testing.assert_allclose(kept.stats()[0].G, RG.gram_stats(rows.filter("id < 15"))[0].G, rtol=1e-10, atol=1e-8)
    kept.remove("b")
    with pytest.raises(Exception):
        kept.stats()


def test_empty_parts_and_bad_rows(spark, kept):
    rows = frame(spark, 10)
    with pytest.raises(ValueError, match="no rows"):
        kept.stats()
    kept.append(rows.filter("id < 0"), "none yet")
    assert kept.centre() is None
    kept.append(rows, "first")
    kept.append(rows.filter("id < 0"), "empty")
    assert kept.stats()[0].n == 10
    with pytest.raises(ValueError):
        kept.stats(["unknown"])
    with pytest.raises(Exception, match="uneven|width"):
        kept.append(frame(spark, 3, d=4), "narrow")
    with pytest.raises(Exception, match="null"):
        kept.append(rows.withColumn("label", F.lit(None).cast("double")), "null")


def test_additions_are_compensated():
    rng = np.random.default_rng(1)
    values = rng.normal(size=20_000) * 10.0 ** rng.integers(-8, 9, 20_000)
    exact = float(sum(map(Fraction, values.tolist())))
    one, halves = Compensated(1), [Compensated(1), Compensated(1)]
    plain = 0.0
    for i, v in enumerate(values):
        plain += v
        one.add(np.array([v]))
        halves[i % 2].add(np.array([v]))
    both = Compensated(1)
    for h in halves:
        both.add(h.hi, h.lo)
    assert one.value[0] == pytest.approx(exact, rel=1e-15) and both.value[0] == pytest.approx(exact, rel=1e-15)
    assert abs(one.value[0] - exact) <= abs(plain - exact)
