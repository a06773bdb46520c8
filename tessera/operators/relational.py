"""Counting, filtering, grouping and ordering over a table.

Each function returns a lazy DataFrame, so Catalyst pushes filters and the
column choice into the parquet scan and plans a partial + final aggregate.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_rows(df: DataFrame, alias: str = "n") -> DataFrame:
    """``count(*)`` as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def filter_between(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Inclusive range filter."""
    return df.filter(F.col(col).between(lo, hi))


def column_stats(df: DataFrame, col: str) -> DataFrame:
    """avg, max, min of one column."""
    return df.agg(F.avg(col).alias(f"avg_{col}"), F.max(col).alias(f"max_{col}"),
                  F.min(col).alias(f"min_{col}"))


def count_per_group(df: DataFrame, key: str, alias: str = "n") -> DataFrame:
    """Count per key, ordered by key (partial + final hash aggregate, then a
    range-partitioned sort of the small result)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(alias)).orderBy(key)


def first_n(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by ``key`` (``TakeOrderedAndProject``: each task
    keeps its own top n, so only n rows per task reach the final merge)."""
    return df.orderBy(key).limit(n)


def with_min_of(df: DataFrame, col: str, source: DataFrame | None = None,
                alias: str | None = None) -> DataFrame:
    """Attach the minimum of ``col`` (taken over ``source``, default ``df``)
    to every row without a driver round trip: the aggregate is one row, so
    broadcasting it is size-bounded by construction."""
    src = source if source is not None else df
    m = src.agg(F.min(col).alias(alias or f"min_{col}"))
    return df.crossJoin(F.broadcast(m))


def vector_sum_long(df: DataFrame, keys: list[str], vec: str) -> DataFrame:
    """Element-wise sum of an array column per key, as ``(keys.., i, total)``.

    ``Summarizer.sum`` adds whole vectors with a partial aggregate per task:
    one vector per key and task is shuffled, and only sums are taken apart."""
    summed = df.groupBy(*keys).agg(Summarizer.sum(array_to_vector(F.col(vec))).alias("s"))
    return summed.select(*keys, F.posexplode(vector_to_array("s")).alias("i", "total"))
