"""How the given tables stand in for the inputs of the original jobs.

* song rows: ``orders`` - the label is a decimal year (year plus a month
  fraction, so truncation matters) and three features from price and keys;
* text rows of numbers: ``embeddings`` - label then elements, comma joined;
* images: ``embeddings`` - 64 floats as an 8x8 grid, ``label`` 0-9.

Text rows are built from doubles, whose text form parses back to the same
value, so parsing is exact on every engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import table

FOLD_MOD = 3        # fold = key % 3


def song_values(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None) -> DataFrame:
    """Numeric song columns derived from orders: ``(o_orderkey, year_raw,
    f1, f2, f3)`` as doubles.  ``years`` (inclusive) restricts the rows by
    the order date - the same rows as a filter on the derived year, but one
    the parquet scan can apply (pushed filter, row-group skipping)."""
    o = table(spark, sf_dir, "orders")
    if years is not None:
        lo, hi = years
        # bounds in the column's own type (timestamp_ntz here), so the
        # comparison is wall-clock and independent of the session time zone
        ts = o.schema["o_orderdate"].dataType.simpleString()
        o = o.filter((F.col("o_orderdate") >= F.lit(f"{lo:04d}-01-01 00:00:00").cast(ts))
                     & (F.col("o_orderdate") < F.lit(f"{hi + 1:04d}-01-01 00:00:00").cast(ts)))
    return o.select(
        "o_orderkey", F.col("o_orderdate").alias("played"),
        (F.year("o_orderdate").cast("double")
         + (F.month("o_orderdate") - 1).cast("double") / F.lit(12.0)).alias("year_raw"),
        (F.col("o_totalprice") / F.lit(1000.0)).alias("f1"),
        (F.pmod("o_custkey", F.lit(100)).cast("double") / F.lit(100.0)).alias("f2"),
        (F.pmod("o_orderkey", F.lit(97)).cast("double") / F.lit(97.0)).alias("f3"),
    )


SONG_VALUES_SQL = """
  SELECT o_orderkey,
         CAST(year(o_orderdate) AS DOUBLE) + CAST(month(o_orderdate) - 1 AS DOUBLE) / 12.0 AS year_raw,
         o_totalprice / 1000.0 AS f1,
         CAST(o_custkey % 100 AS DOUBLE) / 100.0 AS f2,
         CAST(o_orderkey % 97 AS DOUBLE) / 97.0 AS f3
  FROM orders
"""


def song_lines(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Comma-separated song text rows ``value`` (``year,f1,f2,f3``)."""
    v = song_values(spark, sf_dir).drop("played")
    line = F.concat_ws(",", *[F.col(c).cast("string") for c in ("year_raw", "f1", "f2", "f3")])
    cols = ([F.col("o_orderkey")] if with_key else []) + [line.alias("value")]
    return v.select(*cols)


def song_table(spark: SparkSession, sf_dir: str, years: tuple[int, int] | None = None,
               dated: bool = False) -> DataFrame:
    """``year int, feat1 float, feat2 float, feat3 float`` (with key, and the
    date column ``played`` if ``dated``)."""
    v = song_values(spark, sf_dir, years)
    return v.select(
        "o_orderkey", *(["played"] if dated else []),
        F.col("year_raw").cast("float").cast("int").alias("year"),
        F.col("f1").cast("float").alias("feat1"),
        F.col("f2").cast("float").alias("feat2"),
        F.col("f3").cast("float").alias("feat3"),
    )


SONG_TABLE_SQL = f"""
  SELECT o_orderkey,
         CAST(trunc(CAST(year_raw AS FLOAT)) AS INTEGER) AS year,
         CAST(f1 AS FLOAT) AS feat1, CAST(f2 AS FLOAT) AS feat2, CAST(f3 AS FLOAT) AS feat3
  FROM ({SONG_VALUES_SQL}) sv
"""


def embedding_rows(spark: SparkSession, sf_dir: str, dims: int | None = None) -> DataFrame:
    """``(vec_id, label double, x array<double>)``; first ``dims`` elements."""
    e = table(spark, sf_dir, "embeddings")
    x = F.transform("embedding", lambda v: v.cast("double"))
    if dims is not None:
        x = F.slice(x, 1, dims)
    return e.select("vec_id", F.col("label").cast("double").alias("label"), x.alias("x"))


def embedding_lines(spark: SparkSession, sf_dir: str, dims: int | None = None) -> DataFrame:
    """``(vec_id, value)``: label then the elements, comma joined."""
    r = embedding_rows(spark, sf_dir, dims)
    return r.select(
        "vec_id",
        F.concat_ws(",", F.col("label").cast("string"),
                    F.array_join(F.transform("x", lambda v: v.cast("string")), ",")).alias("value"))


def fold_of(key_col: str) -> F.Column:
    return F.pmod(F.col(key_col), F.lit(FOLD_MOD)).cast("int")
