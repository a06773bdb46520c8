"""Small in-code tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Class id -> name of the 10-class clothing image set.
LABEL_NAMES = {
    0: "T-shirt/top",
    1: "Trouser",
    2: "Pullover",
    3: "Dress",
    4: "Coat",
    5: "Sandal",
    6: "Shirt",
    7: "Sneaker",
    8: "Bag",
    9: "Ankle boot",
}


def inline_table(spark: SparkSession, rows, schema) -> DataFrame:
    """A local collection as a table (``sc.parallelize(...).toDF``)."""
    return spark.createDataFrame(rows, schema)


def label_name_table(spark: SparkSession) -> DataFrame:
    return inline_table(spark, sorted(LABEL_NAMES.items()), "label int, label_name string")


def label_name_map():
    """The same lookup as a map literal, usable in any expression."""
    items = []
    for k, v in sorted(LABEL_NAMES.items()):
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def label_names_sql_case(col: str) -> str:
    """The lookup as a SQL ``CASE`` (for the DuckDB oracle)."""
    arms = " ".join(f"WHEN {k} THEN '{v}'" for k, v in sorted(LABEL_NAMES.items()))
    return f"CASE {col} {arms} END"
