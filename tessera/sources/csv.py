"""``;``-separated, double-quoted text with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_semicolon_csv(spark: SparkSession, path: str, schema: StructType | str,
                       columns: list[str] | None = None) -> DataFrame:
    """Parse with an explicit schema (no inference pass); the header row is
    dropped by the reader and quotes are removed from quoted fields.
    ``columns`` picks fields by name after parsing, so the CSV scan only
    materialises what is used."""
    df = (spark.read.option("sep", ";").option("header", True)
          .option("quote", '"').option("mode", "FAILFAST")
          .schema(schema).csv(path))
    return df.select(*columns) if columns else df


def write_semicolon_csv(df: DataFrame, path: str) -> str:
    """Write with every field quoted and a header row."""
    (df.write.mode("overwrite").option("sep", ";").option("header", True)
     .option("quoteAll", True).csv(path))
    return path
