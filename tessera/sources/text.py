"""Line-per-row text files (``value string``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_text_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``; splits files into byte ranges,
    so one large file still spreads over many tasks."""
    return spark.read.text(path)


def write_text_rows(df: DataFrame, path: str, col: str = "value",
                    compression: str | None = None) -> str:
    """Write one string column as text lines, one file per partition."""
    w = df.select(col).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(path)
    return path
