"""Song text rows as a file stream, and songs per year over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tessera.session import shared_dir


def song_rows_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New text files under ``input_dir`` as typed song rows."""
    from tessera.plans.relational import parse_song_lines

    reader = spark.readStream.schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return parse_song_lines(reader.text(input_dir))


def songs_per_year_stream(spark: SparkSession, input_dir: str, lo: int = 2000, hi: int = 2010,
                          query_name: str = "songs_per_year", checkpoint: str | None = None,
                          available_now: bool = True) -> StreamingQuery:
    """Running count per year in ``[lo, hi]``; the state is one counter per
    year (bounded by the year range), the result is rewritten in full each
    trigger to an in-memory table named ``query_name``."""
    rows = song_rows_stream(spark, input_dir)
    counts = rows.filter(F.col("year").between(lo, hi)).groupBy("year") \
        .agg(F.count(F.lit(1)).alias("n"))
    w = (counts.writeStream.outputMode("complete").format("memory").queryName(query_name)
         .option("checkpointLocation", checkpoint or shared_dir(spark, f"stream-{query_name}")))
    if available_now:
        w = w.trigger(availableNow=True)
    return w.start()
