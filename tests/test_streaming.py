from pyspark.sql import functions as F

from tessera.plans import QUERIES
from tessera.plans import inputs as I
from tessera.session import shared_dir
from tessera.streaming import songs_per_year_stream

from paths import SF


def test_stream_counts_equal_batch_counts(spark):
    lines = I.song_lines(spark, SF, with_key=True)
    src = shared_dir(spark, "stream-src")
    # two arrivals of files
    lines.filter(F.col("o_orderkey") % 2 == 0).select("value").write.text(f"{src}/a")
    lines.filter(F.col("o_orderkey") % 2 == 1).select("value").write.text(f"{src}/b")
    q = songs_per_year_stream(spark, f"{src}/*", query_name="spy_test")
    q.awaitTermination(120)
    got = {r["year"]: r["n"] for r in spark.sql("SELECT * FROM spy_test").collect()}
    want = {r["year"]: r["n"] for r in QUERIES["songs_per_year"](spark, SF).collect()}
    assert got == want
