"""Song-row questions, sources, filters and aggregates (DataFrame and SQL
forms) over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import relational as R
from tessera.plans import inputs as I
from tessera.plans.registry import register
from tessera.session import drop_at_exit, materialize, release, shared_dir, table
from tessera.sources import csv as csv_src
from tessera.sources import inline, text as text_src


_kept = drop_at_exit


def _songs(spark, sf_dir, years=None):
    return I.song_table(spark, sf_dir, years)


def _songs_view(spark, sf_dir):
    """The view carries the order date, so that a query can also name a range
    of dates, which reaches the scan (the year is computed and can't)."""
    I.song_table(spark, sf_dir, dated=True).createOrReplaceTempView("songs")


def _year_range_sql(lo: int, hi: int) -> str:
    return (f"year >= {lo} AND year <= {hi} AND played >= TIMESTAMP_NTZ '{lo:04d}-01-01 00:00:00' "
            f"AND played < TIMESTAMP_NTZ '{hi + 1:04d}-01-01 00:00:00'")


SONGS = f"({I.SONG_TABLE_SQL}) songs"


# -- A4: songs per year, 2000-2010 ------------------------------------------

@register("songs_per_year", f"""
  SELECT year, count(*) AS n FROM {SONGS}
  WHERE year >= 2000 AND year <= 2010 GROUP BY year ORDER BY year""")
def songs_per_year(spark, sf_dir):
    s = R.filter_between(_songs(spark, sf_dir, (2000, 2010)), "year", 2000, 2010)
    return R.count_per_group(s, "year")


@register("songs_per_year_sql", f"""
  SELECT year, count(*) AS n FROM {SONGS}
  WHERE year >= 2000 AND year <= 2010 GROUP BY year ORDER BY year""")
def songs_per_year_sql(spark, sf_dir):
    _songs_view(spark, sf_dir)
    return spark.sql("SELECT year, count(*) AS n FROM songs "
                     f"WHERE {_year_range_sql(2000, 2010)} GROUP BY year ORDER BY year")


# -- A1: row count ------------------------------------------------------------

@register("count_songs", f"SELECT count(*) AS n FROM {SONGS}")
def count_songs(spark, sf_dir):
    return R.count_rows(_songs(spark, sf_dir))


@register("count_songs_sql", f"SELECT count(*) AS n FROM {SONGS}")
def count_songs_sql(spark, sf_dir):
    _songs_view(spark, sf_dir)
    return spark.sql("SELECT count(*) AS n FROM songs")


# -- S7: parsed rows kept for several questions ---------------------------------

@register("songs_persisted", f"""
  SELECT year, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS n_all, max(feat1) AS most_feat1
  FROM {SONGS} GROUP BY year""")
def songs_persisted(spark, sf_dir):
    """Two questions on rows that the first one leaves in memory (or spilled), released
    at the end; what comes back is a row a year."""
    songs = materialize(_songs(spark, sf_dir))
    try:
        n_all = songs.count()  # parses the rows; the next question reads what is kept
        per_year = songs.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.lit(n_all).cast("long").alias("n_all"), F.max("feat1").alias("most_feat1"))
        return spark.createDataFrame(per_year.collect(), per_year.schema)
    finally:
        release(songs)


# -- F1/F2/A2: count in an inclusive range ----------------------------------

@register("songs_in_range", f"""
  SELECT count(*) AS n FROM {SONGS} WHERE year >= 1998 AND year <= 2000""")
def songs_in_range(spark, sf_dir):
    return R.count_rows(R.filter_between(_songs(spark, sf_dir, (1998, 2000)), "year", 1998, 2000))


@register("songs_in_range_sql", f"""
  SELECT count(*) AS n FROM {SONGS} WHERE year >= 1998 AND year <= 2000""")
def songs_in_range_sql(spark, sf_dir):
    _songs_view(spark, sf_dir)
    return spark.sql(f"SELECT count(*) AS n FROM songs WHERE {_year_range_sql(1998, 2000)}")


# -- A3: avg / max / min --------------------------------------------------------

_YEAR_STATS_SQL = f"""
  SELECT round(avg(year), 9) AS avg_year, max(year) AS max_year, min(year) AS min_year
  FROM {SONGS}"""


@register("year_stats", _YEAR_STATS_SQL)
def year_stats(spark, sf_dir):
    st = R.column_stats(_songs(spark, sf_dir), "year")
    return st.select(F.round("avg_year", 9).alias("avg_year"), "max_year", "min_year")


@register("year_stats_sql", _YEAR_STATS_SQL)
def year_stats_sql(spark, sf_dir):
    _songs_view(spark, sf_dir)
    return spark.sql("SELECT round(avg(year), 9) AS avg_year, max(year) AS max_year, "
                     "min(year) AS min_year FROM songs")


# -- A5/F3: count per group under '<', SQL only (bank stand-in: part) ----------

@register("count_by_age_sql", """
  SELECT age, count(1) AS n FROM (SELECT p_size AS age FROM part) bank
  WHERE age < 30 GROUP BY age ORDER BY age""")
def count_by_age_sql(spark, sf_dir):
    table(spark, sf_dir, "part").selectExpr("p_size AS age", "p_name AS job") \
        .createOrReplaceTempView("bank")
    return spark.sql("SELECT age, count(1) AS n FROM bank WHERE age < 30 "
                     "GROUP BY age ORDER BY age")


# -- S6/A10: first rows by key ------------------------------------------------------

@register("first_n_rows", f"""
  SELECT o_orderkey, year, feat1, feat2, feat3 FROM {SONGS}
  ORDER BY o_orderkey LIMIT 5""")
def first_n_rows(spark, sf_dir):
    return R.first_n(_songs(spark, sf_dir), "o_orderkey", 5)


# -- S1 + P1/P2/P3: text rows written, read back, split, typed, named --------

def parse_song_lines(lines):
    """``value`` lines -> ``year int, feat1..3 float``: the part before the
    first tab, split on commas, first four fields picked, cast and named."""
    f = T.split_fields(T.split_fields("value", "\t")[0], ",")
    return lines.select(f.alias("f")).select(
        T.truncate_to_int(F.col("f")[0]).alias("year"),
        F.col("f")[1].cast("float").alias("feat1"),
        F.col("f")[2].cast("float").alias("feat2"),
        F.col("f")[3].cast("float").alias("feat3"),
    ).toDF("year", "feat1", "feat2", "feat3")


@register("src_text_rows", f"SELECT year, feat1, feat2, feat3 FROM {SONGS}")
def src_text_rows(spark, sf_dir):
    path = shared_dir(spark, "song-lines")
    text_src.write_text_rows(I.song_lines(spark, sf_dir), path)
    return _kept(parse_song_lines(text_src.read_text_rows(spark, path)), path)


@register("song_table", f"SELECT o_orderkey, year, feat1, feat2, feat3 FROM {SONGS}")
def song_table(spark, sf_dir):
    """The song table by parsing the text rows in place (no file hop)."""
    lines = I.song_lines(spark, sf_dir, with_key=True)
    f = T.split_fields("value", ",")
    return lines.select("o_orderkey", f.alias("f")).select(
        "o_orderkey",
        T.truncate_to_int(F.col("f")[0]).alias("year"),
        F.col("f")[1].cast("float").alias("feat1"),
        F.col("f")[2].cast("float").alias("feat2"),
        F.col("f")[3].cast("float").alias("feat3"))


# -- S2: ';' CSV with quotes and header (customer as the bank table) -------------

CUSTOMER_CSV_SCHEMA = ("c_custkey long, c_name string, c_nationkey int, "
                       "c_acctbal double, c_mktsegment string")


@register("src_csv_semicolon", """
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer""")
def src_csv_semicolon(spark, sf_dir):
    path = shared_dir(spark, "customer-csv")
    csv_src.write_semicolon_csv(table(spark, sf_dir, "customer"), path)
    return _kept(csv_src.read_semicolon_csv(spark, path, CUSTOMER_CSV_SCHEMA,
                                            ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]), path)


# -- F4 + P4: raw ';' text with a header line, dropped by value, quotes stripped

@register("drop_header", """
  SELECT n_nationkey, n_name, n_regionkey FROM nation""")
def drop_header(spark, sf_dir):
    """Text with a header line: the CSV writer's, read back as plain lines."""
    path = shared_dir(spark, "nation-text")
    csv_src.write_semicolon_csv(table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey"), path)
    f = T.split_fields("value", ";")
    rows = text_src.read_text_rows(spark, path).select(f.alias("f")) \
        .filter(F.col("f")[0] != F.lit('"n_nationkey"'))
    return _kept(rows.select(
        T.strip_quotes(F.col("f")[0]).cast("int").alias("n_nationkey"),
        T.strip_quotes(F.col("f")[1]).alias("n_name"),
        T.strip_quotes(F.col("f")[2]).cast("int").alias("n_regionkey")), path)


@register("strip_quotes", """
  SELECT event_id, replace(props, '"', '') AS props_clean FROM events""")
def strip_quotes(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", T.strip_quotes("props").alias("props_clean"))


# -- P1: split whole texts on a delimiter ---------------------------------------

@register("split_fields", """
  SELECT doc_id, string_split(text, ' ') AS fields FROM documents""")
def split_fields(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.split_fields("text", " ").alias("fields"))


# -- P5: regex tokenizer (lower-case, empty tokens dropped) ----------------------

@register("regex_tokenize", r"""
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\x0B\f\r]+'),
                             lambda t: length(t) >= 1) AS tokens
  FROM documents""")
def regex_tokenize(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", T.regex_tokenize("text", r"\s+").alias("tokens"))


# -- S3 + P15: inline label-name table and the lookup ---------------------------

@register("src_inline_rows", f"""
  SELECT label, {inline.label_names_sql_case('label')} AS label_name, count(*) AS n
  FROM embeddings GROUP BY label""")
def src_inline_rows(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    counts = e.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # 10 fixed rows: a broadcast of proven size.
    return counts.join(F.broadcast(inline.label_name_table(spark)), "label") \
        .select("label", "label_name", "n")


@register("label_names", f"""
  SELECT vec_id, label, {inline.label_names_sql_case('label')} AS label_name FROM embeddings""")
def label_names(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "label",
                    F.element_at(inline.label_name_map(), F.col("label")).alias("label_name"))
