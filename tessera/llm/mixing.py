"""Mix sources to target weights by a low-discrepancy schedule; DataFrame
operations only.

A source's documents, in the order of a hash of doc_id, make one long line of
words that is cut into blocks of ``block`` words.  The schedule's slots get
points of the golden-ratio sequence; a point is mapped through the cumulative
quotas to a source, slots are ranked within their source, and rank r takes
block r modulo the source's number of blocks.  A source's line is taken again
from its start when used up, and its last block is cut where its target is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_RE, written

#: Points are multiples of STEP / MODULUS, the golden ratio's fraction.
MODULUS = 1 << 31
STEP = 1327217885
CELLS = 4096
CHUNK = 65_536


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_RE)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A key that is never null: null has its own."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def source_targets(rows: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = 32) -> DataFrame:
    """One row per source of ``rows`` (key, source, size): pos, source_size,
    target, words (the target rounded), blocks, quota (slots), low and high
    (bounds of its points).  Sources by code point, null last, have ``weights``
    in turn; targets stop at ``most`` times the source's size and the excess is
    reshared by weight: with sources in the order of cap / weight the capped
    ones come first, and the rest shares what these leave."""
    per = rows.groupBy("key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    every = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1)
    per = (per.withColumn("pos", F.row_number().over(every)).withColumn("w", w)
           .withColumn("cap", F.col("source_size") * F.lit(float(most)))
           .withColumn("ratio", F.col("cap") / F.col("w")))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy("ratio", "pos")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    per = per.withColumn("level", (F.sum("source_size").over(whole) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
                         / F.sum("w").over(after))
    per = per.withColumn("level", F.max(F.when(F.col("ratio") > F.col("level"), F.col("level"))).over(whole))
    per = per.withColumn("target", F.when(F.col("level").isNull() | (F.col("cap") <= F.col("level") * F.col("w")), F.col("cap"))
                         .otherwise(F.col("level") * F.col("w")))
    per = (per.withColumn("words", F.floor(F.col("target") + 0.5))
           .withColumn("blocks", F.expr(f"(source_size + {block - 1}) div {block}"))
           .withColumn("quota", F.expr(f"if(source_size = 0, 0L, (words div source_size) * blocks + (words % source_size + {block - 1}) div {block})")))
    upto = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    slots = F.greatest(F.sum("quota").over(whole), F.lit(1))
    per = per.withColumn("slots", slots).withColumn("high", F.floor(F.sum("quota").over(upto) / slots * F.lit(float(MODULUS))))
    return per.withColumn("low", F.coalesce(F.lag("high").over(Window.orderBy("pos")), F.lit(0).cast("long"))).select(
        "key", "pos", "source_size", "target", "words", "blocks", "quota", "slots", "low", "high")


def lines(rows: DataFrame) -> DataFrame:
    """``rows`` (key, doc_id, size, tie, other) with ``begin``: the words before a document
    in its source's line; rows of one doc_id stand by size and the hashes ``tie`` and ``other``.  Sums run over hash buckets first (at most 65,536 a
    source), then inside a bucket, so no task holds a whole source.  The buckets' sums are merged,
    never broadcast: their table's size is guessed from compressed files."""
    rows = rows.withColumn("mix", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn("bucket", F.substring("mix", 1, 4))
    upto = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy("key", "bucket").agg(F.sum("size").alias("n")).select(
        "key", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("head"))
    inside = Window.partitionBy("key", "bucket").orderBy("mix", "size", "tie", "other").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return rows.join(heads.hint("merge"), ["key", "bucket"]).withColumn("begin", F.col("head") + F.col("inside")).drop("mix", "bucket", "head", "inside", "tie", "other")


def schedule(targets: DataFrame) -> DataFrame:
    """The mix's slots in order: (slot, pos, rank, block, start, stop); start and
    stop are words of the source's line.  A source that the points gave fewer
    slots than its quota gets the few left at the end; more are not taken."""
    spark = targets.sparkSession
    total = targets.agg(F.max("slots")).first()[0] or 0
    n = int(targets.agg(F.sum("quota")).first()[0] or 0)
    edge = CELLS / MODULUS
    cells = targets.filter("high > low").select(
        "pos", "low", "high", F.explode(F.sequence(F.floor(F.col("low") * edge), F.floor((F.col("high") - 1) * edge))).alias("cell"))
    slots = spark.range(min(n, total)).withColumnRenamed("id", "slot").withColumn(
        "point", F.pmod((F.col("slot") % MODULUS) * STEP, F.lit(MODULUS))).withColumn("cell", F.floor(F.col("point") * edge))
    dealt = slots.join(cells, "cell").filter("point >= low and point < high").select(
        "slot", "pos", F.expr(f"slot div {CHUNK}").alias("chunk"))
    counts = dealt.groupBy("pos", "chunk").agg(F.count("*").alias("n"))
    chunks = counts.select("pos", "chunk", F.coalesce(F.sum("n").over(
        Window.partitionBy("pos").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("head"))
    ranked = dealt.withColumn("inside", F.row_number().over(Window.partitionBy("pos", "chunk").orderBy("slot")) - 1)
    ranked = ranked.join(chunks, ["pos", "chunk"]).select("slot", "pos", (F.col("head") + F.col("inside")).alias("rank"))
    had = counts.groupBy("pos").agg(F.sum("n").alias("had"))
    late = targets.join(had, "pos", "left").withColumn("had", F.coalesce("had", F.lit(0))).filter("had < quota").select(
        F.lit(n).cast("long").alias("slot"), "pos", F.explode(F.expr("sequence(had, quota - 1)")).alias("rank"))
    return ranked.union(late)


def block_ranges(slots: DataFrame, targets: DataFrame, block: int) -> DataFrame:
    rows = slots.join(targets.select("pos", "source_size", "words", "blocks", "quota"), "pos").filter("rank < quota")
    rows = rows.withColumn("block", F.expr("rank % blocks")).withColumn("round", F.expr("rank div blocks"))
    rows = rows.withColumn("start", F.col("block") * block)
    return rows.withColumn("stop", F.least(F.col("start") + block, "source_size", F.expr("words - round * source_size"))).select(
        "slot", "pos", "block", "start", "stop")


def _mix(docs: DataFrame, carry: list[str], weights, share: float, most: float, block: int) -> DataFrame:
    """``mix`` with the columns ``carry`` of ``docs`` in a struct ``row``."""
    text = F.col("text").cast("string")
    hashed = [f.name for f in docs.schema if f.name in carry and not any(x in f.dataType.simpleString() for x in ("map<", "variant"))]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), source_key(F.col("source")).alias("key"),
                       word_count(text).alias("size"), F.md5(F.coalesce(text, F.lit(""))).alias("tie"),
                       (F.xxhash64(*[f"`{c}`" for c in hashed]) if hashed else F.lit(0).cast("long")).alias("other"), *([F.struct(*carry).alias("row")] if carry else []))
    rows = written(rows, "sizes")
    targets = written(source_targets(rows, weights, share, most, block), "targets")
    placed = written(lines(rows).join(targets.select("key", "pos", "source_size", "target"), "key").drop("key"), "lines")
    slots = block_ranges(schedule(targets), targets, block)
    pieces = placed.filter("size > 0").select("pos", "begin", (F.col("begin") + F.col("size")).alias("end"), F.explode(
        F.expr(f"sequence(begin div {block}, (begin + size - 1) div {block})")).alias("block"))
    # merged: Spark guesses the size of pieces without their explode, and would broadcast gigabytes of them
    words = F.least("end", "stop") - F.greatest("begin", "start")
    taken = slots.join(pieces.hint("merge"), ["pos", "block"]).withColumn("n", words).filter("n > 0").groupBy("pos", "begin").agg(F.sum("n").alias("taken"))
    # begin names a document of its source: only those without words share one
    return placed.filter("size > 0").join(taken, ["pos", "begin"], "left").unionByName(
        placed.filter("size = 0").withColumn("taken", F.lit(0).cast("long"))).withColumn("taken", F.coalesce("taken", F.lit(0).cast("long")))


def mix(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = 32) -> DataFrame:
    """(doc_id, source, begin, size, source_size, target, taken) for every row
    of ``docs``; taken counts the words that the schedule's blocks take from it.

    Null or empty texts have size 0 and are never taken; a null source is a
    source of its own; rows with equal doc_id follow each other in their
    source's line, by size and by hashes of text and row; an empty table gives an empty result; other columns are not
    looked at.  The same rows give the same mix, whatever their partitions."""
    return _mix(docs, [], weights, share, most, block).select("doc_id", "source", "begin", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, weights=(5, 2, 1), share: float = 1.5, most: float = 2.0, block: int = 32) -> DataFrame:
    """The mix as rows with the columns of ``docs``: a row for each whole time
    that a document is taken, and one with its first words, single spaces
    between them, where its source's target is met inside it; n_chars, if there
    is one, is the text's length.  Documents that are not taken go."""
    rows = _mix(docs, docs.columns, weights, share, most, block).filter("taken > 0")
    rows = rows.withColumn("time", F.explode(F.expr("sequence(1L, (taken + size - 1) div size)")))
    text = F.col("row.text").cast("string")
    first = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORD_RE})"), F.lit(1)), F.lit(1), F.expr("cast(taken % size as int)")), " ")
    rows = rows.withColumn("text", F.when(F.col("time") * F.col("size") <= F.col("taken"), text).otherwise(first))
    pick = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[pick[c].alias(c) if c in pick else F.col("row")[c].alias(c) for c in docs.columns])


def oracle(weights=(5, 2, 1), share: float = 1.5, most: float = 2.0) -> str:
    """DuckDB SQL of doc_id, size, source_size, target, taken: a source's first
    ``words`` words of its line, repeated."""
    case = " ".join(f"WHEN {i} THEN {float(x)}" for i, x in enumerate(weights))
    return f"""
    WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size, md5(coalesce(text, '')) AS tie FROM documents),
    s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
    p AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos FROM s),
    q AS (SELECT *, CASE (pos - 1) % {len(weights)} {case} END AS w, source_size * {float(most)}::DOUBLE AS cap FROM p),
    r AS (SELECT *, (sum(source_size) OVER () * {float(share)}::DOUBLE
                     - coalesce(sum(cap) OVER (ORDER BY cap / w, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                    / sum(w) OVER (ORDER BY cap / w, pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM q),
    l AS (SELECT *, max(CASE WHEN cap / w > lev THEN lev END) OVER () AS level FROM r),
    t AS (SELECT source, source_size, CASE WHEN level IS NULL OR cap <= level * w THEN cap ELSE level * w END AS target FROM l),
    e AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS words,
                 CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.size, d.tie
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begin_at
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
           CASE WHEN size = 0 THEN 0 ELSE CAST((words // source_size) * size
                + greatest(0, least(size, words % source_size - begin_at)) AS BIGINT) END AS taken
    FROM e"""
