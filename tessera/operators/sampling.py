"""Splits with exact shares, overall or in every stratum.

``key % 5`` follows any pattern in the keys, and a random split hits its shares only on
average.  Here the rows of a stratum stand in the order of a hash of their key, and the
first ``round(share * n)`` of them are the first part.  Nothing is sorted: the row at
each cut is found by histogram refinement, one pass for a histogram over the hashes' first
16 bits, one that keeps the hashes of the cuts' own bins (a 65,536th of the rows each),
and on these the next bits in turn.  Then a third pass compares every row with its
stratum's cuts.  Rows that share the hash at a cut are told apart by a hash of the whole row;
what is equal in that too is counted, not ranked, so copies never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import drop_at_exit, shared_dir

BITS = 16
SALTS = 64
COPIES_AT_ONCE = 65_536


def _bins(word: Column, level: int) -> Column:
    """The first ``16 (level + 1)`` bits of a hash, in its (signed) order."""
    return F.shiftright(word, 64 - BITS * (level + 1))


def _cut_positions(counts: DataFrame, shares) -> DataFrame:
    """``(cs, cut, need)``: the rank, from 0, of the first row beyond each cut; cuts
    beyond the last row are left out, no row lies there."""
    cuts, total = [], 0.0
    for i, share in enumerate(shares[:-1]):
        total += share
        cuts.append(F.struct(F.lit(i).alias("cut"), F.floor(F.col("n") * F.lit(total) + F.lit(0.5)).cast("long").alias("need")))
    return counts.select("s", "n", F.explode(F.array(*cuts)).alias("c")).select(F.col("s").alias("cs"), "n", "c.cut", "c.need").filter("need < n").drop("n")


def cut_rows(ranked: DataFrame, shares) -> DataFrame:
    """``(s, cut, h1, h2, need)``: per stratum ``s`` and cut the two hashes of the row
    there, and how many of the rows with the same two lie before it.  ``ranked``: (s, h1, h2)."""
    spark = ranked.sparkSession
    first = ranked.groupBy("s", _bins(F.col("h1"), 0).alias("b")).agg(F.count(F.lit(1)).alias("m"))
    path = shared_dir(spark, "histogram")
    first.write.parquet(path)
    hist = drop_at_exit(spark.read.parquet(path), path)
    counts = hist.groupBy("s").agg(F.sum("m").alias("n"))
    wanted = _cut_positions(counts, shares)  # cs: the cut's stratum, cb: its bin, ch1: its first hash
    running = hist.withColumn("upto", F.sum("m").over(Window.partitionBy("s").orderBy("b")))  # 65,536 bins at most
    here = F.col("s").eqNullSafe(F.col("cs")) & F.expr("need < upto and need >= upto - m")
    cuts = running.join(wanted, here).select("cs", "cut", F.col("b").alias("cb"), F.expr("need - (upto - m)").alias("need"))
    path1 = shared_dir(spark, "bins")
    cuts.write.parquet(path1)
    cuts = drop_at_exit(spark.read.parquet(path1), path1)
    # the hashes in the cuts' bins, with their rows: read by all further levels
    own = ranked.join(cuts, F.col("s").eqNullSafe(F.col("cs")) & (_bins(F.col("h1"), 0) == F.col("cb")), "left_semi")
    path2 = shared_dir(spark, "candidates")
    own.groupBy("s", "h1", "h2").agg(F.count(F.lit(1)).alias("m")).write.parquet(path2)
    near = drop_at_exit(spark.read.parquet(path2), path2)
    for level in range(1, 8):
        word = "h1" if level < 4 else "h2"
        held = ["h1"] if level >= 4 else []  # settled by level 3
        prefix = _bins(F.col("h1" if level <= 4 else "h2"), (level - 1) % 4)
        same = F.col("s").eqNullSafe(F.col("cs")) & (prefix == F.col("cb"))
        if level > 4:
            same = same & (F.col("h1") == F.col("ch1"))
        kept = near.join(cuts, same).select("cs", "cut", "need", *held, _bins(F.col(word), level % 4).alias("b"), "m")
        bins = kept.groupBy("cs", "cut", "need", *held, "b").agg(F.sum("m").alias("m"))
        running = bins.withColumn("upto", F.sum("m").over(Window.partitionBy("cs", "cut").orderBy("b")))
        cuts = running.filter("need < upto and need >= upto - m").select(
            "cs", "cut", *[F.col(c).alias("ch1") for c in held], F.col("b").alias("cb"), F.expr("need - (upto - m)").alias("need"))
    return cuts.select(F.col("cs").alias("s"), "cut", F.col("ch1").alias("h1"), F.col("cb").alias("h2"), "need")


def exact_split(rows: DataFrame, shares, key: str | Column | None = None, strata: str | Column | None = None,
                seed: int = 0, part: str = "part") -> DataFrame:
    """``rows`` with a column ``part`` (int, from 0): in every stratum the parts' sizes are the
    differences of ``floor(n * (sum of the shares so far) + 0.5)``.

    ``key``: a column whose hash under ``seed`` orders the rows, or a bigint expression that is
    that order itself; default: all columns.  The split depends on the rows alone, not on
    their order or partitions.  Null keys and strata are values like any other; of equal rows
    any may go to either part, the number in each is exact.  Columns must be of types that Spark can
    group by; a column named as ``part`` is an error.  An empty table gives an empty result."""
    shares = [float(v) for v in shares]
    if not shares or min(shares) < 0 or abs(sum(shares) - 1.0) > 1e-9:
        raise ValueError("shares are not negative and add up to 1")
    columns = list(rows.columns)
    if part in columns:
        raise ValueError(f"the rows have a column {part}")
    whole = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in columns])
    if key is None:
        h1 = whole
    elif isinstance(key, str):
        h1 = F.xxhash64(F.lit(seed), F.col(f"`{key}`"))
    else:
        h1 = F.coalesce(key.cast("long"), F.lit(-(1 << 63)).cast("long"))
    h2 = F.xxhash64(F.lit(seed + 1), *[F.col(f"`{c}`") for c in columns])
    s = F.lit(0) if strata is None else F.col(f"`{strata}`") if isinstance(strata, str) else strata
    # names of the helpers can't meet the rows' own: these travel in a struct
    ranked = rows.select(s.alias("s"), h1.alias("h1"), h2.alias("h2"), F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    if len(shares) == 1:
        return rows.withColumn(part, F.lit(0))
    path = shared_dir(rows.sparkSession, "cuts")
    cut_rows(ranked.drop("row"), shares).write.parquet(path)
    cuts = drop_at_exit(rows.sparkSession.read.parquet(path), path)
    lines = cuts.groupBy(F.col("s").alias("cs")).agg(F.sort_array(F.collect_list(F.struct("h1", "h2", "cut", "need"))).alias("cuts"))
    # a stratum's few cuts meet its rows in many tasks
    lines = lines.withColumn("to", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    ranked = ranked.withColumn("salt", F.pmod("h2", F.lit(SALTS)).cast("int"))
    met = ranked.join(lines, F.col("s").eqNullSafe(F.col("cs")) & (F.col("salt") == F.col("to")), "left").select(
        "s", "h1", "h2", "row", F.coalesce("cuts", F.array().cast(lines.schema["cuts"].dataType)).alias("cuts"))
    at = lambda c: (c["h1"] == F.col("h1")) & (c["h2"] == F.col("h2"))
    below = lambda c: (c["h1"] < F.col("h1")) | ((c["h1"] == F.col("h1")) & (c["h2"] < F.col("h2")))
    met = met.withColumn("tied", F.filter("cuts", at)).withColumn("p", F.size(F.filter("cuts", below)))
    clear = met.filter(F.size("tied") == 0).select("row", F.col("p").cast("int").alias("p"))
    return clear.unionByName(_dealt(met.filter(F.size("tied") > 0))).select("row.*", F.col("p").alias(part))


def _dealt(tied: DataFrame) -> DataFrame:
    """Rows at a cut: equal ones are counted, their ranks among those with the same two
    hashes are ranges, and each part gets its share of a range as that many copies."""
    same = tied.groupBy("s", "h1", "h2", "row").agg(F.count(F.lit(1)).alias("m"), F.first("tied").alias("tied"), F.first("p").alias("p"))
    w = Window.partitionBy("s", "h1", "h2").orderBy("row")
    same = same.withColumn("upto", F.sum("m").over(w)).withColumn("lo", F.col("upto") - F.col("m"))
    # part p + j holds the ranks from the j-th tied cut's on
    bounds = F.concat(F.array(F.lit(0).cast("long")), F.transform("tied", lambda c: c["need"]), F.array(F.lit((1 << 62)).cast("long")))
    pieces = same.withColumn("bounds", bounds).select("row", "p", "lo", "upto", "bounds", F.explode(F.sequence(F.lit(0), F.size("tied"))).alias("j"))
    size = F.least("upto", F.element_at("bounds", F.col("j") + 2)) - F.greatest("lo", F.element_at("bounds", F.col("j") + 1))
    pieces = pieces.withColumn("size", size).filter("size > 0").select("row", (F.col("p") + F.col("j")).cast("int").alias("p"), "size")
    runs = pieces.select("row", "p", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(COPIES_AT_ONCE).cast("long"))).alias("from"))
    runs = runs.repartition("row", "from")
    return runs.select("row", "p", F.explode(F.sequence(F.col("from"), F.least(F.col("size"), F.col("from") + COPIES_AT_ONCE) - 1)).alias("i")).drop("i")
