"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Every fingerprint emits all variants within half the radius (2 of 4 bits:
2,081 variants).  Two fingerprints within the radius share a variant; two that
share a variant are within the radius.  The variants are shuffled by their
first ``prefix_bits`` bits (10 or more): a fingerprint travels once to each prefix that one
of its variants has, and spells out the variants below that prefix there, so
the shuffle holds 1 + p + p(p-1)/2 rows a fingerprint and not 2,081.  Where near
copies crowd a prefix, it is made longer there: at the full 64 bits at most 2,081
fingerprints can share one.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map, texts, written

BITS = 64
_BIT_TABLE = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(raw: bytes, shingle: int = 4) -> int:
    """SimHash of one text's UTF-8 bytes as an unsigned 64-bit integer.

    Lower-cases A-Z, splits at ASCII white space; shingles of ``shingle``
    words, repeats included; fewer words give one shingle, none give 0."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(g, 42) for g in grams], dtype="<u8")
    # bits set at each position: one histogram of byte values per byte position
    slots = h.view(np.uint8).reshape(-1, 8).astype(np.int64) + np.arange(0, 2048, 256)
    counts = np.bincount(slots.ravel(), minlength=2048).reshape(8, 256) @ _BIT_TABLE
    on = counts.ravel() * 2 > len(h)
    return int(np.packbits(on, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp long) for every row of ``docs``; a null text has no words."""

    def run(batch: pa.RecordBatch):
        fps = np.array([fingerprint(t, shingle) for t in texts(batch.column(1))], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), run,
                     "doc_id long, fp long")


def _flips(bits: int, most: int) -> np.ndarray:
    """XOR masks that flip at most ``most`` of the lowest ``bits`` bits."""
    masks = [0]
    for k in range(1, most + 1):
        masks += [sum(1 << b for b in c) for c in combinations(range(bits), k)]
    return np.array(masks, dtype=np.uint64)


def _meet(fps: np.ndarray, left: np.ndarray, bits: int, most_variants: int) -> Iterator[np.ndarray]:
    """Yields pairs (smaller, larger) of fingerprints that share a variant; ``left``
    flips are still free in the lowest ``bits`` bits of each.  Beyond
    ``most_variants`` variants the set is split by the next bit of the variant,
    so memory stays bounded for any number of fingerprints."""
    if len(fps) < 2:
        return
    tables = {r: _flips(bits, r) for r in np.unique(left).tolist()}
    total = sum(int((left == r).sum()) * len(t) for r, t in tables.items())
    if total > most_variants and bits > 0:
        top = (fps >> np.uint64(bits - 1)) & np.uint64(1)
        for side in (0, 1):
            rest = left - (top != side)
            keep = rest >= 0
            # bits above have been agreed on; only the variant's own are compared
            yield from _meet(fps[keep], rest[keep], bits - 1, most_variants)
        return
    low = np.uint64((1 << bits) - 1) if bits < 64 else np.uint64(0xFFFFFFFFFFFFFFFF)
    variants, owners = [], []
    for r, masks in tables.items():
        own = np.flatnonzero(left == r)
        variants.append(((fps[own] & low)[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(own, len(masks)))
    v = np.concatenate(variants)
    s = np.sort(v)
    shared = np.unique(s[1:][s[1:] == s[:-1]])
    if not len(shared):
        return
    at = np.searchsorted(shared, v)
    hit = np.flatnonzero(shared[np.minimum(at, len(shared) - 1)] == v)
    run, own = at[hit], fps[np.concatenate(owners)[hit]]
    order = np.lexsort((own, run))
    run, own = run[order], own[order]
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    least = np.repeat(own[first], np.diff(np.r_[first, len(run)]))
    # all that share a variant lie within the radius of each other: a star is enough
    pair = np.stack([least, own], 1)[least != own]
    if len(pair):
        yield np.unique(pair, axis=0)


def prefix_bits_for(fingerprints: int, half: int, group_rows: int = 1_000_000) -> int:
    """The fewest prefix bits (10 or more) that keep the fingerprints of a
    prefix at about ``group_rows``, half-radius neighbours included."""
    bits = 10
    while bits < 40 and fingerprints * sum(comb(bits, k) for k in range(half + 1)) > group_rows << bits:
        bits += 1
    return bits


def prefix_groups(fps: DataFrame, prefix_bits: int, half: int, group_rows: int, step: int = 6) -> DataFrame:
    """(fp, prefix, bits): each distinct fingerprint at every prefix that one of
    its variants has, ``bits`` long: ``prefix_bits``, and ``step`` more wherever
    more than ``group_rows`` fingerprints meet, up to the whole variant.  The
    counts are partial sums; each two that share a variant meet at its prefix."""
    flips = lambda n, left: F.array(*[F.lit(int(m)) for m in _flips(n, left)])
    high = lambda n: F.shiftrightunsigned("fp", BITS - n) if n < BITS else F.col("fp")
    rows = fps.select("fp").distinct().select("fp", F.explode(F.transform(flips(prefix_bits, half), lambda m: high(prefix_bits).bitwiseXOR(m))).alias("prefix"))
    bits, settled = prefix_bits, []
    while bits < BITS:
        crowded = rows.groupBy("prefix").count().filter(F.col("count") > group_rows).select("prefix")
        if crowded.isEmpty():
            break
        crowded = written(crowded, "prefixes")
        settled.append(rows.join(crowded, "prefix", "left_anti").select("fp", "prefix", F.lit(bits).alias("bits")))
        more = min(step, BITS - bits)
        used = F.bit_count(high(bits).bitwiseXOR(F.col("prefix")))
        # the next bits of the variant, with as many flips as the prefix has left
        after = F.when(used == 0, flips(more, half))
        for n in range(1, half + 1):
            after = after.when(used == n, flips(more, half - n))
        own = high(bits + more).bitwiseAND(F.lit((1 << more) - 1))
        longer = F.transform(after, lambda m: F.shiftleft("prefix", more).bitwiseOR(own.bitwiseXOR(m)))
        rows = written(rows.join(crowded, "prefix", "left_semi").select("fp", F.explode(longer).alias("prefix")), "prefixes")
        bits += more
    out = rows.select("fp", "prefix", F.lit(bits).alias("bits"))
    for part in settled:
        out = out.union(part)
    return out


def links(fps: DataFrame, max_distance: int = 4, prefix_bits: int | None = None, most_variants: int = 4_000_000,
          group_rows: int = 2_000_000) -> DataFrame:
    """(a, b) links between distinct fingerprints of ``fps`` (column fp) that
    connect exactly those within ``max_distance`` bits: of the fingerprints at
    one variant each is linked to the least.  ``prefix_bits`` sizes the groups
    that a task holds, by default from the number of fingerprints; a prefix with
    more than ``group_rows`` is made longer.  Pairs leave a group some at a time."""
    half = max_distance // 2
    if max_distance % 2:
        raise ValueError("the radius must be even to be met in the middle")
    if prefix_bits is None:
        prefix_bits = prefix_bits_for(fps.select("fp").distinct().count(), half)
    rows = prefix_groups(fps, prefix_bits, half, group_rows)

    def near(found: list[np.ndarray]) -> pa.RecordBatch:
        pairs = np.unique(np.concatenate(found), axis=0)
        close = np.bitwise_count(pairs[:, 0] ^ pairs[:, 1]) <= max_distance
        pairs = np.ascontiguousarray(pairs[close]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        own = table.column("fp").to_numpy().view(np.uint64)
        prefix = table.column("prefix").to_numpy()[:1].view(np.uint64)[0]
        shift = BITS - table.column("bits")[0].as_py()
        used = np.bitwise_count((own >> np.uint64(shift)) ^ prefix).astype(np.int64)
        found, size = [], 0
        for pairs in _meet(own, half - used, shift, most_variants):
            found.append(pairs)
            size += len(pairs)
            if size > most_variants // 4:
                yield near(found)
                found, size = [], 0
        if found:
            yield near(found)

    return rows.groupBy("bits", "prefix").applyInArrow(meet, "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): each node of ``edges`` (a, b) with the least node it can
    reach.  Alternating large-star and small-star rounds; every round's edges
    are written to the shared folder."""
    edges = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b")))
        edges = written(small.filter("a <> b").distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long")), F.countDistinct("a")).first()
        # a star forest: every node but the roots has one edge, and no root is a leaf
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _groups(classes: DataFrame, max_distance: int) -> DataFrame:
    """(fp, least, root) of fingerprints (fp, least): root is the same for all
    that links connect."""
    roots = components(links(classes, max_distance))
    return classes.join(roots, classes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    component_id is the least doc_id that links of ``max_distance`` bits reach,
    the own included; equal fingerprints are linked.  Null or empty texts have
    fingerprint 0 and are linked like any other; a null doc_id keeps its row
    and never becomes an id unless all of its component are null; repeated
    rows stay; an empty table gives an empty result; other columns of ``docs``
    are not looked at."""
    fp = written(fingerprints(docs, shingle), "fingerprints")
    classes = fp.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = _groups(classes, max_distance)
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.join(ids, "root").select("fp", "component_id")
    return fp.join(of, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 4, max_distance: int = 4) -> DataFrame:
    """One row of ``docs`` of each group of linked fingerprints, all columns
    unchanged: the one with the least doc_id (nulls last, then by fingerprint
    and a hash of the text).  Rows with equal doc_id and text are one.

    The rows to keep are chosen from ids, hashes and fingerprints; texts are
    shuffled once, to meet them."""
    text = F.col("text").cast("string")
    named = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64(text).alias("hash"),
                        F.struct(*docs.columns).alias("row"))

    def run(batch: pa.RecordBatch):
        fps = np.array([fingerprint(t, shingle) for t in texts(batch.column(3))], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps.view(np.int64))], ["doc_id", "id", "hash", "fp"])

    rows = written(arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                                         F.xxhash64(text).alias("hash"), text.alias("text")), run, "doc_id long, id string, hash long, fp long"), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp", "hash", "id")).alias("first")
    keep = rows.join(_groups(classes, max_distance).select("fp", "root"), "fp").groupBy("root").agg(first).select("first.id", "first.hash").distinct()
    # a task keeps one of equal rows before it sends any
    order = Window.partitionBy("id", "hash").orderBy(F.xxhash64("row"))
    single = named.withColumn("n", F.row_number().over(order)).filter("n <= 1")
    return single.join(keep, ["id", "hash"], "left_semi").select("row.*")
