"""Exact substring removal by merged Burrows-Wheeler transforms.

A byte goes if a string of ``length`` bytes that covers it also starts
anywhere else.  Three steps, all over whole texts:

1. **Anchors.**  Each window of ``length`` bytes picks the gram with the least
   hash inside it (its minimizer).  Equal windows pick equal grams at equal
   offsets, so windows whose gram occurs once in the corpus are unique and are
   settled here; the rest is cut into *units*: the runs of windows that share
   one anchor, aligned at it.  Nothing that could repeat is dropped.
2. **Transforms.**  Distinct units are shuffled by their anchor's hash (a task
   sends equal ones once, so copies don't gather in one place).  A task splits
   its units into shards, and each shard builds its transform column by column
   from the right (the symbols before the sorted suffixes of each column).
3. **Merge.**  The shards' transforms are merged by iterative interleave
   refinement: the vector that tells which shard each merged row comes from is
   refined one symbol at a time from the transforms alone, no suffix is sorted
   again.  In the merged order equal windows are neighbours; those with a
   common prefix of ``length`` bytes or more give the repeated intervals.

Units of a *crowded* anchor, one with more than ``crowd`` units, don't meet by
the anchor: each distinct unit goes to a task of its own, and its windows are
counted one by one under 128-bit hashes, with partial sums.  So no task holds
more than ``crowd`` units of one anchor, however many texts share a passage.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, dropped, written

GRAM = 40
_POS_BITS = np.uint64(21)
_POS_MASK = np.uint64((1 << 21) - 1)
_MULT = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1
_BYTE_HASH = np.random.Generator(np.random.PCG64(200)).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every gram of GRAM bytes, by doubling."""
    h = {1: _BYTE_HASH[data]}
    size = 1
    while size < 32:
        p = np.uint64(pow(_MULT, size, 1 << 64))
        h[2 * size] = h[size][:-size] * p + h[size][size:]
        if size != 8:
            del h[size]
        size *= 2
    out = h[32][: len(data) - GRAM + 1] * np.uint64(pow(_MULT, 8, 1 << 64)) + h[8][32 : 32 + len(data) - GRAM + 1]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(29)
    return out


def _window_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (width - size)], x[width - size :]) if width > size else x


def anchor_units(data: np.ndarray, ends: np.ndarray, length: int):
    """Units of a run of texts laid end to end in ``data`` (text t ends before
    ends[t]): arrays (text, start, n_starts, offset, key); start counts from the
    run's first byte, offset is the anchor's distance from the unit's start."""
    empty = np.empty(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty
    keys = (_gram_hashes(data) & ~_POS_MASK) | np.arange(len(data) - GRAM + 1, dtype=np.uint64)
    least = _window_min(keys, length - GRAM + 1)
    begins = np.r_[0, ends[:-1]]
    inside = np.zeros(len(least) + 1, np.int32)
    whole = np.flatnonzero(ends - begins >= length)
    inside[begins[whole]] += 1
    inside[ends[whole] - length + 1] -= 1
    valid = np.cumsum(inside[:-1]) > 0
    cut = np.flatnonzero((least[1:] != least[:-1]) | (valid[1:] != valid[:-1])) + 1
    first = np.r_[0, cut]
    size = np.diff(np.r_[first, len(least)])
    first, size = first[valid[first]], size[valid[first]]
    at = (least[first] & _POS_MASK).astype(np.int64)
    return np.searchsorted(ends, first, side="right"), first, size, at - first, (least[first] >> _POS_BITS).astype(np.int64)


def _runs(batch_texts: list[bytes], length: int, most: int = 1 << 19):
    """Lay texts end to end in runs of about ``most`` bytes; a longer text
    comes in overlapping pieces, each window in just one.  Yields (data, ends,
    text numbers, offsets of the pieces in their texts)."""
    data, own, base, size = [], [], [], 0
    for t, raw in enumerate(batch_texts):
        if len(raw) < length:
            continue
        for lo in range(0, len(raw) - length + 1, most):
            piece = raw[lo : lo + most + length - 1]
            data.append(piece), own.append(t), base.append(lo)
            size += len(piece)
            if size >= most:
                yield np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(x) for x in data]), np.array(own), np.array(base)
                data, own, base, size = [], [], [], 0
    if data:
        yield np.frombuffer(b"".join(data), np.uint8), np.cumsum([len(x) for x in data]), np.array(own), np.array(base)


def _raw(column: pa.Array) -> list[bytes]:
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


class ShardTransform:
    """Transform of a shard of aligned rows (uint8, one column a position):
    ``symbols[c]`` holds, in the sorted order of the suffixes that begin at
    column c + 1, the symbol before each."""

    def __init__(self, columns: np.ndarray):
        width, n = columns.shape
        self.n = n
        self.symbols = np.empty((width, n), np.uint8)
        order = np.arange(n)
        for c in range(width - 1, -1, -1):
            self.symbols[c] = columns[c][order]
            order = order[np.argsort(self.symbols[c], kind="stable")]


def merged_orders(shards: list[ShardTransform]):
    """Merge by interleave refinement.  Yields (c, order) from the last column
    to the first: rows (numbered shard after shard) sorted by their suffixes
    from column c on.  Only the transforms are read: ``z`` tells each merged
    row's shard, the stable sort of the symbols it deals out refines it."""
    width = len(shards[0].symbols)
    z = np.repeat(np.arange(len(shards), dtype=np.uint16), [s.n for s in shards])
    order = np.arange(len(z))
    dealt = np.empty(len(z), np.uint8)
    for c in range(width - 1, -1, -1):
        dealt[np.argsort(z, kind="stable")] = np.concatenate([s.symbols[c] for s in shards])
        step = np.argsort(dealt, kind="stable")
        z, order = z[step], order[step]
        yield c, order


def repeated_starts(rows: np.ndarray, first: np.ndarray, n_starts: np.ndarray, length: int, shard_rows: int) -> np.ndarray:
    """(row, column) table: True where the window of ``length`` bytes that
    starts there equals that of another row.  Row r has windows from column
    first[r] on, n_starts[r] of them."""
    n, width = rows.shape
    columns = np.ascontiguousarray(rows.T)
    shards = [ShardTransform(columns[:, i : i + shard_rows]) for i in range(0, n, shard_rows)]
    starts = width - length + 1
    at = np.arange(starts)[:, None]
    valid = (at >= first) & (at < first + n_starts)
    out = np.zeros((starts, n), bool)
    for c, order in merged_orders(shards):
        if c >= starts:
            continue
        own = order[valid[c][order]]
        if len(own) < 2:
            continue
        window = np.ascontiguousarray(rows[own, c : c + length])
        if length % 8 == 0:
            window = window.view(np.uint64)
        same = (window[1:] == window[:-1]).all(axis=1)  # common prefix of neighbours >= length
        out[c, own[1:][same]] = True
        out[c, own[:-1][same]] = True
    return out.T


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, from, to) of the runs of True in each row."""
    edge = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, lo = np.nonzero(edge == 1)
    _, hi = np.nonzero(edge == -1)
    return row, lo, hi


def _union(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of the union of [lo, hi)."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    head = np.r_[True, lo[1:] > hi[:-1]]
    return lo[head], hi[np.r_[np.flatnonzero(head)[1:] - 1, len(lo) - 1]]


def repeated_intervals(units: DataFrame, length: int, shard_rows: int = 8192, band_rows: int = 65_536) -> DataFrame:
    """(u1, u2, lo, hi): the intervals of each distinct unit that repeated
    windows cover, from rows (key, u1, u2, n_starts, offset, bytes) that are
    partitioned and sorted by key.  u1, u2 name a unit by its content; a second
    row of a name, its bytes null or not, says that the unit occurs again.  The
    rows of one key are never split over bands."""
    width = 2 * length - GRAM

    def solve(table: pa.Table):
        u1, u2 = table.column("u1").to_numpy(), table.column("u2").to_numpy()
        empty = table.column("bytes").is_null().to_numpy()
        order = np.lexsort((empty, u2, u1))
        head = np.r_[True, (u1[order][1:] != u1[order][:-1]) | (u2[order][1:] != u2[order][:-1])]
        copies = np.diff(np.r_[np.flatnonzero(head), len(order)])
        table = table.take(pa.array(order[head]))
        offset, n_starts = table.column("offset").to_numpy(), table.column("n_starts").to_numpy()
        first = (length - GRAM) - offset
        rows = np.zeros((len(first), width), np.uint8)
        for i, b in enumerate(table.column("bytes").to_pylist()):
            rows[i, first[i] : first[i] + len(b)] = np.frombuffer(b, np.uint8)
        flags = repeated_starts(rows, first, n_starts, length, shard_rows)
        at = np.arange(flags.shape[1])
        flags |= (copies > 1)[:, None] & (at >= first[:, None]) & (at < (first + n_starts)[:, None])
        row, lo, hi = _spans(flags)
        return pa.RecordBatch.from_arrays(
            [table.column(c).combine_chunks().take(pa.array(row)) for c in ("u1", "u2")]
            + [pa.array((lo - first[row]).astype(np.int32)), pa.array((hi - 1 + length - first[row]).astype(np.int32))], ["u1", "u2", "lo", "hi"])

    def run(batches):
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows < band_rows:
                continue
            table = pa.Table.from_batches(held)
            key = table.column("key").to_numpy()
            cut = int(np.searchsorted(key, key[-1]))
            if cut:
                yield solve(table.slice(0, cut).combine_chunks())
                table = table.slice(cut).combine_chunks()
            held, rows = table.to_batches(), table.num_rows
        if rows:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return units.mapInArrow(run, "u1 long, u2 long, lo int, hi int")


def unit_windows(units: DataFrame, length: int) -> DataFrame:
    """(u1, u2, at, w1, w2, copies): every window of each distinct unit, at
    ``at`` in it, named by its content; copies is 2 if the unit occurs again.
    Units as in ``repeated_intervals``, sorted by (u1, u2); one is held at once."""

    def windows(name, raw, copies):
        n = len(raw) - length + 1
        w = np.frombuffer(b"".join([xxhash.xxh3_128_digest(raw[i : i + length]) for i in range(n)]), np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, name[0])), pa.array(np.full(n, name[1])), pa.array(np.arange(n, dtype=np.int16)),
                                           pa.array(w[:, 0]), pa.array(w[:, 1]), pa.array(np.full(n, min(copies, 2), np.int32))], ["u1", "u2", "at", "w1", "w2", "copies"])

    def run(batches):
        last, raw, copies = None, None, 0
        for batch in batches:
            for name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                name, value = name[:2], name[2]
                if name != last:
                    if last is not None:
                        yield windows(last, raw, copies)
                    last, raw, copies = name, None, 0
                copies += 1
                if raw is None:
                    raw = value.as_py()
        if last is not None:
            yield windows(last, raw, copies)

    return units.select("u1", "u2", "bytes").mapInArrow(run, "u1 long, u2 long, at short, w1 long, w2 long, copies int")


def window_intervals(windows: DataFrame, length: int) -> DataFrame:
    """(u1, u2, lo, hi): as ``repeated_intervals``, from rows of ``unit_windows``."""
    again = windows.groupBy("w1", "w2").agg(F.sum("copies").alias("n")).filter("n > 1").select("w1", "w2")
    places = windows.join(again, ["w1", "w2"], "left_semi").groupBy("u1", "u2").agg(F.sort_array(F.collect_list("at")).alias("at"))

    def run(batch: pa.RecordBatch):
        row, lo, hi = [], [], []
        for i, at in enumerate(batch.column(2)):
            at = at.values.to_numpy()
            head = np.flatnonzero(np.r_[True, np.diff(at) > 1])
            row += [i] * len(head)
            lo += at[head].tolist()
            hi += (at[np.r_[head[1:] - 1, len(at) - 1]] + length).tolist()
        row = pa.array(row, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(row), batch.column(1).take(row), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], ["u1", "u2", "lo", "hi"])

    return arrow_map(places, run, "u1 long, u2 long, lo int, hi int")


def digests(text):
    """Two independent 64-bit hashes of a text, together its 128-bit key."""
    return F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(200), text).alias("h2")


def kept_texts(docs: DataFrame, length: int = 200, crowd: int = 4096) -> DataFrame:
    """(h1, h2, n_bytes, n_removed, n_spans, kept binary) of every distinct text
    of ``docs``; join ``docs`` to it by ``digests(coalesce(text, ''))``.

    A null text is empty.  Texts shorter than ``length`` bytes keep all.  Equal
    texts (repeated rows included) are handled once and lose all their bytes if
    they have ``length`` or more.  An empty table gives an empty result; other
    columns are not looked at."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    name = f"tessera_texts_{uuid.uuid4().hex[:12]}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (docs.select(text.alias("text")).select("text", *digests(F.col("text")))
     .groupBy("h1", "h2").agg(F.count("*").alias("copies"), F.first("text").alias("text"))
     .write.option("compression", "zstd").bucketBy(n, "h1", "h2").saveAsTable(name))  # both joins below find the texts in place
    whole = spark.table(name)

    def cut(batch: pa.RecordBatch):
        h1, h2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for data, ends, own, base in _runs(_raw(batch.column(2)), length):
            t, start, size, offset, key = anchor_units(data, ends, length)
            begins = np.r_[0, ends[:-1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[own[t]]), pa.array(h2[own[t]]), pa.array(key), pa.array((start - begins[t] + base[t]).astype(np.int32)),
                 pa.array(size.astype(np.int16)), pa.array(offset.astype(np.int16))],
                ["h1", "h2", "key", "start", "n_starts", "offset"])

    units = written(arrow_map(whole.select("h1", "h2", "text"), cut,
                              "h1 long, h2 long, key long, start int, n_starts short, offset short"), "units")
    often = written(units.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select("key", (F.col("n") > crowd).alias("crowded")), "anchors")
    # hashes of anchors are not negative: -1 stands for any crowded one
    again = units.join(often, "key").withColumn("key", F.when(F.col("crowded"), F.lit(-1)).otherwise(F.col("key")))
    wanted = again.groupBy("h1", "h2").agg(F.collect_list(F.struct("key", "start", "n_starts", "offset")).alias("units"))

    def slices(batch: pa.RecordBatch):
        """(positions of the units' texts in the batch, units, their bytes, names u1 and u2), some at a time"""
        raw, units = _raw(batch.column(2)), batch.column(3)
        part = units.flatten()
        owner = np.repeat(np.arange(batch.num_rows), units.value_lengths().to_numpy())
        for i in range(0, len(owner), 16_384):
            p, own = part.slice(i, 16_384), owner[i : i + 16_384]
            start, size = p.field("start").to_numpy(), p.field("n_starts").to_numpy()
            bits = [raw[a][b:c] for a, b, c in zip(own.tolist(), start.tolist(), (start + size + (length - 1)).tolist())]
            name = b"".join([xxhash.xxh3_128_digest(x, o) for x, o in zip(bits, p.field("offset").to_pylist())])
            u = np.frombuffer(name, np.int64).reshape(-1, 2)
            yield own, p, bits, u

    def distinct_units(batches, crowded=False):
        # a task sends a unit's bytes once, and a bare second row if it has it again
        seen: dict[tuple[int, int], int] = {}
        for batch in batches:
            for _, p, bits, u in slices(batch):
                take, mine = [], (p.field("key").to_numpy() < 0).tolist()
                for i, name in enumerate(map(tuple, u.tolist())):
                    if mine[i] != crowded:
                        continue
                    n = seen[name] = seen.get(name, 0) + 1
                    if n > 1:
                        bits[i] = None
                    if n <= 2:
                        take.append(i)
                at = pa.array(take, pa.int64())
                yield pa.RecordBatch.from_arrays([p.field("key").take(at), pa.array(u[take, 0]), pa.array(u[take, 1]), p.field("n_starts").take(at), p.field("offset").take(at),
                                                  pa.array(bits, pa.binary()).take(at)], ["key", "u1", "u2", "n_starts", "offset", "bytes"])

    def places(batch: pa.RecordBatch):
        for own, p, _, u in slices(batch):
            own = pa.array(own)
            yield pa.RecordBatch.from_arrays([pa.array(u[:, 0]), pa.array(u[:, 1]), batch.column(0).take(own), batch.column(1).take(own), p.field("start")],
                                             ["u1", "u2", "h1", "h2", "start"])

    joined = whole.join(wanted, ["h1", "h2"]).select("h1", "h2", "text", "units")
    kind = "key long, u1 long, u2 long, n_starts short, offset short, bytes binary"
    found = repeated_intervals(joined.mapInArrow(distinct_units, kind).repartition(n, "key").sortWithinPartitions("key"), length)
    crowds = []
    if not often.filter("crowded").isEmpty():
        some = joined.filter(F.exists("units", lambda u: u["key"] < 0)).withColumn("units", F.filter("units", lambda u: u["key"] < 0))
        crowded = some.mapInArrow(lambda batches: distinct_units(batches, True), kind).repartition(n, "u1", "u2").sortWithinPartitions("u1", "u2", F.col("bytes").isNull())
        crowds = [written(unit_windows(crowded, length), "windows")]
        found = found.union(window_intervals(crowds[0], length))
    members = arrow_map(joined, places, "u1 long, u2 long, h1 long, h2 long, start int")
    spans = members.join(found, ["u1", "u2"]).select(
        "h1", "h2", (F.col("start") + F.col("lo")).cast("long").alias("lo"), (F.col("start") + F.col("hi")).cast("long").alias("hi"))
    covered = spans.groupBy("h1", "h2").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))

    def remove(batch: pa.RecordBatch):
        copies, spans = batch.column(3).to_pylist(), batch.column(4)
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for i, raw in enumerate(_raw(batch.column(2))):
            own = spans[i].values if spans[i].is_valid else None
            if copies[i] > 1 and len(raw) >= length:
                lo, hi = np.array([0]), np.array([len(raw)])
            elif own is not None:
                lo, hi = _union(own.field("lo").to_numpy(), own.field("hi").to_numpy())
            else:
                lo = hi = np.empty(0, np.int64)
            ends = np.r_[lo, len(raw)].tolist()
            kept.append(b"".join(raw[a:b] for a, b in zip([0, *hi.tolist()], ends)))
            n_bytes.append(len(raw)), n_removed.append(int((hi - lo).sum())), n_spans.append(len(lo))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_bytes, pa.int64()), pa.array(n_removed, pa.int64()),
                                          pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())],
                                         ["h1", "h2", "n_bytes", "n_removed", "n_spans", "kept"])

    both = whole.join(covered, ["h1", "h2"], "left").select("h1", "h2", "text", "copies", "spans")
    out = written(arrow_map(both, remove, "h1 long, h2 long, n_bytes long, n_removed long, n_spans long, kept binary"), "kept")
    spark.sql(f"DROP TABLE {name}")
    dropped(units, often, *crowds)
    return out


def with_kept(docs: DataFrame, length: int = 200, crowd: int = 4096) -> DataFrame:
    """(row, n_bytes, n_removed, n_spans, kept) for every row of ``docs``: row is
    the row as it was but for its text, kept the remaining bytes."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), *digests(text))
    return rows.join(kept_texts(docs.select("text"), length, crowd), ["h1", "h2"]).drop("h1", "h2")


def remaining_documents(docs: DataFrame, length: int = 200) -> DataFrame:
    """Every row of ``docs``, all columns, with the remaining bytes as its text
    (empty where it was null; a character cut in two leaves the
    replacement mark) and, if there is one, n_chars set to its length."""
    rows = with_kept(docs, length).withColumn("text", F.make_valid_utf8(F.col("kept").cast("string")))
    pick = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*[pick[c].alias(c) if c in pick else F.col("row")[c].alias(c) for c in docs.columns])
