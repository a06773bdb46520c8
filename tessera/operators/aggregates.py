"""Distributed sums of fixed-size numeric blocks.

Iterative fits emit one partial-sum vector per task.  Summing those in one
reducer would funnel ``#tasks x width`` numbers into one place; instead the
vector is cut into blocks of ``block`` numbers and summed by Spark in two
levels, first per block id and salt (a function of the emitting task), then per
block id, so a reducer adds ``#tasks / SALTS`` blocks at most.  Only the final
``width`` numbers reach the driver - a bound set by the model size, not the
data.  The same two levels run at every size.  Counts, which must be exact, are
added as 64-bit integers in the same two levels; where it only matters which of
them reach a least count, as bytes that stop there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 4096
SALTS = 64

BLOCK_SCHEMA = "key long, blk long, salt int, part array<double>"

#: Whole numbers are sent in smaller blocks, so that a batch of 10,000 rows is 40 MB at most
COUNT_BLOCK = 512

COUNT_SCHEMA = "blk long, salt int, part array<long>"

UPTO_SCHEMA = "blk long, salt int, part binary"


def emit_blocks(vec: np.ndarray, block: int = BLOCK, key: int = 0) -> pa.RecordBatch:
    """A task's partial-sum vector as ``(key, blk, salt, part)`` rows."""
    vec = np.asarray(vec, dtype=np.float64).ravel()
    n = max(1, -(-len(vec) // block))
    offsets = np.minimum(np.arange(n + 1, dtype=np.int64) * block, len(vec)).astype(np.int32)
    parts = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vec))
    task = TaskContext.get()
    salt = task.partitionId() % SALTS if task is not None else 0
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, key, dtype=np.int64)), pa.array(np.arange(n, dtype=np.int64)),
         pa.array(np.full(n, salt, dtype=np.int32)), parts],
        names=["key", "blk", "salt", "part"])


def block_sums(parts: DataFrame) -> DataFrame:
    """``(key, blk, s vector)``: the blocks of ``parts`` added up."""
    salted = parts.groupBy("key", "blk", "salt").agg(
        Summarizer.sum(array_to_vector(F.col("part"))).alias("s"))
    return salted.groupBy("key", "blk").agg(Summarizer.sum(F.col("s")).alias("s"))


def sum_blocks(parts: DataFrame) -> dict[int, np.ndarray]:
    """The sums of ``parts``, reassembled per key."""
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in block_sums(parts).collect():
        out.setdefault(r["key"], {})[r["blk"]] = r["s"].toArray()
    return {k: np.concatenate([v[b] for b in sorted(v)]) for k, v in out.items()}


def _count_rows(blk: np.ndarray, salt: int, flat: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch:
    parts = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
    return pa.RecordBatch.from_arrays(
        [pa.array(blk.astype(np.int64)), pa.array(np.full(len(blk), salt, dtype=np.int32)), parts], names=["blk", "salt", "part"])


def emit_counts(vec: np.ndarray) -> pa.RecordBatch:
    """A task's whole numbers as ``(blk, salt, part)`` rows."""
    vec = np.asarray(vec, dtype=np.int64).ravel()
    n = -(-len(vec) // COUNT_BLOCK)
    task = TaskContext.get()
    salt = task.partitionId() % SALTS if task is not None else 0
    return _count_rows(np.arange(n), salt, vec, np.minimum(np.arange(n + 1) * COUNT_BLOCK, len(vec)))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each block of a task's rows."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        part = batch.column("part")
        flat, at = part.flatten().to_numpy(), part.offsets.to_numpy()
        at = at - at[0]
        for i, blk in enumerate(batch.column("blk").to_pylist()):
            own = flat[at[i]:at[i + 1]]
            if blk in total:
                total[blk] += own
            else:
                total[blk] = own.copy()
    if total:
        yield _count_rows(np.array(list(total)), 0, np.concatenate(list(total.values())), np.cumsum([0, *map(len, total.values())]))


def sum_counts(parts: DataFrame, size: int) -> np.ndarray:
    """The sums of what ``emit_counts`` made of vectors of ``size`` whole numbers,
    in 64-bit integers: ``Summarizer.sum`` is a running mean times a weight, which
    may fall below the whole number it stands for."""
    out = np.zeros(size, np.int64)
    salted = parts.repartition("blk", "salt").mapInArrow(_added, COUNT_SCHEMA)
    sums = salted.repartition("blk").mapInArrow(_added, COUNT_SCHEMA).select("blk", "part").toArrow()
    for batch in sums.to_batches():
        for blk, part in zip(batch.column("blk").to_pylist(), batch.column("part")):
            own = part.values.to_numpy()
            out[blk * COUNT_BLOCK:blk * COUNT_BLOCK + len(own)] += own
    return out


def upto_kind(least: int) -> np.dtype:
    """The narrowest numbers that hold 0 to ``least``."""
    return np.min_scalar_type(max(least, 1))


def _upto_rows(blk: np.ndarray, salt: int, parts: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(blk, pa.int64()), pa.array(np.full(len(blk), salt, dtype=np.int32)), pa.array(parts, pa.binary())], names=["blk", "salt", "part"])


def emit_upto(vec: np.ndarray, at_once: int = 2048) -> Iterator[pa.RecordBatch]:
    """A task's counts, of ``upto_kind(least)`` and none above ``least``, as
    ``(blk, salt, part)`` rows of their bytes; blocks of zeros are left out."""
    task = TaskContext.get()
    salt = task.partitionId() % SALTS if task is not None else 0
    some = np.flatnonzero(np.add.reduceat(vec != 0, np.arange(0, len(vec), COUNT_BLOCK), dtype=np.int64))
    for i in range(0, len(some), at_once):
        own = some[i:i + at_once]
        yield _upto_rows(own, salt, [vec[b * COUNT_BLOCK:(b + 1) * COUNT_BLOCK].tobytes() for b in own.tolist()])


def reached(parts: DataFrame, size: int, least: int) -> np.ndarray:
    """A bit (``np.packbits``) for each of ``size`` numbers: whether its sum over what
    ``emit_upto`` made is ``least`` or more.  A sum that stops at ``least`` tells it as
    well as the whole sum, and takes a byte for each number where ``least`` is under 256."""
    least = max(least, 1)
    kind = upto_kind(least)

    def sums(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for blk, part in zip(batch.column("blk").to_pylist(), batch.column("part").to_pylist()):
                own = np.frombuffer(part, kind)
                if blk in total:
                    total[blk] += np.minimum(own, least - total[blk])
                else:
                    total[blk] = own.copy()
        return total

    def added(batches):
        if total := sums(batches):
            yield _upto_rows(np.array(list(total)), 0, [v.tobytes() for v in total.values()])

    def packed(batches):
        if total := sums(batches):
            yield _upto_rows(np.array(list(total)), 0, [np.packbits(v == least).tobytes() for v in total.values()])

    out = np.zeros(-(-size // 8), np.uint8)
    salted = parts.repartition("blk", "salt").mapInArrow(added, UPTO_SCHEMA)
    for batch in salted.repartition("blk").mapInArrow(packed, UPTO_SCHEMA).select("blk", "part").toArrow().to_batches():
        for blk, part in zip(batch.column("blk").to_pylist(), batch.column("part").to_pylist()):
            at = blk * COUNT_BLOCK // 8
            out[at:at + len(part)] = np.frombuffer(part, np.uint8)
    return out


class Shared:
    """Model-sized values for one job as a broadcast variable: sent once per
    executor, not once per task.  ``release()`` after the job frees the
    executors' copies."""

    def __init__(self, spark, value):
        self.handle = spark.sparkContext.broadcast(value)

    def release(self) -> None:
        self.handle.destroy()
