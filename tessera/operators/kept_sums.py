"""Least-squares sums that are kept, so that arriving rows are read once.

A fit from ``regression.gram_stats`` reads all its rows.  Here the sums of every part of the input
(a day, a delivery) are written as a table in a folder of the part's own; a fit
adds the parts' sums, a job whose size is the number of parts times the squared
width, and never looks at the rows again.  All parts are taken around one centre, which
the first part fixes.  Sums that live long are added to often, so every number is
a pair ``hi + lo``: what an addition rounds off ``hi`` goes to ``lo``, in the tasks, in
both merge levels and on the driver.
"""

from __future__ import annotations

from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators import arrow_batches as AB
from tessera.operators.aggregates import BLOCK, SALTS
from tessera.operators.regression import GramStats, _centre, _prepared
from tessera.session import drop_dir

PAIR_SCHEMA = "grp int, blk long, salt int, hi array<double>, lo array<double>"
STORED_SCHEMA = "grp int, blk long, hi array<double>, lo array<double>"
ROWS_AT_ONCE = 4096


class Compensated:
    """A vector of running sums as ``hi + lo`` (Knuth's exact addition)."""

    def __init__(self, size: int):
        self.hi, self.lo = np.zeros(size), np.zeros(size)

    def add(self, hi: np.ndarray, lo: np.ndarray | None = None) -> None:
        s = self.hi + hi
        back = s - self.hi
        self.lo += (self.hi - (s - back)) + (hi - back)
        if lo is not None:
            self.lo += lo
        self.hi = s

    @property
    def value(self) -> np.ndarray:
        return self.hi + self.lo


def _blocks(grp: int, sums: Compensated, salt: int) -> pa.RecordBatch:
    n = -(-len(sums.hi) // BLOCK)
    offsets = pa.array(np.minimum(np.arange(n + 1) * BLOCK, len(sums.hi)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, grp, np.int32)), pa.array(np.arange(n, dtype=np.int64)), pa.array(np.full(n, salt, np.int32)),
         pa.ListArray.from_arrays(offsets, pa.array(sums.hi)), pa.ListArray.from_arrays(offsets, pa.array(sums.lo))],
        names=["grp", "blk", "salt", "hi", "lo"])


def pair_sums(rows: DataFrame, label: str, features: str, group: str | None, centre) -> DataFrame:
    """Per task and group the sums ``[upper triangle of U'U, U'v, sum u, sum v, v'v, n]`` around
    ``centre``, in blocks; ``ROWS_AT_ONCE`` rows are multiplied at a time and
    their products added with compensation."""
    x0, y0 = centre

    def per_task(batches):
        from pyspark import TaskContext
        d = len(x0)
        iu, ju = np.triu_indices(d)
        acc: dict[int, Compensated] = {}
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(lo, ROWS_AT_ONCE)
                grp, v = AB.vector(part, "grp", np.int64), AB.vector(part, "y") - y0
                u = AB.matrix(part, "x", d) - x0
                if np.isnan(v).any():
                    raise ValueError("labels that are not numbers")
                for g in np.unique(grp):
                    U, w = u[grp == g], v[grp == g]
                    acc.setdefault(int(g), Compensated(len(iu) + 2 * d + 3)).add(
                        np.concatenate([(U.T @ U)[iu, ju], U.T @ w, U.sum(axis=0), [w.sum(), w @ w, len(w)]]))
        salt = TaskContext.get().partitionId() % SALTS
        for g in list(acc):
            yield _blocks(g, acc.pop(g), salt)

    return _prepared(rows, label, features, group).mapInArrow(per_task, PAIR_SCHEMA)


def merged(pairs: DataFrame) -> DataFrame:
    """The pairs of blocks added up per group and block, first per salt, then over
    the salts; a group's blocks are streamed, so a merging task holds one block."""

    def add(keys, batches):
        total = None
        for batch in batches:
            at = {name: batch.schema.get_field_index(name) for name in ("hi", "lo")}
            for i in range(batch.num_rows):
                hi, lo = (np.asarray(batch.column(at[name])[i].values) for name in ("hi", "lo"))
                total = total or Compensated(len(hi))
                total.add(hi, lo)
        yield pa.RecordBatch.from_arrays([pa.array([k.as_py()], t) for k, t in zip(keys, (pa.int32(), pa.int64(), pa.int32()))]
                                         + [pa.array([v], pa.list_(pa.float64())) for v in (total.hi, total.lo)],
                                         names=["grp", "blk", "salt"][:len(keys)] + ["hi", "lo"])

    # the type hints pick the streaming form
    from collections.abc import Iterator

    add.__annotations__ = {"keys": tuple[pa.Scalar, ...], "batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    salted = pairs.groupBy("grp", "blk", "salt").applyInArrow(add, PAIR_SCHEMA)
    return salted.drop("salt").groupBy("grp", "blk").applyInArrow(add, STORED_SCHEMA)


class KeptSums:
    """The kept sums below ``path`` (a folder on storage that driver and executors share).

    ``append(rows, part)`` reads the rows of one part once and writes its sums; a part
    that is there already is replaced, so an append that failed is simply repeated.
    ``remove(part)`` forgets a part, ``stats()`` gives the sums per group over all
    parts (or the named ones), from which every fit of ``operators.regression`` and
    ``operators.elastic`` starts.  Rows need labels and vectors of one width without
    nulls, or an append raises; a part without rows has no sums."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _exists(self, name: str) -> bool:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return bool(at.getFileSystem(conf).exists(at))

    def _folder(self, part) -> str:
        return "sums/part=" + quote(str(part), safe="")

    def centre(self) -> tuple[np.ndarray, float] | None:
        # a write that was broken off leaves no _SUCCESS and counts as none
        if not self._exists("centre/_SUCCESS"):
            return None
        x, y = self.spark.read.parquet(f"{self.path}/centre").first()
        return np.array(x, dtype=np.float64), float(y)

    def append(self, rows: DataFrame, part, label: str = "label", features: str = "features", group: str | None = None) -> None:
        kept = self.centre()
        if kept is None:
            if not rows.head(1):
                return
            kept = _centre(_prepared(rows, label, features, group))
            schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("y", T.DoubleType())])
            self.spark.createDataFrame([(kept[0].tolist(), kept[1])], schema).write.mode("overwrite").parquet(f"{self.path}/centre")
        merged(pair_sums(rows, label, features, group, kept)).write.mode("overwrite").parquet(f"{self.path}/{self._folder(part)}")

    def remove(self, part) -> None:
        drop_dir(self.spark, f"{self.path}/{self._folder(part)}")

    def stats(self, parts=None) -> dict[int, GramStats]:
        """The sums per group of ``parts`` (default: all that are kept)."""
        kept = self.centre()
        if kept is None:
            raise ValueError("no rows were kept")
        if parts is None:
            stored = self.spark.read.schema(STORED_SCHEMA).option("recursiveFileLookup", "true").parquet(f"{self.path}/sums")
        else:
            folders = [f for f in map(self._folder, parts) if self._exists(f)]
            if not folders:
                raise ValueError("no rows were kept")
            stored = self.spark.read.schema(STORED_SCHEMA).parquet(*[f"{self.path}/{f}" for f in folders])
        # blocks of many parts are dealt over salts by the file that they come from
        pairs = stored.withColumn("salt", F.pmod(F.xxhash64(F.input_file_name()), F.lit(SALTS)).cast("int"))
        held: dict[int, dict[int, np.ndarray]] = {}
        for r in merged(pairs.select("grp", "blk", "salt", "hi", "lo")).toLocalIterator():
            held.setdefault(r["grp"], {})[r["blk"]] = np.array(r["hi"]) + np.array(r["lo"])
        if not held:
            raise ValueError("no rows were kept")
        x0, y0 = kept
        d = len(x0)
        t, (iu, ju), out = d * (d + 1) // 2, np.triu_indices(d), {}
        for g, blocks in held.items():
            s = np.concatenate([blocks[b] for b in sorted(blocks)])
            uu = np.zeros((d, d))
            uu[iu, ju] = uu[ju, iu] = s[:t]
            sv, vv, n = (float(v) for v in s[t + 2 * d:])
            out[g] = GramStats(x0, y0, n, s[t + d:t + 2 * d].copy(), sv, uu, s[t:t + d].copy(), vv)
        return out

    def drop(self) -> None:
        drop_dir(self.spark, self.path)
