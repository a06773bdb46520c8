"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tessera.session import drop_dir, shared_dir

#: Words are maximal runs of anything but the six ASCII white-space bytes; the
#: same class that ``bytes.split()`` uses.
WORD_RE = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage
    in a way that survives lost executors, and lets several jobs share rows
    that were costly to make."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_to = path
    return back


def dropped(*tables: DataFrame) -> None:
    """Delete what ``written`` wrote, once nothing will read it again."""
    for df in tables:
        drop_dir(df.sparkSession, df.written_to)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""

    def run(batches):
        for batch in batches:
            yield from fn(batch)

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text of an Arrow string column; null is empty."""
    for value in column.cast(pa.large_binary()):
        raw = value.as_py()
        yield b"" if raw is None else raw


class Memo(dict):
    """A bounded cache: ``memo[key]`` makes what it does not hold.  When it has
    ``most`` keys they become the older half, from which those still in use are
    taken back; keys over ``longest`` characters are not kept."""

    def __init__(self, make: Callable, most: int = 250_000, longest: int = 64):
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key: str):
        value = self.older.pop(key, None)
        if value is None:
            value = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
