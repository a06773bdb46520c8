"""Rows stored by batch, so that a training round opens only its own batch.

A round over batch ``b`` of a table that is merely persisted still looks at
every row.  Here the rows are written once to the shared folder, in the order of their batch
ids: folders of neighbouring batches (partition pruning while the round is planned)
and small row groups inside (skipped by their least and largest batch id)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import drop_dir, shared_dir

ROW_GROUP = 512 << 10  # bytes
PAGE = 64 << 10


def batch_of(key: str, size: int):
    """The batch of a row, ``key div size`` in whole numbers (a quotient of
    doubles would lose the digits of keys above 2^53)."""
    return F.expr(f"cast(`{key}` as bigint) div {int(size)}")


@dataclass
class BatchStore:
    """The written rows: ``span`` batch ids from ``first`` on, ``per_folder`` of them a folder."""
    stored: DataFrame
    path: str
    first: int
    span: int
    per_folder: int

    def rows(self, round_: int) -> DataFrame:
        """The rows of the batch that ``round_`` takes: the ids in turn, around; no
        rows where the keys have a gap."""
        at = round_ % self.span
        own = (F.col("folder") == at // self.per_folder) & (F.col("batch") == self.first + at)
        return self.stored.filter(own).drop("folder", "batch")

    def drop(self) -> None:
        drop_dir(self.stored.sparkSession, self.path)


def store_batches(rows: DataFrame, key: str, size: int, folders: int = 1024) -> BatchStore:
    """Write ``rows`` by batch of ``size`` keys, ``folders`` folders at most; rows
    with a null key are in no batch.  One pass for the range of ids, one to write."""
    b = batch_of(key, size)
    low, high = rows.agg(F.min(b), F.max(b)).first()
    if low is None:
        raise ValueError("no training rows")
    span = int(high) - int(low) + 1
    per = -(-span // folders)
    path = shared_dir(rows.sparkSession, "batches")
    named = rows.filter(F.col(key).isNotNull()).withColumn("batch", b).withColumn("folder", F.expr(f"(batch - {int(low)}L) div {per}").cast("int"))
    # a large batch is dealt over tasks by its keys
    dealt = named.repartitionByRange("batch", key).sortWithinPartitions("folder", "batch")
    dealt.write.option("parquet.block.size", ROW_GROUP).option("parquet.page.size", PAGE).partitionBy("folder").parquet(path)
    back = rows.sparkSession.read.schema(named.schema).parquet(path)
    return BatchStore(back, path, int(low), span, per)
