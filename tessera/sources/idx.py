"""idx-ubyte image and label files (optionally gzip), the format of the
classic handwritten-digit and clothing image sets.

Reading is a Spark data source, ``idx``: records have a fixed length, so a plain file
is planned as ranges of records, each a task that seeks to its first byte and
streams some records at a time; a gzip file, which can only be read from its
beginning, is one task, streamed too.  Images meet labels by a join on (stem,
idx).  Writing: a task writes a pair of files for every ``chunk`` of its rows, so
it never holds more; a retried task writes the same names again, so a lost
executor leaves no debris.
"""

from __future__ import annotations

import gzip
import io
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tessera.operators import arrow_batches as AB
from tessera.session import qualified

IMAGE_MAGIC = 2051
LABEL_MAGIC = 2049


def encode_images(pixels: np.ndarray) -> bytes:
    n, h, w = pixels.shape
    return struct.pack(">IIII", IMAGE_MAGIC, n, h, w) + pixels.astype(np.uint8).tobytes()


def encode_labels(labels: np.ndarray) -> bytes:
    return struct.pack(">II", LABEL_MAGIC, len(labels)) + labels.astype(np.uint8).tobytes()


def _header(stream) -> tuple[int, tuple[int, ...], int]:
    """Records, the shape of one, and the bytes before the first."""
    magic, n = struct.unpack(">II", stream.read(8))
    if magic not in (IMAGE_MAGIC, LABEL_MAGIC):
        raise ValueError(f"not an idx image/label file (magic {magic})")
    if magic == LABEL_MAGIC:
        return n, (), 8
    return n, (int(np.prod(struct.unpack(">II", stream.read(8)))),), 16


def _stream(stream, first: int, last: int, shape: tuple[int, ...], chunk: int) -> Iterator[tuple[int, np.ndarray]]:
    size = int(np.prod(shape)) if shape else 1
    for at in range(first, last, chunk):
        take = min(chunk, last - at)
        raw = stream.read(take * size)
        if len(raw) != take * size:
            raise ValueError("the file ends before its last record")
        yield at, np.frombuffer(raw, np.uint8).reshape(take, *shape)


def records(content: bytes, chunk: int = 4096):
    """The records of one idx file, ``chunk`` at a time: ``(first, values)``,
    values (n, h * w) for images and (n,) for labels."""
    stream = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        stream = gzip.GzipFile(fileobj=stream)
    n, shape, _ = _header(stream)
    yield from _stream(stream, 0, n, shape, chunk)


def _opened(path: str):
    """The Arrow file system of a qualified path, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path)


class IdxRange(InputPartition):
    """Records ``first`` to ``last`` of a file; all of it where ``last`` is None (gzip)."""

    def __init__(self, path: str, stem: str, first: int = 0, last: int | None = None):
        super().__init__((path, first))
        self.path, self.stem, self.first, self.last = path, stem, first, last


class IdxReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.kind = options["path"], options["kind"]
        self.factor = float(options.get("factor", 1.0))
        self.most = int(options.get("recordsPerTask", RECORDS_PER_TASK))

    def partitions(self) -> list[InputPartition]:
        """Ranges from the headers of the plain files alone; a range's share of its
        file's bytes follows from the record length."""
        from pyarrow import fs

        files, base = _opened(self.path)
        out = []
        for info in sorted(files.get_file_info(fs.FileSelector(base)), key=lambda f: f.path):
            named = re.fullmatch(r"(.*)-(images|labels)-idx\d-ubyte(\.gz)?", info.base_name)
            if not info.is_file or not named or named[2] != self.kind:
                continue
            if named[3]:
                out.append(IdxRange(info.path, named[1]))
                continue
            with files.open_input_file(info.path) as f:
                n, shape, head = _header(f)
            if info.size != head + n * (int(np.prod(shape)) if shape else 1):
                raise ValueError(f"{info.path}: the file ends before its last record, or goes on after it")
            out += [IdxRange(info.path, named[1], i, min(i + self.most, n)) for i in range(0, n, self.most)]
        return out

    def read(self, partition: IdxRange) -> Iterator[pa.RecordBatch]:
        files, _ = _opened(self.path)
        whole = partition.last is None
        with files.open_input_stream(partition.path, compression=None) if whole else files.open_input_file(partition.path) as f:
            stream = gzip.GzipFile(fileobj=f) if whole else f
            n, shape, head = _header(stream)
            first, last = (0, n) if whole else (partition.first, partition.last)
            if not whole:
                f.seek(head + first * (int(np.prod(shape)) if shape else 1))
            for at, values in _stream(stream, first, last, shape, 4096):
                data = AB.list_column(values / self.factor) if self.kind == "images" else pa.array(values.astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array([partition.stem] * len(values), pa.string()), pa.array(np.arange(at, at + len(values))), data],
                                                 ["file", "idx", "pixels" if self.kind == "images" else "label"])


class IdxSource(DataSource):
    """``spark.read.format("idx")`` with ``kind`` images or labels, ``recordsPerTask`` and ``factor``."""

    @classmethod
    def name(cls) -> str:
        return "idx"

    def schema(self) -> str:
        return "file string, idx long, " + ("pixels array<double>" if self.options["kind"] == "images" else "label int")

    def reader(self, schema) -> IdxReader:
        return IdxReader(self.options)


RECORDS_PER_TASK = 262_144


def write_idx(df: DataFrame, path: str, pixels: str = "pixels", label: str = "label",
              h: int = 8, w: int = 8, chunk: int = 65_536, compress: bool = True) -> int:
    """Write ``pixels`` (0..255 ints, ``h*w`` per row) and ``label`` as idx part
    files under ``path``, gzip or (``compress=False``) plain - resolved by Spark's own
    file systems, so tasks and readers mean the same place; returns the number of rows written."""
    root = qualified(df.sparkSession, path.rstrip("/"))

    def per_task(batches):
        from pyspark import TaskContext

        task, part, held, rows = TaskContext.get().partitionId(), 0, [], 0
        filesys, base = _opened(root)
        filesys.create_dir(base, recursive=True)

        def flush():
            nonlocal part, held, rows
            images = np.concatenate([x for x, _ in held]).reshape(-1, h, w)
            labels = np.concatenate([y for _, y in held])
            for kind, blob in (("images-idx3-ubyte", encode_images(images)), ("labels-idx1-ubyte", encode_labels(labels))):
                with filesys.open_output_stream(f"{base}/part-{task:05d}-{part:04d}-{kind}" + (".gz" if compress else ""), compression=None) as out:
                    out.write(gzip.compress(blob, mtime=0) if compress else blob)
            part, held, rows = part + 1, [], 0
            return pa.RecordBatch.from_arrays([pa.array([len(labels)], pa.int64())], ["n"])

        for batch in batches:
            for i in range(0, batch.num_rows, chunk):
                piece = batch.slice(i, chunk)
                held.append((AB.matrix(piece, pixels, h * w), AB.vector(piece, label, np.int64)))
                rows += piece.num_rows
                if rows >= chunk:
                    yield flush()
        if rows:
            yield flush()

    return int(df.select(pixels, label).mapInArrow(per_task, "n long").agg(F.sum("n")).first()[0] or 0)


def read_idx(spark: SparkSession, path: str, scale: bool = True, records_per_task: int = RECORDS_PER_TASK) -> DataFrame:
    """``(file, idx, label int, pixels array<double>)`` from the idx files
    under ``path`` - part files written by ``write_idx`` or the usual
    ``<set>-images-idx3-ubyte[.gz]`` / ``<set>-labels-idx1-ubyte[.gz]``
    pairs (``file`` is then ``train``, ``t10k``, ...); pixels are scaled to
    0..1 when ``scale``.  A plain file is read by ``records_per_task`` records a task.  An
    image without a label, or the reverse, raises."""
    spark.dataSource.register(IdxSource)

    def rows_of(kind: str) -> DataFrame:
        options = {"path": qualified(spark, path.rstrip("/")), "kind": kind, "recordsPerTask": str(records_per_task), "factor": "255.0" if scale else "1.0"}
        return spark.read.format("idx").options(**options).load()

    both = rows_of("images").join(rows_of("labels"), ["file", "idx"], "full_outer")
    paired = F.col("label").isNotNull() & F.col("pixels").isNotNull()
    return both.select("file", "idx", F.when(paired, F.col("label")).otherwise(
        F.raise_error(F.concat(F.lit("idx part "), "file", F.lit(": images and labels do not pair up")))).cast("int").alias("label"), "pixels")
