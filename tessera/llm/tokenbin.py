"""Token ids in a bit-packed file format.

A file is a Parquet part of rows, each a block: whole documents in ascending
doc_id order whose ids are packed in the fewest bits that the vocabulary
needs, little-endian bit order, with each document's first id (``offsets``).
An id's place in a block is its number times the width, so any range is read
by itself and unpacked with numpy.  Parts are in doc_id order too.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import shared_dir

from .common import Memo

SCHEMA = ("part int, block int, first long, n_ids long, width int, low long, high long, doc_ids array<long>, offsets array<long>, payload binary")


#: Marks that make a part of their own behind letters.
SENTENCE_MARKS = frozenset(".,;:!?")


def width_of(vocab_size: int) -> int:
    return max(1, int(vocab_size - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Unsigned ids (uint32) in ``width`` bits each."""
    if len(ids) and int(ids.max()) >> width:
        raise ValueError("an id does not fit the width")
    bits = np.unpackbits(np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4), axis=1, count=width, bitorder="little")
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack(payload: bytes, width: int, lo: int, hi: int) -> np.ndarray:
    """Ids lo..hi-1 of a block; only their own bytes are looked at."""
    from_bit = lo * width
    raw = np.frombuffer(payload, np.uint8, (hi * width + 7) // 8 - from_bit // 8, from_bit // 8) if hi > lo else np.empty(0, np.uint8)
    bits = np.unpackbits(raw, bitorder="little")[from_bit % 8 : from_bit % 8 + (hi - lo) * width].reshape(-1, width)
    return np.packbits(np.pad(bits, ((0, 0), (0, 32 - width))), axis=1, bitorder="little").view("<u4").ravel() if hi > lo else np.empty(0, "<u4")


def _byte_letters() -> dict[int, str]:
    """The letters that byte-level tokenizers write bytes as: printable Latin-1
    stands for itself, the rest follows from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{b: chr(b) for b in own}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


class StretchEncoder:
    """Ids (little-endian uint32 bytes) of texts by their stretches between spaces.

    The tokenizer's normalizer and pre-tokenizer treat white space as a break
    and no id or added token spans it, so a text's ids are its stretches' ids in
    turn.  Texts that normalisation only lower-cases have their stretches split
    by the tokenizer's own pattern and given to its merges; for others each
    stretch takes the library's whole way."""

    def __init__(self, path: str, most: int = 400_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]], [x["type"] for x in spec["pre_tokenizer"]["pretokenizers"]]
        if steps != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            raise ValueError(f"unknown steps {steps}")
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.added = [x["content"][:2] for x in spec["added_tokens"]]
        self.letters = _byte_letters()
        self.whole, self.lower, self.parts = Memo(self._whole, most), Memo(self._lower, most), Memo(self._part, most)

    def _whole(self, stretch: str) -> bytes:
        return np.array(self.tokenizer.encode(stretch, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: str) -> bytes:
        letters = part.encode().decode("latin-1").translate(self.letters)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _lower(self, stretch: str) -> bytes:
        if stretch.isalpha():  # letters alone are one part
            return self._part(stretch)
        if stretch[-1:] in SENTENCE_MARKS and stretch[:-1].isalpha():
            return self.lower[stretch[:-1]] + self.parts[stretch[-1]]
        return b"".join(map(self.parts.__getitem__, self.split.findall(stretch)))

    def encode(self, text: str) -> bytes:
        # a capital sigma's lower case depends on its place here, but not in the library
        plain = unicodedata.is_normalized("NFC", text) and "Σ" not in text and not any(x in text for x in self.added)
        held = self.lower if plain else self.whole
        return b"".join(map(held.__getitem__, (text.lower() if plain else text).replace("\n", " ").split(" ")))


@lru_cache(maxsize=2)
def stretch_encoder(path: str) -> StretchEncoder:
    """One per worker process: its caches serve all its tasks."""
    return StretchEncoder(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, vocab_size: int, end_id: int, block_ids: int = 65_536) -> DataFrame:
    """Blocks (SCHEMA) of ``docs``' ids in ascending doc_id order, nulls first.

    Every document gets ``end_id``; a null text is empty; repeated doc_ids keep
    all their rows, by text; a block ends with the document that fills it, so
    one longer than ``block_ids`` is a block of its own; an empty table makes
    no block; other columns are not looked at."""
    width = width_of(vocab_size)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder, part = stretch_encoder(tokenizer_path), TaskContext.get().partitionId()
        block = first = held = 0
        doc_ids, offsets, data = [], [], []

        def flush():
            nonlocal block, first, held, doc_ids, offsets, data
            named = [x for x in doc_ids if x is not None]
            row = {"part": [part], "block": [block], "first": [first], "n_ids": [held], "width": [width], "low": [min(named, default=None)],
                   "high": [max(named, default=None)], "doc_ids": [doc_ids],
                   "offsets": [offsets], "payload": [pack(np.frombuffer(b"".join(data), "<u4"), width)]}
            out = pa.RecordBatch.from_pydict(row, pa.schema([
                ("part", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32()),
                ("low", pa.int64()), ("high", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("payload", pa.binary())]))
            block, first, held, doc_ids, offsets, data = block + 1, first + held, 0, [], [], []
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encoder.encode(text.as_py() or "") + end
                doc_ids.append(doc_id), offsets.append(held), data.append(ids)
                held += len(ids) // 4
                if held >= block_ids:
                    yield flush()
        if doc_ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, SCHEMA)


def write_files(docs: DataFrame, path: str, **encoding) -> None:
    encode_documents(docs, **encoding).write.parquet(path)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, block, doc_id, start, n_tokens, ids_crc32) of every document in
    the files; start counts the ids of all documents before it."""
    blocks = spark.read.schema(SCHEMA).parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                offsets = [*row["offsets"], row["n_ids"]]
                ids = unpack(row["payload"], row["width"], 0, row["n_ids"])
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(offsets, offsets[1:])]
                n = len(crc)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                     pa.array([row["first"] + x for x in row["offsets"]], pa.int64()), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())],
                    ["part", "doc_id", "inside", "n_tokens", "ids_crc32"])

    docs = blocks.select("first", "part", "n_ids", "width", "doc_ids", "offsets", "payload").mapInArrow(
        run, "part int, doc_id long, inside long, n_tokens long, ids_crc32 long")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # a row per file
    before = parts.select("part", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return docs.join(before, "part").select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def _ids(rows: DataFrame) -> DataFrame:
    """(doc_id, at, ids) of the pieces ``rows`` (doc_id, at, width, lo, hi, payload); only
    the bytes of ids lo to hi - 1 are unpacked."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["doc_id"]], pa.int64()), pa.array([r["at"]], pa.int64()),
                     pa.array([unpack(r["payload"], r["width"], r["lo"], r["hi"]).tolist()], pa.list_(pa.int64()))], ["doc_id", "at", "ids"])

    return rows.select("doc_id", "at", "width", "lo", "hi", "payload").mapInArrow(run, "doc_id long, at long, ids array<long>")


def read_documents(spark: SparkSession, path: str, doc_ids) -> DataFrame:
    """(doc_id, ids) of the named documents, in no order; repeated doc_ids give all their
    rows, unknown ones none, None those without a doc_id.  Files and row groups that can't
    hold them are skipped by their least and greatest doc_id."""
    named = sorted({int(x) for x in doc_ids if x is not None})
    blocks = spark.read.schema(SCHEMA).parquet(path)
    holds = F.lit(False)
    for x in named:
        holds = holds | ((F.col("low") <= x) & (F.col("high") >= x))
    wanted = F.col("doc_id").isin(named)
    if None in doc_ids:
        # rows without a doc_id come first: such a block starts with one
        holds = holds | F.col("doc_ids")[0].isNull()
        wanted = wanted | F.col("doc_id").isNull()
    stops = F.concat(F.slice("offsets", 2, F.size("offsets") - 1), F.array("n_ids"))
    rows = blocks.filter(holds).select("width", "payload", F.explode(F.arrays_zip("doc_ids", "offsets", stops.alias("stops"))).alias("d")).select(
        F.col("d.doc_ids").alias("doc_id"), F.lit(0).cast("long").alias("at"), "width", F.col("d.offsets").alias("lo"), F.col("d.stops").alias("hi"), "payload")
    return _ids(rows.filter(F.coalesce(wanted, F.lit(False)))).select("doc_id", "ids")


def read_range(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """(at, ids) of the ids numbered ``start`` to ``stop`` - 1 over all files, a row for each block
    that holds some; ``at`` is the number of a row's first id.  Two short passes: the sizes of all
    parts, then the blocks of the parts that overlap; the others are skipped."""
    blocks = spark.read.schema(SCHEMA).parquet(path)
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", "n", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    hit = parts.filter((F.col("before") < int(stop)) & (F.col("before") + F.col("n") > int(start))).collect()  # files of the range
    if not hit or stop <= start:
        return spark.createDataFrame([], "at long, ids array<long>")
    rows = blocks.filter(F.col("part").isin([r["part"] for r in hit])).join(
        F.broadcast(spark.createDataFrame([(r["part"], r["before"]) for r in hit], "part int, before long")), "part")
    begin = F.col("before") + F.col("first")
    lo, hi = F.greatest(F.lit(int(start)) - begin, F.lit(0)), F.least(F.lit(int(stop)) - begin, F.col("n_ids"))
    rows = rows.select(F.lit(None).cast("long").alias("doc_id"), (begin + lo).alias("at"), "width", lo.alias("lo"), hi.alias("hi"), "payload")
    return _ids(rows.filter("lo < hi")).select("at", "ids")


def round_trip(docs: DataFrame, **encoding) -> DataFrame:
    """Write ``docs``' ids to the shared folder and read them back."""
    path = shared_dir(docs.sparkSession, "tokens")
    write_files(docs, path, **encoding)
    return read_files(docs.sparkSession, path)
