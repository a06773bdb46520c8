"""Offset-preserving SentencePiece encoding and decoding.

Texts are normalised here, by longest-prefix match through the model's
compiled character map (a double-array trie), which records for every byte of
the normalised text the byte of the source it came from.  The library's merges
then run on the normalised text (a copy of the model that changes nothing more),
and each piece is projected through the recorded alignment to its span of
source bytes.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo

SPACE = "▁"


class CharacterMap:
    """The compiled map: a double-array trie of source strings whose values are
    places in a block of zero-ended replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.replacements = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[bytes, int] | None:
        """(replacement, source length) of the longest key at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        node = (units[0] >> 10) << ((units[0] & 512) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units) or (units[node] & 0x800000FF) != raw[i]:
                break
            unit = units[node]
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, i + 1 - at
        if found is None:
            return None
        start, length = found
        return self.replacements[start : self.replacements.index(b"\0", start)], length


class Normalizer:
    def __init__(self, spec):
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.dummy, self.strip, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, alignment): alignment[i] is the source byte that
        normalised byte i came from; one more entry for the end."""
        if not raw:
            return b"", np.zeros(1, np.int64)
        space = SPACE.encode() if self.escape else b" "
        if not self.map.units and not self.strip:  # each character is its own longest prefix
            data = np.frombuffer(raw, np.uint8)
            width = np.where(data == 32, len(space), 1)
            align = np.repeat(np.arange(len(data)), width)
            head = len(space) * self.dummy
            return space * self.dummy + raw.replace(b" ", space), np.r_[np.zeros(head, np.int64), align, len(raw)]
        out, align, at = bytearray(), [], 0

        def step(i):
            hit = self.map.longest(raw, i)
            if hit:
                return hit
            n = 1 + (raw[i] >= 0xC0) + (raw[i] >= 0xE0) + (raw[i] >= 0xF0)
            return raw[i : i + n], n

        if self.strip:
            while at < len(raw):
                text, n = step(at)
                if text != b" ":
                    break
                at += n
            if at == len(raw):
                return b"", np.zeros(1, np.int64)
        if self.dummy:
            out += space
            align += [at] * len(space)
        after_space = self.strip
        while at < len(raw):
            text, n = step(at)
            if after_space:
                text = text.lstrip(b" ")
            if text:
                text, ends = text.replace(b" ", space), text.endswith(b" ")
                out += text
                align += [at] * len(text)
                after_space = ends and self.strip
            at += n
        end = len(raw)
        if self.strip:
            while out.endswith(space):
                end = align[len(out) - len(space)]
                del out[-len(space) :], align[-len(space) :]
        return bytes(out), np.array([*align, end], np.int64)


class Codec:
    """Encodes with spans and decodes."""

    def __init__(self, path: str, most: int = 250_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as model

        with open(path, "rb") as f:
            proto = model.ModelProto.FromString(f.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalize = Normalizer(proto.normalizer_spec)
        spec = proto.normalizer_spec
        spec.precompiled_charsmap, spec.normalization_rule_tsv = b"", ""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = False
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
        names = [p.piece for p in proto.pieces]
        byte = {i for i, p in enumerate(proto.pieces) if p.type == model.ModelProto.SentencePiece.BYTE}
        self.lengths = np.array([1 if i in byte else len(x.encode()) for i, x in enumerate(names)], np.int64)
        self.unknown = proto.trainer_spec.unk_id
        # merges only make pieces of the vocabulary: where none has the space mark after another character, and
        # none has a line feed, texts come apart there
        plain = [x for i, x in enumerate(names) if i not in byte]
        bpe = proto.trainer_spec.model_type == model.TrainerSpec.BPE and proto.trainer_spec.byte_fallback
        apart = bpe and not any(SPACE in x.lstrip(SPACE) or "\n" in x for x in plain)
        self.parts = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n" if apart else r"(?s).+")
        self.memo = Memo(self._part, most)

    def _part(self, part: str) -> tuple[tuple[int, ...], str]:
        ids = self.merges.encode(part)
        return tuple(ids), ",".join(map(str, ids))

    def encode(self, raw: bytes) -> tuple[list[int], str, np.ndarray]:
        """(ids, decimal ids joined by commas, bounds): piece i spans the source
        bytes bounds[i] to bounds[i + 1]."""
        norm, align = self.normalize(raw)
        got = list(map(self.memo.__getitem__, self.parts.findall(norm.decode())))
        ids = list(chain.from_iterable([x[0] for x in got]))
        n = self.lengths[np.array(ids, np.int64)]
        if self.unknown in ids:
            n = np.array([len(p.piece.encode()) for x in self.parts.findall(norm.decode())
                          for p in self.merges.encode(x, out_type="immutable_proto").pieces], np.int64)
        return ids, ",".join([x[1] for x in got]), align[np.r_[0, np.cumsum(n)]] if ids else np.zeros(1, np.int64)

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One per worker process: its cache serves all its tasks."""
    return Codec(path)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids array<int>, bounds array<long>, decoded) for every row of
    ``docs``: the pieces' ids, their source byte bounds (one more than ids) and
    the decoded text.  A null text is empty and has no pieces."""

    def run(batches):
        own = codec(model_path)
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids, _, bounds = own.encode((text.as_py() or "").encode())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id.as_py()], pa.int64()), pa.array([ids], pa.list_(pa.int32())),
                     pa.array([bounds], pa.list_(pa.int64())), pa.array([own.decode(ids)])], ["doc_id", "ids", "bounds", "decoded"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, ids array<int>, bounds array<long>, decoded string")


def digest_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, bounds_crc32) for every
    row of ``docs``, without the arrays leaving the task; bounds_crc32 is over
    the bounds as little-endian 64-bit integers.  A null text is empty; repeated
    rows stay; an empty table gives an empty result; a very long text is encoded
    whole; other columns are not looked at."""

    def run(batches):
        own = codec(model_path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            rows = []
            for text in batch.column(1):
                ids, decimal, bounds = own.encode((text.as_py() or "").encode())
                rows.append((len(ids), sha(decimal.encode()), sha(own.decode(ids).encode()), zlib.crc32(bounds.astype("<i8").tobytes())))
            n, a, b, c = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.int64())],
                                             ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "bounds_crc32"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, bounds_crc32 long")
