"""Encoding, packing and counting against the libraries themselves."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model
from tessera.llm import pieces, tokenbin, tokencount
from tokenizers import Tokenizer

PIECES, WORDS, BYTES = (P.path(x) for x in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.json"))
ODD = ["", " ", "  a", "a  b ", "\n", "a\n b\n", " \n ", "é▁x", "日本語 テスト\t\x00z", "▁", "a ▁ b", "\U0001f600 x", "<s> </s> <unk> <0x0A>", "a" * 300,
       "  x　y", "it's 'S don't", "<|endoftext|>x <|startoftext|> y", "Á ́ İx Σς ΑΣ", "\x1c\x85  q"]


def test_pieces_match_the_library(edge, edge_rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in edge_rows:
        ids = lib.encode(r[1] or "")
        want.append((r[0] or -1, len(ids), sha(",".join(map(str, ids))), sha(lib.decode(ids))))
    got = [(r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.digest_documents(edge, PIECES).collect()]
    assert sorted(got) == sorted(want)


def test_odd_texts_and_their_spans():
    lib, codec = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.Codec(PIECES)
    for text in ODD:
        raw = text.encode()
        ids, decimal, bounds = codec.encode(raw)
        assert ids == lib.encode(text) and decimal == ",".join(map(str, ids))
        assert len(bounds) == len(ids) + 1 and (np.diff(bounds) >= 0).all() and bounds[-1] == len(raw)
        for i, a, b in zip(ids, bounds, bounds[1:]):
            if not lib.is_byte(i):
                assert raw[a:b].decode().replace(" ", "▁") in (lib.id_to_piece(i), lib.id_to_piece(i)[1:])


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("dummy", [False, True])
@pytest.mark.parametrize("strip", [False, True])
def test_normaliser_matches_the_library(rule, dummy, strip, edge_rows):
    lib = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=dummy, escape_whitespaces=True, remove_extra_whitespaces=strip)
    ours = pieces.Normalizer(model.ModelProto.FromString(lib.serialized_model_proto()).normalizer_spec)
    for text in [*ODD, "ＡＢＣ ﬁ ½ ①", "  Ｘ　　y  ", "ﾊﾟ é Å", *[r[1] or "" for r in edge_rows[:9]]]:
        norm, align = ours(text.encode())
        assert norm.decode() == lib.normalize(text)
        assert len(align) == len(norm) + 1 and (np.diff(align) >= 0).all() and align[-1] <= len(text.encode())


def test_encoded_documents(edge, empty, edge_rows):
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = pieces.encode_documents(edge, PIECES).collect()
    assert sorted(tuple(r.ids) for r in rows) == sorted(tuple(lib.encode(r[1] or "")) for r in edge_rows)
    assert pieces.digest_documents(empty, PIECES).collect() == []


@pytest.mark.parametrize("width", [1, 7, 15, 16, 17, 31, 32])
def test_packing_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 1001).astype("<u4")
    data = tokenbin.pack(ids, width)
    assert len(data) == (1001 * width + 7) // 8
    assert (tokenbin.unpack(data, width, 0, 1001) == ids).all()
    for lo, hi in ((13, 77), (1000, 1001), (5, 5)):
        assert (tokenbin.unpack(data, width, lo, hi) == ids[lo:hi]).all()


def test_packing_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        tokenbin.pack(np.array([8], "<u4"), 3)


def test_stretches_encode_as_whole_texts():
    lib, cache = Tokenizer.from_file(WORDS), tokenbin.StretchEncoder(WORDS, most=5)
    more = ["ΟΔΥΣΣΕΥΣ Σ", "<|ENDOFTEXT|> <|endoftext|>", "a\u0301 e\u0301", "İSTANBUL ǅ ẞ", "x\x7fy\xad\xa0z 1２३", "ça'll WE'LL 'LL", "\x0b\x0c"]
    for text in [*ODD, *more, *ODD]:
        assert np.frombuffer(cache.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


def test_token_files(edge, empty, edge_rows):
    lib = Tokenizer.from_file(WORDS)
    options = {"tokenizer_path": WORDS, "vocab_size": 49_408, "end_id": 1}
    at, want = 0, []
    for r in sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*lib.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((r[0], at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    for extra in ({}, {"block_ids": 50}):
        path = tokenbin.shared_dir(edge.sparkSession, "t")
        tokenbin.write_files(edge, path, **options, **extra)
        got = tokenbin.read_files(edge.sparkSession, path).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    assert tokenbin.round_trip(empty, **options).collect() == []


def test_files_are_read_by_document_and_by_range(edge, empty, edge_rows):
    lib, spark = Tokenizer.from_file(WORDS), edge.sparkSession
    own, line = {}, []
    for r in sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = [*lib.encode(r[1] or "", add_special_tokens=False).ids, 1]
        own.setdefault(r[0], []).append(ids)
        line += ids
    path = tokenbin.shared_dir(spark, "t")
    tokenbin.write_files(edge.repartition(3), path, tokenizer_path=WORDS, vocab_size=49_408, end_id=1, block_ids=50)
    known = [x for x in own if x is not None]
    for asked in ([known[0]], [known[-1], 10**15], known[1:4], [None], [None, known[2]], []):
        got = sorted((str(r.doc_id), r.ids) for r in tokenbin.read_documents(spark, path, asked).collect())
        assert got == sorted((str(x), ids) for x in asked for ids in own.get(x, []))
    n = len(line)
    for lo, hi in ((0, n), (0, 1), (n - 1, n + 50), (n // 3, n // 3 + 200), (7, 7), (n, n + 5), (49, 51)):
        rows = sorted(tokenbin.read_range(spark, path, lo, hi).collect())
        assert [x for r in rows for x in r.ids] == line[lo:hi]
        assert [r.at for r in rows] == [lo + sum(len(q.ids) for q in rows[:i]) for i in range(len(rows))]
    plan = tokenbin.read_documents(spark, path, known[:1])._jdf.queryExecution().toString()
    assert "LessThanOrEqual(low" in plan or "low#" in plan
    none = tokenbin.shared_dir(spark, "t")
    tokenbin.write_files(empty, none, tokenizer_path=WORDS, vocab_size=49_408, end_id=1)
    assert tokenbin.read_documents(spark, none, [1]).collect() == [] and tokenbin.read_range(spark, none, 0, 9).collect() == []


def test_edits_keep_the_count():
    counter, rng, letters = tokencount.Counter(BYTES, P.PATTERN, most=50), random.Random(3), "ab '  \n1,sltdvé日!m"
    whole = lambda s: len(counter.tokenizer.encode(s, add_special_tokens=False).ids)
    for _ in range(400):
        text = "".join(rng.choice(letters) for _ in range(rng.choice((0, 5, 40, 400))))
        doc = tokencount.CountedText(text, counter)
        assert doc.tokens == whole(text)
        for _ in range(5):
            at, n, new = rng.randint(0, len(text) + 3), rng.randint(0, 6), "".join(rng.choice(letters) for _ in range(rng.randint(0, 5)))
            doc.replace(at, n, new)
            at = min(at, len(text))
            text = text[:at] + new + text[at + n :]
            assert (doc.text(), doc.tokens, doc.chars) == (text, whole(text), len(text))


def test_edits_encode_little():
    counter = tokencount.Counter(BYTES, P.PATTERN)
    doc = tokencount.CountedText("some words " * 5000, counter)
    doc.replace(20_000, 3, "new ones")
    assert doc.encoded < 40


def test_counts_of_documents(edge, empty, edge_rows, spark):
    counter = tokencount.Counter(BYTES, P.PATTERN)
    whole = lambda s: len(counter.tokenizer.encode(s, add_special_tokens=False).ids)
    edits = tokencount.derived_edits(F.col("doc_id"), F.col("text"), F.col("source"))
    got = sorted(map(tuple, tokencount.count(edge, edits, BYTES, P.PATTERN).drop("n_encoded").collect()), key=str)
    want = []
    for r in edge_rows:
        text, key = r[1] or "", "" if r[0] is None else str(r[0])
        new, size = r[3] or "", len(text) + 1
        edited = text
        for k in range(3):
            at, n = zlib.crc32(f"{key}:{k}".encode()) % size, zlib.crc32(f"{key}-{k}".encode()) % 12
            edited = edited[:at] + new + edited[min(at, len(edited)) + n :]
        want.append((r[0], whole(text), whole(edited), len(edited)))
    assert got == sorted(want, key=str)
    assert tokencount.count(empty, edits, BYTES, P.PATTERN).collect() == []
    table = spark.createDataFrame([(7, 1, 0, 1, "b"), (7, 2, 0, 0, "a "), (8, 1, None, 0, "x")], "doc_id long, seq int, pos int, n_delete int, insert string")
    rows = {r.doc_id: r for r in tokencount.count_edits(edge, table, BYTES, P.PATTERN).collect()}
    assert rows[7].n_edited_tokens == whole("a bne") and rows[8].n_edited_tokens == rows[8].n_tokens
