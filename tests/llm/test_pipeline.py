"""The corpus pipeline against brute-force versions of its stages."""

import hashlib

import corpus_pipeline
import public_tokenizers as P
import sentencepiece
from tessera.llm import langid, mixing
from tessera.llm.common import written
from test_dedup import brute_components, brute_fingerprint, brute_removal

SF001 = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark):
    docs = corpus_pipeline.documents(spark, SF001)
    stages = dict(corpus_pipeline.STAGES)
    told = written(stages["language_id"](spark, docs, SF001), "a")
    assert told.columns == docs.columns
    lost = docs.join(told, "doc_id", "left_anti").collect()
    assert all(r.text is None or not langid.has_letter(r.text) or len(r.text) < 100 for r in lost)

    rows = told.collect()
    single = written(stages["simhash_dedup"](spark, told, SF001), "b")
    roots = brute_components([brute_fingerprint(r.text) for r in rows])
    least = {root: min(r.doc_id for r, c in zip(rows, roots) if c == root) for root in set(roots)}
    assert sorted(r.doc_id for r in single.collect()) == sorted(least.values())

    rows = single.collect()
    rest = written(stages["suffix_array_dedup"](spark, single, SF001), "c")
    want = {r.doc_id: b[3] for r, b in zip(rows, brute_removal([r.text for r in rows], 200))}
    whole = [r for r in rest.collect() if "�" not in r.text]
    assert rest.columns == docs.columns and rest.count() == len(rows) and len(whole) > 0.9 * len(rows)
    assert all(hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id] for r in whole)

    mixed = written(stages["source_mixing"](spark, rest, SF001), "d")
    taken = {r.doc_id: r.taken for r in mixing.mix(rest).collect()}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.encode().split())
    assert words == {k: v for k, v in taken.items() if v} and mixed.columns == docs.columns

    lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    got = sorted((r.doc_id, r.n_tokens) for r in stages["sentencepiece"](spark, mixed, SF001).collect())
    assert got == sorted((r.doc_id, len(lib.encode(r.text))) for r in mixed.collect())


def test_edge_rows_and_empty_tables_pass_through(spark, edge, empty):
    for docs in (edge, empty):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, ""), name)
            assert name == "sentencepiece" or docs.columns == columns
    assert docs.count() == 0
