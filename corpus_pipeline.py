"""The corpus pipeline: five stages from raw documents to encoded, mixed text.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
reads again as the next one's ``docs``.  All but the last return the columns
they were given; rows may be repeated, texts null or empty, tables empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import langid, mixing, pieces, simhash, suffix_dedup
from tessera.llm.common import documents, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a probability of a half or more;
    null texts and texts without a letter go."""
    return langid.confident(docs, min_score=0.5)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, the one with the least doc_id."""
    return simhash.one_of_each(docs, shingle=4, max_distance=4)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the bytes that strings of 200 bytes cover that
    also start elsewhere."""
    return suffix_dedup.remaining_documents(docs, length=200)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, the last of
    a source cut where its target is met."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and bounds_crc32) of each document."""
    return pieces.digest_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("simhash_dedup", drop_near_duplicates),
    ("suffix_array_dedup", drop_repeated_passages),
    ("source_mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: SQL can't state the trained model, the fingerprints or the tokenizer; the
#: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
