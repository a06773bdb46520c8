"""The registered queries of the ten operators, and their DuckDB oracles
where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, convrepair, itq, langid, licenses, mixing, pieces, quality, rpforest, simhash, suffix_dedup, tokenbin, tokencount
from .common import documents

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document; 4-word shingles, 4 bits."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=4, max_distance=4)


@query
def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_bytes, n_removed, n_spans and kept_sha256 of every document; 200 bytes."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    return suffix_dedup.with_kept(docs, length=200).select(
        F.col("row.doc_id").cast("long").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """n_tokens and digests of ids and decoded text of every document."""
    return pieces.digest_documents(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """start, n_tokens and ids_crc32 of every document, from the written files."""
    return tokenbin.round_trip(documents(spark, sf_dir), tokenizer_path=public_tokenizers.path("word_bpe_49k.json"),
                               vocab_size=49_408, end_id=1)


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """size, source_size, target and taken of every document; weights 5, 2, 1, 150% of all, at most twice."""
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op10_source_mixing"] = mixing.oracle()


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and verdict of every document against references from all of them."""
    return quality.rate(documents(spark, sf_dir))


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """held_out, lang_pred and score of every document."""
    return langid.identify(documents(spark, sf_dir))


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical length, digest and licence of every document."""
    return licenses.scan(documents(spark, sf_dir))


ORACLES["op5_license_scan"] = licenses.oracle()


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits that insert its source's name."""
    docs = documents(spark, sf_dir)
    edits = tokencount.derived_edits(F.col("doc_id"), F.col("text"), F.concat(F.lit(" the "), F.coalesce("source", F.lit("")), F.lit("'s ")))
    return tokencount.count(docs, edits, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


@query
def op1_rp_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest found of every embedding whose vec_id is divisible by 50."""
    return rpforest.neighbours(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired turns of every conversation, after planted damage."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return convrepair.repair_digests(rows, convrepair.damaged(rows))


@query
def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2,000 phrases of 2 to 5 words that occur 100 times or more."""
    return collocations.collocations(documents(spark, sf_dir), min_count=100, longest=5, top=2000)


ORACLES["op12_phrase_collocations"] = collocations.oracle()


@query
def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and kept of every embedding, at a cosine of 0.98 within its label."""
    return itq.near_duplicates(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"), min_cosine=0.98)


ORACLES["op11_embedding_near_dedup"] = itq.oracle(0.98)
