"""Registered queries of the operators, with SQL where SQL can say it."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from . import (ann, automaton_dedup, bpe, conversations, embed_dedup, langid, merkle, mixing, oracles, pieces, secrets, simhash,
               suffix_dedup, warc)
from ..sources.sinks import stage
from .common import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RANK_FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECE_FILE = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op1_learned_partitions")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


@query("op2_suffix_array")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query("op3_warc_zstd", sql="""
    WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
    d AS (SELECT page_id, octet_length(payload) AS n, sha1(payload) AS digest,
                 max(page_id) OVER (PARTITION BY payload) AS owner FROM p)
    SELECT page_id, n AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= 1000 AND page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 1000 AND page_id < owner THEN owner END AS refers_to
    FROM d""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written to the shared folder and read from there."""
    archives = stage(spark, warc.write_archives(warc.mark_revisits(read(spark, sf_dir, "pages"))), "warc")
    return (warc.read_archives(archives)
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


@query("op4_language_id")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return (langid.identify(docs, langid.fit(docs))
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score"))


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(read(spark, sf_dir, "documents"), bpe.load_ranks(RANK_FILE), public_tokenizers.PATTERN,
                            ids=False)


@query("op6_projection_passes")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_copies(read(spark, sf_dir, "embeddings"))


@query("op7_suffix_automata")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return automaton_dedup.remove_repeats(read(spark, sf_dir, "documents"))


@query("op8_mix_sources")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


@query("op9_simhash_golay")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op10_secret_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, sf_dir, "documents")).drop("redacted")


@query("op11_distinct_chunks")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(read(spark, sf_dir, "documents"), pieces.load_vocabulary(PIECE_FILE), ids=False)


def merkle_rows(docs: DataFrame, height: int = merkle.HEIGHT) -> DataFrame:
    """Proofs of all documents, those of every seventh document (by checksum of its id) folded from a leaf with one character more."""
    bad = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    more = F.when(bad, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return (merkle.manifest(docs, changed={"n_chars": more}, height=height, siblings=False)
            .select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))


@query("op12_octopus_multiproof", sql=oracles.MERKLE)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle_rows(read(spark, sf_dir, "documents"))


@query("op13_deepening_repair", sql=oracles.REPAIR)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return conversations.with_empty(conversations.report(conversations.repair(conversations.damage(rows))), rows)
