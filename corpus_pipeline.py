"""A training corpus from raw documents in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the
`docs` of the next one. All but the last return the columns of `docs`.
"""
from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerline.llm import bpe, langid, mixing, secrets, simhash
from ledgerline.llm.common import column, free
from ledgerline.session import staged_root

LEAST_SCORE = 0.5
TOKEN_SHARE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised. Texts without a letter, or with no clearly likeliest language, go."""
    names = tuple(free(docs.columns, "lang_pred", "score"))
    named = langid.identify(docs, langid.fit(docs), keep=tuple(docs.columns), names=names)
    sure = (F.col(names[0]) != langid.UNKNOWN) & (F.col(names[1]) >= LEAST_SCORE)
    return named.where(sure).select(*[column(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of fingerprints: four-word shingles, links at four bits or fewer."""
    return simhash.keep_one(docs, shingle=4, most=4)


def remove_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced in their texts."""
    return secrets.redact_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with half of the tokens, whose sources, languages and topics have tempered shares."""
    return mixing.sample_documents(docs, TOKEN_SHARE)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text and their number, with the digests of the ids and of what they decode to."""
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN)


STAGES = [("language_id", identify_language), ("simhash_dedup", drop_near_copies), ("secret_scan", remove_secrets),
          ("mix_sources", mix), ("byte_bpe", encode)]

# SQL can't express a fitted model, the fingerprints or the merges; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; what a stage returns is written to the shared folder for the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = f"{staged_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        made.write.parquet(f"{root}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
