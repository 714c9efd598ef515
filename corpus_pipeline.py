"""A cleaning run over ``documents``: language, repeated passages, near duplicates, benchmark, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a frame that is written as Parquet and read
again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, decontam, langid, line_dedup, simhash
from tallyline.llm.common import read, saved, text_session

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters, and those in no language that can be told."""
    text_session(spark)
    return langid.keep_identified(docs)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes repeated passages out of the texts, but for their first occurrence."""
    text_session(spark)
    return line_dedup.dedup_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group within two bits of SimHash over three-word shingles."""
    text_session(spark)
    return simhash.keep_one(docs, size=3, most=2)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold ten words of a benchmark item in a row, or a whole shorter item."""
    text_session(spark)
    return decontam.remove_contaminated(docs, read(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and digests of them and of what they decode to."""
    text_session(spark)
    # Written in between, so that an executor runs one Python worker a task and not two side by side.
    ids = saved(bpe.encode(docs.select("doc_id", "lang", "source", "text"), RANKS).drop("text"), "ids")
    both = bpe.decode(ids, RANKS)
    return both.select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", identify_language),
    ("line_dedup", remove_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("byte_bpe", tokenize),
]

# Hashes, a learnt model and a tokenizer are beyond SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
