"""The cleaning pipeline over ``documents``: each stage works on all that the one before it kept.

All stages take any table with doc_id, text and source. A null text counts as
the empty one and stays null where it is handed on; a null or repeated doc_id
is one of its row alone; repeated rows are judged alike; texts are taken whole;
an empty table gives an empty one; further columns, of any name, are handed on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.llm import decontamination, encoding, quality, secrets, simhash
from affinity.sources.scratch import materialize

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _recounted(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, lines above the limit taken out, n_chars as of the new text."""
    return _recounted(quality.cleaned(docs), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id, unchanged.

    Of rows that agree in id and text, but not in other columns, any one stays.
    """
    return simhash.one_of_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, unchanged."""
    return decontamination.cleaned(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, found secrets masked, n_chars as of the new text."""
    return _recounted(secrets.redacted(docs), docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, their number, and the digest of their decoding."""
    made = encoding.encode_decode(docs, WORD_BPE)
    return made.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]

# Fingerprints and token ids can't be had in SQL; tests/llm holds the run against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
