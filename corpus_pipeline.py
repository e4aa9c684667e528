"""From raw documents to tokens: language, repeated lines, near copies, benchmark leaks, BPE.

Each stage takes (spark, docs, sf_dir) and returns what its predecessor's rows become.
``run`` writes every result as Parquet into the shared folder and reads it back, so a
stage that is repeated after a loss never repeats the ones before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinloom.llm import bpe, decontaminate, langid, lines, minhash
from kinloom.llm.common import table, written


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a likely language go."""
    return langid.accepted(docs, langid.fit(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five documents or more stay in the largest doc_id only; text and n_chars change."""
    return lines.dedup_lines(docs)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles (Jaccard 0.8) the smallest doc_id stays."""
    gone = minhash.near_duplicates(docs, width=5, percent=80).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents holding a ten-word window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256): the ids of each whole text, and what they decode to."""
    rows = bpe.tokens(docs)
    decoded = F.sha2(F.col("decoded").cast("binary"), 256)
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", decoded.alias("decoded_sha256"))


STAGES = [
    ("language", known_language),
    ("line_dedup", without_repeated_lines),
    ("near_duplicates", one_of_near_copies),
    ("decontaminate", without_benchmark),
    ("bpe", encoded),
]

# Language identification and BPE cannot be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
