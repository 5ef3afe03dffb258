"""The corpus pipeline: five stages over documents, each on all that the one before has kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each as a table in the shared folder
and reads it again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import decontaminate, exact_dedup, language_id, minmax_dedup, sentencepiece_viterbi
from sparkloom.llm.common import table, written

#: Least similarity of near copies, in percent. The pipeline's own: op1 has another.
NEAR = 80


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go."""
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the least doc_id stays."""
    return minmax_dedup.keep_one(docs, NEAR)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go from the texts, and documents that are mostly such passages go."""
    return decontaminate.clean(spark, docs, table(spark, sf_dir, "benchmark"))


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, n_bytes, ids_sha256 and round_trip of each document."""
    return sentencepiece_viterbi.encode(spark, docs).drop("ids")


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", decontaminate_documents),
    ("SentencePiece encoding and decoding", encode_documents),
]

#: No SQL: the last stage's segmentation can't be expressed in it. Tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage-" + "".join(c if c.isalnum() else "-" for c in name))
    return docs
