"""A training-data pipeline: quality rules, SimHash near-dedup, secret scans, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again
as the next stage's docs. All but the last return the columns of documents.

Defined results of every stage: an empty table gives no rows; texts of any length are worked on whole; extra columns,
also of clashing names, stay as they are up to the mix and are not read by the encoding. Null, empty and blank texts
fail the quality rules, so no later stage meets them; each would take them nonetheless (as no words, or the empty
text). Null and repeated ids are ids like any other: rows are told apart by all their columns, and of equal rows one
stays after near-dedup. Ties (equal texts of several ids) keep the least id, nulls last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.llm import bpe, copies, mixing, quality, secrets
from tabulark.llm._shared import documents, materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the fertility bands reject go."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document stays of each group that SimHash over five-word shingles links, and none of what is alike to
    another that stays in 0.8 of its five-word shingles or more (op9's contract has other bounds)."""
    return copies.drop(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts, in whatever layer of encoding, are replaced by marks."""
    return secrets.redact(docs).withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each row a document as often, and with as many of its words, as its source's target takes."""
    return mixing.mix_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text of the mix."""
    return bpe.encode(docs, bpe.vocabulary_path())


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Fingerprints, decoding layers and byte-pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.split()[0])
    return STAGES[-1][1](spark, docs, sf_dir)
