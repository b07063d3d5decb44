"""Queries over the driver's tables, one for each operator of this subpackage, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fingerprints, lm, mixing, negatives, quality, runs, secrets, sharding, simhash, toxicity, warc
from ._shared import documents


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(documents(spark, sf_dir))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(documents(spark, sf_dir))


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digest(chat.format_chat(turns.unionByName(probe)))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_neighbours(documents(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(documents(spark, sf_dir), 8)


def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(documents(spark, sf_dir))
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, secrets.KINDS), F.sha2(joined("base_spans"), 256).alias("base_sha256"), joined("spans").alias("spans"), "n_windowed")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(documents(spark, sf_dir), bpe.vocabulary_path())


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("id") % 100 == 0, label=negatives.shifted())


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.find(runs.planted(documents(spark, sf_dir))))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    single = (op1_toxicity, op2_lm_scoring, op3_quality_rules, op4_chat_formatting, op5_mixing, op6_fingerprints, op7_sharding, op8_secret_scans, op9_simhash, op10_byte_bpe, op11_warc, op12_hard_negatives, op13_periodic_runs)
    return {f.__name__: f for f in single} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {"op4_chat_formatting": chat.oracle(), "op5_mixing": mixing.oracle(), "op11_warc": warc.oracle(), "op12_hard_negatives": negatives.oracle()}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
