"""The registered queries of the training-data operators: each applies its
operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardflow.llm import chat_format, importance, mixing, va_clusters, warc
from rewardflow.llm.chat_format import chat_digest
from rewardflow.llm.common import table
from rewardflow.llm.decontaminate import contamination
from rewardflow.llm.importance import resample
from rewardflow.llm.lm_scoring import score_texts
from rewardflow.llm.mixing import plan_mix
from rewardflow.llm.pii import find_personal_data, spans_digest
from rewardflow.llm.quality_mil import score_quality
from rewardflow.llm.quality_rules import apply_rules
from rewardflow.llm.simhash_trie import simhash_components
from rewardflow.llm.suffix_dedup import dedup_digest
from rewardflow.llm.toxicity import score_toxicity
from rewardflow.llm.va_clusters import cluster_vectors
from rewardflow.llm.warc import archive_pages


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = plan_mix(table(spark, sf_dir, "documents"))
    return plan.orderBy(F.array_min("positions").asc_nulls_last(), "doc_id").drop("positions")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digest(table(spark, sf_dir, "documents"))


def op5_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark, table(spark, sf_dir, "pages"))[1]


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(said).alias("text"))
    return chat_digest(rows.unionByName(probe))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, budget=2)


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_digest(find_personal_data(table(spark, sf_dir, "documents")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings")).drop("in_full")


QUERIES = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_mix_sources": op2_mix_sources,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_warc_bundles": op5_warc_bundles,
    "op6_quality_rules": op6_quality_rules,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_chat_format": op8_chat_format,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_personal_data": op11_personal_data,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_centroid_clustering": op13_centroid_clustering,
}

ORACLE_SQL: dict[str, str] = {
    "op2_mix_sources": mixing.ORACLE,
    "op5_warc_bundles": warc.ORACLE,
    "op8_chat_format": chat_format.ORACLE,
    "op12_importance_resampling": importance.ORACLE,
    "op13_centroid_clustering": va_clusters.ORACLE,
}
