"""Training-corpus pipeline: each stage applies one operator of rewardflow.llm.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes
each result as Parquet below the session's shared checkpoint folder and reads
it back as the next stage's documents. Every stage but the last returns the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rewardflow.llm.common import Scratch, table
from rewardflow.llm.decontaminate import decontaminate
from rewardflow.llm.mixing import plan_mix, training_order
from rewardflow.llm.quality_mil import score_quality
from rewardflow.llm.simhash_trie import one_per_component
from rewardflow.llm.suffix_dedup import dedup_texts


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (predicted label 1)."""
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    scored = score_quality(packed, table(spark, sf_dir, "labels"), keep=("row",))
    return scored.where("predicted = 1").select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within 2 bits."""
    return one_per_component(docs, shingle=3, budget=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that occur earlier are cut; every document stays."""
    return dedup_texts(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut; a document that is mostly benchmark text goes."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: a row per document copy that the mix takes, with its
    ``position``, range-sorted by it. Columns of documents that have the name of a
    column of the plan are kept as ``document_<name>`` (``document_`` as often as it
    takes to be free)."""
    made = ("size", "source_size", "target", "taken", "positions", "position")
    taken = {c.lower() for c in docs.columns}
    for c in docs.columns:
        if c.lower() in made:
            free = f"document_{c}"
            while free.lower() in taken:
                free = f"document_{free}"
            taken.add(free.lower())
            docs = docs.withColumnRenamed(c, free)
    return training_order(plan_mix(docs, keep=tuple(docs.columns)))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("benchmark_passages", benchmark_passages),
          ("mixture", mixture)]

# trained models and fingerprints have no SQL form
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written and read back."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
        scratch.settle()
    return docs
