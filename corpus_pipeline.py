"""The corpus pipeline: documents in, sharded documents out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of their
input. The caller writes each result as Parquet and reads it again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starledger.llm.common import Scratch
from starledger.llm.decontaminate import without_benchmark
from starledger.llm.mixing import sample_mixture
from starledger.llm.neardup import keep_one_of_each
from starledger.llm.quality import keep_good
from starledger.llm.sharding import interleave


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the robust distances reject go."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    return keep_one_of_each(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window that repeats a benchmark item go."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample by calibrated probabilities holds the raked source, language and topic margins."""
    return sample_mixture(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document gets a shard and a slot; every shard matches the mixture of sources."""
    return interleave(docs).drop("copy")


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Robust estimates and minwise trees have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each result written to the shared folder and read again."""
    scratch = Scratch(spark, "pipeline")
    docs, sf_dir = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), sf_dir.rstrip("/")
    for i, (_, stage) in enumerate(STAGES):
        last, docs = docs, scratch.stage(stage(spark, docs, sf_dir))
        if i:
            scratch.release(last)
    return docs
