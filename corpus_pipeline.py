"""A training corpus from the documents table: five stages, each written and reread as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm import decontaminate, hash_ring, minmax_dedup, mixing, toxicity_pu
from tallyforge.llm.common import fold
from tallyforge.session import scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained outside its held-out rows, does not reject."""
    held_out = fold("doc_id", 5) == 0
    confirmed, prior = toxicity_pu.confirmed_toxic(spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out)
    return toxicity_pu.score_toxicity(docs, confirmed, prior, held_out, keep=True)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minmax_dedup.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark."""
    return decontaminate.without_passages(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights; a document stands in the result as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its place there."""
    return hash_ring.sharded_documents(docs)


STAGES = [("toxicity", without_toxic), ("near_duplicates", without_copies), ("decontamination", without_benchmark), ("mixing", mix),
          ("sharding", shard)]

#: Learned scores, near duplicates and edit distances are beyond SQL; tests hold each stage against its operator, and those
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sharded corpus; every stage but the last is written to the shared scratch folder and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
