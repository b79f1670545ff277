"""From raw documents to shards of training text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillsight.llm import decontaminate, mixing, quality_classifier, sharding, simhash
from tillsight.llm.queries import quality_model
from tillsight.llm.tables import read
from tillsight.session import scratch_path

# SQL can't state a trained model's verdicts.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality_classifier.keep_good(docs, quality_model(spark, docs, sf_dir))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item was found."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once; small sources begin again until the rows have the target weights."""
    return mixing.mixed_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their shard and their place in it."""
    return sharding.shards(docs, 8)


STAGES = [("quality", quality), ("near_copies", near_copies), ("benchmark", benchmark), ("mix", mix), ("shard", shard)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
