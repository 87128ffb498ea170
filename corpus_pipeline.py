"""A corpus pipeline of five operators over the table ``documents``.

``STAGES`` lists them in order. Each takes what its predecessor kept, written as
Parquet and read again, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, mixing, queries, sharding, simhash, toxicity
from tidewater.llm.shared import free_name, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more as toxic go; null and empty texts stay. Without labels
    nothing is known to be toxic."""
    model, into = queries.toxicity_model(spark, sf_dir, docs), free_name(docs, "toxicity")
    return toxicity.score_texts(docs, model, into=into).where(F.col(f"{into}.score") < 0.5).drop(into)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by SimHash the document with the smallest id stays; null and
    empty texts are one group."""
    return simhash.one_per_group(docs, words=4, distance=4)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts stay."""
    into = free_name(docs, "contamination")
    found = decontaminate.find_contamination(docs, queries.table(spark, sf_dir, "benchmark"), into=into)
    return found.where(F.size(f"{into}.item_ids") == 0).drop(into)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says; null and empty texts by the prior's rate."""
    labelled = docs.select("doc_id", F.col("lang").alias("domain")).join(queries.table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    into, copy = free_name(docs, "mixture"), free_name(docs, "copy")
    found = mixing.mix(docs, labelled, temper=0.7, into=into)
    return found.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(f"{into}.copies").cast("int")))).drop(copy, into)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each row."""
    return sharding.assign_shards(docs, queries.SHARD_BYTES)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("mixing", mix_domains),
    ("sharding", shard),
]

#: Classifiers and fingerprints are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each one's rows written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
