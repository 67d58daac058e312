"""From raw documents to token records in training order.

Five stages, each one call of a training-data operator.  Every stage gets the
Parquet table that the one before it wrote and works on all of its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from custvalue.llm.common import bounded_batches, table, written
from custvalue.llm.decontaminate import decontaminate
from custvalue.llm.mixing import mix
from custvalue.llm.quality import accept_quality
from custvalue.llm.shards import materialise
from custvalue.llm.simhash import simhash_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    bounded_batches(spark)
    return accept_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of SimHash near duplicates."""
    bounded_batches(spark)
    return simhash_dedup(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a word window of a benchmark item."""
    bounded_batches(spark)
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, rare sources up to twice, by temperature weights, in mixture order:
    every file holds one stretch of it, sorted, so the next stage packs what the mixture puts together."""
    bounded_batches(spark)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = mix(docs).repartitionByRange(n, "mix_position", "doc_id").sortWithinPartitions("mix_position", "doc_id")
    return order.select(*[f"`{c}`" for c in docs.columns])


def token_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in keyed training order: the files are written; their records as read back."""
    bounded_batches(spark)
    return materialise(docs, bytes_out=True)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_records", token_records),
]

# SimHash, a fitted classifier and byte-pair tokens cannot be written in SQL;
# tests/llm compares every stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
