"""The corpus pipeline: quality, near-duplicates, decontamination, mixing, shards.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept. All but the last return the columns of ``documents``; the last adds the
slot and shard of each row.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskweave.llm import decontaminate, mixture, quality_knn, sharding, simhash_blocks
from riskweave.session import shared_folder, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that the classifier rejects go."""
    return quality_knn.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: one document of each near-duplicate class stays; five-word shingles, Jaccard similarity 0.8."""
    return simhash_blocks.deduplicate(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents with benchmark passages go."""
    return decontaminate.remove(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: every document as often as the mix takes it."""
    return mixture.apply_mix(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the shard of every document."""
    return sharding.shard(docs)


STAGES = [
    ("quality_classifier", good_quality),
    ("near_dedup", one_of_each),
    ("decontamination", not_in_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Nearest-neighbour votes and near-duplicates are beyond SQL; tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again as the next one's input."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
