"""A corpus pipeline of five stages over the table of documents.

Each stage gets all that the one before kept, as Parquet, and what it decides takes effect: toxic
documents go, one document of each near-duplicate group stays, documents with benchmark windows go,
sources are mixed to their target weights (a document may then stand there up to three times), and
the rest is packed into shards. All but the last return the columns of documents; the last adds size,
text_crc32, shard and slot.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from brindle.functions.paths import drop
from brindle.llm import decontaminate, mixing, sharding, simhash, toxicity
from brindle.llm.common import scratch_root, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.dedup(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard(docs)


STAGES = [("toxicity", toxic), ("simhash", near_copies), ("decontamination", benchmark), ("mixing", mixture), ("sharding", shards)]

ORACLE_SQL = None  # SimHash, learned scores and hash thresholds aren't SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), None
    folder = f"{scratch_root(spark)}/brindle/pipeline-{uuid.uuid4().hex}"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if last:  # what a stage has read isn't needed any more
            drop(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
