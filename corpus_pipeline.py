"""A corpus pipeline of the training-data operators. Each stage works on all that the one before it kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from kgsync.llm import packing, quality_rules, simhash, substring_dedup
from kgsync.llm.common import checkpoint_dir, remove_folder, table, work_folder


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.filter_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [("quality rules", keep_quality), ("SimHash near-dedup", drop_near_copies), ("substring dedup", cut_repeats), ("packing", pack_sequences)]

#: Gear hashing, fingerprints and token ids have no SQL form; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's output is a table in the shared folder; what a stage wrote for itself, and the output before, go when it is whole."""
    docs, folder = table(spark, sf_dir, "documents"), f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        with work_folder(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        if k:
            remove_folder(spark, f"{folder}/{k - 1}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
