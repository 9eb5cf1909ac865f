"""Toxicity, exact dedup, SimHash near-dedup, mixing and packing, one after the other over documents."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from faturaflow.llm import exact_dedup, mixing, packing, simhash, toxicity
from faturaflow.llm.common import table
from faturaflow.sources.stage import shared_root


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints."""
    return simhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a document in which a budget ends gives its first words."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, placed in sequences."""
    return packing.op3_pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: Hash functions, connected components and a tokenizer are no SQL: tests/llm has the brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each is written to the shared folder and read again; a stage's
    table is dropped once the next one is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_root(spark)}/pipeline-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        if k:
            last = path(f"{folder}/{k - 1}")
            last.getFileSystem(spark._jsc.hadoopConfiguration()).delete(last, True)
    return docs
