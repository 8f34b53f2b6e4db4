"""A corpus from raw documents: toxic texts, texts of no known language, exact and near copies go; what stays is packed into batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratevane.llm import exact_dedup, langid, packing, simhash, toxicity
from ratevane.llm.frames import documents, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from `labels` and drops what is predicted to be toxic."""
    return toxicity.keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_unidentified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from `lang` and drops texts without a letter or unlike every language learned."""
    return langid.keep_identified(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal after lower-casing A-Z, the largest id stays."""
    return exact_dedup.keep_unique(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that SimHash links connect, the smallest id stays."""
    return simhash.keep_first(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets of least padding, and batches in them."""
    return packing.pack(docs)


STAGES = [("toxicity", drop_toxic), ("language_id", drop_unidentified), ("exact_dedup", drop_exact_copies), ("simhash_near_dedup", drop_near_copies), ("packing", pack)]

#: Learned models, fingerprint components and a dynamic programme have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's rows written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
