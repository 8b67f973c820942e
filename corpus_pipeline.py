"""Raw documents to packed token sequences, in five stages. Each stage works on all its predecessor kept.

All stages but the last return the columns of `documents`. Rejected, duplicate and contaminated documents go; repeated line
chunks leave the text. Stages handle nulls, repeated rows, empty tables and extra columns as their operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import decontaminate, line_dedup, near_copies, packing, quality_rules
from riskspark.session import stored


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.keep_good(docs, rules)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.without_repeated_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.one_per_group(docs, width=5, share=0.8)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, capacity=1024, end_id=2)


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("best_fit_packing", pack_sequences),
]

#: No SQL: the learned list, 64-bit line hashes, linked near copies and tokens are beyond it. Tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
