"""Lake tables and reference tables as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.schemas import DECISION, ENRICHED_TABLE, nullable

PARTITIONS = {"event_time": "event_day", "decision_time_ms": "decision_day"}


def _relaxed(schema: T.StructType, partition: str) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in schema]
    return T.StructType([*fields, T.StructField(partition, T.DateType(), True)])


def read_table(spark: SparkSession, path: str, schema: T.StructType, partition: str, start=None, end=None) -> DataFrame:
    """A day-partitioned table; `start` and `end` prune partitions. The schema is given, not inferred."""
    df = spark.read.schema(_relaxed(schema, partition)).parquet(path)
    if start is not None:
        df = df.where(F.col(partition) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(partition) <= F.lit(end).cast("date"))
    return df


def read_enriched(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    return read_table(spark, path, ENRICHED_TABLE, "event_day", start, end)


def read_decisions(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    return read_table(spark, path, DECISION, "decision_day", start, end)


GEO_RANGES = nullable(
    "network string, prefix_len int, country string, city string, network_class string, confidence float"
)


def read_geo(spark: SparkSession, path: str | None) -> DataFrame:
    """The geo reference table; without a path every lookup misses and geo columns are null."""
    if path is None:
        return spark.createDataFrame([], GEO_RANGES)
    return spark.read.schema(GEO_RANGES).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """An offline feature table; rows without key or event time cannot be joined and are left out."""
    df = spark.read.parquet(path)
    return df.where(F.col("account_id").isNotNull() & F.col("event_timestamp").isNotNull())
