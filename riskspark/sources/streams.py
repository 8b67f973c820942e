"""Streaming and bounded reads of the topics.

Each topic is read from Kafka, or from a folder of files with the same layout
for replays and tests. The Kafka readers need Spark's Kafka package on the
class path and are thin option builders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.decisions import per_key_cap


def kafka_stream(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Records of a topic; committed offsets come from the query's own checkpoint."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .option("kafka.isolation.level", "read_committed")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load()


def kafka_batch(spark: SparkSession, servers: str, topics: list[str], cap_per_topic: int | None = None) -> DataFrame:
    """All records the topics hold now, without committing offsets; optionally the first few of each."""
    records = (
        spark.read.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("endingOffsets", "latest")
        .load()
    )
    if cap_per_topic is None:
        return records
    return per_key_cap(records, ["topic"], cap_per_topic, F.col("timestamp"), F.col("partition"), F.col("offset"))


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """The same rows from a folder, new files being new records."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.format(file_format).load(path)


def json_values(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Rows of a topic that carries JSON."""
    return records.select(F.from_json(F.col(value).cast("string"), schema).alias("r")).select("r.*")
