"""Micro-batch sinks. A batch that is written again replaces its own earlier output.

Every table has its day partition and, below it, the number of the micro-batch
that wrote the rows. A retried batch overwrites exactly the partitions it wrote
before, so files stay correct when an executor or the driver is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import id_index
from riskspark.operators.decisions import as_stored
from riskspark.operators.dedup import first_per_key
from riskspark.operators.features import feature_views
from riskspark.plans.dead_letters import alert_envelopes, processing_envelopes
from riskspark.schemas import split_conformed

BATCH = "ingest_batch"


def write_batch(df: DataFrame, path: str, partition: str, day: Column, batch_id: int) -> None:
    (
        df.withColumns({partition: day, BATCH: F.lit(batch_id)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition, BATCH)
        .parquet(path)
    )


def write_record_table(
    df: DataFrame,
    schema: T.StructType,
    path: str,
    partition: str,
    time_column: str,
    batch_id: int,
    order: list[str],
    letters_path: str,
) -> None:
    """First row per transaction in the table's layout.

    A row that lacks a required value would fail every retry, so it becomes a
    dead letter of this batch instead of holding up the stream.
    """
    good, bad = split_conformed(first_per_key(df, ["transaction_id"], *order), schema)
    write_batch(good, path, partition, F.to_date(time_column), batch_id)
    errors = bad.select(
        "transaction_id",
        F.lit("SCHEMA_VALIDATION_ERROR").alias("error_type"),
        F.concat(F.lit("missing "), F.array_join("null_columns", ", ")).alias("error_message"),
        F.encode(F.to_json(F.struct(*schema.names)), "UTF-8").alias("original_payload_bytes"),
    )
    letters = processing_envelopes(errors, path, F.current_timestamp())
    write_batch(letters, letters_path, "failed_day", F.to_date("failed_at"), batch_id)


def stored_before(spark, path: str, batch_id: int) -> DataFrame | None:
    """What earlier micro-batches stored, without leftovers of this one."""
    try:
        stored = spark.read.parquet(path)
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise
    return stored.where(F.col(BATCH) < batch_id)


def store_alerts(alert_rows: DataFrame, path: str, batch_id: int, inserted_at: Column) -> None:
    """Insert-ignore by transaction: an alert already stored keeps its review.

    Known ids are kept beside the table in a layout for lookups (`id_index`), of which a batch reads the buckets of
    its own ids. A table that was written without it gets its ids first.
    """
    spark, ids = alert_rows.sparkSession, f"{path}_ids"
    fresh = first_per_key(alert_rows, ["transaction_id"], "evaluation_timestamp", "severity")
    known = id_index.read_indexed(spark, ids)
    if known is None:
        stored = stored_before(spark, path, batch_id)
        if stored is not None:
            id_index.write_indexed(stored.select("transaction_id").distinct(), "transaction_id", ids, -1)
            known = id_index.read_indexed(spark, ids)
    fresh = id_index.unknown(fresh, known, "transaction_id", batch_id)
    write_batch(as_stored(fresh, inserted_at), path, "alert_day", F.to_date("evaluation_timestamp"), batch_id)
    written = stored_batch(spark, path, batch_id)
    if written is not None:
        id_index.write_indexed(written.select("transaction_id"), "transaction_id", ids, batch_id)


def stored_batch(spark, path: str, batch_id: int) -> DataFrame | None:
    """What this micro-batch stored."""
    stored = stored_before(spark, path, batch_id + 1)
    return None if stored is None else stored.where(F.col(BATCH) == batch_id)


def publish_features(enriched: DataFrame, root: str, batch_id: int) -> None:
    """All three feature tables of a batch; an error in any of them fails the batch, which runs again."""
    for name, view in feature_views(enriched).items():
        write_batch(view, f"{root}/{name}", "feature_day", F.to_date("event_timestamp"), batch_id)


def keyed_json(df: DataFrame, key: str) -> DataFrame:
    """Key and JSON value of each row, the form a topic takes."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def to_topic(df: DataFrame, key: str, servers: str, topic: str) -> None:
    """Writes a batch to Kafka. Needs Spark's Kafka package on the class path."""
    writer = keyed_json(df, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("kafka.acks", "all").option("topic", topic).save()


def to_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Appends a batch to a database table. Needs the database's driver on the class path."""
    writer = df.write.format("jdbc").mode("append").option("url", url).option("dbtable", table)
    for name, value in options.items():
        writer = writer.option(name, value)
    writer.save()


REASONS = {"TimeoutError": "timeout", "ConnectionError": "catalog_unavailable", "OSError": "catalog_unavailable"}


def reason_of(error: BaseException) -> str:
    for kind in type(error).__mro__:
        if kind.__name__ in REASONS:
            return REASONS[kind.__name__]
    return "flush_error"


def logged(step: str, audit_path: str, write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """`write` with failures recorded in an audit table and raised again, so that the batch is retried."""

    def run(batch: DataFrame, batch_id: int) -> None:
        try:
            write(batch, batch_id)
        except Exception as error:
            spark = batch.sparkSession
            row = [(step, batch_id, reason_of(error), str(error))]
            entry = spark.createDataFrame(row, "step string, batch_id bigint, reason string, message string")
            entry.withColumn("failed_at", F.current_timestamp()).write.mode("append").parquet(audit_path)
            raise

    return run


def deliver_alerts(
    alert_rows: DataFrame, deliver: Callable[[DataFrame], None], dlq_path: str, batch_id: int
) -> bool:
    """Delivers a batch of alerts; if that fails they go to the alert dead letters instead."""
    try:
        deliver(alert_rows)
    except Exception as error:
        letters = alert_envelopes(alert_rows, F.lit(str(error)), F.current_timestamp())
        write_batch(letters, dlq_path, "failed_day", F.to_date("failed_at"), batch_id)
        return False
    return True
