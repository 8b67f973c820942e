"""Stand-alone streams: dedup, live alert feed, label join, windowed monitors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from riskspark.operators.dedup import first_per_key
from riskspark.streaming.sinks import write_batch

BUFFER = 500  # fixed value: alerts the feed remembers


def dedup_stream(events: DataFrame, ttl: str = "48 hours") -> DataFrame:
    """First row per transaction, for a stream that needs nothing but that."""
    return events.withWatermark("event_time", ttl).dropDuplicatesWithinWatermark(["transaction_id"])


def feed_step(previous: DataFrame | None, batch: DataFrame, size: int = BUFFER) -> DataFrame:
    """The newest `size` distinct alerts of the feed so far and a new batch."""
    rows = batch if previous is None else previous.select(*batch.columns).unionByName(batch)
    distinct = first_per_key(rows, ["transaction_id"], "evaluation_timestamp", "account_id")
    return distinct.orderBy(F.col("evaluation_timestamp").desc(), F.col("transaction_id").desc()).limit(size)


def start_feed(alert_rows: DataFrame, root: str, size: int = BUFFER, trigger: dict | None = None) -> StreamingQuery:
    """Keeps the live feed as one small table version per micro-batch under `root`/feed.

    A version is written from the one before it, never from itself.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = f"{root}/feed"
        previous = None
        if batch_id > 0:
            versions = spark.read.schema(feed_schema(batch.schema)).parquet(path)  # a batch without alerts leaves no file
            latest = versions.where(F.col("ingest_batch") < batch_id).agg(F.max("ingest_batch")).scalar()
            previous = versions.where(F.col("ingest_batch") == latest)
        write_batch(feed_step(previous, batch, size), path, "feed_day", F.lit("1970-01-01").cast("date"), batch_id)

    writer = alert_rows.writeStream.option("checkpointLocation", f"{root}/feed_checkpoint").foreachBatch(step)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()


def feed_schema(alerts: T.StructType) -> T.StructType:
    return T.StructType([*alerts.fields, T.StructField("ingest_batch", T.LongType()), T.StructField("feed_day", T.DateType())])


def read_feed(spark, root: str, alerts: T.StructType | None = None) -> DataFrame:
    """The newest version of the feed; with the schema of the alerts it can be read before the first alert too."""
    reader = spark.read if alerts is None else spark.read.schema(feed_schema(alerts))
    versions = reader.parquet(f"{root}/feed")
    latest = versions.agg(F.max("ingest_batch")).scalar()
    return versions.where(F.col("ingest_batch") == latest).drop("ingest_batch", "feed_day")


def join_labels_stream(decisions: DataFrame, labels: DataFrame, low_hours: int = 24, high_hours: int = 72) -> DataFrame:
    """Decisions with the labels that arrive within the window; without one after it they count as legitimate.

    Both sides are streams with `decision_time_ms` and `label_timestamp_ms` as event times.
    """
    left = decisions.withWatermark("decision_time_ms", "10 minutes")
    right = labels.withWatermark("label_timestamp_ms", "10 minutes").withColumnRenamed("transaction_id", "label_id")
    decided, labelled = F.col("decision_time_ms"), F.col("label_timestamp_ms")
    window = (labelled >= decided + F.expr(f"INTERVAL {low_hours} HOURS")) & (
        labelled <= decided + F.expr(f"INTERVAL {high_hours} HOURS")
    )
    joined = left.join(right, (F.col("transaction_id") == F.col("label_id")) & window, "leftOuter")
    return joined.withColumn("is_fraud", F.coalesce(F.col("label") == "fraud", F.lit(False))).drop("label_id")


def windowed_counts(rows: DataFrame, time_column: str, width: str, *keys: str, delay: str = "10 seconds") -> DataFrame:
    """Rows per window and key, final once the watermark has passed the window."""
    marked = rows.withWatermark(time_column, delay)
    grouped = marked.groupBy(F.window(time_column, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    return grouped.select(F.col("w.start").alias("window_start"), *keys, "n")


