"""The full enriched record from a deduplicated event stream or table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.coerce import non_negative_gap
from riskspark.operators.chunks import hot_key_lists
from riskspark.operators.device import device_features, device_key
from riskspark.operators.geo import geo_enrich
from riskspark.operators.velocity import velocity_features
from riskspark.schemas import ENRICHED_EVENT

PROCESSOR_VERSION = "002-stream-processor@1.0.0"  # fixed value
MAX_INT = 2**31 - 1
RULE_INPUTS = ["txn_time_ms", "txn_amount", "device_is_new", "device_count_24h"]


def assemble(features: DataFrame, enriched_at_ms: Column, version: str = PROCESSOR_VERSION) -> DataFrame:
    """The 37 record columns followed by the four that rules read.

    Input: event columns with `event_ms` and `processing_ms` next to the
    timestamps, velocity, geo and device columns. `enriched_at_ms` is evaluated
    once per row.
    """
    timed = features.select("*", enriched_at_ms.alias("_enriched_ms"))
    latency = non_negative_gap(F.col("_enriched_ms"), F.col("processing_ms"))
    timed = timed.withColumns(
        {
            "enrichment_time": F.timestamp_millis("_enriched_ms"),
            "enrichment_latency_ms": F.least(latency, F.lit(MAX_INT)).cast("int"),
            "processor_version": F.lit(version),
            "schema_version": F.lit("1"),
            "txn_time_ms": F.col("event_ms"),
            "txn_amount": F.col("amount"),
        }
    )
    record = []
    for field in ENRICHED_EVENT:
        column = F.col(field.name)
        if field.name == "device_first_seen":
            column = F.timestamp_millis(column)
        record.append(column.alias(field.name))
    return timed.select(*record, *RULE_INPUTS)


def enrich(events: DataFrame, ranges: DataFrame, enriched_at_ms: Column, known_fraud: DataFrame | None = None) -> DataFrame:
    """Velocity, geo and device features and the assembled record, for deduplicated events."""
    timed = events.withColumns(
        {
            "event_ms": F.unix_millis("event_time"),
            "processing_ms": F.unix_millis("processing_time"),
        }
    )
    return assemble(add_features(timed, ranges, known_fraud), enriched_at_ms)


def add_features(events: DataFrame, ranges: DataFrame, known_fraud: DataFrame | None = None) -> DataFrame:
    """Geo by subnet, velocity per account, history per device.

    Hot accounts and devices are found in one pass over the two columns. With
    the distinct subnets and the rows themselves the events are read three times.
    """
    hot = hot_key_lists(events, {"account": F.col("account_id"), "device": device_key()})
    located = geo_enrich(events, ranges)
    moving = velocity_features(located, history=events, hot=hot["account"])
    return device_features(moving, history=located, hot=hot["device"], known_fraud=known_fraud)


def as_record(assembled: DataFrame) -> DataFrame:
    """The record with all times as timestamps, ready for `conform` and the sinks."""
    return assembled.withColumn("prev_txn_time_ms", F.timestamp_millis("prev_txn_time_ms"))
