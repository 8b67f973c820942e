"""Corrected records of transactions that a late row should have counted for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.clock import DAY_MS, MINUTE_MS
from riskspark.operators.decisions import latest_enriched
from riskspark.operators.velocity import VELOCITY_COLUMNS, velocity_features

REACH_MS = DAY_MS + MINUTE_MS  # a row can count for others this much later
LATE_COLUMNS = ["transaction_id", "account_id", "event_time", "amount"]


def corrected(stored: DataFrame, late: DataFrame, corrected_at_ms) -> DataFrame:
    """Rows of `stored` whose velocity changes by the `late` rows, with the new values.

    They are meant to be appended: readers take the latest version of a
    transaction. Only accounts with a late row are read, and of those only the
    rows within a day of it. `late` has transaction, account, event time and amount.
    """
    spans = late.groupBy("account_id").agg(
        F.min(F.unix_millis("event_time")).alias("_low"), F.max(F.unix_millis("event_time")).alias("_high")
    )
    versions = latest_enriched(stored.join(spans.select("account_id"), "account_id", "left_semi").select(*stored.columns))
    near = versions.withColumn("_ms", F.unix_millis("event_time")).join(spans, "account_id").where(
        F.col("_ms").between(F.col("_low") - REACH_MS, F.col("_high") + REACH_MS)
    )
    context = near.select(*LATE_COLUMNS, "_ms", "_low").unionByName(
        late.select(*LATE_COLUMNS).withColumn("_ms", F.unix_millis("event_time")), allowMissingColumns=True
    )
    renewed = velocity_features(context, time_ms="_ms").where(F.col("_low").isNotNull() & (F.col("_ms") >= F.col("_low")))
    values = renewed.select("transaction_id", *[F.col(c).alias(f"_new_{c}") for c in VELOCITY_COLUMNS])
    joined = near.select(*versions.columns).join(values, "transaction_id")
    changed = F.lit(False)
    for name in VELOCITY_COLUMNS:
        changed = changed | (F.col(name) != F.col(f"_new_{name}"))
    replaced = {name: F.col(f"_new_{name}") for name in VELOCITY_COLUMNS}
    replaced["enrichment_time"] = F.timestamp_millis(corrected_at_ms)
    return joined.where(changed).select(
        *[replaced.get(name, F.col(name)).alias(name) for name in versions.columns]
    )
