"""The four analyst views over the enriched and decision tables.

Percentiles are `percentile_approx`, as the views promise approximate values;
with `ACCURACY` they are exact up to that many rows per group.

`start` and `end` are days. They are applied before deduplication so that they
prune partitions; a transaction's copies must then share their day, which holds
for the enriched table (event day) and for decisions made again on one day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.operators.decisions import latest_decisions, latest_enriched

ACCURACY = 100_000
DECISION_DAY = "decision_date"
DECIDED_COLUMNS = ("transaction_id", "decision", "fraud_score", "decision_time_ms", "latency_ms", "decision_day")

# Columns of the audit view, in its order.
AUDIT_ENRICHED = [
    "transaction_id", "account_id", "merchant_id", "amount", "currency", "channel", "event_time",
    "enrichment_time", "geo_country", "geo_city", "geo_network_class", "geo_confidence",
    "device_txn_count", "device_known_fraud", "prev_geo_country", "prev_txn_time_ms",
    "vel_count_1m", "vel_amount_1m", "vel_count_5m", "vel_amount_5m", "vel_count_1h",
    "vel_amount_1h", "vel_count_24h", "vel_amount_24h", "enrichment_latency_ms",
]
AUDIT_DECISION = {
    "decision": "decision",
    "fraud_score": "fraud_score",
    "rule_triggers": "rule_triggers",
    "model_version": "model_version",
    "decision_time_ms": "decision_time_ms",
    "latency_ms": "decision_latency_ms",
    "schema_version": "decision_schema_version",
}


def quantile(column: str, share: float) -> Column:
    return F.percentile_approx(column, share, ACCURACY)


def between_days(df: DataFrame, time_column: str, start=None, end=None) -> DataFrame:
    """Rows from day `start` to day `end`, both included; None leaves a side open.

    A day partition column of the table is filtered too when it is there.
    """
    partition = {"event_time": "event_day", "decision_time_ms": "decision_day"}.get(time_column)
    columns = [F.to_date(time_column)]
    if partition in df.columns:
        columns.append(F.col(partition))
    for column in columns:
        if start is not None:
            df = df.where(column >= F.lit(start).cast("date"))
        if end is not None:
            df = df.where(column <= F.lit(end).cast("date"))
    return df


def since(df: DataFrame, time_column: str, now: Column, hours: int) -> DataFrame:
    """Rows later than `hours` before `now`."""
    if not 1 <= hours <= 90 * 24:
        raise ValueError("a lookback is one hour to ninety days")
    start = now - F.make_dt_interval(hours=F.lit(hours))
    partition = {"event_time": "event_day", "decision_time_ms": "decision_day"}.get(time_column)
    if partition in df.columns:
        df = df.where(F.col(partition) >= F.to_date(start))
    return df.where(F.col(time_column) > start)


def lookback(df: DataFrame, time_column: str, now: Column, hours: int) -> DataFrame:
    """Rows of the last `hours`, up to `now`: 1, 24, 7 * 24 or up to 90 days in the reports.

    For rows that are final; versions of a row are deduplicated before the upper bound, see `recent_decisions`.
    """
    return since(df, time_column, now, hours).where(F.col(time_column) <= now)


def current_decisions(decisions: DataFrame, start=None, end=None) -> DataFrame:
    """Latest decision per transaction, with its day, where that day is in the window.

    Rows before `start` are cut before deduplication, since an older row never wins; rows after `end` only after it,
    so that a transaction decided again later is not reported by what it was.
    """
    latest = latest_decisions(between_days(decisions, "decision_time_ms", start))
    return between_days(latest, "decision_time_ms", None, end).withColumn(DECISION_DAY, F.to_date("decision_time_ms"))


def recent_decisions(decisions: DataFrame, now: Column, hours: int) -> DataFrame:
    """Latest decision per transaction, where it was made in the last `hours` up to `now`."""
    latest = latest_decisions(since(decisions, "decision_time_ms", now, hours))
    return latest.where(F.col("decision_time_ms") <= now)


def transaction_audit(enriched: DataFrame, decisions: DataFrame, transaction_id: str | None = None) -> DataFrame:
    """Every transaction once with its decision, if there is one."""
    if transaction_id is not None:
        enriched = enriched.where(F.col("transaction_id") == transaction_id)
        decisions = decisions.where(F.col("transaction_id") == transaction_id)
    left = latest_enriched(enriched, AUDIT_ENRICHED)
    right = latest_decisions(decisions).select(
        "transaction_id", *[F.col(old).alias(new) for old, new in AUDIT_DECISION.items()]
    )
    joined = left.join(right, "transaction_id", "left")
    return joined.select(*AUDIT_ENRICHED, *AUDIT_DECISION.values())


def decided_transactions(
    enriched: DataFrame, decisions: DataFrame, columns: list[str], start=None, end=None
) -> DataFrame:
    """Latest decisions with `columns` of their transaction; both sides unique before the join."""
    narrow = decisions.select(*[c for c in decisions.columns if c in DECIDED_COLUMNS])
    left = current_decisions(narrow, start, end)
    if start is not None or end is not None:  # only the window's transactions are deduplicated
        enriched = enriched.join(left.select("transaction_id"), "transaction_id", "left_semi")
    right = latest_enriched(enriched, columns).select("transaction_id", *columns)
    return left.join(right, "transaction_id")


def fraud_rate_daily(enriched: DataFrame, decisions: DataFrame, start=None, end=None) -> DataFrame:
    joined = decided_transactions(enriched, decisions, ["channel", "amount"], start, end)
    return joined.groupBy(DECISION_DAY, "channel", "decision").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        quantile("latency_ms", 0.99).alias("p99_latency_ms"),
    )


def triggered(decisions: DataFrame, start=None, end=None) -> DataFrame:
    """One row per latest decision and rule that triggered it."""
    return current_decisions(decisions, start, end).select(
        "transaction_id", "decision", "fraud_score", DECISION_DAY, F.explode("rule_triggers").alias("rule_name")
    )


def rule_triggers_daily(decisions: DataFrame, start=None, end=None, rule_name: str | None = None) -> DataFrame:
    rows = triggered(decisions, start, end)
    if rule_name is not None:
        rows = rows.where(F.col("rule_name") == rule_name)
    return rows.groupBy(DECISION_DAY, "rule_name", "decision").agg(
        F.count(F.lit(1)).alias("trigger_count"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        quantile("fraud_score", 0.5).alias("median_fraud_score"),
        quantile("fraud_score", 0.95).alias("p95_fraud_score"),
    )


def model_versions(decisions: DataFrame, start=None, end=None, version: str | None = None) -> DataFrame:
    rows = current_decisions(decisions, start, end)
    if version is not None:
        rows = rows.where(F.col("model_version") == version)
    return rows.groupBy("model_version", DECISION_DAY, "decision").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        quantile("fraud_score", 0.5).alias("median_fraud_score"),
        quantile("fraud_score", 0.95).alias("p95_fraud_score"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        quantile("latency_ms", 0.99).alias("p99_latency_ms"),
    )
