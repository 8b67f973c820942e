"""Decisions and alerts from evaluated transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions import severity as sev
from riskspark.operators.dedup import first_per_key, latest_per_key
from riskspark.operators.rules import SHADOW_SUFFIX

RULE_ONLY_MODEL = "rule-only"


def decide(evaluated: DataFrame, decided_at_ms: Column, extra: tuple[str, ...] = ()) -> DataFrame:
    """One decision per evaluated row, allowed ones included.

    `rule_triggers` is empty for a clean row even when shadow rules matched;
    `shadow_triggers` keeps those.
    """
    clean = F.col("determination") == "clean"
    decision = F.when(clean, "ALLOW").otherwise(sev.scoring_decision(F.col("highest_severity")))
    none = F.array().cast("array<string>")
    decided = evaluated.select("*", decision.alias("_decision"))
    return decided.select(
        "transaction_id",
        F.col("_decision").alias("decision"),
        sev.decision_score(F.col("_decision")).alias("fraud_score"),
        F.when(clean, none).otherwise(F.col("matched_rules")).alias("rule_triggers"),
        F.lit(RULE_ONLY_MODEL).alias("model_version"),
        F.timestamp_millis(decided_at_ms).alias("decision_time_ms"),
        F.lit(0.0).alias("latency_ms"),
        F.lit("1").alias("schema_version"),
        "shadow_triggers",
        *extra,
    )


def alerts(evaluated: DataFrame, evaluated_at_ms: Column) -> DataFrame:
    """One alert per suspicious row."""
    return evaluated.where(F.col("determination") == "suspicious").select(
        "transaction_id",
        "account_id",
        F.col("matched_rules").alias("matched_rule_names"),
        F.coalesce("highest_severity", F.lit("low")).alias("severity"),
        F.timestamp_millis(evaluated_at_ms).alias("evaluation_timestamp"),
    )


def display_alerts(alert_rows: DataFrame) -> DataFrame:
    """Alerts as the live feed shows them."""
    return alert_rows.select(
        "transaction_id",
        "account_id",
        F.col("matched_rule_names").alias("rule_triggers"),
        "severity",
        sev.display_decision(F.col("severity")).alias("decision"),
        "evaluation_timestamp",
    )


def live_feed(alert_rows: DataFrame, buffer: int = 500, shown: int = 100) -> DataFrame:
    """The newest distinct alerts: the latest `buffer` of them are kept, `shown` are displayed."""
    distinct = first_per_key(alert_rows, ["transaction_id"], "evaluation_timestamp", "account_id")
    newest = [F.col("evaluation_timestamp").desc(), F.col("transaction_id").desc()]
    return display_alerts(distinct).orderBy(*newest).limit(min(buffer, shown))


def as_stored(alert_rows: DataFrame, inserted_at: Column) -> DataFrame:
    """Alerts with the review columns of the alert table."""
    return alert_rows.select(
        "*",
        F.lit("pending").alias("status"),
        F.lit(None).cast("string").alias("reviewed_by"),
        F.lit(None).cast("timestamp").alias("reviewed_at"),
        inserted_at.alias("inserted_at"),
    )


def find_alerts(
    stored: DataFrame,
    transaction_id: str | None = None,
    account_id: str | None = None,
    status: str | None = None,
) -> DataFrame:
    for name, value in (("transaction_id", transaction_id), ("account_id", account_id), ("status", status)):
        if value is not None:
            stored = stored.where(F.col(name) == value)
    return stored


def active_triggers(names: Column) -> Column:
    """Matched rule names without the shadow ones."""
    return F.filter(names, lambda name: ~name.endswith(SHADOW_SUFFIX))


def latest_decisions(decisions: DataFrame) -> DataFrame:
    return latest_per_key(decisions, ["transaction_id"], "decision_time_ms", "decision", "fraud_score")


def latest_enriched(enriched: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Latest version of each enriched transaction, reading only `columns` when given."""
    if columns:
        needed = dict.fromkeys(["transaction_id", "enrichment_time", "amount", *columns])
        enriched = enriched.select(*needed)
    return latest_per_key(enriched, ["transaction_id"], "enrichment_time", "amount")


def per_key_cap(df: DataFrame, keys: list[str], n: int, *order: Column) -> DataFrame:
    """At most `n` rows per key, the report form of a bounded read."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")
