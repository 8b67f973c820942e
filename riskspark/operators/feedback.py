"""Labels joined back on decisions, and training sets made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.clock import hours
from riskspark.operators.dedup import latest_per_key
from riskspark.operators.features import point_in_time

WINDOW_HOURS = (24, 72)  # fixed values: labels arrive this long after the decision


def join_labels(
    decisions: DataFrame,
    labels: DataFrame,
    decided_ms: str = "decided_ms",
    labelled_ms: str = "labelled_ms",
    window_hours: tuple[int, int] = WINDOW_HOURS,
) -> DataFrame:
    """Adds `label`, `is_fraud` and `label_outcome` to every (deduplicated) decision.

    The newest label inside the window counts; a decision without one is taken
    as legitimate. Confusion classes compare FLAG and BLOCK with the label.
    """
    low, high = (hours(n) for n in window_hours)
    times = decisions.select("transaction_id", F.col(decided_ms).alias("_decided"))
    delay = F.col(labelled_ms) - F.col("_decided")
    in_window = labels.join(times, "transaction_id").where(delay.between(low, high))
    newest = latest_per_key(in_window, ["transaction_id"], labelled_ms, "label", "label_source")
    found = newest.select("transaction_id", "label", F.col(labelled_ms).alias("label_ms"))
    joined = decisions.join(found, "transaction_id", "left")
    fraud = F.coalesce(F.col("label") == "fraud", F.lit(False))
    positive = F.col("decision") != "ALLOW"
    outcome = (
        F.when(positive & fraud, "TP").when(positive, "FP").when(fraud, "FN").otherwise("TN")
    )
    return joined.withColumns({"is_fraud": fraud, "label_outcome": outcome})


def training_set(labelled: DataFrame, views: dict[str, DataFrame]) -> DataFrame:
    """Labelled decisions with features as of the transaction, never later."""
    return point_in_time(labelled, views)


def rule_precision(labelled: DataFrame, triggers: str = "rule_triggers") -> DataFrame:
    """Per rule: triggers, confirmed frauds, false positives and their share."""
    exploded = labelled.select(F.explode(triggers).alias("rule_id"), "is_fraud")
    counted = exploded.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("triggers"), F.count_if("is_fraud").alias("frauds")
    )
    false_positives = F.col("triggers") - F.col("frauds")
    return counted.select(
        "*", false_positives.alias("false_positives"), (false_positives / F.col("triggers")).alias("fp_rate")
    )
