"""Counters of the rule engine, shadow rule promotion and demotion, backtests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.rules import SHADOW_SUFFIX, Rule, evaluate
from riskspark.plans.reports import rule_families

# Promotion gate and demotion threshold.
MIN_TRIGGERS = 100
MAX_SHADOW_FP_RATE = 0.02
MAX_ACTIVE_FP_RATE = 0.05


def rule_counters(evaluated: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Per enabled rule: evaluations, triggers, flags, shadow triggers, shadow false positives."""
    catalogue = rule_families(evaluated.sparkSession, rules)
    matched = evaluated.select(F.explode("matched_rules").alias("match"), "determination")
    shadow = F.col("match").endswith(SHADOW_SUFFIX)
    counted = matched.groupBy(F.regexp_replace("match", f"{SHADOW_SUFFIX}$", "").alias("rule_id")).agg(
        F.count_if(~shadow).alias("triggers"),
        F.count_if(shadow).alias("shadow_triggers"),
        F.count_if(shadow & (F.col("determination") == "clean")).alias("shadow_fp"),
    )
    rows = evaluated.agg(F.count(F.lit(1)).alias("n")).scalar()
    joined = F.broadcast(catalogue).join(counted, "rule_id", "left")
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("triggers", "shadow_triggers", "shadow_fp")]
    return joined.select("rule_id", "family", rows.alias("evaluations"), *numbers)


def shadow_report(decisions: DataFrame, since_ms: int, until_ms: int) -> DataFrame:
    """Triggers and estimated false positive rate per shadow rule, and whether it may be promoted.

    `decisions` has `decided_ms`, `decision` and `shadow_triggers`. A shadow
    trigger on a transaction that stayed clean (ALLOW) counts as false positive.
    """
    recent = decisions.where((F.col("decided_ms") > since_ms) & (F.col("decided_ms") <= until_ms))
    counted = (
        recent.select(F.explode("shadow_triggers").alias("match"), "decision")
        .groupBy(F.regexp_replace("match", f"{SHADOW_SUFFIX}$", "").alias("rule_id"))
        .agg(
            F.count(F.lit(1)).alias("shadow_triggers_24h"),
            F.count_if(F.col("decision") == "ALLOW").alias("fp_count_24h"),
        )
    )
    rate = F.col("fp_count_24h") / F.col("shadow_triggers_24h")
    few = F.col("shadow_triggers_24h") < MIN_TRIGGERS
    reason = F.when(
        few,
        F.concat(F.lit("few_triggers:"), F.col("shadow_triggers_24h")),
    ).when(F.col("estimated_fp_rate") >= MAX_SHADOW_FP_RATE, "false_positive_rate")
    rated = counted.withColumn("estimated_fp_rate", rate)
    return rated.select(
        "*", reason.isNull().alias("can_promote"), F.coalesce(reason, F.lit("")).alias("reason")
    ).orderBy(F.col("shadow_triggers_24h").desc(), "rule_id")


def active_fp_rate(reviewed: DataFrame, width: str = "1 hour") -> DataFrame:
    """Per rule and time window: active triggers, those reviewed as false positives, breach flag.

    `reviewed` are stored alerts with their review status.
    """
    active = F.filter("matched_rule_names", lambda name: ~name.endswith(SHADOW_SUFFIX))
    rows = reviewed.select("evaluation_timestamp", "status", F.explode(active).alias("rule_id"))
    counted = rows.groupBy(F.window("evaluation_timestamp", width).alias("w"), "rule_id").agg(
        F.count(F.lit(1)).alias("triggers"),
        F.count_if(F.col("status") == "false-positive").alias("false_positives"),
    )
    rate = F.col("false_positives") / F.col("triggers")
    return counted.select(
        F.col("w.start").alias("window_start"),
        "rule_id",
        "triggers",
        "false_positives",
        rate.alias("fp_rate"),
        (rate > MAX_ACTIVE_FP_RATE).alias("demote"),
    )


def backtest(history: DataFrame, rules_before: Iterable[Rule], rules_after: Iterable[Rule]) -> DataFrame:
    """Transactions per (determination before, after) and rule that changed, over stored history.

    Both rule sets are evaluated in the same pass over the table.
    """
    columns = history.columns
    before = evaluate(history, rules_before).select(
        *columns, F.col("determination").alias("_before"), F.col("matched_rules").alias("_rules_before")
    )
    after = evaluate(before, rules_after)
    gained = F.array_except("matched_rules", "_rules_before")
    lost = F.array_except("_rules_before", "matched_rules")
    changes = F.concat(
        F.transform(gained, lambda r: F.struct(F.lit("gained").alias("change"), r.alias("rule_id"))),
        F.transform(lost, lambda r: F.struct(F.lit("lost").alias("change"), r.alias("rule_id"))),
    )
    exploded = after.select("_before", "determination", F.explode_outer(changes).alias("c"))
    return exploded.groupBy(
        F.col("_before").alias("before"),
        F.col("determination").alias("after"),
        F.coalesce("c.change", F.lit("same")).alias("change"),
        F.coalesce("c.rule_id", F.lit("")).alias("rule_id"),
    ).agg(F.count(F.lit(1)).alias("transactions"))


