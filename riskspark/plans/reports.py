"""What the analyst pages show, each as one query over the base tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.operators.decisions import active_triggers
from riskspark.operators.rules import Rule, enabled_rules
from riskspark.plans import views
from riskspark.schemas import DECISIONS

UNKNOWN_FAMILY = "unknown"


def block_rate(decisions: DataFrame, start=None, end=None, strict_reference: bool = False) -> DataFrame:
    """Share of blocked decisions per day; `strict_reference` leaves out days without a block."""
    daily = views.current_decisions(decisions, start, end).groupBy(views.DECISION_DAY).agg(
        F.count_if(F.col("decision") == "BLOCK").alias("blocked"), F.count(F.lit(1)).alias("total")
    )
    if strict_reference:
        daily = daily.where(F.col("blocked") > 0)
    return daily.withColumn("fraud_rate", F.col("blocked") / F.col("total"))


def channel_decision_pivot(enriched: DataFrame, decisions: DataFrame, start=None, end=None) -> DataFrame:
    """Decisions per channel, one column each; combinations that never occur are 0."""
    joined = views.decided_transactions(enriched, decisions, ["channel"], start, end)
    counts = [F.count_if(F.col("decision") == name).alias(name) for name in DECISIONS]
    return joined.groupBy("channel").agg(*counts)


def _breakdown(enriched, decisions, column, start, end) -> DataFrame:
    joined = views.decided_transactions(enriched, decisions, [column, "amount"], start, end)
    fraud = F.col("decision") == "BLOCK"
    return joined.groupBy(column).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.count_if(fraud).alias("fraud_count"),
        F.coalesce(F.sum(F.when(fraud, F.col("amount"))), F.lit(0)).cast("decimal(38,4)").alias("fraud_amount"),
    )


def merchant_fraud(enriched: DataFrame, decisions: DataFrame, top_n: int = 10, start=None, end=None) -> DataFrame:
    """Merchants with the most blocked transactions."""
    grouped = _breakdown(enriched, decisions, "merchant_id", start, end)
    order = [F.col("fraud_count").desc(), F.col("fraud_amount").desc(), F.col("merchant_id")]
    return grouped.orderBy(*order).limit(top_n)


def geo_fraud(enriched: DataFrame, decisions: DataFrame, start=None, end=None) -> DataFrame:
    """Blocked transactions and their share per country; unknown countries are one group."""
    grouped = _breakdown(enriched, decisions, "geo_country", start, end)
    return grouped.withColumn("fraud_rate", F.col("fraud_count") / F.col("transactions"))


def rule_families(spark, rules: Iterable[Rule]) -> DataFrame:
    """The catalogue as a table: one row per enabled rule."""
    rows = [(r.rule_id, r.name, r.family, r.severity, r.mode) for r in enabled_rules(rules)]
    return spark.createDataFrame(rows, "rule_id string, name string, family string, severity string, mode string")


def rule_leaderboard(
    decisions: DataFrame, rules: Iterable[Rule], top_n: int | None = None, start=None, end=None
) -> DataFrame:
    """Triggers, trigger rate, share of allowed decisions and scores per rule.

    Every enabled rule of the catalogue is listed, also with zero triggers; a
    rule the catalogue does not know has family 'unknown'. Medians come from the
    decisions themselves, not from daily medians.
    """
    current = views.current_decisions(decisions, start, end)
    counted = current.select(
        "decision", "fraud_score", F.explode("rule_triggers").alias("rule_name")
    ).groupBy("rule_name").agg(
        F.count(F.lit(1)).alias("triggers"),
        F.count_if(F.col("decision") == "ALLOW").alias("allowed"),
        F.avg("fraud_score").alias("avg_score"),
        views.quantile("fraud_score", 0.5).alias("median_score"),
        views.quantile("fraud_score", 0.95).alias("p95_score"),
    )
    catalogue = rule_families(decisions.sparkSession, rules).select(
        F.col("rule_id").alias("rule_name"), "family"
    )
    # At most one row per catalogue entry, a file of a few rules.
    joined = counted.join(F.broadcast(catalogue), "rule_name", "full")
    decided = current.agg(F.count(F.lit(1)).alias("n")).scalar()
    total = F.coalesce("triggers", F.lit(0))
    board = joined.select(
        "rule_name",
        F.coalesce("family", F.lit(UNKNOWN_FAMILY)).alias("family"),
        total.alias("total_triggers"),
        F.coalesce(F.lit(100.0) * total / decided, F.lit(0.0)).alias("trigger_rate_pct"),
        F.coalesce(F.col("allowed") / F.col("triggers"), F.lit(0.0)).alias("fp_rate"),
        "avg_score",
        "median_score",
        "p95_score",
    )
    ranked = board.orderBy(F.col("total_triggers").desc(), "rule_name")
    return ranked if top_n is None else ranked.limit(top_n)


def model_summary(decisions: DataFrame, start=None, end=None) -> DataFrame:
    return views.current_decisions(decisions, start, end).groupBy("model_version").agg(
        F.count(F.lit(1)).alias("total_txns"),
        F.avg("fraud_score").alias("avg_score"),
        views.quantile("fraud_score", 0.5).alias("median_score"),
        views.quantile("fraud_score", 0.95).alias("p95_score"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        views.quantile("latency_ms", 0.99).alias("p99_latency_ms"),
    )


def model_compare(decisions: DataFrame, version_a: str, version_b: str, start=None, end=None) -> DataFrame:
    """Daily score of two versions side by side; a day only one has keeps a null for the other.

    As on the page, the daily value is the mean over the day's decisions kinds
    of their average score. Both versions come out of one scan.
    """
    both = views.current_decisions(decisions, start, end).where(F.col("model_version").isin(version_a, version_b))
    kinds = both.groupBy("model_version", views.DECISION_DAY, "decision").agg(F.avg("fraud_score").alias("score"))
    sides = [
        F.avg(F.when(F.col("model_version") == version, F.col("score"))).alias(name)
        for version, name in ((version_a, "version_a"), (version_b, "version_b"))
    ]
    return kinds.groupBy(views.DECISION_DAY).agg(*sides).orderBy(views.DECISION_DAY)


def score_histogram(decisions: DataFrame, bins: int = 20, start=None, end=None) -> DataFrame:
    """Decisions per model version and score interval of equal width; a score of 1 is in the last, empty ones are left out.

    Scores below 0 or above 1 are counted in the first and last interval; decisions without a score in none.
    """
    current = views.current_decisions(decisions, start, end).where(F.col("fraud_score").isNotNull())
    place = F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(F.col("fraud_score") * bins).cast("int")))
    counted = current.groupBy("model_version", place.alias("bin")).agg(F.count(F.lit(1)).alias("decisions"))
    total = F.sum("decisions").over(Window.partitionBy("model_version"))
    return counted.select(
        "model_version", "bin", (F.col("bin") / bins).alias("low"), ((F.col("bin") + 1) / bins).alias("high"),
        "decisions", (F.col("decisions") / total).alias("share"),
    )


def channel_fraud(enriched: DataFrame, decisions: DataFrame, start=None, end=None) -> DataFrame:
    """Transactions, blocked ones and their share per channel."""
    grouped = _breakdown(enriched, decisions, "channel", start, end)
    return grouped.withColumn("fraud_rate", F.col("fraud_count") / F.col("transactions"))


def newest_decision(decisions: DataFrame) -> Column:
    """The time a rolling window of stored decisions ends at, where no clock is given."""
    return decisions.agg(F.max("decision_time_ms").alias("at")).scalar()


def rolling_decisions(decisions: DataFrame, hours: int, now: Column | None = None) -> DataFrame:
    """Latest decisions of the last `hours` up to `now`, for the reports that read decisions only: 1, 24 and 7 * 24 hours on the pages."""
    return views.recent_decisions(decisions, newest_decision(decisions) if now is None else now, hours)


def rolling(
    report: Callable[..., DataFrame], enriched: DataFrame, decisions: DataFrame, hours: int, now: Column | None = None, **options
) -> DataFrame:
    """A report over both tables for a rolling window; only the window's transactions are deduplicated."""
    recent = rolling_decisions(decisions, hours, now)
    wanted = enriched.join(recent.select("transaction_id"), "transaction_id", "left_semi")
    return report(wanted, recent, **options)


def top_scored(enriched: DataFrame, decisions: DataFrame, limit: int = 20) -> DataFrame:
    """Decisions with features, highest score first; copies are not removed here."""
    joined = enriched.select("transaction_id", "account_id", "amount", "vel_count_1h").join(
        decisions.select("transaction_id", "decision", "fraud_score", "rule_triggers", "decision_time_ms"),
        "transaction_id",
    )
    order = [F.col("fraud_score").desc(), F.col("transaction_id"), F.col("decision_time_ms"), F.col("amount")]
    picked = joined.orderBy(*order).limit(limit)
    return picked.select("account_id", "amount", "vel_count_1h", "decision", "fraud_score", "rule_triggers")


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


def rule_flags(alert_rows: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Alerts per rule, family and severity, shadow matches left out."""
    exploded = alert_rows.select(
        F.explode(active_triggers(F.col("matched_rule_names"))).alias("rule_id"), "severity"
    )
    families = rule_families(alert_rows.sparkSession, rules).select("rule_id", "family")
    counted = exploded.groupBy("rule_id", "severity").agg(F.count(F.lit(1)).alias("flags"))
    joined = counted.join(F.broadcast(families), "rule_id", "left")
    return joined.select("rule_id", F.coalesce("family", F.lit(UNKNOWN_FAMILY)).alias("family"), "severity", "flags")

