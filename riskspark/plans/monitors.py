"""Windowed monitors over events, decisions, alerts and dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.clock import MINUTE_MS, minute_of
from riskspark.operators.prefix import largest_before
from riskspark.plans.views import quantile

# Latency buckets in ms and alert limits.
LATENCY_BUCKETS = (1, 5, 10, 20, 50, 100, 250, 500)
P99_LIMIT_MS = 20
SILENT_MINUTES = 15
FLAG_RATE_MINUTES = 5
ALERTS_PER_SECOND = 100
STALL_MS = 60_000
MINUTE_BITS = 36  # minutes since 1970 have 25 bits today


def window_start(time_ms: str, minutes: int) -> Column:
    width = minutes * MINUTE_MS
    return (F.floor(F.col(time_ms) / F.lit(width)) * F.lit(width)).cast("bigint").alias("window_ms")


def latency_histogram(df: DataFrame, latency: str, time_ms: str, minutes: int = 5) -> DataFrame:
    """Cumulative bucket counts and percentiles per window, and whether p99 is over its limit."""
    buckets = [F.count_if(F.col(latency) <= bound).alias(f"le_{bound}") for bound in LATENCY_BUCKETS]
    shares = [quantile(latency, share).alias(name) for name, share in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))]
    grouped = df.groupBy(window_start(time_ms, minutes)).agg(*buckets, F.count(F.lit(1)).alias("le_inf"), *shares)
    return grouped.withColumn("p99_breach", F.col("p99") > P99_LIMIT_MS)


def throughput(df: DataFrame, time_ms: str, failed: Column, minutes: int = 1) -> DataFrame:
    """Rows, failures, rows per second and error rate per window."""
    grouped = df.groupBy(window_start(time_ms, minutes)).agg(
        F.count(F.lit(1)).alias("events"), F.count_if(failed).alias("errors")
    )
    return grouped.select(
        "*",
        (F.col("events") / F.lit(60.0 * minutes)).alias("per_second"),
        (F.col("errors") / F.col("events")).alias("error_rate"),
    )


def severity_rate(alert_rows: DataFrame, time_ms: str, minutes: int = 1) -> DataFrame:
    """Alerts per window and severity."""
    return alert_rows.groupBy(window_start(time_ms, minutes), "severity").agg(F.count(F.lit(1)).alias("alerts"))


def dead_letter_alarm(dead: DataFrame, failed_ms: str) -> DataFrame:
    """Minutes with any dead letter, by error type."""
    return dead.groupBy(window_start(failed_ms, 1), "error_type").agg(F.count(F.lit(1)).alias("letters"))


def alert_burst(alert_rows: DataFrame, time_ms: str, limit: float = ALERTS_PER_SECOND) -> DataFrame:
    """Five minute windows with more alerts per second than the limit."""
    counted = alert_rows.groupBy(window_start(time_ms, 5)).agg(F.count(F.lit(1)).alias("alerts"))
    rate = F.col("alerts") / F.lit(300.0)
    return counted.withColumn("per_second", rate).where(rate > limit)


def silent_minutes(df: DataFrame, time_ms: str, flagged: Column) -> DataFrame:
    """Minutes at which no row was flagged for so long that the evaluator may be down.

    A flag keeps the 5 minute rate above zero for 5 minutes, and the alarm waits
    for 15 minutes of zero rate; so a minute is silent when the 19 minutes that
    end with it hold no flag. Minutes before the first 19 are not judged.
    """
    reach = SILENT_MINUTES + FLAG_RATE_MINUTES - 1
    minutes = df.select(minute_of(F.col(time_ms)).alias("minute"), flagged.alias("flagged"))
    bounds = minutes.agg(F.min("minute").alias("low"), F.max("minute").alias("high"))
    first = F.col("low") + F.lit(reach - 1)
    spine = bounds.where(first <= F.col("high")).select(F.explode(F.sequence(first, F.col("high"))).alias("minute"))
    busy = minutes.where("flagged").select("minute").distinct()
    covered = busy.select(
        F.explode(F.sequence(F.col("minute"), F.col("minute") + F.lit(reach - 1))).alias("minute")
    )
    silent = spine.join(covered, "minute", "left_anti")
    return silent.select((F.col("minute") * F.lit(MINUTE_MS)).alias("minute_ms"))


def stalled_watermark(df: DataFrame, at_ms: str, watermark_ms: str, limit_ms: int = STALL_MS) -> DataFrame:
    """Intervals longer than the limit in which no row moved the watermark forward.

    Rows are reduced to one per minute before anything is ordered over all of
    them, and the order is worked out by blocks (`largest_before`); only the rows
    that move the watermark decide where an interval ends.
    """
    at, mark = F.col(at_ms), F.col(watermark_ms)
    rows = df.select(minute_of(at).alias("minute"), at.alias("at"), mark.alias("mark"))
    per_minute = rows.groupBy("minute").agg(F.max("mark").alias("top"), F.max_by("at", F.struct("mark", -F.col("at"))).alias("last_at"))
    reached = largest_before(per_minute, "minute", "top", "before", MINUTE_BITS)
    reached = reached.where(F.col("before").isNull() | (F.col("top") > F.col("before")))
    moving = rows.join(reached.select("minute", "before"), "minute").where(
        F.col("before").isNull() | (F.col("mark") > F.col("before"))
    )
    first = moving.groupBy("minute").agg(F.min("at").alias("first_at"))
    steps = reached.join(first, "minute").select("minute", "first_at", F.struct("minute", "last_at").alias("here"))
    steps = largest_before(steps, "minute", "here", "prior", MINUTE_BITS).select("first_at", F.col("prior.last_at").alias("from_ms"))
    return steps.where(F.col("first_at") - F.col("from_ms") > limit_ms).select(
        "from_ms", F.col("first_at").alias("to_ms"), (F.col("first_at") - F.col("from_ms")).alias("stalled_ms")
    )


def late_split(df: DataFrame, event_ms: str, watermark_ms: str, lateness_ms: int = 30_000) -> DataFrame:
    """Adds `lateness`: on_time, within (late but accepted) or beyond (to dead letters).

    Before any watermark (null) nothing is late.
    """
    event, mark = F.col(event_ms), F.col(watermark_ms)
    late = (
        F.when(mark.isNull(), "on_time")
        .when(event < mark - F.lit(lateness_ms), "beyond")
        .when(event < mark, "within")
        .otherwise("on_time")
    )
    return df.withColumn("lateness", late)


def late_counts(split: DataFrame, time_ms: str) -> DataFrame:
    """Late rows per day, within and beyond the allowed lateness."""
    day = window_start(time_ms, 1440)
    return split.groupBy(day).agg(
        F.count_if(F.col("lateness") == "within").alias("late_within"),
        F.count_if(F.col("lateness") == "beyond").alias("late_beyond"),
        F.count(F.lit(1)).alias("events"),
    )


def recent_alerts(stored: DataFrame, now_ms: int, inserted_ms: str = "inserted_ms") -> DataFrame:
    """Newest alert and the number of alerts in the last one and five minutes."""
    age = F.lit(now_ms).cast("bigint") - F.col(inserted_ms)
    recent = age >= 0
    return stored.agg(
        F.max(F.when(recent, F.col(inserted_ms))).alias("newest_ms"),
        F.count_if(recent & (age <= MINUTE_MS)).alias("alerts_1m"),
        F.count_if(recent & (age <= 5 * MINUTE_MS)).alias("alerts_5m"),
    )
