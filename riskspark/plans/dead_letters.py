"""Dead letters: envelopes, the common table, trend report, inspection and replay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions import payload as pl
from riskspark.operators.decisions import per_key_cap

# The four topics, report limits and classes.
TOPICS = ("txn.ingestion.dlq", "txn.processing.dlq", "txn.scoring.dlq", "txn.fraud.alerts.dlq")
PARSE_ERROR = "parse_error"
TOP_ERRORS = 5
ALERT_RATE_PCT = 5.0
INSPECT_CAP = 200
DRY_RUN = "[DRY RUN]"


def processing_envelopes(
    errors: DataFrame, source_topic: str, failed_at: Column, host: str = "", dlq_id: Column | None = None
) -> DataFrame:
    """Processing dead letters from rows with `error_type` and `error_message`; other columns optional."""

    def column(name: str, default, type_name: str) -> Column:
        value = F.col(name) if name in errors.columns else F.lit(default)
        return F.coalesce(value, F.lit(default)).cast(type_name) if default is not None else value.cast(type_name)

    return errors.select(
        (F.uuid() if dlq_id is None else dlq_id).alias("dlq_id"),
        F.lit(source_topic).alias("source_topic"),
        column("source_partition", 0, "int").alias("source_partition"),
        column("source_offset", 0, "bigint").alias("source_offset"),
        column("transaction_id", None, "string").alias("transaction_id"),
        column("original_payload_bytes", "", "binary").alias("original_payload_bytes"),
        "error_type",
        "error_message",
        column("watermark_at_rejection", None, "timestamp").alias("watermark_at_rejection"),
        column("event_time_at_rejection", None, "timestamp").alias("event_time_at_rejection"),
        failed_at.alias("failed_at"),
        F.lit(host).alias("processor_host"),
        F.spark_partition_id().alias("processor_subtask_index"),
    )


def alert_envelopes(failed_alerts: DataFrame, message: Column, failed_at: Column) -> DataFrame:
    """Dead letters of alerts that could not be delivered."""
    return failed_alerts.select(
        "*",
        F.lit("DELIVERY_FAILURE").alias("error_type"),
        message.alias("error_message"),
        failed_at.alias("failed_at"),
    )


def union_topics(topics: dict[str, DataFrame]) -> DataFrame:
    """All topics in one table: the union of their columns plus `dlq_topic`."""
    parts = [df.withColumn("dlq_topic", F.lit(topic)) for topic, df in topics.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part, allowMissingColumns=True)
    return result


def with_error_type(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds `error_type` from a JSON payload; whatever cannot be parsed is a parse error."""
    found = F.get_json_object(payload, "$.error_type")
    return df.withColumn("error_type", F.coalesce(found, F.lit(PARSE_ERROR)))


def daily_counts(dead: DataFrame, failed_at: str = "failed_at") -> DataFrame:
    return dead.groupBy(F.to_date(failed_at).alias("day"), "dlq_topic", "error_type").agg(
        F.count(F.lit(1)).alias("n")
    )


def rolling_trend(daily: DataFrame, literal: bool = False) -> DataFrame:
    """Per day, topic and error type: 7 and 30 day totals, average and trend.

    The windows are calendar days that end with the row's day. `literal` takes
    one day more each, as the written plan does, and knows only two trends.
    """
    extra = 1 if literal else 0
    number = F.unix_date("day")
    span = Window.partitionBy("dlq_topic", "error_type").orderBy("_day")

    def total(days: int) -> Column:
        return F.sum("n").over(span.rangeBetween(-(days - 1 + extra), 0))

    rows = daily.withColumn("_day", number).select(
        "day", "dlq_topic", "error_type", "n", total(7).alias("total_7d"), total(30).alias("total_30d")
    )
    earlier = (F.col("total_7d") - F.col("n")) / F.lit(6.0)
    trend = F.when(F.col("n") > earlier, "increasing")
    if not literal:
        trend = trend.when(F.col("n") < earlier, "decreasing")
    return rows.select(
        "day",
        "dlq_topic",
        "error_type",
        F.col("n").alias("today"),
        "total_7d",
        "total_30d",
        (F.col("total_7d") / F.lit(7.0)).alias("avg_7d"),
        trend.otherwise("stable").alias("trend"),
    )


def _last_days(daily: DataFrame, as_of: Column, days: int) -> Column:
    return F.col("day").between(F.date_sub(as_of, days - 1), as_of)


def top_errors(daily: DataFrame, as_of: Column, limit: int = TOP_ERRORS) -> DataFrame:
    """Error types with the highest 7 day volume over all topics."""
    recent = daily.where(_last_days(daily, as_of, 7))
    volume = recent.groupBy("error_type").agg(F.sum("n").alias("volume_7d"))
    picked = volume.orderBy(F.col("volume_7d").desc(), "error_type").limit(limit)
    # `limit` rows at most reach this window.
    return picked.select(
        "error_type",
        "volume_7d",
        F.row_number().over(Window.orderBy(F.col("volume_7d").desc(), F.col("error_type"))).alias("rank"),
    )


def error_rate(daily: DataFrame, throughput: DataFrame, as_of: Column, day: str = "day") -> DataFrame:
    """Dead letters of a day as a share of the main topic's rows that day."""
    dead = daily.where(F.col("day") == as_of).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("dead"))
    main = throughput.where(F.col(day) == as_of).agg(F.count(F.lit(1)).alias("n")).scalar()
    counted = dead.select(F.col("dead").alias("total_dlq_volume"), main.alias("main_throughput"))
    rate = F.when(F.col("main_throughput") > 0, F.lit(100.0) * F.col("total_dlq_volume") / F.col("main_throughput"))
    rated = counted.withColumn("error_rate_pct", F.coalesce(rate, F.lit(0.0)))
    high = F.col("error_rate_pct") > ALERT_RATE_PCT
    return rated.withColumn("classification", F.when(high, "high").otherwise("normal"))


def topic_summary(daily: DataFrame, as_of: Column) -> DataFrame:
    """Per topic: totals of today, 7 and 30 days and the 7 day dominant error type."""
    recent = daily.where(_last_days(daily, as_of, 30))
    today, week = F.col("day") == as_of, _last_days(daily, as_of, 7)
    zero = F.lit(0)
    by_error = recent.groupBy("dlq_topic", "error_type").agg(
        F.coalesce(F.sum(F.when(today, F.col("n"))), zero).alias("today"),
        F.coalesce(F.sum(F.when(week, F.col("n"))), zero).alias("week"),
        F.sum("n").alias("month"),
    )
    return by_error.groupBy("dlq_topic").agg(
        F.sum("today").alias("total_today"),
        F.sum("week").alias("total_7d"),
        F.sum("month").alias("total_30d"),
        F.max_by("error_type", F.struct("week", "error_type")).alias("dominant_error"),
    )


def inspect(dead: DataFrame, payload: str = "payload", cap: int = INSPECT_CAP, mask: bool = True) -> DataFrame:
    """The oldest `cap` letters per topic with a masked payload and its preview."""
    shown = per_key_cap(dead, ["dlq_topic"], cap, F.col("failed_at"), F.col("dlq_id"))
    body = pl.display_masked(F.col(payload)) if mask else pl.as_map(F.col(payload))
    return shown.withColumn("masked_payload", F.to_json(body)).withColumn(
        "payload_preview", pl.preview(F.col("masked_payload"))
    )


def replay_plan(
    dead: DataFrame,
    target_topic: str,
    max_messages: int,
    error_types: tuple[str, ...] | None = None,
    dry_run: bool = True,
) -> DataFrame:
    """The oldest letters to send again, in order. A dry run marks them instead of naming a target."""
    if max_messages <= 0:
        raise ValueError("max_messages must be positive")
    rows = dead if error_types is None else dead.where(F.col("error_type").isin(*error_types))
    picked = rows.orderBy("failed_at", "dlq_id").limit(max_messages)
    return picked.withColumn("target_topic", F.lit(DRY_RUN if dry_run else target_topic))


def replay(plan: DataFrame, deliver) -> None:
    """Sends the planned letters again, one delivery per target; dry-run rows are not sent.

    `deliver(rows, target)` writes one target's rows. A plan names one target.
    """
    targets = [row[0] for row in plan.select("target_topic").distinct().limit(2).collect()]
    for target in targets:
        if target != DRY_RUN:
            deliver(plan.where(F.col("target_topic") == target), target)


def trend_report(daily: DataFrame, throughput: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """The daily trend report: error rate, top errors, windows of the day's errors, topic summaries."""
    trend = rolling_trend(daily)
    return {
        "error_rate": error_rate(daily, throughput, as_of),
        "top_errors": top_errors(daily, as_of),
        "windows": trend.where(F.col("day") == as_of),
        "topics": topic_summary(daily, as_of),
    }


def write_report(report: dict[str, DataFrame], root: str, job_day: str) -> None:
    """Writes each part for the job's day; running the day again replaces it."""
    for name, part in report.items():
        part.write.mode("overwrite").json(f"{root}/{name}/job_day={job_day}")


def with_audit(dead: DataFrame, audit: DataFrame) -> DataFrame:
    """Dead letters with what is known of their transaction; letters without one stay."""
    known = audit.select("transaction_id", "account_id", "amount", "decision", "fraud_score")
    return dead.join(known, "transaction_id", "left")
