"""Dead letter reports, inspection and replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import payload as pl
from riskspark.plans import dead_letters as dl
from riskspark.plans import monitors
from riskspark.registry.base import DECIDED, ENRICHED, LETTERS, TX, num, register, with_ctes
from riskspark.sources import driver_tables as given

BASE = (TX, LETTERS)
AS_OF = "2024-01-25"
AS_OF_NUMBER = 19747  # days from 1970-01-01 to AS_OF


def letters(spark, folder):
    return dl.with_error_type(given.dead_letters(spark, folder))


def daily(spark, folder):
    return dl.daily_counts(letters(spark, folder))


def as_of():
    return F.lit(AS_OF).cast("date")


@register("dlq_daily_counts", with_ctes(*BASE) + "SELECT day, dlq_topic, error_type, n FROM daily")
def dlq_daily_counts(spark, folder):
    """Built from one table per topic, the way the topics are read."""
    rows = letters(spark, folder)
    parts = {topic: rows.where(F.col("dlq_topic") == topic).drop("dlq_topic") for topic in dl.TOPICS}
    return dl.daily_counts(dl.union_topics(parts))


TREND = """
t AS (SELECT a.*, (SELECT sum(n) FROM daily b WHERE b.dlq_topic = a.dlq_topic AND b.error_type = a.error_type AND b.dn BETWEEN a.dn - 6 - {x} AND a.dn) AS s7,
  (SELECT sum(n) FROM daily b WHERE b.dlq_topic = a.dlq_topic AND b.error_type = a.error_type AND b.dn BETWEEN a.dn - 29 - {x} AND a.dn) AS s30 FROM daily a)"""


@register(
    "dlq_rolling_trend",
    with_ctes(*BASE, TREND.format(x=0))
    + f"""SELECT day, dlq_topic, error_type, n AS today, CAST(s7 AS BIGINT) AS total_7d, CAST(s30 AS BIGINT) AS total_30d, {num('s7 / 7.0::DOUBLE')} AS avg_7d,
  CASE WHEN n * 6 > s7 - n THEN 'increasing' WHEN n * 6 < s7 - n THEN 'decreasing' ELSE 'stable' END AS trend FROM t""",
)
def dlq_rolling_trend(spark, folder):
    return dl.rolling_trend(daily(spark, folder))


@register(
    "dlq_rolling_trend_literal",
    with_ctes(*BASE, TREND.format(x=1))
    + f"""SELECT day, dlq_topic, error_type, n AS today, CAST(s7 AS BIGINT) AS total_7d, CAST(s30 AS BIGINT) AS total_30d, {num('s7 / 7.0::DOUBLE')} AS avg_7d,
  CASE WHEN n * 6 > s7 - n THEN 'increasing' ELSE 'stable' END AS trend FROM t""",
)
def dlq_rolling_trend_literal(spark, folder):
    return dl.rolling_trend(daily(spark, folder), literal=True)


@register(
    "dlq_top_errors",
    with_ctes(*BASE, f"v AS (SELECT error_type, CAST(sum(n) AS BIGINT) AS volume_7d FROM daily WHERE dn BETWEEN {AS_OF_NUMBER - 6} AND {AS_OF_NUMBER} GROUP BY 1)")
    + """SELECT error_type, volume_7d, CAST(row_number() OVER (ORDER BY volume_7d DESC, error_type) AS INTEGER) AS rank FROM v
  QUALIFY row_number() OVER (ORDER BY volume_7d DESC, error_type) <= 5""",
)
def dlq_top_errors(spark, folder):
    return dl.top_errors(daily(spark, folder), as_of())


@register(
    "dlq_error_rate",
    with_ctes(*BASE, f"""r AS (SELECT (SELECT CAST(sum(n) AS BIGINT) FROM daily WHERE dn = {AS_OF_NUMBER}) AS total_dlq_volume,
  (SELECT count(*) FROM tx WHERE event_ms // 86400000 = {AS_OF_NUMBER}) AS main_throughput)""")
    + f"""SELECT *, {num('100.0::DOUBLE * total_dlq_volume / main_throughput')} AS error_rate_pct,
  CASE WHEN 100.0 * total_dlq_volume / main_throughput > 5 THEN 'high' ELSE 'normal' END AS classification FROM r""",
)
def dlq_error_rate(spark, folder):
    main = given.transactions(spark, folder).select(F.to_date("event_time").alias("day"))
    return dl.error_rate(daily(spark, folder), main, as_of())


@register(
    "dlq_topic_summary",
    with_ctes(*BASE, f"""e AS (SELECT dlq_topic, error_type, coalesce(sum(n) FILTER (WHERE dn = {AS_OF_NUMBER}), 0) AS d1,
  coalesce(sum(n) FILTER (WHERE dn >= {AS_OF_NUMBER - 6}), 0) AS d7, sum(n) AS d30 FROM daily WHERE dn BETWEEN {AS_OF_NUMBER - 29} AND {AS_OF_NUMBER} GROUP BY ALL)""")
    + """SELECT dlq_topic, CAST(sum(d1) AS BIGINT) AS total_today, CAST(sum(d7) AS BIGINT) AS total_7d, CAST(sum(d30) AS BIGINT) AS total_30d,
  (SELECT error_type FROM e x WHERE x.dlq_topic = e.dlq_topic ORDER BY d7 DESC, error_type DESC LIMIT 1) AS dominant_error FROM e GROUP BY dlq_topic""",
)
def dlq_topic_summary(spark, folder):
    return dl.topic_summary(daily(spark, folder), as_of())


@register(
    "dlq_trend_report_windows",
    with_ctes(*BASE, TREND.format(x=0))
    + f"""SELECT day, dlq_topic, error_type, n AS today, CAST(s7 AS BIGINT) AS total_7d, CAST(s30 AS BIGINT) AS total_30d, {num('s7 / 7.0::DOUBLE')} AS avg_7d,
  CASE WHEN n * 6 > s7 - n THEN 'increasing' WHEN n * 6 < s7 - n THEN 'decreasing' ELSE 'stable' END AS trend FROM t WHERE dn = {AS_OF_NUMBER}""",
)
def dlq_trend_report(spark, folder):
    main = given.transactions(spark, folder).select(F.to_date("event_time").alias("day"))
    return dl.trend_report(daily(spark, folder), main, as_of())["windows"]


@register(
    "dlq_inspect",
    with_ctes(*BASE, "c AS (SELECT * FROM dlq QUALIFY row_number() OVER (PARTITION BY dlq_topic ORDER BY failed_ms, dlq_id) <= 50)")
    + """SELECT dlq_id, dlq_topic, error_type, failed_ms AS failed_at,
  CASE WHEN event_id % 23 = 0 THEN NULL ELSE '411111****' || right('4111111111' || lpad(CAST(event_id AS VARCHAR), 6, '0'), 4) END AS card,
  CASE WHEN event_id % 23 = 0 THEN '{"_raw":"broken ' || transaction_id || '"}' END AS broken FROM c""",
)
def dlq_inspect(spark, folder):
    shown = dl.inspect(letters(spark, folder), cap=50)
    broken = F.col("error_type") == dl.PARSE_ERROR
    return shown.select(
        "dlq_id", "dlq_topic", "error_type", "failed_at",
        F.get_json_object("masked_payload", "$.card_number").alias("card"),
        F.when(broken & F.col("masked_payload").contains("_raw"), pl.preview(F.col("payload_preview"))).alias("broken"),
    )


@register(
    "dlq_replay_plan",
    with_ctes(*BASE)
    + """SELECT dlq_id, dlq_topic, error_type, failed_ms, '[DRY RUN]' AS target_topic FROM dlq WHERE error_type IN ('schema_invalid', 'downstream_unavailable')
  ORDER BY failed_ms, dlq_id LIMIT 100""",
)
def dlq_replay_plan(spark, folder):
    plan = dl.replay_plan(letters(spark, folder), "txn.api", 100, ("schema_invalid", "downstream_unavailable"))
    return plan.select("dlq_id", "dlq_topic", "error_type", "failed_ms", "target_topic")


@register(
    "dlq_with_audit",
    with_ctes(*BASE, ENRICHED, DECIDED)
    + f"""SELECT q.dlq_id, q.transaction_id, e.account_id, {num('e.amount')} AS amount, d.decision, d.fraud_score FROM dlq q
  LEFT JOIN enr1 e ON e.transaction_id = q.transaction_id LEFT JOIN dec1 d ON d.transaction_id = q.transaction_id""",
)
def dlq_with_audit(spark, folder):
    from riskspark.plans import views

    audit = views.transaction_audit(given.enriched_table(spark, folder), given.decision_table(spark, folder))
    joined = dl.with_audit(letters(spark, folder), audit)
    return joined.select("dlq_id", "transaction_id", "account_id", "amount", "decision", "fraud_score")


@register(
    "dlq_minute_alarm",
    with_ctes(*BASE) + "SELECT failed_ms // 60000 * 60000 AS window_ms, error_type, count(*) AS letters FROM dlq GROUP BY ALL",
)
def dlq_minute_alarm(spark, folder):
    return monitors.dead_letter_alarm(letters(spark, folder), "failed_ms")


@register(
    "dlq_processing_envelope",
    with_ctes(*BASE)
    + """SELECT dlq_id, 'txn.api' AS source_topic, 0 AS source_partition, CAST(0 AS BIGINT) AS source_offset, transaction_id,
  'LATE_EVENT_BEYOND_ALLOWED_LATENESS' AS error_type, failed_ms AS watermark_at_rejection, failed_ms - 60000 AS event_time_at_rejection, failed_ms AS failed_at, 'host-1' AS processor_host FROM dlq""",
)
def dlq_processing_envelope(spark, folder):
    late = given.dead_letters(spark, folder).select(
        "dlq_id", "transaction_id",
        F.lit("LATE_EVENT_BEYOND_ALLOWED_LATENESS").alias("error_type"),
        F.lit("late").alias("error_message"),
        F.col("failed_at").alias("watermark_at_rejection"),
        F.timestamp_millis(F.col("failed_ms") - 60000).alias("event_time_at_rejection"),
        "failed_at",
    )
    built = dl.processing_envelopes(late, "txn.api", F.col("failed_at"), "host-1", dlq_id=F.col("dlq_id"))
    return built.drop("original_payload_bytes", "error_message", "processor_subtask_index")
