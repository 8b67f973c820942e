"""Monitors, audits, reconciliation and table upkeep."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators.dedup import keep_latest_ties
from riskspark.plans import hash_tree, maintenance, monitors, pii_audit, reconcile
from riskspark.registry.base import DAY, DECIDED, ENRICHED, TX, num, register, with_ctes
from riskspark.registry.rules import ALERTS, given_alerts
from riskspark.schemas import nullable
from riskspark.sources import driver_tables as given

BASE = (TX, ENRICHED, DECIDED)


@register(
    "latency_histogram",
    with_ctes(*BASE)
    + "SELECT enriched_ms // 300000 * 300000 AS window_ms, "
    + ", ".join(f"count(*) FILTER (WHERE enrichment_latency_ms <= {b}) AS le_{b}" for b in monitors.LATENCY_BUCKETS)
    + """, count(*) AS le_inf, quantile_disc(enrichment_latency_ms, 0.5) AS p50, quantile_disc(enrichment_latency_ms, 0.95) AS p95,
  quantile_disc(enrichment_latency_ms, 0.99) AS p99, CASE WHEN quantile_disc(enrichment_latency_ms, 0.99) > 20 THEN 1 ELSE 0 END AS p99_breach FROM enr GROUP BY ALL""",
)
def latency_histogram(spark, folder):
    return monitors.latency_histogram(given.enriched_table(spark, folder), "enrichment_latency_ms", "enriched_ms")


@register(
    "throughput_per_minute",
    with_ctes(TX)
    + f"""SELECT event_ms // 60000 * 60000 AS window_ms, count(*) AS events, count(*) FILTER (WHERE event_type = 'error') AS errors,
  {num('count(*) / 60.0::DOUBLE')} AS per_second, {num("count(*) FILTER (WHERE event_type = 'error') / CAST(count(*) AS DOUBLE)")} AS error_rate FROM tx GROUP BY ALL""",
)
def throughput_per_minute(spark, folder):
    return monitors.throughput(given.transactions(spark, folder), "event_ms", F.col("event_type") == "error")


@register(
    "flag_rate_by_severity",
    with_ctes(TX, DECIDED, ALERTS)
    + "SELECT evaluation_ms // 3600000 * 3600000 AS window_ms, severity, count(*) AS alerts FROM al GROUP BY ALL",
)
def flag_rate(spark, folder):
    return monitors.severity_rate(given_alerts(spark, folder), "evaluation_ms", minutes=60)


@register(
    "alert_burst",
    with_ctes(TX, DECIDED, ALERTS)
    + f"""SELECT evaluation_ms // 300000 * 300000 AS window_ms, count(*) AS alerts, {num('count(*) / 300.0::DOUBLE')} AS per_second FROM al
  GROUP BY ALL HAVING count(*) / 300.0 > 0.005""",
)
def alert_burst(spark, folder):
    """With a limit the given tables reach: two alerts in five minutes."""
    return monitors.alert_burst(given_alerts(spark, folder), "evaluation_ms", limit=0.005)


@register(
    "silent_interval_alert",
    with_ctes(TX, """
b AS (SELECT min(event_ms // 60000) + 18 AS lo, max(event_ms // 60000) AS hi FROM tx),
spine AS (SELECT unnest(range(lo, hi + 1)) AS m FROM b),
f AS (SELECT DISTINCT event_ms // 60000 AS m FROM tx WHERE amount >= 100)""")
    + "SELECT s.m * 60000 AS minute_ms FROM spine s WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.m BETWEEN s.m - 18 AND s.m)",
)
def silent_interval(spark, folder):
    return monitors.silent_minutes(given.transactions(spark, folder), "event_ms", F.col("amount") >= 100)


@register(
    "watermark_stall",
    with_ctes(TX, """
w AS (SELECT processing_ms AS t, event_ms - k % 50 * 60000 AS mark, event_id FROM tx),
m AS (SELECT t, mark, max(mark) OVER (ORDER BY t, mark DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM w),
s AS (SELECT t, lag(t) OVER (ORDER BY t) AS from_ms FROM m WHERE reached IS NULL OR mark > reached)""")
    + "SELECT from_ms, t AS to_ms, t - from_ms AS stalled_ms FROM s WHERE t - from_ms > 1800000",
)
def watermark_stall(spark, folder):
    """Rows up to 50 minutes behind; stalls of more than half an hour."""
    rows = given.transactions(spark, folder).selectExpr("processing_ms", "event_ms - k % 50 * 60000 AS mark")
    return monitors.stalled_watermark(rows, "processing_ms", "mark", limit_ms=1_800_000)


@register(
    "late_event_split",
    with_ctes(TX, """
w AS (SELECT *, CASE WHEN event_id % 9 <> 0 THEN event_ms + CASE CAST(k % 5 AS INTEGER) WHEN 0 THEN -10000 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 30000 ELSE 30001 END END AS mark FROM tx),
s AS (SELECT *, CASE WHEN mark IS NULL THEN 'on_time' WHEN event_ms < mark - 30000 THEN 'beyond' WHEN event_ms < mark THEN 'within' ELSE 'on_time' END AS lateness FROM w)""")
    + """SELECT event_ms // 86400000 * 86400000 AS window_ms, count(*) FILTER (WHERE lateness = 'within') AS late_within,
  count(*) FILTER (WHERE lateness = 'beyond') AS late_beyond, count(*) AS events FROM s GROUP BY ALL""",
)
def late_event_split(spark, folder):
    shifts = F.array(*[F.lit(x) for x in (-10000, 0, 1, 30000, 30001)])
    mark = F.when(F.col("event_id") % 9 != 0, F.col("event_ms") + F.get(shifts, (F.col("k") % 5).cast("int")))
    rows = given.transactions(spark, folder).withColumn("mark", mark)
    return monitors.late_counts(monitors.late_split(rows, "event_ms", "mark"), "event_ms")


@register(
    "recent_alerts",
    with_ctes(TX, DECIDED, ALERTS)
    + """SELECT max(evaluation_ms) FILTER (WHERE evaluation_ms <= 1706000000000) AS newest_ms,
  count(*) FILTER (WHERE evaluation_ms BETWEEN 1706000000000 - 60000 AND 1706000000000) AS alerts_1m,
  count(*) FILTER (WHERE evaluation_ms BETWEEN 1706000000000 - 300000 AND 1706000000000) AS alerts_5m FROM al""",
)
def recent_alerts(spark, folder):
    return monitors.recent_alerts(given_alerts(spark, folder), 1706000000000, "evaluation_ms")


def _pii_sql() -> str:
    tables = (("documents", "text"), ("pages", "html"), ("pages", "url"), ("conversations", "text"), ("conversations", "role"), ("documents", "lang"), ("documents", "source"))
    cells = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{c}' AS matched_field, {c} AS txt FROM {t}" for t, c in tables)
    octet = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
    return f"""
WITH cells AS ({cells}),
v4 AS (SELECT table_name, matched_field, txt, unnest(regexp_extract_all(txt, '\\b[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}\\.[0-9]{{1,3}}(?:/[0-9]{{1,2}})?\\b')) AS c FROM cells),
v6 AS (SELECT table_name, matched_field, txt, unnest(regexp_extract_all(txt, '(?:^|[^0-9A-Za-z_:])((?:[0-9A-Fa-f]{{0,4}}:){{2,7}}[0-9A-Fa-f]{{0,4}})(?:$|[^0-9A-Za-z_:])', 1)) AS c FROM cells),
hits AS (
  SELECT table_name, matched_field, txt, 'PAN' AS p FROM cells WHERE regexp_matches(txt, '\\b\\d{{4}}[\\s-]?\\d{{4}}[\\s-]?\\d{{4}}[\\s-]?\\d{{4}}\\b')
  UNION ALL SELECT DISTINCT table_name, matched_field, txt, 'IPv4' FROM v4
   WHERE regexp_matches(split_part(c, '/', 1), '^{octet}(\\.{octet}){{3}}$') AND coalesce(try_cast(nullif(split_part(c, '/', 2), '') AS INTEGER), 99) > 24
     AND NOT regexp_matches(split_part(c, '/', 1), '^(10\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.|192\\.168\\.|127\\.0\\.0\\.1$)')
  UNION ALL SELECT DISTINCT table_name, matched_field, txt, 'IPv6' FROM v6
   WHERE length(c) > 2 AND (regexp_matches(c, '^([0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}$')
     OR (regexp_matches(c, '^(([0-9A-Fa-f]{{1,4}}:)*[0-9A-Fa-f]{{1,4}})?::(([0-9A-Fa-f]{{1,4}}:)*[0-9A-Fa-f]{{1,4}})?$') AND len(list_filter(string_split(c, ':'), lambda g: g <> '')) <= 7)))
"""


# DISTINCT in the check counts equal texts once; rows per text are joined back to count copies.
PII_SQL = _pii_sql() + """, d AS (SELECT DISTINCT table_name, matched_field, txt, p FROM hits)
SELECT table_name, matched_field, p AS matched_pattern, sha256(txt) AS record_sample_hash, count(*) AS matches
FROM d JOIN cells USING (table_name, matched_field, txt) GROUP BY ALL"""


def given_texts(spark, folder):
    return {name: given.table(spark, folder, name) for name in ("documents", "pages", "conversations")}


def findings(spark, folder):
    parts = [pii_audit.content_findings(name, df) for name, df in given_texts(spark, folder).items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@register("pii_audit_findings", PII_SQL)
def pii_findings(spark, folder):
    return findings(spark, folder)


@register(
    "pii_audit_summary",
    _pii_sql() + """, d AS (SELECT DISTINCT table_name, matched_field, txt, p FROM hits),
n AS (SELECT table_name, matched_field, txt, count(*) AS n FROM cells GROUP BY ALL)
SELECT table_name, matched_field, p AS matched_pattern, CAST(sum(n) AS BIGINT) AS matches, count(*) AS distinct_records
FROM d JOIN n USING (table_name, matched_field, txt) GROUP BY ALL""",
)
def pii_summary(spark, folder):
    return pii_audit.summary(findings(spark, folder))


@register(
    "pii_scan_log",
    _pii_sql() + """, d AS (SELECT DISTINCT table_name, matched_field, txt, p FROM hits)
SELECT 'audit-scan-20240131-00000000' AS scan_id, table_name, matched_field, p AS matched_pattern, sha256(txt) AS record_sample_hash,
  CASE WHEN p = 'PAN' THEN 'TABLE_HALTED' ELSE 'ALERT_SENT' END AS action_taken FROM d""",
)
def pii_scan_log(spark, folder):
    log = pii_audit.audit(given_texts(spark, folder), "audit-scan-20240131-00000000", F.current_timestamp())
    return log.drop("scan_timestamp")


RECON = """
s AS (SELECT transaction_id FROM tx WHERE event_id % 41 <> 3), e AS (SELECT DISTINCT transaction_id FROM enr WHERE event_id % 37 <> 5), d AS (SELECT DISTINCT transaction_id FROM dec)"""


RECON_SQL = (
    with_ctes(*BASE, RECON, """
c AS (SELECT (SELECT count(*) FROM s) AS source_ids, (SELECT count(*) FROM e) AS enriched_ids, (SELECT count(*) FROM d) AS decision_ids,
  (SELECT count(*) FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM e)) AS missing_enriched,
  (SELECT count(*) FROM e WHERE transaction_id NOT IN (SELECT transaction_id FROM s)) AS unexpected_enriched,
  (SELECT count(*) FROM e WHERE transaction_id NOT IN (SELECT transaction_id FROM d)) AS missing_decisions,
  (SELECT count(*) FROM d WHERE transaction_id NOT IN (SELECT transaction_id FROM e)) AS unexpected_decisions)""")
    + f"""SELECT *, {num('missing_enriched / CAST(source_ids AS DOUBLE)')} AS gap,
  CASE WHEN missing_enriched / CAST(source_ids AS DOUBLE) <= 0.001 THEN 1 ELSE 0 END AS within_limit FROM c"""
)


@register("reconciliation", RECON_SQL)
def reconciliation(spark, folder):
    source = given.transactions(spark, folder).where(F.col("event_id") % 41 != 3)
    enriched = given.enriched_table(spark, folder).where(F.col("event_id") % 37 != 5)
    return reconcile.report(source, enriched, given.decision_table(spark, folder))


@register("reconciliation_tree", RECON_SQL)
def reconciliation_tree(spark, folder):
    """The same row from hash trees: only ids of ranges that differ are compared one by one."""
    source = given.transactions(spark, folder).where(F.col("event_id") % 41 != 3)
    enriched = given.enriched_table(spark, folder).where(F.col("event_id") % 37 != 5)
    return hash_tree.report(source, enriched, given.decision_table(spark, folder))


@register(
    "missing_transactions",
    with_ctes(*BASE, RECON) + "SELECT transaction_id FROM s WHERE transaction_id NOT IN (SELECT transaction_id FROM e)",
)
def missing_transactions(spark, folder):
    source = given.transactions(spark, folder).where(F.col("event_id") % 41 != 3)
    enriched = given.enriched_table(spark, folder).where(F.col("event_id") % 37 != 5)
    return reconcile.missing(source, enriched)


@register(
    "compaction_latest",
    with_ctes(*BASE) + f"SELECT transaction_id, enriched_ms, {num('amount')} AS amount FROM enr1",
)
def compaction_latest(spark, folder):
    rows = given.enriched_table(spark, folder).select("transaction_id", "enriched_ms", "amount")
    return maintenance.compacted(rows, "transaction_id", "enriched_ms", "amount")


@register(
    "compaction_keep_ties",
    with_ctes(*BASE)
    + f"""SELECT transaction_id, processing_ms AS version, {num('amount')} AS amount FROM enr WHERE (transaction_id, processing_ms) IN
  (SELECT (transaction_id, max(processing_ms)) FROM enr GROUP BY transaction_id)""",
)
def compaction_ties(spark, folder):
    """Copies share their version here, so both stay, as in a delete of all but the maximum."""
    rows = given.enriched_table(spark, folder)
    version = F.unix_millis("event_time") + F.col("event_id") % 40
    return keep_latest_ties(rows.select("transaction_id", version.alias("version"), "amount"), "transaction_id", "version")


@register(
    "retention_purge",
    """WITH o AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderdate FROM orders)
SELECT day, count(*) AS "rows" FROM o WHERE o_orderdate < DATE '2003-06-30' - INTERVAL 7 YEAR GROUP BY ALL""",
)
def retention_purge(spark, folder):
    orders = given.table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day"))
    return maintenance.expired_days(orders, "day", F.lit("2003-06-30").cast("date"))


@register(
    "retention_kept",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate >= DATE '2003-06-30' - INTERVAL 7 YEAR""",
)
def retention_kept(spark, folder):
    orders = given.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    return maintenance.retained(orders, "day", F.lit("2003-06-30").cast("date"))


@register(
    "schema_old_files_merge",
    "SELECT p_partkey, p_brand, p_size, CAST(NULL AS VARCHAR) AS p_comment, CAST(NULL AS DOUBLE) AS p_weight FROM part",
)
def schema_old_files(spark, folder):
    """Files written before two nullable columns were added."""
    newer = nullable("p_partkey bigint, p_brand string, p_size int, p_comment string, p_weight double")
    return maintenance.read_evolved(spark, f"{folder}/part.parquet", newer)


@register(
    "daily_volume",
    with_ctes(TX) + f"SELECT event_ms // {DAY} * {DAY} AS window_ms, count(*) AS events FROM tx GROUP BY ALL",
)
def daily_volume(spark, folder):
    tx = given.transactions(spark, folder)
    return tx.groupBy(monitors.window_start("event_ms", 1440)).agg(F.count(F.lit(1)).alias("events"))
