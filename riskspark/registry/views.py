"""The analyst views and page reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark.operators import id_index
from riskspark.operators.dedup import latest_per_key
from riskspark.plans import reports, rollups, views
from riskspark.registry.base import DECIDED, ENRICHED, TX, num, register, with_ctes
from riskspark.registry.rules import SCALED_RULES
from riskspark.session import shared_folder, stored
from riskspark.sources import driver_tables as given

BASE = (TX, ENRICHED, DECIDED)
JOINED = "j AS (SELECT d.*, e.channel, e.merchant_id, e.geo_country, e.amount AS e_amount FROM dec1 d JOIN enr1 e USING (transaction_id))"


def both(spark, folder):
    return given.enriched_table(spark, folder), given.decision_table(spark, folder)


def _vel() -> str:
    parts = []
    for label, factor in (("1m", 1), ("5m", 2), ("1h", 3), ("24h", 4)):
        parts += [f"cnt * {factor} AS vel_count_{label}", f"{num(f'e.amount * {factor}')} AS vel_amount_{label}"]
    return ", ".join(parts)


AUDIT_SQL = f"""SELECT e.transaction_id, e.account_id, e.merchant_id, {num('e.amount')} AS amount, 'USD' AS currency, e.channel,
  e.event_ms AS event_time, e.enriched_ms AS enrichment_time, e.geo_country, e.geo_country || '-city' AS geo_city,
  CASE WHEN e.geo_country IS NOT NULL THEN CASE WHEN e.k % 7 = 0 THEN 'HOSTING' ELSE 'RESIDENTIAL' END END AS geo_network_class,
  CASE WHEN e.geo_country IS NOT NULL THEN 0.5::DOUBLE END AS geo_confidence,
  CASE WHEN e.api_key_id IS NOT NULL THEN CAST(e.event_id % 5 + 1 AS INTEGER) END AS device_txn_count,
  CASE WHEN e.api_key_id IS NOT NULL THEN CASE WHEN e.event_id % 97 = 0 THEN 1 ELSE 0 END END AS device_known_fraud,
  CASE WHEN e.event_id % 5 <> 0 THEN 'C' || (e.k % 24) END AS prev_geo_country,
  CASE WHEN e.event_id % 5 <> 0 THEN e.event_ms - e.event_id % 5 * 600000 END AS prev_txn_time_ms,
  {_vel()}, e.enrichment_latency_ms, d.decision, d.fraud_score, array_to_string(d.rule_triggers, ',') AS rule_triggers,
  d.model_version, d.decided_ms AS decision_time_ms, {num('d.latency_ms')} AS decision_latency_ms,
  CASE WHEN d.transaction_id IS NOT NULL THEN '1' END AS decision_schema_version
  FROM enr1 e LEFT JOIN dec1 d ON e.transaction_id = d.transaction_id"""


@register("transaction_audit", with_ctes(*BASE) + AUDIT_SQL)
def transaction_audit(spark, folder):
    return views.transaction_audit(*both(spark, folder))


@register("audit_lookup", with_ctes(*BASE) + AUDIT_SQL + " WHERE e.transaction_id = 'txn-000000000040'")
def audit_lookup(spark, folder):
    """One transaction; the filter reaches both sides before they are deduplicated."""
    return views.transaction_audit(*both(spark, folder), transaction_id="txn-000000000040")


@register("audit_lookup_indexed", with_ctes(*BASE) + AUDIT_SQL + " WHERE e.transaction_id = 'txn-000000000040'")
def audit_lookup_indexed(spark, folder):
    """The same from tables laid out by id: one bucket of each is opened."""
    sides = []
    for df in both(spark, folder):
        path = f"{shared_folder(spark)}/by-id-{uuid.uuid4().hex}"
        id_index.write_indexed(df, "transaction_id", path, buckets=16)
        sides.append(id_index.lookup(spark.read.parquet(path), "transaction_id", "txn-000000000040", buckets=16))
    return views.transaction_audit(*sides)


@register(
    "fraud_rate_daily",
    with_ctes(*BASE, JOINED)
    + f"""SELECT decision_date, channel, decision, count(*) AS transaction_count, {num('sum(e_amount)')} AS total_amount,
  {num('avg(fraud_score)')} AS avg_fraud_score, {num('quantile_disc(latency_ms, 0.99)')} AS p99_latency_ms FROM j GROUP BY ALL""",
)
def fraud_rate_daily(spark, folder):
    return views.fraud_rate_daily(*both(spark, folder))


@register(
    "fraud_rate_window",
    with_ctes(*BASE, """
newest AS (SELECT *, strftime(epoch_ms(CAST(decided_ms AS BIGINT)), '%Y-%m-%d') AS decision_date FROM dec
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY decided_ms DESC) = 1),
recent AS (SELECT * FROM newest WHERE decision_date BETWEEN '2024-01-10' AND '2024-01-16'),
j AS (SELECT d.*, e.channel, e.amount AS e_amount FROM recent d JOIN enr1 e USING (transaction_id))""")
    + f"""SELECT decision_date, channel, decision, count(*) AS transaction_count, {num('sum(e_amount)')} AS total_amount,
  {num('avg(fraud_score)')} AS avg_fraud_score, {num('quantile_disc(latency_ms, 0.99)')} AS p99_latency_ms FROM j GROUP BY ALL""",
)
def fraud_rate_window(spark, folder):
    """One week; the first day prunes partitions of a lake table, the last is cut after deduplication."""
    return views.fraud_rate_daily(*both(spark, folder), start="2024-01-10", end="2024-01-16")


@register(
    "fraud_rate_rollup",
    with_ctes(*BASE, JOINED)
    + f"""SELECT channel, decision, count(*) AS transaction_count, {num('sum(e_amount)')} AS total_amount, {num('avg(fraud_score)')} AS avg_fraud_score,
  1 AS p99_within FROM j WHERE decision_date BETWEEN '2024-01-03' AND '2024-03-31' GROUP BY ALL""",
)
def fraud_rate_rollup(spark, folder):
    """Ninety days from daily roll-ups; `p99_within` says that the sketched p99 is within 1 % of its rank in all rows."""
    rows = rollups.fraud_rate_rows(*both(spark, folder))
    window = ("2024-01-03", "2024-03-31")
    report = rollups.fraud_rate(stored(rollups.daily(rows, rollups.FRAUD_RATE)), *window)
    inside = rows.where(F.col("decision_date").between(*window))
    error = rollups.rank_error(report, inside, ["channel", "decision"], "p99_latency_ms", "latency_ms", 0.99)
    within = (F.col("rank_error") <= 0.01).alias("p99_within")
    return report.drop("p99_latency_ms").join(error.select("channel", "decision", within), ["channel", "decision"])


@register(
    "rule_triggers_daily",
    with_ctes(*BASE)
    + f"""SELECT decision_date, r AS rule_name, decision, count(*) AS trigger_count, {num('avg(fraud_score)')} AS avg_fraud_score,
  {num('quantile_disc(fraud_score, 0.5)')} AS median_fraud_score, {num('quantile_disc(fraud_score, 0.95)')} AS p95_fraud_score
  FROM dec1, unnest(rule_triggers) AS u(r) GROUP BY ALL""",
)
def rule_triggers_daily(spark, folder):
    return views.rule_triggers_daily(given.decision_table(spark, folder))


@register(
    "rule_drilldown",
    with_ctes(*BASE)
    + f"""SELECT decision_date, r AS rule_name, decision, count(*) AS trigger_count, {num('avg(fraud_score)')} AS avg_fraud_score,
  {num('quantile_disc(fraud_score, 0.5)')} AS median_fraud_score, {num('quantile_disc(fraud_score, 0.95)')} AS p95_fraud_score
  FROM dec1, unnest(rule_triggers) AS u(r) WHERE r = 'XX-999' GROUP BY ALL""",
)
def rule_drilldown(spark, folder):
    return views.rule_triggers_daily(given.decision_table(spark, folder), rule_name="XX-999")


@register(
    "model_versions",
    with_ctes(*BASE)
    + f"""SELECT model_version, decision_date, decision, count(*) AS transaction_count, {num('avg(fraud_score)')} AS avg_fraud_score,
  {num('quantile_disc(fraud_score, 0.5)')} AS median_fraud_score, {num('quantile_disc(fraud_score, 0.95)')} AS p95_fraud_score,
  {num('avg(latency_ms)')} AS avg_latency_ms, {num('quantile_disc(latency_ms, 0.99)')} AS p99_latency_ms FROM dec1 GROUP BY ALL""",
)
def model_versions(spark, folder):
    return views.model_versions(given.decision_table(spark, folder))


@register(
    "block_rate",
    with_ctes(*BASE)
    + f"""SELECT decision_date, count(*) FILTER (WHERE decision = 'BLOCK') AS blocked, count(*) AS total,
  {num("count(*) FILTER (WHERE decision = 'BLOCK') / CAST(count(*) AS DOUBLE)")} AS fraud_rate FROM dec1 GROUP BY ALL""",
)
def block_rate(spark, folder):
    return reports.block_rate(given.decision_table(spark, folder))


@register(
    "fraud_by_channel_pivot",
    with_ctes(*BASE, JOINED)
    + """SELECT channel, count(*) FILTER (WHERE decision = 'ALLOW') AS "ALLOW", count(*) FILTER (WHERE decision = 'FLAG') AS "FLAG",
  count(*) FILTER (WHERE decision = 'BLOCK') AS "BLOCK" FROM j GROUP BY ALL""",
)
def fraud_by_channel_pivot(spark, folder):
    return reports.channel_decision_pivot(*both(spark, folder))


@register(
    "merchant_fraud_topn",
    with_ctes(*BASE, JOINED)
    + f"""SELECT merchant_id, count(*) AS transactions, count(*) FILTER (WHERE decision = 'BLOCK') AS fraud_count,
  {num("coalesce(sum(e_amount) FILTER (WHERE decision = 'BLOCK'), 0)")} AS fraud_amount FROM j GROUP BY ALL
  ORDER BY fraud_count DESC, fraud_amount DESC, merchant_id LIMIT 5""",
)
def merchant_fraud_topn(spark, folder):
    return reports.merchant_fraud(*both(spark, folder), top_n=5)


@register(
    "geo_fraud",
    with_ctes(*BASE, JOINED)
    + f"""SELECT geo_country, count(*) AS transactions, count(*) FILTER (WHERE decision = 'BLOCK') AS fraud_count,
  {num("coalesce(sum(e_amount) FILTER (WHERE decision = 'BLOCK'), 0)")} AS fraud_amount,
  {num("count(*) FILTER (WHERE decision = 'BLOCK') / CAST(count(*) AS DOUBLE)")} AS fraud_rate FROM j GROUP BY ALL""",
)
def geo_fraud(spark, folder):
    return reports.geo_fraud(*both(spark, folder))


CATALOGUE_SQL = "cat AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{r.rule_id}', '{r.family}')" for r in SCALED_RULES if r.enabled
) + ") AS v(rule_name, family))"


@register(
    "rule_leaderboard",
    with_ctes(*BASE, CATALOGUE_SQL, """
agg AS (SELECT r AS rule_name, count(*) AS n, count(*) FILTER (WHERE decision = 'ALLOW') AS allowed, avg(fraud_score) AS a,
  quantile_disc(fraud_score, 0.5) AS m, quantile_disc(fraud_score, 0.95) AS p FROM dec1, unnest(rule_triggers) AS u(r) GROUP BY r)""")
    + f"""SELECT rule_name, coalesce(family, 'unknown') AS family, coalesce(n, 0) AS total_triggers,
  {num('coalesce(100.0::DOUBLE * n / (SELECT count(*) FROM dec1), 0)')} AS trigger_rate_pct,
  {num('coalesce(allowed / CAST(n AS DOUBLE), 0)')} AS fp_rate, {num('a')} AS avg_score, {num('m')} AS median_score, {num('p')} AS p95_score
  FROM agg FULL JOIN cat USING (rule_name)""",
)
def rule_leaderboard(spark, folder):
    return reports.rule_leaderboard(given.decision_table(spark, folder), SCALED_RULES)


@register(
    "rule_triggers_last_day",
    with_ctes(*BASE, """
newest AS (SELECT * FROM dec QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY decided_ms DESC) = 1),
recent AS (SELECT * FROM newest WHERE decided_ms > 1706000000000 - 86400000 AND decided_ms <= 1706000000000)""")
    + """SELECT r AS rule_name, decision, count(*) AS trigger_count FROM recent, unnest(rule_triggers) AS u(r) GROUP BY ALL""",
)
def rule_triggers_last_day(spark, folder):
    now = F.timestamp_millis(F.lit(1706000000000))
    recent = views.recent_decisions(given.decision_table(spark, folder), now, hours=24)
    return views.triggered(recent).groupBy("rule_name", "decision").agg(F.count(F.lit(1)).alias("trigger_count"))


@register(
    "model_summary",
    with_ctes(*BASE)
    + f"""SELECT model_version, count(*) AS total_txns, {num('avg(fraud_score)')} AS avg_score, {num('quantile_disc(fraud_score, 0.5)')} AS median_score,
  {num('quantile_disc(fraud_score, 0.95)')} AS p95_score, {num('avg(latency_ms)')} AS avg_latency_ms,
  {num('quantile_disc(latency_ms, 0.99)')} AS p99_latency_ms FROM dec1 GROUP BY ALL""",
)
def model_summary(spark, folder):
    return reports.model_summary(given.decision_table(spark, folder))


@register(
    "model_compare",
    with_ctes(*BASE, "kinds AS (SELECT model_version, decision_date, decision, avg(fraud_score) AS s FROM dec1 WHERE model_version IN ('model-0', 'model-2') GROUP BY ALL)",
        "a AS (SELECT decision_date, avg(s) AS version_a FROM kinds WHERE model_version = 'model-0' GROUP BY ALL)",
        "b AS (SELECT decision_date, avg(s) AS version_b FROM kinds WHERE model_version = 'model-2' GROUP BY ALL)")
    + f"SELECT decision_date, {num('version_a')} AS version_a, {num('version_b')} AS version_b FROM a FULL JOIN b USING (decision_date)",
)
def model_compare(spark, folder):
    return reports.model_compare(given.decision_table(spark, folder), "model-0", "model-2")


@register(
    "top_scored_decisions",
    with_ctes(*BASE)
    + f"""SELECT e.account_id, {num('e.amount')} AS amount, cnt * 3 AS vel_count_1h, decision, fraud_score, array_to_string(rule_triggers, ',') AS rule_triggers
  FROM enr e JOIN dec d USING (transaction_id) ORDER BY fraud_score DESC, transaction_id, decided_ms, e.amount LIMIT 20""",
)
def top_scored(spark, folder):
    return reports.top_scored(*both(spark, folder))


@register(
    "table_counts",
    with_ctes(*BASE)
    + "SELECT 'enriched_transactions' AS table_name, count(*) AS row_count FROM enr UNION ALL SELECT 'fraud_decisions', count(*) FROM dec",
)
def table_counts(spark, folder):
    enriched, decisions = both(spark, folder)
    return reports.table_counts({"enriched_transactions": enriched, "fraud_decisions": decisions})


@register(
    "approx_percentiles",
    with_ctes(*BASE)
    + f"""SELECT decision, {num('quantile_disc(latency_ms, 0.5)')} AS p50, {num('quantile_disc(latency_ms, 0.95)')} AS p95,
  {num('quantile_disc(latency_ms, 0.99)')} AS p99 FROM dec1 GROUP BY ALL""",
)
def approx_percentiles(spark, folder):
    shares = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    return views.current_decisions(given.decision_table(spark, folder)).groupBy("decision").agg(
        *[views.quantile("latency_ms", share).alias(name) for name, share in shares]
    )


@register(
    "customer_segment_orders",
    f"""SELECT n_name, c_mktsegment, count(*) AS orders, {num('sum(CAST(o_totalprice AS DECIMAL(18,4)))')} AS total_amount,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS finished FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""",
)
def customer_segment_orders(spark, folder):
    """The wide geographic breakdown on the order tables: orders are reduced per customer first."""
    orders = given.table(spark, folder, "orders").select("o_custkey", "o_orderstatus", "o_totalprice")
    per_customer = orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("o_totalprice").cast("decimal(18,4)")).alias("amount"),
        F.count_if(F.col("o_orderstatus") == "F").alias("done"),
    )
    customer = given.table(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = given.table(spark, folder, "nation").select("n_nationkey", "n_name")
    joined = per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy("n_name", "c_mktsegment").agg(
        F.sum("n").alias("orders"), F.sum("amount").alias("total_amount"), F.sum("done").alias("finished")
    )


@register(
    "latest_order_per_customer",
    f"""SELECT o_custkey, o_orderkey, epoch_us(o_orderdate) // 86400000000 AS order_day, {num('o_totalprice')} AS o_totalprice FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1""",
)
def latest_order(spark, folder):
    orders = given.table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    latest = latest_per_key(orders, ["o_custkey"], "o_orderdate", "o_orderkey")
    day = F.unix_date(F.to_date("o_orderdate")).cast("bigint")
    return latest.select("o_custkey", "o_orderkey", day.alias("order_day"), "o_totalprice")




def recent_cte(hours: int) -> str:
    """Latest decisions of the hours before the newest one, and these with their transactions."""
    return f"""
rec AS (SELECT * FROM dec WHERE decided_ms > (SELECT max(decided_ms) FROM dec) - {hours} * 3600000
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY decided_ms DESC) = 1),
jr AS (SELECT d.*, e.channel, e.merchant_id, e.geo_country, e.amount AS e_amount FROM rec d JOIN enr1 e USING (transaction_id))"""


def _breakdown_sql(column: str, hours: int, rate: bool) -> str:
    share = f""", {num("count(*) FILTER (WHERE decision = 'BLOCK') / CAST(count(*) AS DOUBLE)")} AS fraud_rate""" if rate else ""
    return with_ctes(*BASE, recent_cte(hours)) + f"""SELECT {column}, count(*) AS transactions, count(*) FILTER (WHERE decision = 'BLOCK') AS fraud_count,
  {num("coalesce(sum(e_amount) FILTER (WHERE decision = 'BLOCK'), 0)")} AS fraud_amount{share} FROM jr GROUP BY ALL"""


@register("channel_fraud_last_hour", _breakdown_sql("channel", 1, True))
def channel_fraud_last_hour(spark, folder):
    return reports.rolling(reports.channel_fraud, *both(spark, folder), hours=1)


@register("merchant_fraud_last_day", _breakdown_sql("merchant_id", 24, False))
def merchant_fraud_last_day(spark, folder):
    """Every merchant, of which there are ten here."""
    return reports.rolling(reports.merchant_fraud, *both(spark, folder), hours=24, top_n=1000)


@register("geo_fraud_last_week", _breakdown_sql("geo_country", 7 * 24, True))
def geo_fraud_last_week(spark, folder):
    return reports.rolling(reports.geo_fraud, *both(spark, folder), hours=7 * 24)


@register(
    "rule_leaderboard_last_week",
    with_ctes(*BASE, recent_cte(7 * 24), CATALOGUE_SQL, """
agg AS (SELECT r AS rule_name, count(*) AS n, count(*) FILTER (WHERE decision = 'ALLOW') AS allowed, avg(fraud_score) AS a,
  quantile_disc(fraud_score, 0.5) AS m, quantile_disc(fraud_score, 0.95) AS p FROM rec, unnest(rule_triggers) AS u(r) GROUP BY r)""")
    + f"""SELECT rule_name, coalesce(family, 'unknown') AS family, coalesce(n, 0) AS total_triggers,
  {num('coalesce(100.0::DOUBLE * n / (SELECT count(*) FROM rec), 0)')} AS trigger_rate_pct,
  {num('coalesce(allowed / CAST(n AS DOUBLE), 0)')} AS fp_rate, {num('a')} AS avg_score, {num('m')} AS median_score, {num('p')} AS p95_score
  FROM agg FULL JOIN cat USING (rule_name)""",
)
def rule_leaderboard_last_week(spark, folder):
    return reports.rule_leaderboard(reports.rolling_decisions(given.decision_table(spark, folder), 7 * 24), SCALED_RULES)


@register(
    "score_histogram",
    with_ctes(*BASE, """
b AS (SELECT model_version, CAST(greatest(0, least(19, floor(fraud_score * 20))) AS INTEGER) AS bin FROM dec1)""")
    + f"""SELECT model_version, bin, {num('bin / 20.0')} AS low, {num('(bin + 1) / 20.0')} AS high, count(*) AS decisions,
  {num('count(*) / CAST(sum(count(*)) OVER (PARTITION BY model_version) AS DOUBLE)')} AS share FROM b GROUP BY model_version, bin""",
)
def score_histogram(spark, folder):
    return reports.score_histogram(given.decision_table(spark, folder), bins=20)
