"""Feature publication and lookup, as-of joins, labels and training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions.clock import DAY_MS, HOUR_MS, naive_millis
from riskspark.operators import feedback
from riskspark.operators import features as ft
from riskspark.operators.decisions import latest_decisions, latest_enriched
from riskspark.registry.base import DECIDED, ENRICHED, TX, num, register, with_ctes
from riskspark.sources import driver_tables as given

BASE = (TX, ENRICHED, DECIDED)

FEATURES = """
ft0 AS (
  SELECT account_id, transaction_id, event_ms, enriched_ms, amount, CAST(cnt AS BIGINT) AS c, coalesce(geo_country, '') AS geo_country,
    CASE WHEN geo_country IS NULL THEN '' ELSE geo_country || '-city' END AS geo_city,
    CASE WHEN geo_country IS NULL THEN '' WHEN k % 7 = 0 THEN 'HOSTING' ELSE 'RESIDENTIAL' END AS geo_network_class,
    CASE WHEN geo_country IS NULL THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS geo_confidence,
    CASE WHEN api_key_id IS NOT NULL THEN event_ms - event_id % 5 * 3600000 END AS device_first_seen,
    CASE WHEN api_key_id IS NOT NULL THEN CAST(event_id % 5 + 1 AS BIGINT) ELSE 0 END AS device_txn_count,
    CASE WHEN api_key_id IS NOT NULL AND event_id % 97 = 0 THEN 1 ELSE 0 END AS device_known_fraud,
    CASE WHEN event_id % 5 <> 0 THEN 'C' || (k % 24) ELSE '' END AS prev_geo_country,
    CASE WHEN event_id % 5 <> 0 THEN event_ms - event_id % 5 * 600000 END AS prev_txn_time_ms
  FROM enr1),
ft AS (SELECT * FROM ft0 QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY event_ms DESC, transaction_id DESC) = 1)"""

VEL_SQL = ", ".join(
    f"c * {f} AS vel_count_{label}, {num(f'amount * {f}')} AS vel_amount_{label}"
    for label, f in (("1m", 1), ("5m", 2), ("1h", 3), ("24h", 4))
)
REST_SQL = "geo_country, geo_city, geo_network_class, geo_confidence, device_first_seen, device_txn_count, device_known_fraud, prev_geo_country, prev_txn_time_ms"


def given_views(spark, folder):
    return ft.feature_views(latest_enriched(given.enriched_table(spark, folder)))


@register("feature_publication", with_ctes(*BASE, FEATURES) + f"SELECT account_id, transaction_id, event_ms AS event_timestamp, {VEL_SQL} FROM ft0")
def feature_publication(spark, folder):
    return given_views(spark, folder)["velocity"]


@register("feature_latest", with_ctes(*BASE, FEATURES) + f"SELECT account_id, {VEL_SQL}, {REST_SQL} FROM ft")
def feature_latest(spark, folder):
    return ft.snapshot(given_views(spark, folder))


_ZERO = {"geo_country": "''", "geo_city": "''", "geo_network_class": "''", "prev_geo_country": "''"}


@register(
    "feature_lookup",
    with_ctes(*BASE, FEATURES, f"sn AS (SELECT account_id, {VEL_SQL}, {REST_SQL}, device_first_seen IS NOT NULL AND prev_txn_time_ms IS NOT NULL AS whole FROM ft)")
    + "SELECT transaction_id, account_id, "
    + ", ".join(
        f"CASE WHEN whole THEN {c} ELSE {_ZERO.get(c, '0')} END AS {c}"
        for c in ("vel_count_1m", "vel_amount_24h", "geo_country", "geo_confidence", "device_first_seen", "device_txn_count", "device_known_fraud", "prev_geo_country")
    )
    + ", CASE WHEN whole THEN 0 ELSE 1 END AS feature_miss FROM tx LEFT JOIN sn USING (account_id)",
)
def feature_lookup(spark, folder):
    tx = given.transactions(spark, folder).select("transaction_id", "account_id")
    served = ft.lookup(tx, ft.snapshot(given_views(spark, folder)), mode="overwrite")
    return served.select(
        "transaction_id", "account_id", "vel_count_1m", "vel_amount_24h", "geo_country", "geo_confidence",
        "device_first_seen", "device_txn_count", "device_known_fraud", "prev_geo_country", "feature_miss",
    )


AS_OF = """
fx AS (SELECT account_id, transaction_id AS f_id, event_ms AS f_ms, c AS vel_count_1m, amount AS a FROM ft0 WHERE right(transaction_id, 1) IN ('0', '3', '6')),
pairs AS (SELECT t.transaction_id, t.account_id, t.event_ms, f_ms, vel_count_1m, a FROM tx t LEFT JOIN fx ON fx.account_id = t.account_id AND f_ms <= t.event_ms
  QUALIFY row_number() OVER (PARTITION BY t.transaction_id ORDER BY f_ms DESC NULLS LAST, f_id DESC) = 1)"""


AS_OF_SQL = (
    with_ctes(*BASE, FEATURES, AS_OF)
    + f"""SELECT transaction_id, CASE WHEN event_ms - f_ms <= {2 * DAY_MS} THEN f_ms END AS feature_at_ms,
  CASE WHEN event_ms - f_ms <= {2 * DAY_MS} THEN vel_count_1m END AS vel_count_1m,
  {num(f'CASE WHEN event_ms - f_ms <= {2 * DAY_MS} THEN a END')} AS vel_amount_1m FROM pairs"""
)


@register("feature_asof", AS_OF_SQL)
def feature_asof(spark, folder, **options):
    """Features exist for some transactions only; those older than two days do not count."""
    view = given_views(spark, folder)["velocity"].where(F.right("transaction_id", F.lit(1)).isin("0", "3", "6"))
    timed = view.withColumn("feature_ms", F.unix_millis("event_timestamp"))
    tx = given.transactions(spark, folder).select("transaction_id", "account_id", "event_ms")
    found = ft.as_of(tx, timed, ["vel_count_1m", "vel_amount_1m"], 48 * HOUR_MS, **options)
    return found.select("transaction_id", "feature_at_ms", "vel_count_1m", "vel_amount_1m")


@register("feature_asof_hot", AS_OF_SQL)
def feature_asof_hot(spark, folder):
    return feature_asof(spark, folder, hot_rows=85)


@register(
    "order_asof_history",
    f"""WITH o AS (SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) // 1000 AS ms, o_totalprice FROM orders)
SELECT e.o_orderkey, p.ms AS feature_at_ms, {num('p.o_totalprice')} AS last_price FROM o e LEFT JOIN o p
  ON p.o_custkey = e.o_custkey AND p.o_orderkey % 2 = 0 AND p.ms <= e.ms AND e.ms - p.ms <= {365 * DAY_MS} WHERE e.o_orderkey % 2 = 1
  QUALIFY row_number() OVER (PARTITION BY e.o_orderkey ORDER BY p.ms DESC NULLS LAST, p.o_orderkey DESC) = 1""",
)
def order_asof(spark, folder):
    """Odd orders look up the customer's last even order within a year."""
    ms = naive_millis("o_orderdate")
    orders = given.table(spark, folder, "orders").select("o_orderkey", "o_custkey", ms.alias("ms"), "o_totalprice")
    entities = orders.where(F.col("o_orderkey") % 2 == 1).drop("o_totalprice")
    history = orders.where(F.col("o_orderkey") % 2 == 0).select(
        "o_orderkey", "o_custkey", F.col("ms").alias("feature_ms"), F.col("o_totalprice").alias("last_price")
    )
    found = ft.as_of(
        entities, history, ["last_price"], 365 * DAY_MS, key="o_custkey", entity_ms="ms", tiebreak="o_orderkey", chunk_ms=30 * DAY_MS
    )
    return found.select("o_orderkey", "feature_at_ms", "last_price")


LABELS = """
lab AS (
  SELECT transaction_id, CASE WHEN amount >= 100 THEN 'fraud' WHEN k % 3 = 0 THEN 'disputed' ELSE 'legitimate' END AS label,
         processing_ms + 15 + CAST(h AS BIGINT) * 3600000 AS labelled_ms
  FROM tx, unnest(CASE CAST(event_id % 4 AS INTEGER) WHEN 0 THEN [30] WHEN 1 THEN [10, 80] WHEN 2 THEN [24, 72] ELSE [] END) AS u(h)),
lj AS (
  SELECT d.*, l.label, l.labelled_ms AS label_ms, coalesce(l.label = 'fraud', false) AS is_fraud FROM dec1 d LEFT JOIN lab l
    ON l.transaction_id = d.transaction_id AND l.labelled_ms - d.decided_ms BETWEEN 86400000 AND 259200000
  QUALIFY row_number() OVER (PARTITION BY d.transaction_id ORDER BY l.labelled_ms DESC NULLS LAST) = 1)"""


def given_labels(spark, folder):
    """Labels 30 h after the decision, at the edges of the window, outside it, or none."""
    tx = given.transactions(spark, folder)
    n = F.col("event_id")
    delays = F.when(n % 4 == 0, F.array(F.lit(30))).when(n % 4 == 1, F.array(F.lit(10), F.lit(80))).when(n % 4 == 2, F.array(F.lit(24), F.lit(72)))
    label = F.when(F.col("amount") >= 100, "fraud").when(F.col("k") % 3 == 0, "disputed").otherwise("legitimate")
    return tx.select(
        "transaction_id", label.alias("label"), F.lit("bank").alias("label_source"), "processing_ms", F.explode(delays).alias("h")
    ).select("transaction_id", "label", "label_source", (F.col("processing_ms") + 15 + F.col("h") * F.lit(HOUR_MS)).alias("labelled_ms"))


def labelled(spark, folder):
    return feedback.join_labels(latest_decisions(given.decision_table(spark, folder)), given_labels(spark, folder))


OUTCOME = """CASE WHEN decision <> 'ALLOW' AND is_fraud THEN 'TP' WHEN decision <> 'ALLOW' THEN 'FP' WHEN is_fraud THEN 'FN' ELSE 'TN' END"""


@register(
    "label_feedback_join",
    with_ctes(*BASE, LABELS)
    + f"SELECT transaction_id, decision, label, label_ms, CASE WHEN is_fraud THEN 1 ELSE 0 END AS is_fraud, {OUTCOME} AS label_outcome FROM lj",
)
def label_feedback_join(spark, folder):
    return labelled(spark, folder).select("transaction_id", "decision", "label", "label_ms", "is_fraud", "label_outcome")


@register(
    "rule_precision",
    with_ctes(*BASE, LABELS)
    + f"""SELECT r AS rule_id, count(*) AS triggers, count(*) FILTER (WHERE is_fraud) AS frauds, count(*) FILTER (WHERE NOT is_fraud) AS false_positives,
  {num('count(*) FILTER (WHERE NOT is_fraud) / CAST(count(*) AS DOUBLE)')} AS fp_rate FROM lj, unnest(rule_triggers) AS u(r) GROUP BY ALL""",
)
def rule_precision(spark, folder):
    return feedback.rule_precision(labelled(spark, folder))


def _training_sql() -> str:
    ttl = {"velocity": 48, "geo": 24, "device": 14 * 24}
    values = {"velocity": ["vel_count_1m", "vel_amount_24h"], "geo": ["geo_country"], "device": ["device_txn_count", "prev_geo_country"]}
    ctes = [f"fa AS (SELECT account_id, transaction_id AS f_id, event_ms AS f_ms, {VEL_SQL}, {REST_SQL} FROM ft0)",
            """pt AS (SELECT l.transaction_id, l.event_ms, l.is_fraud, fa.* EXCLUDE (account_id) FROM lj l LEFT JOIN fa
  ON fa.account_id = l.account_id AND fa.f_ms <= l.event_ms
  QUALIFY row_number() OVER (PARTITION BY l.transaction_id ORDER BY f_ms DESC NULLS LAST, f_id DESC) = 1)"""]
    columns = ["transaction_id", "CASE WHEN is_fraud THEN 1 ELSE 0 END AS is_fraud"]
    for view, names in values.items():
        valid = f"event_ms - f_ms <= {ttl[view] * HOUR_MS}"
        columns.append(f"CASE WHEN {valid} THEN f_ms END AS {view}_at_ms")
        columns += [f"CASE WHEN {valid} THEN {name} END AS {name}" for name in names]
    return with_ctes(*BASE, FEATURES, LABELS, *ctes) + f"SELECT {', '.join(columns)} FROM pt"


@register("training_set", _training_sql())
def training_set(spark, folder):
    rows = labelled(spark, folder).select("transaction_id", "account_id", "event_ms", "is_fraud")
    features = ft.feature_table(latest_enriched(given.enriched_table(spark, folder)))
    result = feedback.training_set(rows, dict.fromkeys(("velocity", "geo", "device"), features))
    return result.select(
        "transaction_id", "is_fraud", "velocity_at_ms", "vel_count_1m", "vel_amount_24h",
        "geo_at_ms", "geo_country", "device_at_ms", "device_txn_count", "prev_geo_country",
    )


NOW = 1706659200000  # 2024-01-31T00:00:00Z, right after the last event


@register(
    "feature_freshness",
    with_ctes(*BASE, FEATURES)
    + f"SELECT max(event_ms) AS newest_ms, {NOW} - max(event_ms) AS lag_ms, CASE WHEN {NOW} - max(event_ms) > 30000 THEN 1 ELSE 0 END AS stale FROM ft0",
)
def feature_freshness(spark, folder):
    return ft.freshness(given_views(spark, folder)["velocity"], NOW)


@register(
    "document_label_join",
    """SELECT lang, source, count(*) AS documents, count(quality) AS labelled, CAST(coalesce(sum(toxic), 0) AS BIGINT) AS toxic,
  count(*) FILTER (WHERE quality = 1) AS good FROM documents LEFT JOIN labels USING (doc_id) GROUP BY ALL""",
)
def document_label_join(spark, folder):
    """Label join with the negative default on the document tables."""
    documents = given.table(spark, folder, "documents").select("doc_id", "lang", "source")
    joined = documents.join(given.table(spark, folder, "labels"), "doc_id", "left")
    return joined.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("documents"),
        F.count("quality").alias("labelled"),
        F.coalesce(F.sum("toxic"), F.lit(0)).cast("bigint").alias("toxic"),
        F.count_if(F.col("quality") == 1).alias("good"),
    )
