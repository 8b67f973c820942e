"""Deduplication, velocity, geo, device and the assembled record."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import clock
from riskspark.functions import ip as ipf
from riskspark.operators import dedup
from riskspark.operators.corrections import corrected
from riskspark.operators.assemble import add_features, assemble
from riskspark.operators.device import DEVICE_COLUMNS, device_features
from riskspark.operators.geo import GEO_COLUMNS, geo_enrich
from riskspark.operators.velocity import VELOCITY_COLUMNS, velocity_features
from riskspark.registry.base import DAY, GEO, RESENT, TX, WINDOWS, device_cte, num, register, velocity_cte, with_ctes
from riskspark.schemas import ENRICHED_TABLE, conform
from riskspark.sources import driver_tables as given

VELOCITY_OUT = ", ".join(
    f"vel_count_{label}, {num('vel_amount_' + label)} AS vel_amount_{label}" for label, _ in WINDOWS
)


VELOCITY_SQL = with_ctes(TX, velocity_cte("tx")) + f"SELECT transaction_id, {VELOCITY_OUT} FROM vel"


@register("velocity_features", VELOCITY_SQL)
def velocity(spark, folder):
    tx = given.transactions(spark, folder).select("transaction_id", "account_id", "event_ms", "amount")
    return velocity_features(tx).select("transaction_id", *VELOCITY_COLUMNS)


@register("velocity_hot_accounts", VELOCITY_SQL)
def velocity_hot(spark, folder):
    """The same with a limit that makes part of the accounts hot, so they are cut into chunks."""
    tx = given.transactions(spark, folder).select("transaction_id", "account_id", "event_ms", "amount")
    return velocity_features(tx, hot_rows=66).select("transaction_id", *VELOCITY_COLUMNS)


def _exact_sql() -> str:
    parts = []
    for label, minutes in WINDOWS:
        inside = f"FILTER (WHERE b.event_ms > a.event_ms - {minutes * 60000})"
        parts += [f"CAST(count(*) {inside} AS INTEGER) AS vel_count_{label}", f"{num(f'sum(b.amount) {inside}')} AS vel_amount_{label}"]
    return with_ctes(TX) + f"""
SELECT a.transaction_id, {', '.join(parts)}
FROM tx a JOIN tx b ON a.account_id = b.account_id
 AND (b.event_ms < a.event_ms OR (b.event_ms = a.event_ms AND b.transaction_id <= a.transaction_id))
GROUP BY a.transaction_id"""


EXACT_SQL = _exact_sql()


@register("velocity_exact_range", EXACT_SQL)
def velocity_exact(spark, folder):
    tx = given.transactions(spark, folder).select("transaction_id", "account_id", "event_ms", "amount")
    return velocity_features(tx, exact=True).select("transaction_id", *VELOCITY_COLUMNS)


@register("velocity_exact_hot", EXACT_SQL)
def velocity_exact_hot(spark, folder):
    tx = given.transactions(spark, folder).select("transaction_id", "account_id", "event_ms", "amount")
    return velocity_features(tx, exact=True, hot_rows=330).select("transaction_id", *VELOCITY_COLUMNS)


FINE_DEVICE = "fine AS (SELECT * REPLACE (api_key_id || '-' || (user_id % 50) AS api_key_id), 'C' || (k % 25) AS geo_country FROM tx)"
DEVICE_OUT = ("t.transaction_id, device_first_seen, device_txn_count, device_known_fraud, prev_geo_country,"
              " prev_txn_time_ms, device_is_new, device_count_24h")


DEVICE_SQL = with_ctes(TX, FINE_DEVICE, device_cte("fine")) + (
    f"SELECT {DEVICE_OUT} FROM fine t LEFT JOIN dev USING (transaction_id)"
)


def fine_devices(spark, folder):
    """So many devices that some of them go idle for more than a week."""
    return given.transactions(spark, folder).selectExpr(
        "transaction_id", "event_ms", "concat(api_key_id, '-', user_id % 50) AS api_key_id", "concat('C', k % 25) AS geo_country"
    )


@register("device_profile", DEVICE_SQL)
def device_profile(spark, folder):
    result = device_features(fine_devices(spark, folder))
    return result.select("transaction_id", *DEVICE_COLUMNS, "device_is_new", "device_count_24h")


@register("device_profile_hot", DEVICE_SQL)
def device_profile_hot(spark, folder):
    result = device_features(fine_devices(spark, folder), hot_rows=9)
    return result.select("transaction_id", *DEVICE_COLUMNS, "device_is_new", "device_count_24h")


@register(
    "dedup_first_48h",
    with_ctes(TX, RESENT, f"""
chain AS (
  SELECT transaction_id, min(event_ms) AS event_ms FROM resent GROUP BY transaction_id
  UNION ALL
  SELECT c.transaction_id, (SELECT min(r.event_ms) FROM resent r
      WHERE r.transaction_id = c.transaction_id AND r.event_ms >= c.event_ms + {2 * DAY}) AS event_ms
  FROM chain c WHERE c.event_ms IS NOT NULL)""")
    + "SELECT transaction_id, event_ms, copy_hours FROM resent JOIN chain USING (transaction_id, event_ms)",
)
def dedup_first(spark, folder):
    rows = given.resent(given.transactions(spark, folder)).select("transaction_id", "event_ms", "copy_hours")
    return dedup.first_within(rows, "transaction_id", "event_ms", "copy_hours", clock.hours(48))


@register(
    "dedup_batch_first",
    with_ctes(TX, RESENT)
    + "SELECT transaction_id, event_ms, copy_hours FROM resent QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY event_ms) = 1",
)
def dedup_batch(spark, folder):
    rows = given.resent(given.transactions(spark, folder)).select("transaction_id", "event_ms", "copy_hours")
    return dedup.first_per_key(rows, ["transaction_id"], "event_ms")


@register(
    "geo_enrich",
    with_ctes(TX, GEO)
    + f"""SELECT transaction_id, caller_ip_subnet, geo_country, geo_city, geo_network_class,
  {num('geo_confidence')} AS geo_confidence FROM tx LEFT JOIN located USING (caller_ip_subnet)""",
)
def geo(spark, folder):
    tx = given.transactions(spark, folder).select("transaction_id", "caller_ip_subnet")
    return geo_enrich(tx, given.geo_ranges(spark, folder)).select("transaction_id", "caller_ip_subnet", *GEO_COLUMNS)


FULL_CTES = (
    TX, GEO, velocity_cte("tx"),
    "placed AS (SELECT tx.*, geo_country, geo_city, geo_network_class, geo_confidence FROM tx LEFT JOIN located USING (caller_ip_subnet))",
    device_cte("placed"),
    """full_rec AS (
  SELECT p.*, vel.* EXCLUDE (transaction_id), dev.* EXCLUDE (transaction_id),
         processing_ms + event_id % 7 + 3 AS enrichment_time,
         CAST(event_id % 7 + 3 AS INTEGER) AS enrichment_latency_ms
  FROM placed p JOIN vel USING (transaction_id) LEFT JOIN dev USING (transaction_id))""",
)


def enriched_now(spark, folder):
    """Every transaction through the whole enrichment, with a fixed processing delay."""
    tx = given.transactions(spark, folder)
    featured = add_features(tx, given.geo_ranges(spark, folder))
    return assemble(featured, F.col("processing_ms") + F.col("event_id") % 7 + 3)


V6_SQL = with_ctes(TX, """
six AS (SELECT transaction_id, user_id % 25 AS n, k % 4 * 10 AS g FROM tx),
named AS (
  SELECT transaction_id, n, CASE WHEN g = 30 AND n % 4 = 1 THEN 'house' WHEN g = 20 AND n % 5 = 0 THEN 'street'
    WHEN n % 3 <> 0 THEN 'city' WHEN n <> 24 THEN 'wide' END AS place FROM six)""") + """
SELECT transaction_id, CASE WHEN place = 'wide' THEN 'V6' WHEN place IS NOT NULL THEN 'C' || n END AS geo_country,
  CASE WHEN place = 'wide' THEN place ELSE n_name || '-' || place END AS geo_city,
  CASE WHEN place IS NOT NULL THEN 'RESIDENTIAL' END AS geo_network_class FROM named JOIN nation ON n_nationkey = n"""


@register("geo_enrich_v6", V6_SQL)
def geo_v6(spark, folder):
    """IPv6 subnets in nested ranges of 32, 48, 64 and 96 bits."""
    group = "CASE WHEN user_id % 25 = 24 THEN 'db9' ELSE 'db8' END"
    tx = given.transactions(spark, folder).selectExpr(
        "transaction_id", f"concat('2001:', {group}, ':', user_id % 25, ':', k % 4 * 10, '::') AS caller_ip_subnet"
    )
    return geo_enrich(tx, given.geo_ranges_v6(spark, folder)).select("transaction_id", *GEO_COLUMNS[:3])


@register(
    "enriched_transactions",
    with_ctes(*FULL_CTES)
    + f"""SELECT transaction_id, account_id, merchant_id, {num('amount')} AS amount, 'USD' AS currency,
  event_ms AS event_time, processing_ms AS processing_time, channel, '411111' AS card_bin,
  lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') AS card_last4, caller_ip_subnet, api_key_id,
  'txn:write' AS oauth_scope, CAST(NULL AS DOUBLE) AS geo_lat, CAST(NULL AS DOUBLE) AS geo_lon,
  '1.0.0' AS masking_lib_version, {VELOCITY_OUT}, geo_country, geo_city, geo_network_class,
  {num('geo_confidence')} AS geo_confidence, device_first_seen, device_txn_count, device_known_fraud,
  prev_geo_country, prev_txn_time_ms, enrichment_time, enrichment_latency_ms,
  '002-stream-processor@1.0.0' AS processor_version, '1' AS schema_version,
  event_ms AS txn_time_ms, {num('amount')} AS txn_amount, device_is_new, device_count_24h FROM full_rec""",
)
def enriched_transactions(spark, folder):
    return enriched_now(spark, folder)


@register(
    "schema_conform",
    with_ctes(TX, velocity_cte("tx"))
    + """SELECT transaction_id, event_ms AS event_time, vel_count_1m, round(CAST(vel_amount_24h AS DOUBLE), 6) AS vel_amount_24h,
  CASE WHEN k % 4 IN (0, 1) THEN 1 WHEN k % 4 = 2 THEN 0 END AS device_known_fraud,
  CAST(NULL AS VARCHAR) AS geo_city, CASE WHEN k % 3 = 0 THEN CAST(NULL AS INTEGER) ELSE CAST(k AS INTEGER) END AS device_txn_count
  FROM tx JOIN vel USING (transaction_id)""",
)
def schema_conform(spark, folder):
    """Loosely typed rows: epoch times, text numbers, text booleans, a column missing."""
    tx = velocity_features(given.transactions(spark, folder))
    truth = F.get(F.array(F.lit("TRUE"), F.lit("yes"), F.lit("no"), F.lit(None)), (F.col("k") % 4).cast("int"))
    loose = tx.select(
        "*",
        truth.alias("device_known_fraud"),
        F.when(F.col("k") % 3 == 0, "n/a").otherwise(F.col("k").cast("string")).alias("device_txn_count"),
    ).drop("event_time").withColumnRenamed("event_ms", "event_time")
    fitted = conform(loose.withColumn("vel_count_1m", F.col("vel_count_1m").cast("string")), ENRICHED_TABLE)
    return fitted.select(
        "transaction_id", "event_time", "vel_count_1m", "vel_amount_24h", "device_known_fraud", "geo_city", "device_txn_count"
    )


@register(
    "late_corrections",
    with_ctes(TX, "punctual AS (SELECT * FROM tx WHERE event_id % 17 <> 3)", velocity_cte("punctual", "before"), velocity_cte("tx", "after"))
    + "SELECT a.transaction_id, "
    + ", ".join(f"a.vel_count_{label}, {num(f'a.vel_amount_{label}')} AS vel_amount_{label}" for label, _ in WINDOWS)
    + " FROM after a JOIN before b USING (transaction_id) WHERE "
    + " OR ".join(f"a.vel_count_{label} <> b.vel_count_{label}" for label, _ in WINDOWS),
)
def late_corrections(spark, folder):
    """Every 17th transaction arrives late; the rows it should have counted for are emitted again."""
    tx = given.transactions(spark, folder)
    stored = velocity_features(tx.where("event_id % 17 <> 3")).withColumn("enrichment_time", F.col("processing_time"))
    late = tx.where("event_id % 17 = 3")
    return corrected(stored, late, F.lit(0).cast("bigint")).select("transaction_id", *VELOCITY_COLUMNS)


V6_TEXT = """CASE CAST(event_id % 5 AS INTEGER)
    WHEN 0 THEN '2001:db8:' || to_hex(user_id) || ':0::1'
    WHEN 1 THEN '2001:0DB8:0000:00' || lpad(to_hex(k), 2, '0') || ':1:2:3:4'
    WHEN 2 THEN '::' || to_hex(k + 1)
    WHEN 3 THEN 'ff02::' || to_hex(k + 1)
    ELSE '2001:db8::1::' || k END"""


@register(
    "ip_truncate",
    with_ctes(TX)
    + f"""SELECT transaction_id, (user_id % 256) || '.' || k || '.' || (event_id % 300) || '.9' AS ip,
  CASE WHEN event_id % 300 > 255 OR user_id % 256 BETWEEN 224 AND 239 THEN NULL
       ELSE (user_id % 256) || '.' || k || '.' || (event_id % 300) || '.0' END AS subnet,
  lower({V6_TEXT}) AS ip6,
  CASE CAST(event_id % 5 AS INTEGER)
    WHEN 0 THEN CASE WHEN user_id = 0 THEN '2001:db8::' ELSE '2001:db8:' || lower(to_hex(user_id)) || '::' END
    WHEN 1 THEN CASE WHEN k = 0 THEN '2001:db8::' ELSE '2001:db8:0:' || lower(to_hex(k)) || '::' END
    WHEN 2 THEN '::' END AS subnet6,
  CASE CAST(event_id % 5 AS INTEGER) WHEN 3 THEN 'MULTICAST' WHEN 4 THEN 'MALFORMED' END AS error6 FROM tx""",
)
def ip_truncate(spark, folder):
    tx = given.transactions(spark, folder)
    user = F.col("user_id")
    k, n = F.col("k"), F.col("event_id")
    text = lambda c: c.cast("string")
    v4 = F.concat_ws(".", text(user % 256), text(k), text(n % 300), F.lit("9"))
    v6 = (
        F.when(n % 5 == 0, F.concat(F.lit("2001:db8:"), F.hex(user), F.lit(":0::1")))
        .when(n % 5 == 1, F.concat(F.lit("2001:0DB8:0000:00"), F.lpad(F.hex(k), 2, "0"), F.lit(":1:2:3:4")))
        .when(n % 5 == 2, F.concat(F.lit("::"), F.hex(k + 1)))
        .when(n % 5 == 3, F.concat(F.lit("ff02::"), F.hex(k + 1)))
        .otherwise(F.concat(F.lit("2001:db8::1::"), text(k)))
    )
    rows = tx.select("transaction_id", v4.alias("ip"), v6.alias("ip6"))
    return rows.select(
        "transaction_id",
        "ip",
        ipf.truncate_ip(F.col("ip")).alias("subnet"),
        F.lower("ip6").alias("ip6"),
        ipf.truncate_ip(F.col("ip6")).alias("subnet6"),
        ipf.ip_error(F.col("ip6")).alias("error6"),
    )


