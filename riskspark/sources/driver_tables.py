"""The given test tables seen as payment data: every row of `events` is one transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# `props` is always {"k": number}; taking the number out as text costs far less than parsing.
PROPS_K = "cast(substring_index(substring_index(props, ': ', -1), '}', 1) AS bigint)"
ID = "lpad(cast(event_id AS string), greatest(12, length(cast(event_id AS string))), '0')"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Masked events with epoch-millisecond times next to the timestamps."""
    events = table(spark, folder, "events")
    naive = isinstance(events.schema["ts"].dataType, T.TimestampNTZType)
    millis = f"timestampdiff(MILLISECOND, {EPOCH}, ts)" if naive else "unix_millis(ts)"
    return events.selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        f"{millis} AS event_ms",
        f"{PROPS_K} AS k",
    ).selectExpr(
        f"concat('txn-', {ID}) AS transaction_id",
        "concat('acc-', user_id) AS account_id",
        "concat('mer-', k % 10) AS merchant_id",
        "cast(value AS decimal(18,4)) AS amount",
        "'USD' AS currency",
        "timestamp_millis(event_ms) AS event_time",
        "timestamp_millis(event_ms + event_id % 40) AS processing_time",
        "CASE event_type WHEN 'click' THEN 'WEB' WHEN 'view' THEN 'MOBILE' WHEN 'purchase' THEN 'POS' ELSE 'API' END AS channel",
        "'411111' AS card_bin",
        "lpad(cast(event_id % 10000 AS string), 4, '0') AS card_last4",
        "concat(user_id * 3 % 223 + 1, '.', user_id % 13, '.', k % 4 * 10, '.0') AS caller_ip_subnet",
        "CASE WHEN k % 25 <> 24 THEN concat('dev-', k % 20) END AS api_key_id",
        "'txn:write' AS oauth_scope",
        "cast(null AS float) AS geo_lat",
        "cast(null AS float) AS geo_lon",
        "'1.0.0' AS masking_lib_version",
        "event_id",
        "user_id",
        "event_ms",
        "event_ms + event_id % 40 AS processing_ms",
        "k",
        "event_type",
    )


def resent(rows: DataFrame) -> DataFrame:
    """Transactions plus re-sent copies: of every 10th after 30 h, of every 30th also after 50 and 100 h."""
    copies = rows.selectExpr(
        "*",
        "explode(CASE WHEN event_id % 30 = 0 THEN array(0, 30, 50, 100)"
        " WHEN event_id % 10 = 0 THEN array(0, 30) ELSE array(0) END) AS copy_hours",
    )
    shift = "cast(copy_hours AS bigint) * 3600000"
    moved = {
        "event_ms": f"event_ms + {shift}",
        "processing_ms": f"processing_ms + {shift}",
        "event_time": f"timestamp_millis(event_ms + {shift})",
        "processing_time": f"timestamp_millis(processing_ms + {shift})",
    }
    return copies.selectExpr(*[f"{moved[c]} AS {c}" if c in moved else c for c in copies.columns])


def geo_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Nested networks per nation: its /8 blocks, one /16, one /24 and one /28 inside them."""
    nation = table(spark, folder, "nation").selectExpr("n_nationkey AS n", "n_name")
    blocks = nation.selectExpr("*", "explode(sequence(1, 200)) AS octet").where("(octet - 1) % 25 = n")
    wide = blocks.selectExpr(
        "concat(octet, '.0.0.0') AS network", "8 AS prefix_len", "concat('C', n) AS country", "concat(n_name, '-wide') AS city",
        "cast(null AS string) AS network_class", "cast(null AS float) AS confidence",
    )
    inner = nation.selectExpr(
        "*",
        "stack(3, '0', 16, '-city', 'HOSTING', 0.5D, '20', 24, '-street', 'MOBILE', 0.75D,"
        " '30', 28, '-house', 'BUSINESS', 0.25D) AS (third, prefix_len, suffix, network_class, confidence)",
    ).selectExpr(
        "concat((n + 7) % 25 + 1, '.5.', third, '.0') AS network", "prefix_len", "concat('C', n) AS country",
        "concat(n_name, suffix) AS city", "network_class", "cast(confidence AS float) AS confidence",
    )
    return wide.unionByName(inner)


def geo_ranges_v6(spark: SparkSession, folder: str) -> DataFrame:
    """One network of 32 bits, and nested ones of 48, 64 and 96 bits for some nations."""
    nation = table(spark, folder, "nation").selectExpr("n_nationkey AS n", "n_name", "CASE WHEN n_nationkey = 24 THEN 'db9' ELSE 'db8' END AS g")
    inner = nation.selectExpr(
        "*", "stack(3, 48, '::', '-city', n % 3 <> 0, 64, ':20::', '-street', n % 5 = 0, 96, ':30::', '-house', n % 4 = 1) AS (len, tail, suffix, there)"
    ).where("there")
    found = inner.selectExpr("concat('2001:', g, ':', n, tail) AS network", "len AS prefix_len", "concat('C', n) AS country", "concat(n_name, suffix) AS city")
    wide = nation.where("n = 0").selectExpr("'2001:db8::' AS network", "32 AS prefix_len", "'V6' AS country", "'wide' AS city")
    return wide.unionByName(found).selectExpr("*", "cast(null AS string) AS network_class", "cast(null AS float) AS confidence")


def enriched_table(spark: SparkSession, folder: str) -> DataFrame:
    """A lake table in which every 10th transaction was written twice, the later copy with a higher amount."""
    copies = transactions(spark, folder).selectExpr(
        "*", "explode(CASE WHEN event_id % 10 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    )
    based = copies.selectExpr(
        "*",
        "cast(amount + copy AS decimal(18,4)) AS amt",
        "processing_ms + event_id % 120 + copy * 1000 AS enriched_ms",
        "CASE WHEN event_id % 11 <> 0 THEN concat('C', k % 25) END AS country",
        "cast(event_id % 9 + 1 AS int) AS cnt",
        "api_key_id IS NOT NULL AS has_device",
    )
    velocity = []
    for label, factor in (("1m", 1), ("5m", 2), ("1h", 3), ("24h", 4)):
        velocity += [
            f"cnt * {factor} AS vel_count_{label}",
            f"cast(amt * {factor} AS decimal(18,4)) AS vel_amount_{label}",
        ]
    return based.selectExpr(
        "transaction_id", "account_id", "merchant_id", "amt AS amount", "currency", "event_time",
        "timestamp_millis(enriched_ms) AS enrichment_time",
        "channel", "card_bin", "card_last4", "caller_ip_subnet", "coalesce(api_key_id, '') AS api_key_id",
        "oauth_scope", "geo_lat", "geo_lon", "masking_lib_version",
        *velocity,
        "country AS geo_country",
        "concat(country, '-city') AS geo_city",
        "CASE WHEN country IS NOT NULL THEN CASE WHEN k % 7 = 0 THEN 'HOSTING' ELSE 'RESIDENTIAL' END END AS geo_network_class",
        "cast(CASE WHEN country IS NOT NULL THEN 0.5 END AS float) AS geo_confidence",
        "CASE WHEN has_device THEN timestamp_millis(event_ms - event_id % 5 * 3600000) END AS device_first_seen",
        "CASE WHEN has_device THEN cast(event_id % 5 + 1 AS int) END AS device_txn_count",
        "CASE WHEN has_device THEN event_id % 97 = 0 END AS device_known_fraud",
        "CASE WHEN event_id % 5 <> 0 THEN concat('C', k % 24) END AS prev_geo_country",
        "CASE WHEN event_id % 5 <> 0 THEN timestamp_millis(event_ms - event_id % 5 * 600000) END AS prev_txn_time_ms",
        "cast(event_id % 120 AS int) AS enrichment_latency_ms",
        "'1.0' AS processor_version", "'1' AS schema_version",
        "event_ms", "enriched_ms", "event_id", "event_type",
    )


def decision_table(spark: SparkSession, folder: str) -> DataFrame:
    """A decision table by amount: every 20th decision was made twice, every 50th transaction has none."""
    copies = transactions(spark, folder).where("event_id % 50 <> 7").selectExpr(
        "*", "explode(CASE WHEN event_id % 20 = 0 THEN array(0, 1) ELSE array(0) END) AS copy"
    )
    shaped = copies.selectExpr(
        "*",
        "CASE WHEN copy = 1 OR amount >= 150 THEN 'BLOCK' WHEN amount >= 60 THEN 'FLAG' ELSE 'ALLOW' END AS decision",
        "processing_ms + 15 + copy * 5000 AS decided_ms",
    )
    return shaped.selectExpr(
        "transaction_id",
        "decision",
        "CASE decision WHEN 'ALLOW' THEN 0.0D WHEN 'FLAG' THEN 0.3D ELSE 0.8D END AS fraud_score",
        "array_compact(array(CASE WHEN decision = 'BLOCK' THEN 'VEL-001' END,"
        " CASE WHEN decision <> 'ALLOW' AND k % 2 = 0 THEN 'VEL-003' END,"
        " CASE WHEN decision <> 'ALLOW' AND k % 3 = 0 THEN 'XX-999' END,"
        " CASE WHEN decision = 'ALLOW' AND k % 10 = 0 THEN 'ND-001' END,"
        " CASE WHEN decision = 'FLAG' AND k % 5 = 0 THEN 'VEL-004:shadow' END)) AS rule_triggers",
        "concat('model-', event_id % 3) AS model_version",
        "timestamp_millis(decided_ms) AS decision_time_ms",
        "event_id % 97 / 4.0D AS latency_ms",
        "'1' AS schema_version",
        "array_compact(array(CASE WHEN k % 5 = 0 THEN 'VEL-004:shadow' END,"
        " CASE WHEN amount >= 100 THEN 'ND-002:shadow' END,"
        " CASE WHEN amount >= 20 THEN 'IT-001:shadow' END)) AS shadow_triggers",
        "decided_ms", "account_id", "event_ms", "event_id", "amount", "k",
    )


def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    """Error events as dead letters of the four topics; some payloads are not JSON."""
    errors = transactions(spark, folder).where("event_type = 'error'").selectExpr(
        "*",
        "get(array('schema_invalid', 'deserialization_failure', 'downstream_unavailable', 'late_event_beyond_window',"
        " 'unknown_error', 'enrichment_exception'), cast(k % 7 AS int)) AS kind",
    )
    return errors.selectExpr(
        f"concat('dlq-', {ID}) AS dlq_id",
        "get(array('txn.ingestion.dlq', 'txn.processing.dlq', 'txn.scoring.dlq', 'txn.fraud.alerts.dlq'),"
        " cast(k % 4 AS int)) AS dlq_topic",
        "transaction_id",
        "CASE WHEN event_id % 23 = 0 THEN concat('broken ', transaction_id) ELSE to_json(struct(kind AS error_type,"
        " transaction_id, concat('4111111111', lpad(cast(event_id AS string), 6, '0')) AS card_number,"
        " concat('9.', k % 10, '.1.2') AS ip)) END AS payload",
        "timestamp_millis(event_ms + 60) AS failed_at",
        "event_ms + 60 AS failed_ms",
        "event_id",
    )
