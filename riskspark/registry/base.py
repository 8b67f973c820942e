"""Registration, and SQL fragments shared by the checks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Only types both engines print alike: days as text, times as epoch ms, arrays joined."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, T.TimestampType):
            column = F.unix_millis(column)
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        elif isinstance(kind, T.BooleanType):
            column = column.cast("int")
        elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
            column = F.round(column.cast("double"), 6)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def wrap(function: Query) -> Query:
        def query(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # days are UTC days
            return portable(function(spark, folder))

        _QUERIES[name] = query
        if sql is not None:
            _SQL[name] = sql
        return function

    return wrap


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


DAY = 86_400_000


def day(ms: str) -> str:
    return f"strftime(epoch_ms(CAST({ms} AS BIGINT)), '%Y-%m-%d')"


def num(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6)"


TX = """
ev AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) // 1000 AS event_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
tx AS (
  SELECT 'txn-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS transaction_id,
         'acc-' || user_id AS account_id, 'mer-' || (k % 10) AS merchant_id,
         CAST(value AS DECIMAL(18,4)) AS amount, event_ms, event_ms + event_id % 40 AS processing_ms,
         CASE event_type WHEN 'click' THEN 'WEB' WHEN 'view' THEN 'MOBILE' WHEN 'purchase' THEN 'POS'
              ELSE 'API' END AS channel,
         (user_id * 3 % 223 + 1) || '.' || (user_id % 13) || '.' || (k % 4 * 10) || '.0' AS caller_ip_subnet,
         CASE WHEN k % 25 <> 24 THEN 'dev-' || (k % 20) END AS api_key_id,
         event_id, user_id, k, event_type
  FROM ev)"""

RESENT = """
resent AS (
  SELECT tx.* REPLACE (event_ms + h * 3600000 AS event_ms, processing_ms + h * 3600000 AS processing_ms),
         CAST(h AS INTEGER) AS copy_hours
  FROM tx, unnest(CASE WHEN event_id % 30 = 0 THEN [0, 30, 50, 100]
                       WHEN event_id % 10 = 0 THEN [0, 30] ELSE [0] END) AS u(h))"""

GEO = """
geo AS (
  SELECT 'C' || n_nationkey AS geo_country, n_name || '-wide' AS geo_city, 'RESIDENTIAL' AS geo_network_class,
         0.9::DOUBLE AS geo_confidence, 8 AS len, CAST(o AS BIGINT) * 16777216 AS lo,
         CAST(o AS BIGINT) * 16777216 + 16777215 AS hi
  FROM nation, range(1, 201) AS r(o) WHERE (o - 1) % 25 = n_nationkey
  UNION ALL
  SELECT 'C' || n_nationkey, n_name || suffix, class, conf, len, base + plus, base + plus + size - 1
  FROM (SELECT *, CAST((n_nationkey + 7) % 25 + 1 AS BIGINT) * 16777216 + 5 * 65536 AS base FROM nation),
       (VALUES ('-city', 'HOSTING', 0.5::DOUBLE, 16, 0, 65536), ('-street', 'MOBILE', 0.75, 24, 20 * 256, 256),
               ('-house', 'BUSINESS', 0.25, 28, 30 * 256, 16)) AS v(suffix, class, conf, len, plus, size)),
subnets AS (SELECT DISTINCT caller_ip_subnet, CAST(split_part(caller_ip_subnet, '.', 1) AS BIGINT) * 16777216
  + CAST(split_part(caller_ip_subnet, '.', 2) AS BIGINT) * 65536
  + CAST(split_part(caller_ip_subnet, '.', 3) AS BIGINT) * 256 + 1 AS ip FROM tx),
located AS (
  SELECT caller_ip_subnet, geo_country, geo_city, geo_network_class, geo_confidence
  FROM subnets JOIN geo ON ip BETWEEN lo AND hi
  QUALIFY row_number() OVER (PARTITION BY caller_ip_subnet ORDER BY len DESC) = 1)"""

WINDOWS = (("1m", 1), ("5m", 5), ("1h", 60), ("24h", 1440))


def velocity_cte(source: str, name: str = "vel") -> str:
    """Every earlier or equal row of the account within the window's minutes, by definition."""
    parts = []
    for label, minutes in WINDOWS:
        inside = f"FILTER (WHERE b.event_ms // 60000 >= a.event_ms // 60000 - {minutes})"
        parts.append(f"CAST(count(*) {inside} AS INTEGER) AS vel_count_{label}")
        parts.append(f"CAST(sum(b.amount) {inside} AS DECIMAL(18,4)) AS vel_amount_{label}")
    return f"""
{name} AS (
  SELECT a.transaction_id, {', '.join(parts)}
  FROM {source} a JOIN {source} b ON a.account_id = b.account_id
   AND (b.event_ms < a.event_ms OR (b.event_ms = a.event_ms AND b.transaction_id <= a.transaction_id))
  GROUP BY a.transaction_id)"""


def device_cte(source: str, name: str = "dev") -> str:
    """`source` has transaction_id, api_key_id, event_ms and geo_country."""
    return f"""
{name}_lag AS (
  SELECT transaction_id, api_key_id, event_ms, lag(event_ms) OVER w AS pm, lag(geo_country) OVER w AS pc
  FROM {source} WHERE api_key_id IS NOT NULL
  WINDOW w AS (PARTITION BY api_key_id ORDER BY event_ms, transaction_id)),
{name}_life AS (
  SELECT *, pm IS NULL OR event_ms - pm > {7 * DAY} AS fresh,
         sum(CASE WHEN pm IS NULL OR event_ms - pm > {7 * DAY} THEN 1 ELSE 0 END)
           OVER (PARTITION BY api_key_id ORDER BY event_ms, transaction_id ROWS UNBOUNDED PRECEDING) AS life
  FROM {name}_lag),
{name} AS (
  SELECT transaction_id, min(event_ms) OVER (PARTITION BY api_key_id, life) AS device_first_seen,
         CAST(row_number() OVER (PARTITION BY api_key_id, life ORDER BY event_ms, transaction_id) AS INTEGER)
           AS device_txn_count,
         0 AS device_known_fraud,
         CASE WHEN NOT fresh THEN pc END AS prev_geo_country,
         CASE WHEN NOT fresh THEN pm END AS prev_txn_time_ms,
         CASE WHEN row_number() OVER (PARTITION BY api_key_id, life ORDER BY event_ms, transaction_id) = 1
              THEN 1 ELSE 0 END AS device_is_new,
         CAST(row_number() OVER (PARTITION BY api_key_id ORDER BY event_ms, transaction_id)
           - count(*) OVER (PARTITION BY api_key_id ORDER BY event_ms // 60000
               RANGE BETWEEN UNBOUNDED PRECEDING AND 1441 PRECEDING) AS INTEGER) AS device_count_24h
  FROM {name}_life)"""


ENRICHED = """
enr AS (
  SELECT tx.* REPLACE (CAST(amount + c AS DECIMAL(18,4)) AS amount),
         processing_ms + event_id % 120 + c * 1000 AS enriched_ms,
         CASE WHEN event_id % 11 <> 0 THEN 'C' || (k % 25) END AS geo_country,
         CAST(event_id % 9 + 1 AS INTEGER) AS cnt, CAST(event_id % 120 AS INTEGER) AS enrichment_latency_ms
  FROM tx, unnest(CASE WHEN event_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS u(c)),
enr1 AS (SELECT * FROM enr QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY enriched_ms DESC, amount DESC) = 1)"""

DECIDED = """
dec0 AS (
  SELECT tx.*, c, CASE WHEN c = 1 OR amount >= 150 THEN 'BLOCK' WHEN amount >= 60 THEN 'FLAG' ELSE 'ALLOW' END AS decision,
         processing_ms + 15 + c * 5000 AS decided_ms
  FROM tx, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS u(c) WHERE event_id % 50 <> 7),
dec AS (
  SELECT transaction_id, decision,
         CASE decision WHEN 'ALLOW' THEN 0.0::DOUBLE WHEN 'FLAG' THEN 0.3::DOUBLE ELSE 0.8::DOUBLE END AS fraud_score,
         list_filter([CASE WHEN decision = 'BLOCK' THEN 'VEL-001' END,
           CASE WHEN decision <> 'ALLOW' AND k % 2 = 0 THEN 'VEL-003' END,
           CASE WHEN decision <> 'ALLOW' AND k % 3 = 0 THEN 'XX-999' END,
           CASE WHEN decision = 'ALLOW' AND k % 10 = 0 THEN 'ND-001' END,
           CASE WHEN decision = 'FLAG' AND k % 5 = 0 THEN 'VEL-004:shadow' END], lambda x: x IS NOT NULL) AS rule_triggers,
         list_filter([CASE WHEN k % 5 = 0 THEN 'VEL-004:shadow' END,
           CASE WHEN amount >= 100 THEN 'ND-002:shadow' END,
           CASE WHEN amount >= 20 THEN 'IT-001:shadow' END], lambda x: x IS NOT NULL) AS shadow_triggers,
         'model-' || (event_id % 3) AS model_version, decided_ms, (event_id % 97) / 4.0::DOUBLE AS latency_ms,
         account_id, event_ms, event_id, amount, k
  FROM dec0),
dec1 AS (SELECT *, strftime(epoch_ms(CAST(decided_ms AS BIGINT)), '%Y-%m-%d') AS decision_date FROM dec
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY decided_ms DESC) = 1)"""

LETTERS = """
dlq0 AS (
  SELECT *, CASE CAST(k % 7 AS INTEGER) WHEN 0 THEN 'schema_invalid' WHEN 1 THEN 'deserialization_failure'
      WHEN 2 THEN 'downstream_unavailable' WHEN 3 THEN 'late_event_beyond_window' WHEN 4 THEN 'unknown_error'
      WHEN 5 THEN 'enrichment_exception' END AS kind
  FROM tx WHERE event_type = 'error'),
dlq AS (
  SELECT 'dlq-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS dlq_id,
         CASE CAST(k % 4 AS INTEGER) WHEN 0 THEN 'txn.ingestion.dlq' WHEN 1 THEN 'txn.processing.dlq'
              WHEN 2 THEN 'txn.scoring.dlq' ELSE 'txn.fraud.alerts.dlq' END AS dlq_topic,
         transaction_id, CASE WHEN event_id % 23 = 0 THEN 'parse_error' ELSE coalesce(kind, 'parse_error') END AS error_type,
         event_ms + 60 AS failed_ms, event_id, k
  FROM dlq0),
daily AS (SELECT strftime(epoch_ms(CAST(failed_ms AS BIGINT)), '%Y-%m-%d') AS day,
  CAST(failed_ms // 86400000 AS BIGINT) AS dn, dlq_topic, error_type, count(*) AS n FROM dlq GROUP BY ALL)"""


def with_ctes(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(parts) + "\n"
