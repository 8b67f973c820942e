"""Validation, masking and dead letters of raw payloads."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import cards
from riskspark.functions import payload as pl
from riskspark.operators import ingest as ing
from riskspark.registry.base import TX, num, register, with_ctes
from riskspark.sources import driver_tables as given
from riskspark.sources import framed_avro

# A card number per event: most have 16 digits, some 15 or too few, some letters or separators.
RAW_SQL = """
luhn AS (SELECT event_id, '4' || lpad(CAST(event_id * 7919 % 1000000000 AS VARCHAR), 14, '0') AS head FROM tx),
raw AS (
  SELECT tx.*, CASE WHEN tx.event_id % 31 = 3 THEN '' ELSE transaction_id END AS tid,
    CASE CAST(tx.event_id % 13 AS INTEGER) WHEN 1 THEN '0' WHEN 2 THEN '-5' WHEN 3 THEN 'abc' WHEN 4 THEN NULL ELSE CAST(amount AS VARCHAR) END AS amount_text,
    CASE WHEN tx.event_id % 17 = 5 THEN 'USDX' ELSE 'USD' END AS cur,
    CASE WHEN event_type = 'error' THEN 'FAX' ELSE channel END AS ch,
    CASE CAST(tx.event_id % 11 AS INTEGER) WHEN 1 THEN substr(head, 1, 4) || '-' || substr(head, 5) || (tx.event_id % 10)
      WHEN 2 THEN substr(head, 1, 15) WHEN 3 THEN substr(head, 1, 13) WHEN 4 THEN head || 'x' WHEN 5 THEN '' ELSE head || (tx.event_id % 10) END AS card,
    CASE CAST(tx.event_id % 19 AS INTEGER) WHEN 1 THEN '239.1.1.1' WHEN 2 THEN '1.2.3' ELSE (user_id % 223 + 1) || '.' || (k % 13) || '.7.9' END AS ip,
    CASE WHEN tx.event_id % 29 = 1 THEN '' ELSE 'key' END AS api, event_ms + CASE CAST(tx.event_id % 23 AS INTEGER) WHEN 1 THEN 300000 WHEN 2 THEN 300001 ELSE 500 END AS now_ms
  FROM tx JOIN luhn USING (event_id))"""


def raw_payloads(spark, folder):
    tx = given.transactions(spark, folder)
    n, text = F.col("event_id"), lambda c: c.cast("string")
    head = F.concat(F.lit("4"), F.lpad(text(n * 7919 % 1000000000), 14, "0"))
    last = text(n % 10)
    user = F.col("user_id")

    def pick(modulus, cases, default):
        value = default
        for rest, case in cases.items():
            value = F.when(n % modulus == rest, case).otherwise(value)
        return value

    card = pick(
        11,
        {
            1: F.concat(F.substring(head, 1, 4), F.lit("-"), F.expr("substring(head_, 5)"), last),
            2: F.substring(head, 1, 15),
            3: F.substring(head, 1, 13),
            4: F.concat(head, F.lit("x")),
            5: F.lit(""),
        },
        F.concat(head, last),
    )
    amount = pick(13, {1: F.lit("0"), 2: F.lit("-5"), 3: F.lit("abc"), 4: F.lit(None)}, text(F.col("amount")))
    home = F.concat_ws(".", text(user % 223 + 1), text(F.col("k") % 13), F.lit("7"), F.lit("9"))
    late = pick(23, {1: F.lit(300000), 2: F.lit(300001)}, F.lit(500))
    return tx.withColumn("head_", head).select(
        F.when(n % 31 == 3, "").otherwise(F.col("transaction_id")).alias("transaction_id"),
        "account_id",
        "merchant_id",
        amount.alias("amount"),
        F.when(n % 17 == 5, "USDX").otherwise("USD").alias("currency"),
        F.col("event_ms").alias("event_time"),
        F.when(F.col("event_type") == "error", "FAX").otherwise(F.col("channel")).alias("channel"),
        card.alias("card_number"),
        pick(19, {1: F.lit("239.1.1.1"), 2: F.lit("1.2.3")}, home).alias("caller_ip"),
        F.when(n % 29 == 1, "").otherwise("key").alias("api_key_id"),
        F.lit("txn:write").alias("oauth_scope"),
        n.alias("event_id"),
        (F.col("event_ms") + late).alias("now_ms"),
    )


CHECKED = """
digits AS (SELECT *, replace(card, '-', '') AS d FROM raw),
luhned AS (
  SELECT *, (SELECT sum(CASE WHEN i % 2 = 1 THEN CASE WHEN 2 * v > 9 THEN 2 * v - 9 ELSE 2 * v END ELSE v END)
             FROM (SELECT i, CAST(substr(reverse(d), CAST(i + 1 AS INTEGER), 1) AS INTEGER) AS v FROM range(0, length(d)) AS r(i))) AS total
  FROM (SELECT * REPLACE (CASE WHEN regexp_matches(d, '^[0-9]+$') THEN d ELSE '1' END AS d), d AS d0 FROM digits)),
checked AS (
  SELECT *, list_filter([CASE WHEN tid = '' THEN 'transaction_id' END, CASE WHEN amount_text IS NULL THEN 'amount' END,
      CASE WHEN card = '' THEN 'card_number' END, CASE WHEN api = '' THEN 'api_key_id' END], lambda x: x IS NOT NULL) AS missing,
    list_filter([CASE WHEN try_cast(amount_text AS DOUBLE) IS NULL THEN 'amount must be a numeric value'
                      WHEN try_cast(amount_text AS DOUBLE) <= 0 THEN 'amount must be > 0' END,
      CASE WHEN length(cur) <> 3 THEN 'currency must be a 3-character ISO-4217 code' END,
      CASE WHEN ch = 'FAX' THEN 'channel must be one of [''API'', ''MOBILE'', ''POS'', ''WEB'']' END,
      CASE WHEN abs(now_ms - event_ms) > 300000 THEN 'event_time is more than 5 minutes from server time' END], lambda x: x IS NOT NULL) AS errs,
    CASE WHEN NOT regexp_matches(d0, '^[0-9]+$') THEN 'NON_DIGIT' WHEN length(d0) NOT IN (15, 16) THEN 'BAD_LENGTH' WHEN total % 10 <> 0 THEN 'CHECK_DIGIT' END AS card_err,
    CASE WHEN ip = '1.2.3' THEN 'MALFORMED' WHEN ip LIKE '239.%' THEN 'MULTICAST' END AS ip_err
  FROM luhned),
verdict AS (
  SELECT *, CASE WHEN len(missing) > 0 THEN [] ELSE errs END AS errors,
    CASE WHEN len(missing) = 0 AND len(errs) = 0 THEN coalesce(card_err, ip_err) END AS masking_error,
    CASE WHEN len(missing) > 0 OR len(errs) > 0 THEN 'ValidationError' WHEN card_err IS NOT NULL THEN 'InvalidPANError'
         WHEN ip_err IS NOT NULL THEN 'MaskingError' END AS error_type
  FROM checked)"""


def checked(spark, folder):
    return ing.check(raw_payloads(spark, folder), F.col("now_ms"))


@register(
    "ingest_validation",
    with_ctes(TX, RAW_SQL, CHECKED)
    + "SELECT event_id, array_to_string(missing, ',') AS missing, array_to_string(errors, ',') AS errors, masking_error, error_type FROM verdict",
)
def ingest_validation(spark, folder):
    return checked(spark, folder).select("event_id", "missing", "errors", "masking_error", "error_type")


@register(
    "event_build",
    with_ctes(TX, RAW_SQL, CHECKED)
    + f"""SELECT tid AS transaction_id, account_id, merchant_id, {num('CAST(amount_text AS DECIMAL(18,4))')} AS amount, cur AS currency, event_ms AS event_time,
  now_ms AS processing_time, ch AS channel, substr(d, 1, 6) AS card_bin, right(d, 4) AS card_last4,
  (user_id % 223 + 1) || '.' || (k % 13) || '.7.0' AS caller_ip_subnet, 'key' AS api_key_id, 'txn:write' AS oauth_scope, '1.0.0' AS masking_lib_version,
  '' AS leaks FROM verdict WHERE error_type IS NULL""",
)
def event_build(spark, folder):
    accepted, _ = ing.split(checked(spark, folder))
    events = ing.build_events(accepted, F.col("now_ms"))
    return events.withColumn("leaks", ing.leaking_columns(events)).drop("geo_lat", "geo_lon", "schema_version")


@register(
    "ingest_dead_letters",
    with_ctes(TX, RAW_SQL, CHECKED)
    + """SELECT error_type, CASE WHEN len(missing) > 0 THEN 'Missing required fields: ' || array_to_string(missing, ', ')
   WHEN len(errors) > 0 THEN 'Field validation errors: ' || array_to_string(errors, ', ') ELSE masking_error END AS error_message,
  count(*) AS letters, 0 AS with_card FROM verdict WHERE error_type IS NOT NULL GROUP BY ALL""",
)
def ingest_dead_letters(spark, folder):
    _, rejected = ing.split(checked(spark, folder))
    letters = ing.reject_envelopes(rejected, "txn.api", F.timestamp_millis("now_ms"))
    leaked = F.col("original_payload").contains("card_number") | F.col("original_payload").contains("caller_ip")
    return letters.groupBy("error_type", "error_message").agg(
        F.count(F.lit(1)).alias("letters"), F.count_if(leaked).cast("int").alias("with_card")
    )


@register(
    "pan_mask",
    with_ctes(TX, RAW_SQL, CHECKED)
    + """SELECT event_id, card_err AS error,
  CASE WHEN card_err IS NULL THEN substr(d, 1, 6) || repeat('*', length(d) - 10) || right(d, 4) END AS masked,
  CASE WHEN regexp_matches(card, '^[0-9]{15,19}$') THEN 1 ELSE 0 END AS leaks FROM checked""",
)
def pan_mask(spark, folder):
    rows = raw_payloads(spark, folder).select("event_id", "card_number")
    card = F.col("card_number")
    error = cards.card_error(card)
    return rows.select(
        "event_id", error.alias("error"), F.when(error.isNull(), cards.masked_card(card)).alias("masked"), cards.looks_like_card(card).alias("leaks")
    )


@register(
    "dlq_payload_mask",
    with_ctes(TX)
    + """SELECT transaction_id, CASE WHEN event_type = 'error' THEN NULL ELSE account_id END AS account,
  CASE WHEN event_type = 'error' THEN NULL ELSE '411111****' || lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0') END AS card,
  CASE WHEN event_type = 'error' THEN NULL ELSE '****' END AS ip,
  CASE WHEN event_type = 'error' THEN 'not json ' || transaction_id END AS raw,
  CASE WHEN event_type = 'error' THEN 1 ELSE 2 END AS safe_keys FROM tx""",
)
def dlq_payload_mask(spark, folder):
    tx = given.transactions(spark, folder)
    card = F.concat(F.lit("41111111"), F.lpad((F.col("event_id") % 100000000).cast("string"), 8, "0"))
    body = F.to_json(F.struct("account_id", card.alias("card_number"), F.lit("1.2.3.4").alias("ip"), F.lit("9.9.9.9").alias("caller_ip")))
    payload = F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), F.col("transaction_id"))).otherwise(body)
    rows = tx.select("transaction_id", payload.alias("payload"))
    shown = pl.display_masked(F.col("payload"))
    kept = F.json_object_keys(pl.sanitised(F.col("payload")))
    return rows.select(
        "transaction_id",
        shown["account_id"].alias("account"),
        shown["card_number"].alias("card"),
        shown["ip"].alias("ip"),
        shown["_raw"].alias("raw"),
        F.size(kept).alias("safe_keys"),
    )


@register(
    "frame_check",
    with_ctes(TX)
    + """SELECT transaction_id, CASE CAST(event_id % 4 AS INTEGER) WHEN 0 THEN NULL WHEN 1 THEN 'frame_short:3' WHEN 2 THEN 'frame_magic:07'
  ELSE 'frame_schema:' || k || ':200' END AS error FROM tx""",
)
def frame_check(spark, folder):
    tx = given.transactions(spark, folder)
    n = F.col("event_id") % 4
    number = lambda c: F.unhex(F.lpad(F.hex(c), 8, "0"))
    text = F.encode("transaction_id", "UTF-8")
    frame = (
        F.when(n == 0, F.concat(F.unhex(F.lit("00")), number(F.lit(200)), text))
        .when(n == 1, F.unhex(F.lit("000001")))
        .when(n == 2, F.concat(F.unhex(F.lit("07")), number(F.lit(200)), text))
        .otherwise(F.concat(F.unhex(F.lit("00")), number(F.col("k")), text))
    )
    rows = tx.select("transaction_id", frame.alias("value"))
    return rows.select("transaction_id", framed_avro.frame_error(F.col("value"), 200).alias("error"))
