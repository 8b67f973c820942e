"""Raw payloads to masked transaction events, rejects to dead letters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import cards, payload
from riskspark.functions import ip as ipf
from riskspark.functions.coerce import is_blank, is_falsy, money
from riskspark.schemas import CHANNELS

# Required fields in reporting order, limits and version stamps.
REQUIRED = (
    "transaction_id",
    "account_id",
    "merchant_id",
    "amount",
    "currency",
    "event_time",
    "channel",
    "card_number",
    "caller_ip",
    "api_key_id",
    "oauth_scope",
)
MAX_SKEW_MS = 5 * 60 * 1000
ERRORS = {
    "amount_sign": "amount must be > 0",
    "amount_type": "amount must be a numeric value",
    "currency": "currency must be a 3-character ISO-4217 code",
    "channel": "channel must be one of ['API', 'MOBILE', 'POS', 'WEB']",
    "api_key_id": "api_key_id must not be empty",
    "oauth_scope": "oauth_scope must not be empty",
    "skew": "event_time is more than 5 minutes from server time",
}
MASKING_LIB_VERSION = "1.0.0"
SCHEMA_VERSION = "1"
# End of fixed values.


def _kind(df: DataFrame, name: str) -> str:
    return "string" if isinstance(df.schema[name].dataType, T.StringType) else "number"


def missing_fields(df: DataFrame) -> Column:
    """Names of required fields that are absent, empty or zero."""
    checks = []
    for name in REQUIRED:
        absent = is_falsy(F.col(name), _kind(df, name)) if name in df.columns else F.lit(True)
        checks.append(F.when(absent, F.lit(name)))
    return F.array_compact(F.array(*checks))


def value_errors(now_ms: Column) -> Column:
    """Messages for values that are present but wrong."""
    text = F.coalesce(F.col("amount").cast("string"), F.lit("0"))
    number, stored = text.try_cast("double"), text.try_cast("double").try_cast("decimal(18,4)")  # NaN, infinite and too large amounts cannot be stored
    skew = F.abs(now_ms - F.col("event_time"))
    checks = [
        F.when(stored.isNull(), ERRORS["amount_type"]).when(number <= 0, ERRORS["amount_sign"]),
        F.when(F.coalesce(F.length("currency"), F.lit(0)) != 3, ERRORS["currency"]),
        F.when(~F.coalesce(F.col("channel").isin(*CHANNELS), F.lit(False)), ERRORS["channel"]),
        F.when(is_blank(F.col("api_key_id")), ERRORS["api_key_id"]),
        F.when(is_blank(F.col("oauth_scope")), ERRORS["oauth_scope"]),
        F.when(skew > MAX_SKEW_MS, ERRORS["skew"]),
    ]
    return F.array_compact(F.array(*checks))


def check(df: DataFrame, now_ms: Column) -> DataFrame:
    """Adds `missing`, `errors`, `masking_error` and the resulting `error_type` (null if accepted).

    The stages stop at the first failure: values are only judged when no field
    is missing, card and address only when the values are good.
    """
    staged = df.select(
        "*",
        missing_fields(df).alias("missing"),
        value_errors(now_ms).alias("_errors"),
        cards.card_error(F.col("card_number")).alias("_card"),
        ipf.ip_error(F.col("caller_ip")).alias("_ip"),
    )
    complete = F.size("missing") == 0
    none = F.array().cast("array<string>")
    good = complete & (F.size("_errors") == 0)
    return staged.select(
        *df.columns,
        "missing",
        F.when(complete, F.col("_errors")).otherwise(none).alias("errors"),
        F.when(good, F.coalesce("_card", "_ip")).alias("masking_error"),
        F.when(~complete | (F.size("_errors") > 0), "ValidationError")
        .when(F.col("_card").isNotNull(), "InvalidPANError")
        .when(F.col("_ip").isNotNull(), "MaskingError")
        .alias("error_type"),
    )


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows of a checked table."""
    accepted = checked.where(F.col("error_type").isNull())
    return accepted, checked.where(F.col("error_type").isNotNull())


def build_events(
    accepted: DataFrame, processed_at_ms: Column, force_channel: str | None = None, v4_prefix: int = 24
) -> DataFrame:
    """Masked 17-column events; card number and full address do not survive."""
    optional = [
        (F.col(name) if name in accepted.columns else F.lit(None)).cast("float").alias(name)
        for name in ("geo_lat", "geo_lon")
    ]
    return accepted.select(
        F.when(is_blank(F.col("transaction_id")), F.uuid()).otherwise(F.col("transaction_id")).alias("transaction_id"),
        "account_id",
        "merchant_id",
        money(F.col("amount")).alias("amount"),
        "currency",
        F.timestamp_millis("event_time").alias("event_time"),
        F.timestamp_millis(processed_at_ms).alias("processing_time"),
        (F.lit(force_channel) if force_channel else F.col("channel")).alias("channel"),
        cards.card_bin(F.col("card_number")).alias("card_bin"),
        cards.card_last4(F.col("card_number")).alias("card_last4"),
        ipf.truncate_ip(F.col("caller_ip"), v4_prefix).alias("caller_ip_subnet"),
        "api_key_id",
        "oauth_scope",
        *optional,
        F.lit(MASKING_LIB_VERSION).alias("masking_lib_version"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
    )


def leaking_columns(df: DataFrame) -> Column:
    """Names of text columns whose whole value looks like a card number."""
    if "card_number" in df.columns:
        raise ValueError("column card_number must not reach the event")
    checks = [
        F.when(cards.looks_like_card(F.col(field.name)), F.lit(field.name))
        for field in df.schema
        if isinstance(field.dataType, T.StringType)
    ]
    return F.array_compact(F.array(*checks))


def reject_envelopes(
    rejected: DataFrame, source_topic: str, failed_at: Column, host: str = "", dlq_id: Column | None = None
) -> DataFrame:
    """Dead letters of rejected payloads, without card number and address."""
    raw = [c for c in rejected.columns if c not in ("missing", "errors", "masking_error", "error_type")]
    safe = [c for c in raw if c not in payload.UNMASKED_KEYS]
    message = (
        F.when(F.size("missing") > 0, F.concat(F.lit("Missing required fields: "), F.array_join("missing", ", ")))
        .when(F.size("errors") > 0, F.concat(F.lit("Field validation errors: "), F.array_join("errors", ", ")))
        .otherwise(F.col("masking_error"))
    )
    return rejected.select(
        (F.uuid() if dlq_id is None else dlq_id).alias("dlq_id"),
        F.lit(source_topic).alias("source_topic"),
        F.to_json(F.struct(*safe)).alias("original_payload"),
        "error_type",
        message.alias("error_message"),
        failed_at.alias("failed_at"),
        F.lit(host).alias("producer_host"),
        F.lit(False).alias("masking_applied"),
    )
