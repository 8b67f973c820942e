"""Record layouts and `conform`, the cast of any DataFrame to one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.coerce import lenient_boolean

MONEY = T.DecimalType(18, 4)


_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
    "binary": T.BinaryType(),
    "money": MONEY,
}


def nullable(columns: str) -> T.StructType:
    """A schema from 'name type, ...'; unlike `fromDDL` it needs no session."""
    pairs = [column.split() for column in columns.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind], True) for name, kind in pairs])


def _struct(required: str, optional: str = "") -> T.StructType:
    """A schema of columns that are never null, then columns that may be."""
    fields = [T.StructField(f.name, f.dataType, False) for f in nullable(required)]
    return T.StructType(fields + (list(nullable(optional)) if optional else []))


def _reorder(schema: T.StructType, names: str) -> T.StructType:
    return T.StructType([schema[name] for name in names.split()])


# Column names, order and types of the published record formats.
RAW_PAYLOAD = nullable(
    "transaction_id string, account_id string, merchant_id string, amount string, currency string,"
    "event_time bigint, channel string, card_number string, caller_ip string, api_key_id string,"
    "oauth_scope string, geo_lat float, geo_lon float"
)

RAW_EVENT = _struct(
    "transaction_id string, account_id string, merchant_id string, amount money,"
    "currency string, event_time timestamp, processing_time timestamp, channel string,"
    "card_bin string, card_last4 string, caller_ip_subnet string, api_key_id string,"
    "oauth_scope string, masking_lib_version string, schema_version string",
    "geo_lat float, geo_lon float",
)

ENRICHED_EVENT = _reorder(
    _struct(
        "transaction_id string, account_id string, merchant_id string, amount money,"
        "currency string, event_time timestamp, processing_time timestamp, channel string,"
        "card_bin string, card_last4 string, caller_ip_subnet string, api_key_id string,"
        "oauth_scope string, masking_lib_version string, vel_count_1m int,"
        "vel_amount_1m money, vel_count_5m int, vel_amount_5m money,"
        "vel_count_1h int, vel_amount_1h money, vel_count_24h int,"
        "vel_amount_24h money, enrichment_time timestamp, enrichment_latency_ms int,"
        "processor_version string, schema_version string",
        "geo_lat float, geo_lon float, geo_country string, geo_city string,"
        "geo_network_class string, geo_confidence float, device_first_seen timestamp,"
        "device_txn_count int, device_known_fraud boolean, prev_geo_country string,"
        "prev_txn_time_ms timestamp",
    ),
    "transaction_id account_id merchant_id amount currency event_time processing_time channel "
    "card_bin card_last4 caller_ip_subnet api_key_id oauth_scope geo_lat geo_lon "
    "masking_lib_version vel_count_1m vel_amount_1m vel_count_5m vel_amount_5m vel_count_1h "
    "vel_amount_1h vel_count_24h vel_amount_24h geo_country geo_city geo_network_class "
    "geo_confidence device_first_seen device_txn_count device_known_fraud prev_geo_country "
    "prev_txn_time_ms enrichment_time enrichment_latency_ms processor_version schema_version",
)

ENRICHED_TABLE = _reorder(
    ENRICHED_EVENT,
    "transaction_id account_id merchant_id amount currency event_time enrichment_time channel "
    "card_bin card_last4 caller_ip_subnet api_key_id oauth_scope geo_lat geo_lon "
    "masking_lib_version vel_count_1m vel_amount_1m vel_count_5m vel_amount_5m vel_count_1h "
    "vel_amount_1h vel_count_24h vel_amount_24h geo_country geo_city geo_network_class "
    "geo_confidence device_first_seen device_txn_count device_known_fraud prev_geo_country "
    "prev_txn_time_ms enrichment_latency_ms processor_version schema_version",
)

DECISION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("decision", T.StringType(), False),
        T.StructField("fraud_score", T.DoubleType(), False),
        T.StructField("rule_triggers", T.ArrayType(T.StringType(), False), False),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("decision_time_ms", T.TimestampType(), False),
        T.StructField("latency_ms", T.DoubleType(), False),
        T.StructField("schema_version", T.StringType(), False),
    ]
)

ALERT = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("account_id", T.StringType(), False),
        T.StructField("matched_rule_names", T.ArrayType(T.StringType(), False), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("evaluation_timestamp", T.TimestampType(), False),
    ]
)

ALERT_REVIEW = T.StructType(
    list(ALERT)
    + [
        T.StructField("status", T.StringType(), False),
        T.StructField("reviewed_by", T.StringType()),
        T.StructField("reviewed_at", T.TimestampType()),
        T.StructField("inserted_at", T.TimestampType(), False),
    ]
)

DLQ_INGEST = _struct(
    "dlq_id string, source_topic string, original_payload string, error_type string,"
    "error_message string, failed_at timestamp, producer_host string, masking_applied boolean"
)

DLQ_PROCESSING = _struct(
    "dlq_id string, source_topic string, source_partition int, source_offset bigint,"
    "original_payload_bytes binary, error_type string, error_message string, failed_at timestamp,"
    "processor_host string, processor_subtask_index int",
    "transaction_id string, watermark_at_rejection timestamp, event_time_at_rejection timestamp",
)

DLQ_ALERT = T.StructType(
    list(ALERT)
    + list(_struct("error_type string, error_message string, failed_at timestamp"))
)

LABEL = _struct(
    "transaction_id string, label string, label_source string, label_timestamp_ms timestamp",
    "chargeback_id string",
)

PII_SCAN = _struct(
    "scan_id string, scan_timestamp timestamp, table_name string, matched_field string,"
    "matched_pattern string, record_sample_hash string, action_taken string"
)

FEATURE_COLUMNS = {
    "velocity": nullable(
        "vel_count_1m bigint, vel_amount_1m double, vel_count_5m bigint, vel_amount_5m double,"
        "vel_count_1h bigint, vel_amount_1h double, vel_count_24h bigint, vel_amount_24h double"
    ),
    "geo": nullable(
        "geo_country string, geo_city string, geo_network_class string, geo_confidence double"
    ),
    "device": nullable(
        "device_first_seen bigint, device_txn_count bigint, device_known_fraud boolean,"
        "prev_geo_country string, prev_txn_time_ms bigint"
    ),
}
FEATURE_TTL_HOURS = {"velocity": 48, "geo": 24, "device": 14 * 24}

CHANNELS = ("API", "MOBILE", "POS", "WEB")
NETWORK_CLASSES = ("RESIDENTIAL", "BUSINESS", "HOSTING", "MOBILE", "UNKNOWN")
DECISIONS = ("ALLOW", "FLAG", "BLOCK")
REVIEW_STATUSES = ("pending", "confirmed-fraud", "false-positive")
DLQ_ERROR_TYPES = (
    "SCHEMA_VALIDATION_ERROR",
    "LATE_EVENT_BEYOND_ALLOWED_LATENESS",
    "ENRICHMENT_EXCEPTION",
)
# End of fixed values.

# Catalogue entries that matter for handling a column; all other columns are internal, not PCI.
_SENSITIVE = {
    "card_bin": ("confidential", True),
    "card_last4": ("confidential", True),
    "caller_ip_subnet": ("confidential", False),
    "account_id": ("confidential", False),
    "geo_lat": ("confidential", False),
    "geo_lon": ("confidential", False),
}


def with_catalogue(schema: T.StructType) -> T.StructType:
    """The schema with sensitivity and PCI flag in each field's metadata."""
    fields = []
    for field in schema:
        sensitivity, pci = _SENSITIVE.get(field.name, ("internal", False))
        metadata = {"sensitivity": sensitivity, "pci": pci}
        fields.append(T.StructField(field.name, field.dataType, field.nullable, metadata))
    return T.StructType(fields)


def _coerced(df: DataFrame, field: T.StructField) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.dataType)
    column, source = F.col(field.name), df.schema[field.name].dataType
    if source.simpleString() == field.dataType.simpleString():  # nullability inside arrays aside
        return column
    if isinstance(field.dataType, T.TimestampType) and isinstance(source, T.IntegralType):
        return F.timestamp_millis(column)
    if isinstance(field.dataType, T.IntegralType) and isinstance(source, T.TimestampType):
        return F.unix_millis(column).cast(field.dataType)
    if isinstance(field.dataType, T.BooleanType) and isinstance(source, T.StringType):
        return lenient_boolean(column)
    return column.try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Casts, orders and fills the columns of `schema`; extra columns are dropped."""
    return df.select(*[_coerced(df, field).alias(field.name) for field in schema])


def null_violations(schema: T.StructType) -> Column:
    """Names of the columns of a conformed row that are null although the schema forbids it."""
    checks = [
        F.when(F.col(field.name).isNull(), F.lit(field.name))
        for field in schema
        if not field.nullable
    ]
    return F.array_compact(F.array(*checks))


def split_conformed(df: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows that fit the schema, rows that do not, with the offending column names)."""
    checked = conform(df, schema).withColumn("null_columns", null_violations(schema))
    good = checked.where(F.size("null_columns") == 0).drop("null_columns")
    return good, checked.where(F.size("null_columns") > 0)


def breaking_changes(old: T.StructType, new: T.StructType) -> list[str]:
    """Changes an old file or consumer would not survive; additive nullable columns are fine."""
    problems, known = [], {field.name: field for field in old}
    added = {field.name: field for field in new}
    for name, field in known.items():
        if name not in added:
            problems.append(f"removed: {name}")
        elif added[name].dataType != field.dataType:
            problems.append(f"type changed: {name}")
        elif field.nullable and not added[name].nullable:
            problems.append(f"no longer nullable: {name}")
    for name, field in added.items():
        if name not in known and not field.nullable:
            problems.append(f"added as not null: {name}")
    return problems


def added_columns(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns to add to a table of schema `old`, always nullable."""
    have = set(old.names)
    return T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in new if f.name not in have]
    )
