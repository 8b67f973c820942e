"""The enrichment stream: dedup, velocity, geo, device, as one streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.clock import minute_of
from riskspark.functions.coerce import is_blank
from riskspark.operators.decisions import latest_enriched
from riskspark.operators.device import IDLE_MS, RECENT_MINUTES
from riskspark.operators.geo import GEO_COLUMNS, geo_pieces, subnet_bits
from riskspark.operators.geo_segments import levels_of, lookup
from riskspark.operators.velocity import WINDOWS
from riskspark.schemas import nullable
from riskspark.session import stored
from riskspark.streaming import stateful

EVENT_TIME = "event_time"
KEY_SPREAD = 256  # keys for rows without a device
SEEN_BUCKETS = 4096  # keys for seen transactions; a stored stream keeps the number it began with


def _stage(df: DataFrame, key, processor, added: T.StructType, seeds: DataFrame | None = None) -> DataFrame:
    """One keyed step. The event time is a plain column for it, so Spark drops no row as late.

    `seeds` has the rows a new query's state begins with, with the same key.
    """
    plain = [T.StructField(f.name, f.dataType, True) for f in df.schema if not f.name.startswith("_key")]
    return df.groupBy(key).transformWithStateInPandas(
        statefulProcessor=processor,
        outputStructType=T.StructType([*plain, *added]),
        outputMode="Append",
        timeMode="EventTime",
        initialState=None if seeds is None else seeds.groupBy(key),
    )


def watermarked(events: DataFrame) -> DataFrame:
    """Events with the number columns the processors work on, behind a watermark.

    The watermark is the clock of timers and of lateness. The event time is made anew after it, so that no later step
    filters by it: rows of any age reach the processors, which mark the ones that are too late.
    """
    timed = events.withColumns(
        {
            "event_ms": F.unix_millis(EVENT_TIME),
            "processing_ms": F.unix_millis("processing_time"),
            "amount_units": (F.col("amount") * stateful.MONEY_UNITS).cast("bigint"),
        }
    )
    clocked = timed.withWatermark(EVENT_TIME, f"{stateful.OUT_OF_ORDER_MS} milliseconds")
    return clocked.withColumn(EVENT_TIME, F.timestamp_micros(F.unix_micros(EVENT_TIME)))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("transaction_id"), F.lit(SEEN_BUCKETS))


def first_seen(events: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """The first row of each transaction within 48 h. Rows without an id are one transaction, as in a grouping."""
    named = events.withColumn("seen_bucket", _bucket())
    seeds = None if history is None else history.select(_bucket().alias("seen_bucket"), "transaction_id", F.col("event_ms").alias("at"))
    return _stage(named, "seen_bucket", stateful.FirstSeen(), T.StructType([]), seeds).drop("seen_bucket")


def with_velocity(events: DataFrame, history: DataFrame | None = None) -> DataFrame:
    added = "lateness string, watermark_ms bigint"
    for _, label in WINDOWS:
        added += f", vel_count_{label} bigint, vel_units_{label} bigint"
    seeds = None if history is None else minute_buckets(history, "account_id")
    return _stage(events, "account_id", stateful.Velocity(), nullable(added), seeds)


def minute_buckets(history: DataFrame, key: str) -> DataFrame:
    """Minute buckets of the keys of stored rows; keys that are null have none."""
    units = F.coalesce(F.sum((F.col("amount") * stateful.MONEY_UNITS).cast("bigint")), F.lit(0)).alias("units")
    kept = history.where(F.col(key).isNotNull())
    return kept.groupBy(key, minute_of(F.col("event_ms")).alias("minute")).agg(F.count(F.lit(1)).alias("n"), units)


def _profiles(history: DataFrame) -> DataFrame:
    """Minute buckets of devices, each with the device's profile as its latest row tells it.

    Of each device the buckets of a day before its latest row are kept.
    """
    rows = history.where(~is_blank(F.col("api_key_id"))).withColumn("device_key", F.col("api_key_id"))
    latest = F.max_by(
        F.struct(
            F.unix_millis("device_first_seen").alias("first_ms"), F.col("device_txn_count").cast("bigint").alias("total"),
            F.col("event_ms").alias("last_ms"), F.col("geo_country").alias("country"),
        ),
        F.struct("event_ms", "transaction_id"),
    )
    profile = rows.groupBy("device_key").agg(latest.alias("p")).select("device_key", "p.*")
    joined = minute_buckets(rows, "device_key").join(profile, "device_key")
    return joined.where(F.col("minute") >= minute_of(F.col("last_ms")) - F.lit(RECENT_MINUTES + 1))


def recent_history(enriched: DataFrame) -> DataFrame:
    """The latest version of stored rows that a new query's state can still depend on: those within the idle time of a device."""
    columns = ["transaction_id", "account_id", "event_time", "amount", "api_key_id", "geo_country", "device_first_seen", "device_txn_count"]
    newest = enriched.agg(F.max("event_time").alias("at"))
    since = newest.select(F.timestamp_millis(F.unix_millis("at") - F.lit(IDLE_MS))).scalar()
    return latest_enriched(enriched.where(F.col("event_time") >= since), columns).withColumn("event_ms", F.unix_millis("event_time"))


def with_device(events: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """Rows without a device are spread over many keys; they have no state to share."""
    has_device = ~is_blank(F.col("api_key_id")) & (F.col("lateness") != "beyond")
    spread = F.concat(F.lit("none-"), F.pmod(F.xxhash64("transaction_id"), F.lit(KEY_SPREAD)).cast("string"))
    keyed = events.withColumns(
        {"has_device": has_device, "device_key": F.when(has_device, F.col("api_key_id")).otherwise(spread)}
    )
    added = nullable(
        "device_first_ms bigint, device_txn_count bigint, prev_ms bigint, device_count_24h bigint, prev_geo_country string"
    )
    seeds = None if history is None else _profiles(history)
    return _stage(keyed, "device_key", stateful.Device(), added, seeds)


def geo_by_subnet(events: DataFrame, ranges: DataFrame, subnet: str = "caller_ip_subnet") -> DataFrame:
    """Geo columns of any subnet without state, by one join with the flattened ranges; every row comes out once."""
    table = geo_pieces(ranges)
    placed = events.withColumn("_bits", subnet_bits(F.col(subnet)))
    return lookup(placed, "_bits", table, GEO_COLUMNS, levels_of(table)).select(*events.columns, *GEO_COLUMNS)


def enriched_stream(events: DataFrame, ranges: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """All enrichment columns; refused rows come along marked `lateness = 'beyond'`.

    `history` is the enriched table of earlier rows. A query without a checkpoint begins with the state they left
    instead of empty windows; a query that goes on from its checkpoint does not look at it.
    """
    earlier = None if history is None else stored(recent_history(history))
    fresh = first_seen(watermarked(events), earlier)
    moving = with_velocity(fresh, earlier)
    placed = geo_by_subnet(moving, ranges)
    return with_device(placed, earlier)


def as_features(batch: DataFrame) -> DataFrame:
    """A micro-batch of the stream with the column names and types of the batch operators."""
    columns = {}
    for _, label in WINDOWS:
        columns[f"vel_count_{label}"] = F.col(f"vel_count_{label}").cast("int")
        units = F.col(f"vel_units_{label}").cast("decimal(18,0)")
        columns[f"vel_amount_{label}"] = (units / F.lit(stateful.MONEY_UNITS)).cast("decimal(18,4)")
    known = F.col("has_device")
    columns.update(
        {
            "device_first_seen": F.col("device_first_ms"),
            "device_txn_count": F.col("device_txn_count").cast("int"),
            "device_known_fraud": F.when(known, F.lit(False)),
            "prev_txn_time_ms": F.col("prev_ms"),
            "device_is_new": F.when(known, F.col("device_txn_count") == 1),
            "device_count_24h": F.col("device_count_24h").cast("int"),
        }
    )
    return batch.withColumns(columns)
