"""Device history: first seen, number of transactions, previous country and time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.clock import DAY_MS, MINUTE_MS, minute_of
from riskspark.functions.coerce import is_blank
from riskspark.operators import chunks

IDLE_MS = 7 * DAY_MS  # fixed value: a device idle for longer starts anew
RECENT_MINUTES = 1440
DEVICE_COLUMNS = [
    "device_first_seen",
    "device_txn_count",
    "device_known_fraud",
    "prev_geo_country",
    "prev_txn_time_ms",
]


def device_key(key: str = "api_key_id") -> Column:
    """The device, null where there is none."""
    return F.when(~is_blank(F.col(key)), F.col(key))


def device_features(
    df: DataFrame,
    key: str = "api_key_id",
    time_ms: str = "event_ms",
    country: str = "geo_country",
    tiebreak: str = "transaction_id",
    known_fraud: DataFrame | None = None,
    history: DataFrame | None = None,
    hot: DataFrame | None = None,
    idle_ms: int = IDLE_MS,
    hot_rows: int = chunks.HOT_ROWS,
    chunk_ms: int = chunks.CHUNK_MS,
) -> DataFrame:
    """Adds the device columns, `device_is_new` and `device_count_24h`; null without a device.

    `known_fraud` is an optional one-column table of device keys known for
    fraud. Times are epoch milliseconds. `history` is a cheaper table with
    the same rows and all columns read here to reduce hot devices on, `hot` the
    list of hot devices where it is known.
    """
    if MINUTE_MS % chunk_ms or chunk_ms >= idle_ms:
        raise ValueError("a chunk must divide a minute and be shorter than the idle time")
    device = device_key(key).alias("_device")
    source = (df if history is None else history).select(device, time_ms, country, tiebreak)
    if hot is None:
        hot = chunks.hot_keys(source, "_device", hot_rows)
    carry = _carry(source, time_ms, country, tiebreak, hot, idle_ms, chunk_ms)

    keyed = df.select("*", device, minute_of(F.col(time_ms)).alias("_minute"))
    rows = chunks.with_chunk(keyed, "_device", time_ms, [tiebreak], hot, chunk_ms)
    part = Window.partitionBy("_device", chunks.CHUNK)
    ordered = part.orderBy("_minute", time_ms, tiebreak)
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    linked = rows.select(
        "*",
        F.row_number().over(ordered).alias("_rn"),
        F.lag(time_ms).over(ordered).alias("_lag_ms"),
        F.lag(country).over(ordered).alias("_lag_country"),
    )
    idle = F.col(time_ms) - F.col("_lag_ms") > F.lit(idle_ms)
    # `_life_ms` and `_life_rn` belong to the row that last broke an idle time
    # inside the chunk; before any break they are null and the carry continues.
    lives = linked.select(
        "*",
        F.coalesce(idle, F.lit(False)).alias("_breaks"),
        F.last(F.when(idle, F.col(time_ms)), ignorenulls=True).over(running).alias("_life_ms"),
        F.last(F.when(idle, F.col("_rn")), ignorenulls=True).over(running).alias("_life_rn"),
        F.first(time_ms).over(running).alias("_start_ms"),
    )
    outside = part.orderBy("_minute").rangeBetween(Window.unboundedPreceding, -(RECENT_MINUTES + 1))
    joined = chunks.join_carry(lives.select("*", F.count(F.lit(1)).over(outside).alias("_old")), carry, "_device")

    known, zero = F.col("_device").isNotNull(), F.lit(0)
    leads = F.col("_rn") == 1
    count = F.when(F.col("_life_rn").isNotNull(), F.col("_rn") - F.col("_life_rn") + 1).otherwise(
        F.col("_rn") + F.coalesce("_before_n", zero)
    )
    first_seen = F.coalesce("_life_ms", "_before_start", "_start_ms")

    def previous(inside: str, carried: str):
        return F.when(known & ~F.col("_breaks"), F.when(leads, F.col(carried)).otherwise(F.col(inside)))

    if known_fraud is None:
        fraud = F.lit(False)
    else:
        flagged = known_fraud.toDF("_device").distinct().withColumn("_fraud", F.lit(True))
        joined = joined.join(flagged, "_device", "left")
        fraud = F.coalesce(F.col("_fraud"), F.lit(False))
    recent = F.col("_rn") - F.col("_old") + F.coalesce("_before_recent", zero)
    return joined.select(
        *df.columns,
        F.when(known, first_seen).alias("device_first_seen"),
        F.when(known, count).cast("int").alias("device_txn_count"),
        F.when(known, fraud).alias("device_known_fraud"),
        previous("_lag_country", "_before_country").alias("prev_geo_country"),
        previous("_lag_ms", "_before_ms").alias("prev_txn_time_ms"),
        F.when(known, count == 1).alias("device_is_new"),
        F.when(known, recent).cast("int").alias("device_count_24h"),
    )


def _carry(source, time_ms, country, tiebreak, hot, idle_ms, chunk_ms) -> DataFrame:
    """Per chunk of a hot device: what is known of it from earlier chunks.

    A chunk is shorter than the idle time, so a device can only go idle between
    two chunks. All columns but the recent count are null when it did.
    """
    reduced = (
        chunks.hot_chunks(source, "_device", time_ms, hot, chunk_ms)
        .groupBy("_device", chunks.CHUNK)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(time_ms).alias("first_ms"),
            F.max(time_ms).alias("last_ms"),
            F.max_by(F.col(country), F.struct(time_ms, tiebreak)).alias("last_country"),
        )
        .withColumn("_minute", F.floor(F.col(chunks.CHUNK) / F.lit(MINUTE_MS // chunk_ms)).cast("bigint"))
    )
    in_order = Window.partitionBy("_device").orderBy("_minute", chunks.CHUNK)
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    linked = reduced.select(
        "*",
        F.lag("last_ms").over(in_order).alias("prev_ms"),
        F.lag("last_country").over(in_order).alias("prev_country"),
        F.sum("n").over(before).alias("n_before"),
    )
    fresh = F.col("prev_ms").isNull() | (F.col("first_ms") - F.col("prev_ms") > F.lit(idle_ms))
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = linked.select(
        "*",
        fresh.alias("fresh"),
        F.last(F.when(fresh, F.col("first_ms")), ignorenulls=True).over(so_far).alias("life_start"),
        F.last(F.when(fresh, F.coalesce("n_before", F.lit(0))), ignorenulls=True).over(so_far).alias("life_base"),
    )
    outside = Window.partitionBy("_device").orderBy("_minute").rangeBetween(
        Window.unboundedPreceding, -(RECENT_MINUTES + 1)
    )
    old = F.coalesce(F.sum("n").over(outside), F.lit(0))
    continues = ~F.col("fresh")
    earlier = F.coalesce("n_before", F.lit(0))
    return marked.select(
        "_device",
        chunks.CHUNK,
        F.when(continues, F.col("life_start")).alias("_before_start"),
        F.when(continues, earlier - F.col("life_base")).alias("_before_n"),
        F.when(continues, F.col("prev_ms")).alias("_before_ms"),
        F.when(continues, F.col("prev_country")).alias("_before_country"),
        (earlier - old).alias("_before_recent"),
    )
