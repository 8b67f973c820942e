"""Feature tables: publication, latest values, values as of a point in time, training sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.clock import HOUR_MS
from riskspark.operators import chunks
from riskspark.operators.dedup import latest_per_key
from riskspark.schemas import FEATURE_COLUMNS, FEATURE_TTL_HOURS

KEY = "account_id"
TIME = "event_timestamp"
_TIMES = {"device_first_seen", "prev_txn_time_ms"}


def _zero(data_type: T.DataType):
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, T.BooleanType):
        return F.lit(False)
    return F.lit(0).cast(data_type)


def _value(df: DataFrame, field: T.StructField):
    column = F.col(field.name)
    if isinstance(df.schema[field.name].dataType, T.TimestampType):
        column = F.unix_millis(column)
    return column.cast(field.dataType)


def feature_table(enriched: DataFrame) -> DataFrame:
    """All features of an enriched batch in one table: key, transaction, event time, 17 values.

    Missing values become 0, false or '', except the two device times, which
    stay null.
    """
    values = []
    for field in (field for fields in FEATURE_COLUMNS.values() for field in fields):
        value = _value(enriched, field)
        if field.name not in _TIMES:
            value = F.coalesce(value, _zero(field.dataType))
        values.append(value.alias(field.name))
    return enriched.select(KEY, "transaction_id", F.col("event_time").alias(TIME), *values)


def feature_views(enriched: DataFrame) -> dict[str, DataFrame]:
    """The three feature tables of an enriched batch."""
    table = feature_table(enriched)
    return {
        view: table.select(KEY, "transaction_id", TIME, *fields.names) for view, fields in FEATURE_COLUMNS.items()
    }


def latest_features(view: DataFrame, name: str) -> DataFrame:
    """The newest row per account of one feature table."""
    columns = FEATURE_COLUMNS[name].names
    narrow = view.select(KEY, TIME, "transaction_id", *columns)
    return latest_per_key(narrow, [KEY], TIME, "transaction_id").select(KEY, *columns)


def snapshot(views: dict[str, DataFrame]) -> DataFrame:
    """One row per account over all feature tables; absent values are null."""
    parts = [latest_features(view, name) for name, view in views.items()]
    joined = parts[0]
    for part in parts[1:]:
        joined = joined.join(part, KEY, "full")
    return joined


def lookup(transactions: DataFrame, snap: DataFrame, mode: str = "fill") -> DataFrame:
    """Adds the 17 latest feature values of the account and `feature_miss`.

    If any value is missing, the whole vector counts as a miss and is zero.
    `overwrite` replaces columns of the same name, as a serving lookup does;
    `fill` only fills those that are null or absent.
    """
    if mode not in ("fill", "overwrite"):
        raise ValueError(mode)
    fields = [field for schema in FEATURE_COLUMNS.values() for field in schema]
    values = snap.select(KEY, *[F.col(f.name).alias(f"_s_{f.name}") for f in fields])
    joined = transactions.join(values, KEY, "left")
    whole = F.lit(True)
    for field in fields:
        whole = whole & F.col(f"_s_{field.name}").isNotNull()
    marked = joined.withColumn("_whole", whole)
    types = {field.name: field.dataType for field in transactions.schema}
    outputs = {}
    for field in fields:
        served = F.when(F.col("_whole"), F.col(f"_s_{field.name}")).otherwise(_zero(field.dataType))
        if field.name in types and mode == "fill":
            served = F.coalesce(F.col(field.name), served.cast(types[field.name]))
        outputs[field.name] = served
    kept = [F.col(c) for c in transactions.columns if c not in outputs]
    return marked.select(
        *kept,
        *[value.alias(name) for name, value in outputs.items()],
        (~F.col("_whole")).alias("feature_miss"),
    )


def as_of_views(
    entities: DataFrame,
    views: dict[str, tuple[DataFrame, list[str], int]],
    key: str = KEY,
    entity_ms: str = "event_ms",
    feature_ms: str = "feature_ms",
    tiebreak: str = "transaction_id",
    hot_rows: int = chunks.HOT_ROWS,
    chunk_ms: int = HOUR_MS,
) -> DataFrame:
    """Adds, per view, the newest values not later than the entity row and not older than its TTL.

    `views` maps a name to (rows, value columns, TTL in ms). Adds `<name>_at_ms`
    and the value columns of each view. Views given as the same DataFrame are
    read once.

    Entities and the rows of all views are merged into one ordered sequence per
    key, so no row pairs are formed and everything takes one shuffle. Hot keys
    are cut into chunks, with the last values of earlier chunks carried over on
    one reduced row per chunk. A feature at the very instant of the entity counts.
    """
    rows = entities.select(
        F.col(key).alias("_key"), F.col(entity_ms).alias("_ms"), F.struct(*entities.columns).alias("_row")
    )
    sources: dict[int, list[str]] = {}
    for name, (view, _, _) in views.items():
        sources.setdefault(id(view), []).append(name)
    features = None
    for names in sources.values():
        view = views[names[0]][0]
        values = [
            F.struct(F.col(feature_ms).alias("_at"), *[F.col(c) for c in views[name][1]]).alias(f"_value_{name}")
            for name in names
        ]
        part = view.where(F.col(key).isNotNull() & F.col(feature_ms).isNotNull()).select(
            F.col(key).alias("_key"), F.col(feature_ms).alias("_ms"), F.col(tiebreak).alias("_tie"), *values
        )
        features = part if features is None else features.unionByName(part, allowMissingColumns=True)
    merged = features.withColumn("_is_row", F.lit(False)).unionByName(
        rows.withColumn("_is_row", F.lit(True)), allowMissingColumns=True
    )
    hot = chunks.hot_keys(features.select("_key").unionByName(rows.select("_key")), "_key", hot_rows)
    narrow = features.unionByName(rows.select("_key", "_ms"), allowMissingColumns=True)

    def newest(name: str):
        order = F.when(F.col(f"_value_{name}").isNotNull(), F.struct("_ms", "_tie"))
        return F.max_by(f"_value_{name}", order).alias(f"_newest_{name}")

    steps = (
        chunks.hot_chunks(narrow, "_key", "_ms", hot, chunk_ms)
        .groupBy("_key", chunks.CHUNK)
        .agg(*[newest(name) for name in views])
    )
    before = chunks.earlier_chunks("_key", chunks.CHUNK)
    carried = [F.last(f"_newest_{n}", ignorenulls=True).over(before).alias(f"_carried_{n}") for n in views]
    carry = steps.select("_key", chunks.CHUNK, *carried)

    chunked = chunks.with_chunk(merged, "_key", "_ms", ["_ms"], hot, chunk_ms)
    inside = chunks.chunk_window("_key", "_ms", "_is_row", "_tie")
    seen = chunked.select(
        "*", *[F.last(f"_value_{n}", ignorenulls=True).over(inside).alias(f"_inside_{n}") for n in views]
    )
    matched = chunks.join_carry(seen.where(F.col("_is_row")), carry, "_key")
    found = matched.select(
        "_row", "_ms", "_key", *[F.coalesce(f"_inside_{n}", f"_carried_{n}").alias(f"_found_{n}") for n in views]
    )
    outputs = []
    for name, (_, columns, ttl_ms) in views.items():
        at = F.col(f"_found_{name}._at")
        valid = F.col("_key").isNotNull() & (F.col("_ms") - at <= F.lit(ttl_ms))
        outputs.append(F.when(valid, at).alias(f"{name}_at_ms"))
        outputs += [F.when(valid, F.col(f"_found_{name}.{c}")).alias(c) for c in columns]
    return found.select("_row.*", *outputs)


def as_of(entities: DataFrame, view: DataFrame, columns: list[str], ttl_ms: int, **options) -> DataFrame:
    """`as_of_views` for a single view; its time is `feature_at_ms`."""
    return as_of_views(entities, {"feature": (view, columns, ttl_ms)}, **options)


def point_in_time(entities: DataFrame, views: dict[str, DataFrame], **options) -> DataFrame:
    """All feature tables as of each entity row, each within its own time to live."""
    timed = {id(view): view.withColumn("feature_ms", F.unix_millis(TIME)) for view in views.values()}
    wanted = {
        name: (timed[id(view)], FEATURE_COLUMNS[name].names, FEATURE_TTL_HOURS[name] * HOUR_MS)
        for name, view in views.items()
    }
    return as_of_views(entities, wanted, **options)


def freshness(view: DataFrame, batch_ms: int, limit_ms: int = 30_000) -> DataFrame:
    """Lag of the newest feature row behind the batch time, and whether it is stale."""
    newest = view.agg(F.max(F.unix_millis(TIME)).alias("newest_ms"))
    lag = F.lit(batch_ms).cast("bigint") - F.col("newest_ms")
    return newest.select("newest_ms", lag.alias("lag_ms"), (lag > limit_ms).alias("stale"))
