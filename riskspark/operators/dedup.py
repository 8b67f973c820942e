"""One row per key: first, latest, and first within a time to live."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import stored


def _single(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # `row_number() = 1` lets Spark keep one row per key on the map side, so a
    # key with very many copies is reduced before the shuffle.
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def first_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The first row of each key by `order`; list a tiebreak to make it deterministic."""
    return _single(df, keys, [F.col(c).asc_nulls_last() for c in order])


def latest_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by `order`."""
    return _single(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_latest_ties(df: DataFrame, key: str, version: str) -> DataFrame:
    """All rows whose version is the highest of their key; equal versions all stay."""
    newest = df.groupBy(key).agg(F.max(version).alias(version))
    return df.join(newest, [key, version], "left_semi")


def first_within(df: DataFrame, key: str, time_ms: str, tiebreak: str, ttl_ms: int) -> DataFrame:
    """First row of each key, and again the first one at least `ttl_ms` after the last kept one.

    Copies do not prolong the time to live. Nearly every key ends within one
    time to live and is settled by its first instant. For keys that reappear
    later every instant is linked to the next one that would be kept after it
    (`next_kept`), and those reachable from the first are found by doubling: in
    round i links reach 2^i steps. So log2(span / ttl) rounds of one job each do,
    whatever the number of keys and of copies, after one job that measures the
    longest span and one that stores the links.
    """
    instants = df.groupBy(key).agg(F.min(time_ms).alias("first"), F.max(time_ms).alias("latest"))
    again = instants.where(F.col("latest") - F.col("first") >= F.lit(ttl_ms))
    span = again.agg(F.max(F.col("latest") - F.col("first"))).first()[0]
    settled = instants.select(key, F.col("first").alias(time_ms))
    if span is not None:
        points = df.select(key, F.col(time_ms).alias("at")).distinct().join(again.select(key, "first"), key)
        links = next_kept(points, key, ttl_ms).withColumn("reached", F.col("at") == F.col("first"))
        links = stored(links.select(key, "at", "next", "reached"))
        for _ in range((span // ttl_ms).bit_length()):
            links = stored(_doubled(links, key))
        settled = settled.unionByName(links.where("reached").select(key, F.col("at").alias(time_ms))).distinct()
    kept_rows = df.join(settled, [key, time_ms], "left_semi")
    return first_per_key(kept_rows, [key, time_ms], tiebreak)


def next_kept(points: DataFrame, key: str, ttl_ms: int) -> DataFrame:
    """Adds `next` to distinct instants (`key`, `at`): the first instant of the key at least `ttl_ms` later, or null.

    It lies in the slot of `at` + ttl, found by one ordered pass over the slot, or
    else it is the first instant of a later slot. Windows hold the instants of a
    key within one slot, or one row per slot of a key, never a whole key.
    """
    slotted = points.withColumn("slot", F.floor(F.col("at") / F.lit(ttl_ms)).cast("bigint"))
    asks = slotted.withColumn("slot", F.col("slot") + 1).withColumn("when", F.col("at") + F.lit(ttl_ms)).withColumn("asks", F.lit(True))
    both = asks.unionByName(slotted.withColumn("when", F.col("at")).withColumn("asks", F.lit(False)))
    onward = Window.partitionBy(key, "slot").orderBy("when", F.col("asks").desc()).rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("inside", F.min(F.when(~F.col("asks"), F.col("when"))).over(onward)).where("asks").drop("when", "asks")
    starts = slotted.groupBy(key, "slot").agg(F.min("at").alias("start"))
    later = Window.partitionBy(key).orderBy("slot").rangeBetween(2, Window.unboundedFollowing)
    beyond = starts.select(key, (F.col("slot") + 1).alias("slot"), F.min("start").over(later).alias("beyond"))
    joined = found.join(beyond, [key, "slot"])
    return joined.select(*points.columns, F.coalesce("inside", "beyond").alias("next"))


def _doubled(links: DataFrame, key: str) -> DataFrame:
    """Links twice as long, and what the links of reached instants reach."""
    ahead = links.select(key, F.col("at").alias("next"), F.col("next").alias("after"))
    longer = links.join(ahead, [key, "next"], "left").select(key, "at", F.col("after").alias("next"), "reached")
    hit = links.where(F.col("reached") & F.col("next").isNotNull())
    hit = hit.select(key, F.col("next").alias("at"), F.lit(None).cast("bigint").alias("next"), F.lit(True).alias("reached"))
    return longer.unionByName(hit).groupBy(key, "at").agg(F.max("next").alias("next"), F.bool_or("reached").alias("reached"))


def insert_ignore(existing: DataFrame, incoming: DataFrame, key: str, *order: str) -> DataFrame:
    """Rows of `incoming` to append: the first of each key that `existing` does not hold."""
    fresh = first_per_key(incoming, [key], *order)
    return fresh.join(existing.select(key), key, "left_anti")
