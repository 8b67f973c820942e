"""Ordered work per key that stays parallel when one key holds most of the rows.

A window over a key puts all its rows into one task. That is fine for nearly all
keys and needs a single shuffle. Only keys with more than `HOT_ROWS` rows are
cut into short time chunks. Their chunks are reduced to one row each before any
shuffle, history is carried from chunk to chunk on those reduced rows, and the
carried values are joined back on (key, chunk), which is how the rows are
partitioned anyway. With no hot key the list is empty and the optimizer drops
the carried side with all its steps.

Hot keys come from one pass over the key columns with a mergeable summary of
frequent items, which never misses a key with more than 3.5 / TRACKED of the
rows. Its counts can be too high by that share; a key cut without need gives the
same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from riskspark.functions.clock import slot

CHUNK_MS = 10_000
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 100_000  # bound of the broadcast list of hot keys
TRACKED = 200_000  # items a summary holds, a few megabytes
SUMMARIES, MERGED = 4096, 64  # tasks that make summaries, and that merge them before the last one does
CHUNK = "_chunk"
WHOLE_KEY = -1  # chunk number of keys that are not cut
NULL_KEY_SPREAD = 4096


def hot_key_lists(df: DataFrame, keys: dict[str, Column], hot_rows: int = HOT_ROWS) -> dict[str, DataFrame]:
    """For each named key the values with so many rows that they must not stay in one task (column `_hot`).

    That is more than `hot_rows`, and more than a `MAX_HOT_KEYS`th of all rows,
    so there are never more than `MAX_HOT_KEYS` of them, however large the table.
    All keys are looked at in the same pass, which reads nothing but them and
    runs when this is called.
    """
    spark, number = df.sparkSession, range(len(keys))
    narrow = df.select(*[key.alias(f"k{i}") for i, key in enumerate(keys.values())]).coalesce(SUMMARIES)
    counts = [F.count(f"k{i}").alias(f"n{i}") for i in number]
    made = narrow.groupBy((F.spark_partition_id() % MERGED).alias("part")).agg(
        *counts, *[F.expr(f"approx_top_k_accumulate(k{i}, {TRACKED})").alias(f"s{i}") for i in number]
    )
    merged = made.groupBy(F.floor(F.col("part") / MERGED)).agg(  # one group, none without rows
        *[F.sum(f"n{i}").alias(f"n{i}") for i in number],
        *[F.expr(f"approx_top_k_combine(s{i}, {TRACKED})").alias(f"s{i}") for i in number],
    )
    limit = "greatest({rows}, n{i} / {keys})"
    frequent = "filter(approx_top_k_estimate(s{i}, {keys}), x -> x.item IS NOT NULL AND x.count > " + limit + ").item"
    found = merged.select(
        *[F.expr(frequent.format(i=i, rows=hot_rows, keys=MAX_HOT_KEYS)).alias(f"hot{i}") for i in number]
    )
    lists = found.first() or [None for _ in number]
    return {name: _listed(spark, lists[i] or [], narrow.schema[f"k{i}"].dataType) for i, name in enumerate(keys)}


def _listed(spark: SparkSession, values: list, kind: DataType) -> DataFrame:
    """The values as a table; one that the optimizer knows to be empty where there are none."""
    if values:
        return spark.createDataFrame([(value,) for value in values], StructType([StructField("_hot", kind)]))
    return spark.range(1).where(F.lit(False)).select(F.lit(None).cast(kind).alias("_hot"))


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot values of one column."""
    return hot_key_lists(df, {key: F.col(key)}, hot_rows)[key]


def with_chunk(
    df: DataFrame, key: str, time_ms: str, spread_by: Sequence[str], hot: DataFrame, chunk_ms: int = CHUNK_MS
) -> DataFrame:
    """Adds the chunk number. Rows without a key are spread by hash, they never meet anyway."""
    # `hot` has at most MAX_HOT_KEYS rows.
    flagged = df.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_KEY_SPREAD))
    chunk = (
        F.when(F.col(key).isNull(), spread)
        .when(F.col("_hot").isNotNull(), slot(F.col(time_ms), chunk_ms))
        .otherwise(F.lit(WHOLE_KEY).cast("bigint"))
    )
    return flagged.withColumn(CHUNK, chunk).drop("_hot")


def hot_chunks(history: DataFrame, key: str, time_ms: str, hot: DataFrame, chunk_ms: int = CHUNK_MS) -> DataFrame:
    """The rows of hot keys with their chunk number, ready to be reduced per chunk."""
    rows = history.join(F.broadcast(hot), F.col(key) == F.col("_hot")).drop("_hot")
    return rows.withColumn(CHUNK, slot(F.col(time_ms), chunk_ms))


def chunk_window(key: str, *order: str) -> Window:
    """Rows of one chunk in order, from its first row to the current one."""
    ordered = Window.partitionBy(key, CHUNK).orderBy(*order)
    return ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def earlier_chunks(key: str, *order: str) -> Window:
    """All chunks of a key before the current one."""
    return Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)


def join_carry(rows: DataFrame, carry: DataFrame, key: str) -> DataFrame:
    return rows.join(carry, [key, CHUNK], "left")


def running_totals(
    df: DataFrame,
    key: str,
    time_ms: str,
    order: Sequence[str],
    totals: dict[str, Column],
    hot_rows: int = HOT_ROWS,
    chunk_ms: int = CHUNK_MS,
) -> DataFrame:
    """Adds, per output name, the running sum of a column over the rows of the key so far.

    `order` breaks ties of equal times. The columns of `totals` must not be null.
    """
    hot = hot_keys(df, key, hot_rows)
    valued = df.select("*", *[value.alias(f"_v_{name}") for name, value in totals.items()])
    reduced = (
        hot_chunks(valued, key, time_ms, hot, chunk_ms)
        .groupBy(key, CHUNK)
        .agg(*[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in totals])
    )
    before = earlier_chunks(key, CHUNK)
    carry = reduced.select(key, CHUNK, *[F.sum(f"_t_{n}").over(before).alias(f"_b_{n}") for n in totals])
    rows = with_chunk(valued, key, time_ms, [time_ms, *order], hot, chunk_ms)
    inside = chunk_window(key, time_ms, *order)
    running = rows.select("*", *[F.sum(f"_v_{name}").over(inside).alias(f"_r_{name}") for name in totals])
    joined = join_carry(running, carry, key)
    known = F.col(key).isNotNull()
    outputs = [
        F.when(known, F.col(f"_r_{name}") + F.coalesce(F.col(f"_b_{name}"), F.lit(0))).alias(name)
        for name in totals
    ]
    return joined.select(*df.columns, *outputs)
