"""Does the state of a running stream agree with the tables it wrote?

The velocity state in a checkpoint is read as a table and compared, minute bucket by minute bucket, with the buckets that the
stored enriched rows give. Only the last day is compared, which every key still holds: older buckets go when a key gets its
next row. The comparison is one full join on (account, minute); both sides are reduced to buckets before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.functions.clock import DAY_MS, MINUTE_MS
from riskspark.operators.decisions import latest_enriched
from riskspark.streaming.enrich import minute_buckets

MAX_ERROR = 0.001  # fixed value: share of velocity values that may be wrong


def velocity_operator(spark: SparkSession, checkpoint: str) -> int:
    """Number of the keyed step that has minute buckets and no device profile."""
    steps = spark.read.format("state-metadata").load(checkpoint).select("operatorId", "operatorProperties").distinct().collect()
    found = [s.operatorId for s in steps if '"buckets"' in s.operatorProperties and '"profile"' not in s.operatorProperties]
    if len(found) != 1:
        raise ValueError(f"no single velocity step in {checkpoint}: {found}")
    return found[0]


def velocity_state(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """account_id, minute, n, units as the state holds them after a micro-batch, the last one by default."""
    reader = spark.read.format("statestore").option("operatorId", velocity_operator(spark, checkpoint)).option("stateVarName", "buckets")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    rows = reader.load(checkpoint)
    return rows.select("key.account_id", F.col("user_map_key.minute").alias("minute"), F.col("user_map_value.n").alias("n"), F.col("user_map_value.units").alias("units"))


def differing_buckets(state: DataFrame, enriched: DataFrame) -> DataFrame:
    """account_id, minute, state_n, table_n, state_units, table_units and `same` of every bucket of the last day of the table."""
    rows = latest_enriched(enriched, ["transaction_id", "account_id", "event_time", "amount"])
    table = minute_buckets(rows.withColumn("event_ms", F.unix_millis("event_time")), "account_id")
    newest = rows.agg(F.floor((F.unix_millis(F.max("event_time")) - F.lit(DAY_MS)) / F.lit(MINUTE_MS)).alias("m")).scalar()
    sides = []
    for df, name in ((state, "state"), (table, "table")):
        sides.append(df.where(F.col("minute") >= newest).select("account_id", "minute", F.col("n").alias(f"{name}_n"), F.col("units").alias(f"{name}_units")))
    both = sides[0].join(sides[1], ["account_id", "minute"], "full")
    same = F.col("state_n").eqNullSafe(F.col("table_n")) & F.col("state_units").eqNullSafe(F.col("table_units"))
    return both.withColumn("same", same)


def report(buckets: DataFrame) -> DataFrame:
    """One row: buckets, those that differ, their share, and whether it is within the limit."""
    counted = buckets.agg(F.count(F.lit(1)).alias("buckets"), F.count_if(~F.col("same")).alias("differing"))
    share = F.coalesce(F.col("differing") / F.nullif(F.col("buckets"), F.lit(0)), F.lit(0.0))
    return counted.select("*", share.alias("error_rate"), (share <= MAX_ERROR).alias("within_limit"))
