"""Daily roll-ups with mergeable quantile sketches: reports over any window read one row per day and group.

A day's row holds counts, sums and, per measured column, a KLL sketch. Counts and sums of a window are exact; a quantile
has the rank error of the sketch, about 0.3 % of the rows at SKETCH_SIZE 1024, whatever the number of days, since merged sketches
are as good as one sketch of all rows. A sketch has a few kilobytes whatever the number of rows, so a 90-day report over a
group costs 90 rows. Days are replaced one by one when their rows change (`refresh`).

Averages come from sums and numbers of non-null values. A group without values has null averages and quantiles.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.plans.views import DECISION_DAY, current_decisions, decided_transactions, triggered

SKETCH_SIZE = 1024


@dataclass(frozen=True)
class Rollup:
    """What is kept per day: `groups` besides the day, columns to add up, to average, and to take quantiles of."""

    count: str
    groups: Sequence[str]
    sums: Sequence[str] = ()
    averages: Sequence[str] = ()
    sketches: Sequence[str] = ()


FRAUD_RATE = Rollup("transaction_count", ("channel", "decision"), ("amount",), ("fraud_score",), ("latency_ms",))
RULE_TRIGGERS = Rollup("trigger_count", ("rule_name", "decision"), (), ("fraud_score",), ("fraud_score",))
MODEL_VERSIONS = Rollup("transaction_count", ("model_version", "decision"), (), ("fraud_score", "latency_ms"), ("fraud_score", "latency_ms"))


def daily(rows: DataFrame, kind: Rollup, day: str = DECISION_DAY) -> DataFrame:
    """One row per day and group."""
    values = [F.count(F.lit(1)).alias(kind.count)]
    for column in dict.fromkeys([*kind.sums, *kind.averages]):
        values.append(F.sum(column).alias(f"{column}_sum"))
    for column in kind.averages:
        values.append(F.count(column).alias(f"{column}_n"))
    for column in kind.sketches:
        values.append(F.when(F.count(column) > 0, F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(SKETCH_SIZE))).alias(f"{column}_sketch"))
    return rows.groupBy(day, *kind.groups).agg(*values)


def quantile(sketch: Column, share: float) -> Column:
    return F.when(sketch.isNotNull(), F.kll_sketch_get_quantile_double(sketch, F.lit(share)))


def window(
    rollup: DataFrame, kind: Rollup, quantiles: dict[str, tuple[str, float]], start=None, end=None, day: str = DECISION_DAY, by_day: bool = False
) -> DataFrame:
    """The report of the days from `start` to `end`, both included: counts, `total_*`, `avg_*` and named quantiles.

    `quantiles` names each quantile with its column and share. With `by_day` every day has its own rows.
    """
    if start is not None:
        rollup = rollup.where(F.col(day) >= F.lit(start).cast("date"))
    if end is not None:
        rollup = rollup.where(F.col(day) <= F.lit(end).cast("date"))
    merged = [F.sum(kind.count).alias(kind.count)]
    merged += [F.sum(f"{c}_sum").alias(f"{c}_sum") for c in dict.fromkeys([*kind.sums, *kind.averages])]
    merged += [F.sum(f"{c}_n").alias(f"{c}_n") for c in kind.averages]
    merged += [F.when(F.count(f"{c}_sketch") > 0, F.kll_merge_agg_double(f"{c}_sketch", F.lit(SKETCH_SIZE))).alias(f"{c}_sketch") for c in kind.sketches]
    groups = [day, *kind.groups] if by_day else list(kind.groups)
    total = rollup.groupBy(*groups).agg(*merged)
    averages = [(F.col(f"{c}_sum") / F.nullif(F.col(f"{c}_n"), F.lit(0))).alias(f"avg_{c}") for c in kind.averages]
    named = [quantile(F.col(f"{column}_sketch"), share).alias(name) for name, (column, share) in quantiles.items()]
    return total.select(*groups, kind.count, *[F.col(f"{c}_sum").alias(f"total_{c}") for c in kind.sums], *averages, *named)


def refresh(rows: DataFrame, kind: Rollup, path: str, day: str = DECISION_DAY) -> None:
    """Writes the days of `rows` to the stored roll-up, in place of what it holds of them; other days stay.

    Each day's rows must be whole.
    """
    table = daily(rows, kind, day).repartition(F.col(day))
    table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fraud_rate_rows(enriched: DataFrame, decisions: DataFrame, start=None, end=None) -> DataFrame:
    return decided_transactions(enriched, decisions, ["channel", "amount"], start, end)


def rule_trigger_rows(decisions: DataFrame, start=None, end=None) -> DataFrame:
    return triggered(decisions, start, end)


def model_version_rows(decisions: DataFrame, start=None, end=None) -> DataFrame:
    return current_decisions(decisions, start, end)


def fraud_rate(rollup: DataFrame, start=None, end=None, by_day: bool = False) -> DataFrame:
    """Transactions, amount, average score and p99 latency per channel and decision."""
    return window(rollup, FRAUD_RATE, {"p99_latency_ms": ("latency_ms", 0.99)}, start, end, by_day=by_day)


def rule_triggers(rollup: DataFrame, start=None, end=None, by_day: bool = False) -> DataFrame:
    shares = {"median_fraud_score": ("fraud_score", 0.5), "p95_fraud_score": ("fraud_score", 0.95)}
    return window(rollup, RULE_TRIGGERS, shares, start, end, by_day=by_day)


def model_versions(rollup: DataFrame, start=None, end=None, by_day: bool = False) -> DataFrame:
    shares = {"median_fraud_score": ("fraud_score", 0.5), "p95_fraud_score": ("fraud_score", 0.95), "p99_latency_ms": ("latency_ms", 0.99)}
    return window(rollup, MODEL_VERSIONS, shares, start, end, by_day=by_day)


def rank_error(estimates: DataFrame, rows: DataFrame, groups: Sequence[str], estimate: str, column: str, share: float) -> DataFrame:
    """Per group how far the estimate's rank is from `share`, as a fraction of the group's values; 0 where ties hold it, null without values."""
    joined = rows.select(*groups, F.col(column).cast("double").alias("_value")).join(estimates.select(*groups, estimate), list(groups))
    values = F.nullif(F.count("_value"), F.lit(0))
    ranks = joined.groupBy(*groups).agg(
        (F.count_if(F.col("_value") < F.col(estimate)) / values).alias("below"),
        (F.count_if(F.col("_value") <= F.col(estimate)) / values).alias("upto"),
    )
    error = F.greatest(F.lit(0.0), F.col("below") - F.lit(share), F.lit(share) - F.col("upto"))
    return ranks.select(*groups, F.when(F.col("upto").isNotNull(), error).alias("rank_error"))
