"""Do the tables hold what the source sent?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_GAP = 0.001  # fixed value: at most 0.1 % of the rows may be missing


def presence(source: DataFrame, enriched: DataFrame, decisions: DataFrame, key: str = "transaction_id") -> DataFrame:
    """One row per id with a flag for each table it occurs in.

    Ids are reduced to one per table before the shuffle; one grouping replaces a
    chain of anti joins and looks in both directions at once.
    """
    parts = None
    for position, df in enumerate((source, enriched, decisions)):
        flags = [F.lit(position == i).alias(name) for i, name in enumerate(("in_source", "in_enriched", "in_decisions"))]
        part = df.select(key).distinct().select(key, *flags)
        parts = part if parts is None else parts.unionByName(part)
    flags = [F.bool_or(name).alias(name) for name in ("in_source", "in_enriched", "in_decisions")]
    return parts.groupBy(key).agg(*flags)


def missing(source: DataFrame, stored: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Ids of `source` that `stored` lacks."""
    return source.select(key).distinct().join(stored.select(key), key, "left_anti")


def report(source: DataFrame, enriched: DataFrame, decisions: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Counts, missing and unexpected ids, gap and verdict in one row."""
    flags = presence(source, enriched, decisions, key)
    s, e, d = F.col("in_source"), F.col("in_enriched"), F.col("in_decisions")
    counted = flags.agg(
        F.count_if(s).alias("source_ids"),
        F.count_if(e).alias("enriched_ids"),
        F.count_if(d).alias("decision_ids"),
        F.count_if(s & ~e).alias("missing_enriched"),
        F.count_if(e & ~s).alias("unexpected_enriched"),
        F.count_if(e & ~d).alias("missing_decisions"),
        F.count_if(d & ~e).alias("unexpected_decisions"),
    )
    gap = F.coalesce(F.col("missing_enriched") / F.nullif(F.col("source_ids"), F.lit(0)), F.lit(0.0))
    return counted.select("*", gap.alias("gap"), (gap <= MAX_GAP).alias("within_limit"))
