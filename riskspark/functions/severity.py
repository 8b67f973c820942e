"""Severity order and the two decision maps, which differ on purpose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Severities from lowest to highest.
SEVERITIES = ("low", "medium", "high", "critical")


def ordinal(severity: Column) -> Column:
    rank = F.lit(None).cast("int")
    for position, name in enumerate(SEVERITIES):
        rank = F.when(severity == name, F.lit(position)).otherwise(rank)
    return rank


def name_of(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(name) for name in SEVERITIES]), rank)


def scoring_decision(severity: Column) -> Column:
    """Decision for a suspicious transaction: high and critical block, the rest is flagged."""
    return F.when(F.coalesce(severity, F.lit("low")).isin("high", "critical"), "BLOCK").otherwise("FLAG")


def display_decision(severity: Column) -> Column:
    """Decision shown on the alert feed, where a low alert is an allowed transaction."""
    return (
        F.when(severity.isin("critical", "high"), "BLOCK")
        .when(severity == "medium", "FLAG")
        .when(severity == "low", "ALLOW")
        .otherwise("UNKNOWN")
    )


def decision_score(decision: Column) -> Column:
    return F.when(decision == "ALLOW", 0.0).when(decision == "FLAG", 0.3).otherwise(0.8)
