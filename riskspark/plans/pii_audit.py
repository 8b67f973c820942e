"""Scan of tables for personal data: column names and whole text content."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions import pii

PATTERNS = ("PAN", "IPv4", "IPv6")
HALTING = ("PAN", "FIELD_NAME")


def field_findings(tables: dict[str, DataFrame]) -> DataFrame:
    """Columns whose name alone is a finding."""
    spark = next(iter(tables.values())).sparkSession
    rows = [
        (table, name, "FIELD_NAME", None, 1)
        for table, df in tables.items()
        for name in df.columns
        if pii.sensitive_name(name)
    ]
    return spark.createDataFrame(
        rows,
        "table_name string, matched_field string, matched_pattern string,"
        "record_sample_hash string, matches bigint",
    )


def _hits(column: Column) -> Column:
    found = F.array(
        F.when(pii.has_pan(column), F.lit("PAN")),
        F.when(F.size(pii.exposed_v4(column)) > 0, F.lit("IPv4")),
        F.when(F.size(pii.exposed_v6(column)) > 0, F.lit("IPv6")),
    )
    return F.array_compact(found)


def content_findings(table_name: str, df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Distinct (field, pattern, content hash) with the number of matching rows. Every text column is searched in full."""
    texts = columns or [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    cells = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in texts])
    hits = (
        df.select(F.explode(cells).alias("cell"))
        .where(F.col("cell.text").isNotNull())
        .select("cell.field", "cell.text", _hits(F.col("cell.text")).alias("patterns"))
        .where(F.size("patterns") > 0)
    )
    # The text is hashed before the shuffle, so no content leaves the scan.
    marked = hits.select(
        F.lit(table_name).alias("table_name"),
        F.col("field").alias("matched_field"),
        F.explode("patterns").alias("matched_pattern"),
        pii.sample_hash(F.col("text")).alias("record_sample_hash"),
    )
    keys = ["table_name", "matched_field", "matched_pattern", "record_sample_hash"]
    return marked.groupBy(*keys).agg(F.count(F.lit(1)).alias("matches"))


def new_scan_id(day: dt.date, draw: Callable[[], str] = lambda: uuid.uuid4().hex) -> str:
    """Id of a scan run: `audit-scan-`, the day, and eight random characters."""
    return f"audit-scan-{day:%Y%m%d}-{draw()[:8]}"


def audit(tables: dict[str, DataFrame], scan_id: str, scanned_at: Column) -> DataFrame:
    """Scan records of all tables, in the layout of the audit log."""
    findings = field_findings(tables)
    for name, df in tables.items():
        findings = findings.unionByName(content_findings(name, df))
    return findings.select(
        F.lit(scan_id).alias("scan_id"),
        scanned_at.alias("scan_timestamp"),
        "table_name",
        "matched_field",
        "matched_pattern",
        F.coalesce("record_sample_hash", pii.sample_hash(F.col("matched_field"))).alias("record_sample_hash"),
        F.when(F.col("matched_pattern").isin(*HALTING), "TABLE_HALTED").otherwise("ALERT_SENT").alias("action_taken"),
    )


def summary(findings: DataFrame) -> DataFrame:
    """Matches and distinct records per table, field and pattern."""
    return findings.groupBy("table_name", "matched_field", "matched_pattern").agg(
        F.sum("matches").alias("matches"), F.count(F.lit(1)).alias("distinct_records")
    )
