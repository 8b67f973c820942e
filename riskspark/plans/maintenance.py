"""Lake table upkeep: compaction, retention, schema evolution."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.dedup import keep_latest_ties, latest_per_key
from riskspark.schemas import breaking_changes

RETENTION_YEARS = 7  # fixed value


def compacted(df: DataFrame, key: str, version: str, *tiebreak: str, ties: str = "one") -> DataFrame:
    """Latest version per key. `ties='all'` keeps rows of equal version, as a delete-by-max does."""
    if ties == "all":
        return keep_latest_ties(df, key, version)
    return latest_per_key(df, [key], version, *tiebreak)


def compact_days(
    spark: SparkSession, path: str, target: str, partition: str, days: list[str], key: str, version: str, *tiebreak: str
) -> None:
    """Rewrites the given day partitions of `path`, compacted, into `target`.

    Only partitions written here are replaced in the target. Source and target
    differ, so a lost executor can always recompute from the source.
    """
    if path.rstrip("/") == target.rstrip("/"):
        raise ValueError("compaction needs a target other than its source")
    source = spark.read.parquet(path).where(F.col(partition).isin(*[F.lit(d).cast("date") for d in days]))
    kept = compacted(source, key, version, *tiebreak)
    (
        kept.repartition(partition, F.pmod(F.xxhash64(key), F.lit(16)))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(target)
    )


def expired(day: Column, today: Column, years: int = RETENTION_YEARS) -> Column:
    """Is a day partition past its retention?"""
    return day < F.add_months(today, -12 * years)


def retained(df: DataFrame, day: str, today: Column, years: int = RETENTION_YEARS) -> DataFrame:
    """Rows that stay; on a day-partitioned table the filter prunes whole partitions."""
    return df.where(~expired(F.col(day), today, years))


def expired_days(df: DataFrame, day: str, today: Column, years: int = RETENTION_YEARS) -> DataFrame:
    """Day partitions to drop and the rows in them."""
    return df.where(expired(F.col(day), today, years)).groupBy(day).agg(F.count(F.lit(1)).alias("rows"))


def remove_expired_days(spark: SparkSession, path: str, partition: str, today: dt.date, years: int = RETENTION_YEARS, dry_run: bool = False) -> DataFrame:
    """Deletes the day folders of a table that are past their retention, and reports them: day, files, bytes.

    Only names are looked at: no file is read, and days that stay are not touched. A folder whose name is not a day of
    this partition column is left alone. Running it again removes nothing more.
    """
    cutoff = _years_before(today, years)
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    removed = []
    for status in system.listStatus(root) if system.exists(root) else []:
        column, _, value = status.getPath().getName().partition("=")
        day = _as_day(value)
        if status.isDirectory() and column == partition and day is not None and day < cutoff:
            summary = system.getContentSummary(status.getPath())
            removed.append((day, summary.getFileCount(), summary.getLength()))
            if not dry_run and not system.delete(status.getPath(), True):
                raise OSError(f"could not delete {status.getPath()}")
    return spark.createDataFrame(sorted(removed), "day date, files bigint, bytes bigint")


def _as_day(text: str) -> dt.date | None:
    try:
        return dt.date.fromisoformat(text)
    except ValueError:
        return None


def _years_before(day: dt.date, years: int) -> dt.date:
    """As `add_months` does: the last of February where the year has no 29th."""
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return day.replace(year=day.year - years, day=28)


def read_evolved(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table whose older files lack newer nullable columns; those read as null."""
    relaxed = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
    return spark.read.schema(relaxed).parquet(path)


def check_evolution(old: T.StructType, new: T.StructType) -> None:
    """Raises if files of `old` or consumers of it would not survive `new`."""
    problems = breaking_changes(old, new)
    if problems:
        raise ValueError("breaking schema change: " + "; ".join(problems))
