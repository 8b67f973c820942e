"""Tables laid out for lookups by id: hash buckets as folders, and a bloom filter of the ids in every file.

A lookup of one id opens one bucket's folder, in which Parquet's bloom filters skip the row groups without it. An
insert-ignore of a micro-batch opens only the buckets its ids fall into, and of each only the id column. Cost follows the
batch, not the table, as long as batches are smaller than the number of buckets. Each bucket has the number of the micro-batch
below it, so a batch that runs again replaces its own files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
BUCKET = "id_bucket"
BATCH = "ingest_batch"
#: Ids a file's filter is made for; more make it less selective, never wrong.
EXPECTED_IDS = 1_000_000


def bucket_of(key: str | Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_indexed(df: DataFrame, key: str, path: str, batch_id: int = 0, buckets: int = BUCKETS) -> None:
    """Writes the rows of one batch; a null key has a bucket like any other value."""
    placed = df.withColumns({BUCKET: bucket_of(key, buckets), BATCH: F.lit(batch_id)})
    (
        placed.repartition(F.col(BUCKET))
        .sortWithinPartitions(BUCKET, key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(EXPECTED_IDS))
        .partitionBy(BUCKET, BATCH)
        .parquet(path)
    )


def read_indexed(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None where nothing has been written."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    return spark.read.parquet(path)


def lookup(table: DataFrame, key: str, value: str, buckets: int = BUCKETS) -> DataFrame:
    """Rows with this id; the bucket is worked out here, so other folders are not listed among the files to read."""
    bucket = table.sparkSession.range(1).select(bucket_of(F.lit(value), buckets)).first()[0]
    return table.where((F.col(BUCKET) == bucket) & (F.col(key) == F.lit(value))).drop(BUCKET, BATCH)


def touched(table: DataFrame, incoming: DataFrame, key: str, before_batch: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The rows of the buckets that `incoming` falls into, without those of `before_batch` and later batches.

    The driver learns the buckets, at most `buckets` small numbers.
    """
    opened = [r[0] for r in incoming.select(bucket_of(key, buckets)).distinct().collect()]
    rows = table.where(F.col(BUCKET).isin(opened))
    return rows if before_batch is None else rows.where(F.col(BATCH) < before_batch)


def unknown(incoming: DataFrame, table: DataFrame | None, key: str, before_batch: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Rows of `incoming` whose id the table does not hold."""
    if table is None:
        return incoming
    known = touched(table, incoming, key, before_batch, buckets).select(BUCKET, key)
    placed = incoming.withColumn(BUCKET, bucket_of(key, buckets))
    return placed.join(known, [BUCKET, key], "left_anti").drop(BUCKET)
