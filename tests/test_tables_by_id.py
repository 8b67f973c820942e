"""Tables by id, retention that deletes, scan ids."""

import datetime as dt
import os
import re

from helpers import rows_of
from pyspark.sql import functions as F

from riskspark.operators import id_index
from riskspark.plans import maintenance, pii_audit
from riskspark.streaming import sinks


def table(spark, path, size=5000):
    df = spark.range(size).selectExpr("concat('t', id) AS transaction_id", "id AS v")
    id_index.write_indexed(df, "transaction_id", path, buckets=64)
    return spark.read.parquet(path)


def test_lookup_opens_one_bucket(spark, folder):
    stored = table(spark, folder)
    assert len(stored.inputFiles()) == 64
    found = id_index.lookup(stored, "transaction_id", "t4711", buckets=64)
    assert found.columns == ["transaction_id", "v"] and rows_of(found, "v") == [("t4711", 4711)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*id_bucket", plan) and "EqualTo(transaction_id,t4711)" in plan
    assert id_index.lookup(stored, "transaction_id", "absent", buckets=64).count() == 0


def test_files_have_bloom_filters(spark, folder):
    table(spark, folder, 200)
    name = spark.read.parquet(folder).inputFiles()[0].removeprefix("file://")
    jvm = spark._jvm
    source = jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(jvm.org.apache.hadoop.fs.Path(name), spark._jsc.hadoopConfiguration())
    reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(source)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    offsets = {columns.get(i).getPath().toDotString(): columns.get(i).getBloomFilterOffset() for i in range(columns.size())}
    reader.close()
    assert offsets["transaction_id"] >= 0 and offsets["v"] < 0


def test_unknown_reads_the_buckets_of_the_batch(spark, folder):
    stored = table(spark, folder)
    batch = spark.createDataFrame([("t1", 0), ("new", 0), ("t2", 0), (None, 0)], "transaction_id string, v bigint")
    assert sorted(r.transaction_id or "" for r in id_index.unknown(batch, stored, "transaction_id", buckets=64).collect()) == ["", "new"]
    buckets = batch.select(id_index.bucket_of("transaction_id", 64)).distinct().count()
    read = id_index.touched(stored, batch, "transaction_id", buckets=64)
    assert read.select(id_index.BUCKET).distinct().count() <= buckets <= 4
    assert id_index.unknown(batch, None, "transaction_id").count() == 4


def alerts(spark, *rows):
    at = dt.datetime(2024, 1, 1)
    schema = "transaction_id string, account_id string, matched_rule_names array<string>, severity string, evaluation_timestamp timestamp"
    return spark.createDataFrame([(t, "a", ["R"], s, at) for t, s in rows], schema)


def test_alert_ids_are_kept_beside_the_table(spark, folder):
    path, now = f"{folder}/alerts", F.current_timestamp()
    # A table from before the ids were kept.
    sinks.write_batch(sinks.as_stored(alerts(spark, ("t1", "high")), now), path, "alert_day", F.to_date("evaluation_timestamp"), 0)
    sinks.store_alerts(alerts(spark, ("t1", "low"), ("t2", "low")), path, 1, now)
    sinks.store_alerts(alerts(spark, ("t1", "low"), ("t2", "low")), path, 1, now)  # runs again
    sinks.store_alerts(alerts(spark, ("t2", "high"), ("t3", "high")), path, 2, now)
    sinks.store_alerts(alerts(spark, ("t2", "high")), path, 3, now)  # nothing new
    assert rows_of(spark.read.parquet(path).select("transaction_id", "severity"), "transaction_id") == [("t1", "high"), ("t2", "low"), ("t3", "high")]
    assert rows_of(spark.read.parquet(f"{path}_ids").select("transaction_id"), "transaction_id") == [("t1",), ("t2",), ("t3",)]


def test_expired_days_are_deleted_and_others_left_alone(spark, folder):
    days = ["2016-02-28", "2016-02-29", "2017-02-27", "2017-02-28", "2024-02-29"]
    spark.createDataFrame([(d, i) for i, d in enumerate(days)], "day string, v int").write.mode("overwrite").partitionBy("day").parquet(folder)
    os.makedirs(f"{folder}/other=1990-01-01")
    os.makedirs(f"{folder}/day=unknown")
    before = {f: os.stat(f).st_mtime_ns for d in days[3:] for f in [f"{folder}/day={d}/{name}" for name in os.listdir(f"{folder}/day={d}")]}
    today = dt.date(2024, 2, 29)
    planned = maintenance.remove_expired_days(spark, folder, "day", today, dry_run=True)
    assert [str(r.day) for r in planned.collect()] == days[:3] and all(os.path.isdir(f"{folder}/day={d}") for d in days)
    gone = maintenance.remove_expired_days(spark, folder, "day", today).collect()
    assert [(str(r.day), r.files) for r in gone] == [(d, 1) for d in days[:3]] and all(r.bytes > 0 for r in gone)
    assert sorted(os.listdir(folder)) == sorted(n for n in ["_SUCCESS", "._SUCCESS.crc", *[f"day={d}" for d in days[3:]], "day=unknown", "other=1990-01-01"] if os.path.exists(f"{folder}/{n}"))
    assert before == {f: os.stat(f).st_mtime_ns for f in before}
    assert maintenance.remove_expired_days(spark, folder, "day", today).count() == 0
    assert maintenance.remove_expired_days(spark, f"{folder}/absent", "day", today).count() == 0
    kept = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("d"))
    assert sorted(str(r.d) for r in maintenance.retained(kept, "d", F.lit(today)).collect()) == days[3:]


def test_scan_ids():
    one, two = (pii_audit.new_scan_id(dt.date(2024, 1, 31)) for _ in range(2))
    assert re.fullmatch(r"audit-scan-20240131-[0-9a-f]{8}", one) and one != two
