"""The streaming job against the batch operators, over files of events."""

import os
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from riskspark.operators.assemble import add_features
from riskspark.registry.rules import SCALED_RULES
from riskspark.schemas import RAW_EVENT
from riskspark.sources import driver_tables as given
from riskspark.sources.lake import read_decisions, read_enriched
from riskspark.sources.streams import file_stream
from riskspark.streaming import enrich, job, live, sinks, state_audit

COLUMNS = [c for c in RAW_EVENT.names if c != "schema_version"]
COMPARED = ["vel_count_1m", "vel_count_5m", "vel_count_1h", "vel_count_24h", "vel_amount_1h", "vel_amount_24h", "geo_country",
            "device_txn_count", "prev_geo_country"]


def events_of(spark, small):
    return given.transactions(spark, small).withColumn("api_key_id", F.coalesce("api_key_id", F.lit("")))


def add_file(df, path):
    df.select(*COLUMNS).coalesce(1).write.mode("append").parquet(path)
    time.sleep(1.1)  # files are taken in the order of their modification times


@pytest.fixture(autouse=True)
def few_keys(monkeypatch):
    """Small tables need few keys."""
    monkeypatch.setattr(enrich, "SEEN_BUCKETS", 8)
    monkeypatch.setattr(enrich, "KEY_SPREAD", 4)


@pytest.fixture(scope="module")
def ranges(spark, small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("geo") / "ranges")
    given.geo_ranges(spark, small).write.parquet(path)
    return spark.read.parquet(path)


def run(spark, source, ranges, root, deliver=None, publish=None, history=None):
    events = file_stream(spark, source, spark.read.parquet(source).schema, files_per_trigger=1)
    query = job.start(events, ranges, SCALED_RULES, root, deliver=deliver, publish=publish, trigger={"availableNow": True}, history=history)
    assert query.awaitTermination(600)
    assert query.exception() is None


def test_stream_equals_batch_with_restart_late_rows_and_copies(spark, small, ranges, folder):
    source, root = f"{folder}/in", f"{folder}/out"
    tx = events_of(spark, small)
    add_file(tx.where("event_id < 400"), source)
    add_file(tx.where("event_id >= 390 AND event_id < 700"), source)  # ten copies
    run(spark, source, ranges, root)
    assert read_enriched(spark, f"{root}/enriched").count() == 700

    state = state_audit.velocity_state(spark, f"{root}/checkpoint")
    buckets = state_audit.differing_buckets(state, read_enriched(spark, f"{root}/enriched")).cache()
    assert buckets.count() > 5 and buckets.where("NOT same").count() == 0
    assert state_audit.report(buckets).first().within_limit
    newest = buckets.orderBy(F.col("minute").desc(), "account_id").first()
    wrong = F.when((F.col("minute") == newest.minute) & (F.col("account_id") == newest.account_id), F.col("n") + 1).otherwise(F.col("n"))
    planted = state_audit.differing_buckets(state.withColumn("n", wrong), read_enriched(spark, f"{root}/enriched"))
    assert [(r.account_id, r.minute, r.state_n - r.table_n) for r in planted.where("NOT same").collect()] == [(newest.account_id, newest.minute, 1)]
    assert state_audit.report(planted).first().differing == 1

    # A restart goes on from the checkpoint. The new files hold rows beyond the
    # allowed lateness: two minutes, eleven minutes and three days behind the newest event.
    newest = tx.where("event_id < 700").agg(F.max("event_ms")).first()[0]
    behind = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(ms).alias("ms"))
                                 for name, ms in (("late-1", 120_000), ("late-2", 660_000), ("late-3", 259_200_000))]))
    late = tx.where("event_id = 5").withColumn("behind", behind).withColumns(
        {"transaction_id": F.col("behind.name"), "event_time": F.timestamp_millis(F.lit(newest) - F.col("behind.ms"))}
    )
    add_file(late, source)
    add_file(tx.where("event_id >= 700"), source)
    failures = []

    def deliver(alerts):
        failures.append(alerts.count())
        raise ConnectionError("topic is away")

    run(spark, source, ranges, root, deliver)

    stored = read_enriched(spark, f"{root}/enriched")
    expected = add_features(tx, given.geo_ranges(spark, small)).select("transaction_id", *COMPARED)
    got = stored.select("transaction_id", *COMPARED)
    assert got.count() == 1000
    assert expected.exceptAll(got).count() == 0

    letters = spark.read.parquet(f"{root}/late").select("transaction_id", "error_type", "watermark_at_rejection", "event_time_at_rejection")
    letters = rows_of(letters, "transaction_id")
    assert [(r[0], r[1]) for r in letters] == [(f"late-{n}", "LATE_EVENT_BEYOND_ALLOWED_LATENESS") for n in (1, 2, 3)]
    assert all(r[2] is not None and r[3] < r[2] for r in letters)

    decisions = read_decisions(spark, f"{root}/decisions")
    assert decisions.count() == 1000
    flagged = decisions.where("decision <> 'ALLOW'").count()
    alerts = spark.read.parquet(f"{root}/alerts")
    assert alerts.count() == flagged and alerts.select("status").distinct().collect()[0][0] == "pending"
    assert sum(failures) == spark.read.parquet(f"{root}/alert_letters").count() > 0
    for view in ("velocity", "geo", "device"):
        assert spark.read.parquet(f"{root}/features/{view}").count() == 1000


def test_new_query_begins_with_the_state_of_stored_rows(spark, small, ranges, folder):
    """Two queries, the second with its own checkpoint, give what one run over all rows gives."""
    tx = events_of(spark, small).where("event_id < 500")
    add_file(tx.where("event_id < 250"), f"{folder}/in")
    add_file(tx.where("event_id >= 240"), f"{folder}/next")  # ten copies of rows the first query has seen
    run(spark, f"{folder}/in", ranges, f"{folder}/out")
    before = read_enriched(spark, f"{folder}/out/enriched")
    run(spark, f"{folder}/next", ranges, f"{folder}/out2", history=before)
    after = read_enriched(spark, f"{folder}/out2/enriched")
    got = before.select("transaction_id", *COMPARED).unionByName(after.select("transaction_id", *COMPARED))
    expected = add_features(tx, given.geo_ranges(spark, small)).select("transaction_id", *COMPARED)
    assert after.count() == 250 and got.count() == 500
    assert expected.exceptAll(got).count() == 0


def test_late_row_corrects_stored_rows(spark, small, ranges, folder):
    """A row 20 s behind the newest is late but accepted; rows after it are emitted again."""
    source, root = f"{folder}/in", f"{folder}/out"
    tx = events_of(spark, small).where("event_id < 300")
    newest = tx.orderBy(F.col("event_ms").desc()).limit(1)
    add_file(tx, source)
    moved = newest.withColumns(
        {"transaction_id": F.lit("late-2"), "event_time": F.timestamp_millis(F.col("event_ms") - 20_000)}
    )
    add_file(moved, source)
    run(spark, source, ranges, root)
    versions = read_enriched(spark, f"{root}/enriched").where(F.col("account_id") == newest.first().account_id)
    again = versions.where(F.col("transaction_id") == newest.first().transaction_id).orderBy("enrichment_time").collect()
    assert [r.vel_count_1m for r in again] == [again[0].vel_count_1m, again[0].vel_count_1m + 1]
    assert read_enriched(spark, f"{root}/enriched").where("transaction_id = 'late-2'").count() == 1
    assert spark.read.schema("transaction_id string").parquet(f"{root}/late").count() == 0


def test_misfit_row_becomes_a_letter(spark, small, ranges, folder):
    source, root = f"{folder}/in", f"{folder}/out"
    add_file(given.transactions(spark, small).where("event_id < 200"), source)  # some have no device key
    published = []
    run(spark, source, ranges, root, publish=lambda df: published.append(df.select("key").distinct().count()))
    assert published and published[0] > 1
    misfits = spark.read.parquet(f"{root}/misfits")
    without = given.transactions(spark, small).where("event_id < 200 AND api_key_id IS NULL").count()
    assert misfits.count() == without > 0
    assert misfits.select("error_message").distinct().collect()[0][0] == "missing api_key_id"
    assert read_enriched(spark, f"{root}/enriched").count() == 200 - without


ELSEWHERE = """
import sys
sys.path.insert(0, sys.argv[1])
from riskspark.session import build_session
from riskspark.streaming import enrich
spark = build_session("elsewhere", "local[2]", spark__sql__shuffle__partitions="1", spark__ui__enabled="false")
at = "timestamp'2024-01-01 00:00:00'"
spark.sql(f"SELECT 't' AS transaction_id, {at} AS event_time, {at} AS processing_time, CAST(1 AS decimal(18,4)) AS amount FROM range(2)").write.parquet("in")
rows = enrich.first_seen(enrich.watermarked(spark.readStream.schema(spark.read.parquet("in").schema).parquet("in")))
query = rows.writeStream.format("parquet").option("checkpointLocation", "c").trigger(availableNow=True).start("out")
assert query.awaitTermination(200) and query.exception() is None
assert spark.read.schema("transaction_id string").parquet("out").count() == 1
"""


def test_keyed_steps_start_from_another_folder(folder):
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {name: value for name, value in os.environ.items() if name != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", ELSEWHERE, home], cwd=folder, env=env, timeout=280, check=True)


def test_rewritten_batch_replaces_itself(spark, folder):
    path = f"{folder}/t"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    day = F.lit("2024-01-01").cast("date")
    sinks.write_batch(df, path, "day", day, 0)
    sinks.write_batch(df.where("v = 2"), path, "day", day, 1)
    sinks.write_batch(df, path, "day", day, 0)
    assert rows_of(spark.read.parquet(path).select("id", sinks.BATCH), "id", sinks.BATCH) == [("a", 0), ("b", 0), ("b", 1)]


def test_alert_store_ignores_known_transactions(spark, folder):
    path = f"{folder}/alerts"
    schema = "transaction_id string, account_id string, matched_rule_names array<string>, severity string, evaluation_timestamp timestamp"
    at = __import__("datetime").datetime(2024, 1, 1)
    first = spark.createDataFrame([("t1", "a", ["R"], "high", at), ("t1", "a", ["R"], "low", at)], schema)
    second = spark.createDataFrame([("t1", "a", ["X"], "low", at), ("t2", "a", ["R"], "low", at)], schema)
    sinks.store_alerts(first, path, 0, F.current_timestamp())
    sinks.store_alerts(second, path, 1, F.current_timestamp())
    sinks.store_alerts(second, path, 1, F.current_timestamp())
    assert rows_of(spark.read.parquet(path).select("transaction_id", "severity"), "transaction_id") == [("t1", "high"), ("t2", "low")]


def test_failed_write_is_logged_and_raised(spark, folder):
    def broken(batch, batch_id):
        raise TimeoutError("too slow")

    with pytest.raises(TimeoutError):
        sinks.logged("enriched", f"{folder}/audit", broken)(spark.range(1), 3)
    assert rows_of(spark.read.parquet(f"{folder}/audit").select("step", "batch_id", "reason"), "step") == [("enriched", 3, "timeout")]


def test_live_feed_keeps_newest(spark, folder):
    schema = "transaction_id string, account_id string, matched_rule_names array<string>, severity string, evaluation_timestamp timestamp"
    import datetime as dt

    def alerts(numbers):
        base = dt.datetime(2024, 1, 1)
        return spark.createDataFrame([(f"t{n}", "a", ["R"], "high", base + dt.timedelta(seconds=n)) for n in numbers], schema)

    source = f"{folder}/alerts"
    for numbers in ((1, 2, 3), (3, 4), (5, 6)):
        alerts(numbers).coalesce(1).write.mode("append").parquet(source)
        time.sleep(1.1)
    stream = file_stream(spark, source, alerts((1,)).schema, files_per_trigger=1)
    query = live.start_feed(stream, folder, size=4, trigger={"availableNow": True})
    assert query.awaitTermination(300)
    assert rows_of(live.read_feed(spark, folder).select("transaction_id"), "transaction_id") == [("t3",), ("t4",), ("t5",), ("t6",)]


def test_label_stream_defaults_to_legitimate(spark, folder):
    import datetime as dt

    start = dt.datetime(2024, 1, 1)

    def decisions(rows):
        return spark.createDataFrame([(t, "BLOCK", start + dt.timedelta(hours=h)) for t, h in rows],
                                     "transaction_id string, decision string, decision_time_ms timestamp")

    def labels(rows):
        return spark.createDataFrame([(t, "fraud", start + dt.timedelta(hours=h)) for t, h in rows],
                                     "transaction_id string, label string, label_timestamp_ms timestamp")

    decisions([("t1", 0), ("t2", 0), ("t3", 0)]).coalesce(1).write.parquet(f"{folder}/d")
    labels([("t1", 30), ("t2", 80)]).coalesce(1).write.parquet(f"{folder}/l")
    time.sleep(1.1)
    decisions([("t9", 400)]).coalesce(1).write.mode("append").parquet(f"{folder}/d")
    labels([("zz", 400)]).coalesce(1).write.mode("append").parquet(f"{folder}/l")
    joined = live.join_labels_stream(
        file_stream(spark, f"{folder}/d", decisions([("t", 0)]).schema, files_per_trigger=1),
        file_stream(spark, f"{folder}/l", labels([("t", 0)]).schema, files_per_trigger=1),
    )
    query = (
        joined.select("transaction_id", "label", "is_fraud").writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(f"{folder}/out")
    )
    assert query.awaitTermination(300)
    assert rows_of(spark.read.schema("transaction_id string, label string, is_fraud boolean").parquet(f"{folder}/out"), "transaction_id") == [
        ("t1", "fraud", True), ("t2", None, False), ("t3", None, False),
    ]


def test_dedup_stream(spark, small, folder):
    tx = given.transactions(spark, small).where("event_id < 50")
    source = f"{folder}/in"
    add_file(tx, source)
    add_file(tx.where("event_id < 10"), source)
    stream = live.dedup_stream(file_stream(spark, source, spark.read.parquet(source).schema, files_per_trigger=1))
    query = (
        stream.select("transaction_id").writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start(f"{folder}/out")
    )
    assert query.awaitTermination(300)
    assert spark.read.schema("transaction_id string").parquet(f"{folder}/out").count() == 50


def test_windowed_counts_stream(spark, folder):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=s), "x") for s in (1, 30, 61, 3600)]
    df = spark.createDataFrame(rows, "failed_at timestamp, error_type string")
    df.coalesce(1).write.parquet(f"{folder}/in")
    counts = live.windowed_counts(file_stream(spark, f"{folder}/in", df.schema), "failed_at", "1 minute", "error_type")
    query = (
        counts.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{folder}/c")
        .trigger(availableNow=True).start(f"{folder}/out")
    )
    assert query.awaitTermination(300)
    got = spark.read.schema("window_start timestamp, error_type string, n bigint").parquet(f"{folder}/out")
    assert [r[0] for r in rows_of(got.select("n"), "n")] == [1, 2]
