import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helpers import rows_of
from riskspark.operators import ingest
from riskspark.operators.features import lookup, snapshot
from riskspark.operators.scoring import score
from riskspark.plans import dead_letters as dl
from riskspark.plans import maintenance, monitors, pii_audit, reconcile
from riskspark.schemas import (
    ENRICHED_EVENT, ENRICHED_TABLE, FEATURE_COLUMNS, RAW_PAYLOAD, breaking_changes, added_columns, conform, split_conformed, with_catalogue,
)
from riskspark.sources import framed_avro
from riskspark.streaming.sinks import keyed_json

NOW = 1_700_000_000_000
PAYLOAD = dict(
    transaction_id="t1", account_id="a1", merchant_id="m1", amount="12.5", currency="USD", event_time=NOW, channel="WEB",
    card_number="4532-0151-1283-0366", caller_ip="203.0.113.77", api_key_id="k", oauth_scope="txn:write", geo_lat=1.5, geo_lon=None,
)


def checked(spark, *changes):
    rows = [tuple({**PAYLOAD, **change}[n] for n in RAW_PAYLOAD.names) for change in changes]
    return ingest.check(spark.createDataFrame(rows, RAW_PAYLOAD), F.lit(NOW).cast("bigint"))


CASES = [
    ({}, [], [], None),
    ({"amount": None}, ["amount"], [], "ValidationError"),
    ({"amount": "0"}, [], ["amount must be > 0"], "ValidationError"),
    ({"amount": "x"}, [], ["amount must be a numeric value"], "ValidationError"),
    ({"currency": "USDX"}, [], ["currency must be a 3-character ISO-4217 code"], "ValidationError"),
    ({"channel": "FAX"}, [], ["channel must be one of ['API', 'MOBILE', 'POS', 'WEB']"], "ValidationError"),
    ({"event_time": NOW - 300_000}, [], [], None),
    ({"event_time": NOW + 300_001}, [], ["event_time is more than 5 minutes from server time"], "ValidationError"),
    ({"event_time": 0, "merchant_id": ""}, ["merchant_id", "event_time"], [], "ValidationError"),
    ({"card_number": "4532015112830367"}, [], [], "InvalidPANError"),
    ({"caller_ip": "224.0.0.1"}, [], [], "MaskingError"),
]


def test_validation(spark):
    got = checked(spark, *[{**change, "account_id": f"a{i:02d}"} for i, (change, *_) in enumerate(CASES)])
    for row, (_, missing, errors, kind) in zip(got.orderBy("account_id").collect(), CASES):
        assert (row.missing, row.errors, row.error_type) == (missing, errors, kind)


def test_numeric_zero_amount_is_missing(spark):
    df = spark.createDataFrame([(0.0,)], "amount double")
    assert "amount" in df.select(ingest.missing_fields(df)).first()[0]


def test_events_and_letters(spark):
    rows = checked(spark, {}, {"transaction_id": "t2", "amount": "-1"})
    accepted, rejected = ingest.split(rows)
    event = ingest.build_events(accepted, F.lit(NOW + 5).cast("bigint"), force_channel="API")
    (row,) = event.collect()
    assert (row.card_bin, row.card_last4, row.caller_ip_subnet, row.channel) == ("453201", "0366", "203.0.113.0", "API")
    assert "card_number" not in event.columns and event.select(ingest.leaking_columns(event)).first()[0] == []
    leak = event.withColumn("account_id", F.lit("4532015112830366"))
    assert leak.select(ingest.leaking_columns(leak)).first()[0] == ["account_id"]
    with pytest.raises(ValueError):
        ingest.leaking_columns(rows)
    (letter,) = ingest.reject_envelopes(rejected, "txn.api", F.current_timestamp(), "h").collect()
    body = json.loads(letter.original_payload)
    assert body["transaction_id"] == "t2" and "card_number" not in body and "caller_ip" not in body
    assert letter.error_message == "Field validation errors: amount must be > 0"


def test_frames(spark):
    good = b"\x00" + (7).to_bytes(4, "big") + b"body"
    rows = [(1, good), (2, b"\x00\x01"), (3, b"\x05" + good[1:]), (4, b"\x00" + (8).to_bytes(4, "big") + b"x"), (5, None), (6, good[:5] + b"")]
    df = spark.createDataFrame(rows, "offset int, value binary")

    def decoder(value):
        text = F.decode(framed_avro.body(value), "UTF-8")
        return F.struct(F.when(text != "", text).alias("transaction_id"))

    ok, bad = framed_avro.decode(df, decoder, schema_id=7)
    assert [r[0] for r in ok.collect()] == ["body"]
    assert [r[1] for r in rows_of(bad.select("offset", "error_message"), "offset")] == [
        "frame_short:2", "frame_magic:05", "frame_schema:8:7", "frame_absent", "Record cannot be decoded",
    ]


def test_schemas():
    assert len(ENRICHED_EVENT) == 37 and len(ENRICHED_TABLE) == 36
    assert set(ENRICHED_EVENT.names) - set(ENRICHED_TABLE.names) == {"processing_time"}
    assert with_catalogue(ENRICHED_TABLE)["card_bin"].metadata == {"sensitivity": "confidential", "pci": True}
    assert sum(len(f) for f in FEATURE_COLUMNS.values()) == 17
    old = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType(), False)])
    newer = T.StructType([*old, T.StructField("c", T.StringType())])
    assert breaking_changes(old, newer) == [] and added_columns(old, newer).names == ["c"]
    bad = T.StructType([T.StructField("a", T.StringType()), T.StructField("d", T.StringType(), False)])
    assert breaking_changes(old, bad) == ["type changed: a", "removed: b", "added as not null: d"]
    with pytest.raises(ValueError):
        maintenance.check_evolution(old, bad)
    assert breaking_changes(old, T.StructType([T.StructField("a", T.IntegerType(), False), old["b"]])) == ["no longer nullable: a"]


def test_conform_splits(spark):
    schema = T.StructType([T.StructField("id", T.StringType(), False), T.StructField("n", T.IntegerType(), False), T.StructField("b", T.BooleanType())])
    df = spark.createDataFrame([("a", "1", "YES"), ("b", "x", "0"), ("c", None, None)], "id string, n string, b string")
    good, bad = split_conformed(df, schema)
    assert rows_of(good, "id") == [("a", 1, True)]
    assert rows_of(bad.select("id", "null_columns"), "id") == [("b", ["n"]), ("c", ["n"])]
    assert conform(df.drop("b"), schema).schema["b"].dataType == T.BooleanType()


def test_feature_lookup_modes(spark):
    names = [f.name for s in FEATURE_COLUMNS.values() for f in s]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for s in FEATURE_COLUMNS.values() for f in s)
    whole = [7, 1.0, 7, 1.0, 7, 1.0, 7, 1.0, "US", "NY", "HOSTING", 0.5, 1, 2, True, "FR", 3]
    partial = [*whole[:-1], None]
    snap = spark.createDataFrame([("a", *whole), ("b", *partial)], f"account_id string, {types}")
    tx = spark.createDataFrame([("1", "a", 5), ("2", "b", 5), ("3", "c", None)], "transaction_id string, account_id string, vel_count_1m int")
    over = {r.transaction_id: r for r in lookup(tx, snap, "overwrite").collect()}
    assert (over["1"].vel_count_1m, over["1"].feature_miss) == (7, False)
    assert all(over[t].feature_miss and over[t].vel_count_1m == 0 and over[t].geo_country == "" for t in ("2", "3"))
    fill = {r.transaction_id: r for r in lookup(tx, snap).collect()}
    assert (fill["1"].vel_count_1m, fill["3"].vel_count_1m, fill["1"].geo_country) == (5, 0, "US")
    assert set(names) <= set(lookup(tx, snap).columns)
    with pytest.raises(ValueError):
        lookup(tx, snap, "other")


def test_scorer_fallback(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("x"))

    def broken():
        raise OSError("model server is away")

    def picky():
        def model(batch):
            raise RuntimeError("bad batch")

        return model

    for load in (broken, picky):
        rows = score(df, ["x"], load, "v1", fallback_score=0.25).collect()
        assert {(r.fraud_probability, r.model_version, r.used_fallback) for r in rows} == {(0.25, "fallback", True)}
    rows = score(df, ["x"], lambda: (lambda b: b["x"] / 10), "v1").collect()
    assert sorted(r.fraud_probability for r in rows) == [0.0, 0.1, 0.2, 0.3, 0.4]


def test_compaction_rewrites_days(spark, folder):
    rows = [("a", 1, "2024-01-01"), ("a", 2, "2024-01-01"), ("b", 1, "2024-01-02"), ("b", 5, "2024-01-02"), ("c", 1, "2024-01-03")]
    df = spark.createDataFrame(rows, "id string, v int, day string").withColumn("day", F.col("day").cast("date"))
    source, target = f"{folder}/s", f"{folder}/t"
    df.write.partitionBy("day").parquet(source)
    for days in (["2024-01-01", "2024-01-02"], ["2024-01-02"]):
        maintenance.compact_days(spark, source, target, "day", days, "id", "v")
    assert rows_of(spark.read.parquet(target).select("id", "v"), "id") == [("a", 2), ("b", 5)]
    with pytest.raises(ValueError):
        maintenance.compact_days(spark, source, source + "/", "day", [], "id", "v")


def test_retention_boundary(spark):
    df = spark.createDataFrame([("2017-06-29",), ("2017-06-30",), ("2020-01-01",)], "day string").withColumn("day", F.col("day").cast("date"))
    assert maintenance.retained(df, "day", F.lit("2024-06-30").cast("date")).count() == 2
    assert maintenance.expired_days(df, "day", F.lit("2024-06-30").cast("date")).count() == 1


def test_pii_audit_of_columns_and_rows(spark):
    df = spark.createDataFrame([("x 203.0.113.42", "1"), ("clean", "2")], "note string, Card_Number string")
    log = pii_audit.audit({"t": df}, "audit-scan-1", F.current_timestamp()).collect()
    assert sorted((r.matched_field, r.matched_pattern, r.action_taken) for r in log) == [
        ("Card_Number", "FIELD_NAME", "TABLE_HALTED"), ("note", "IPv4", "ALERT_SENT"),
    ]
    assert all(len(r.record_sample_hash) == 64 for r in log)


def test_reports_on_empty_tables(spark):
    ids = spark.createDataFrame([], "transaction_id string")
    row = reconcile.report(ids, ids, ids).first()
    assert (row.source_ids, row.gap, row.within_limit) == (0, 0.0, True)
    daily = spark.createDataFrame([], "day date, dlq_topic string, error_type string, n bigint")
    day = F.lit("2024-01-01").cast("date")
    assert dl.rolling_trend(daily).count() == 0 and dl.top_errors(daily, day).count() == 0
    rate = dl.error_rate(daily, daily, day).first()
    assert (rate.total_dlq_volume, rate.error_rate_pct, rate.classification) == (0, 0.0, "normal")


def test_silent_minutes_edges(spark):
    rows = [(m * 60_000, m in (0, 25)) for m in range(0, 61)]
    df = spark.createDataFrame(rows, "ms bigint, flagged boolean")
    got = [r[0] // 60_000 for r in monitors.silent_minutes(df, "ms", F.col("flagged")).collect()]
    assert sorted(got) == [*range(19, 25), *range(44, 61)]


def test_replay_plan(spark):
    df = spark.createDataFrame([("d2", 2, "a"), ("d1", 1, "b"), ("d3", 3, "a")], "dlq_id string, failed_at int, error_type string")
    assert rows_of(dl.replay_plan(df, "t", 1).select("dlq_id", "target_topic"), "dlq_id") == [("d1", "[DRY RUN]")]
    live = dl.replay_plan(df, "t", 5, ("a",), dry_run=False)
    assert rows_of(live.select("dlq_id", "target_topic"), "dlq_id") == [("d2", "t"), ("d3", "t")]
    with pytest.raises(ValueError):
        dl.replay_plan(df, "t", 0)
    sent = []
    dl.replay(live, lambda rows, target: sent.append((target, rows.count())))
    dl.replay(dl.replay_plan(df, "t", 1), lambda rows, target: sent.append((target, rows.count())))
    assert sent == [("t", 2)]


def test_trend_report_files(spark, folder):
    rows = [("2024-01-0%d" % d, "txn.scoring.dlq", "bad", d) for d in range(1, 8)]
    daily = spark.createDataFrame(rows, "day string, dlq_topic string, error_type string, n bigint").withColumn("day", F.col("day").cast("date"))
    main = daily.select("day", F.explode(F.sequence(F.lit(1), F.lit(100))))
    day = F.lit("2024-01-07").cast("date")
    report = dl.trend_report(daily, main, day)
    for _ in range(2):
        dl.write_report(report, folder, "2024-01-07")
    rate = spark.read.json(f"{folder}/error_rate").first()
    assert (rate.total_dlq_volume, rate.error_rate_pct, rate.classification) == (7, 7.0, "high")
    (window,) = spark.read.json(f"{folder}/windows").collect()
    assert (window.today, window.total_7d, window.trend) == (7, 28, "increasing")
    assert spark.read.json(f"{folder}/topics").first().dominant_error == "bad"


def test_keyed_json(spark):
    (row,) = keyed_json(spark.createDataFrame([("a", 1)], "id string, v int"), "id").collect()
    assert row.key == "a" and json.loads(row.value) == {"id": "a", "v": 1}


def test_block_rate_days_without_block(spark):
    import datetime as dt

    from riskspark.plans.reports import block_rate
    from riskspark.plans.views import lookback

    rows = [("t1", "ALLOW", 0.0, dt.datetime(2024, 1, 1)), ("t2", "BLOCK", 0.8, dt.datetime(2024, 1, 2))]
    df = spark.createDataFrame(rows, "transaction_id string, decision string, fraud_score double, decision_time_ms timestamp")
    assert [r[3] for r in rows_of(block_rate(df), "decision_date")] == [0.0, 1.0]
    assert block_rate(df, strict_reference=True).count() == 1
    assert block_rate(df, start="2024-01-02").count() == 1
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    assert lookback(df, "decision_time_ms", now, 24).count() == 1 and lookback(df, "decision_time_ms", now, 25).count() == 2
    with pytest.raises(ValueError):
        lookback(df, "decision_time_ms", now, 91 * 24)


def test_snapshot_takes_latest(spark):
    views = {
        "geo": spark.createDataFrame(
            [("a", 1, "t1", "US", "NY", "H", 0.5), ("a", 2, "t2", "FR", "P", "R", 0.25)],
            "account_id string, event_timestamp bigint, transaction_id string, geo_country string, geo_city string, geo_network_class string, geo_confidence double",
        )
    }
    assert rows_of(snapshot(views).select("account_id", "geo_country"), "account_id") == [("a", "FR")]


def test_a_decision_made_again_after_the_window_is_not_reported(spark):
    import datetime as dt

    from riskspark.plans.views import current_decisions, recent_decisions

    rows = [("t1", "BLOCK", 0.9, dt.datetime(2024, 1, 10)), ("t1", "ALLOW", 0.1, dt.datetime(2024, 1, 12)), ("t2", "FLAG", 0.5, dt.datetime(2024, 1, 10))]
    df = spark.createDataFrame(rows, "transaction_id string, decision string, fraud_score double, decision_time_ms timestamp")
    assert [r["decision"] for r in current_decisions(df, "2024-01-09", "2024-01-10").collect()] == ["FLAG"]
    assert {r["decision"] for r in current_decisions(df).collect()} == {"ALLOW", "FLAG"}
    now = F.lit("2024-01-10 12:00:00").cast("timestamp")
    assert [r["decision"] for r in recent_decisions(df, now, 24).collect()] == ["FLAG"]


@pytest.mark.parametrize("amount", ["NaN", "Infinity", "1e20"])
def test_amounts_that_cannot_be_stored_are_errors(spark, amount):
    from riskspark.operators.ingest import ERRORS, value_errors

    df = spark.createDataFrame([(amount, 0, "EUR", "POS", "k", "s")], "amount string, event_time bigint, currency string, channel string, api_key_id string, oauth_scope string")
    assert ERRORS["amount_type"] in df.select(value_errors(F.lit(0)).alias("e")).first()["e"]


def test_feed_survives_a_first_batch_without_alerts(spark, folder):
    from riskspark.streaming.live import feed_step, read_feed
    from riskspark.streaming.sinks import write_batch

    schema = "transaction_id string, account_id string, evaluation_timestamp timestamp"
    empty = spark.createDataFrame([], schema)
    write_batch(feed_step(None, empty), f"{folder}/feed", "feed_day", F.lit("1970-01-01").cast("date"), 0)
    assert read_feed(spark, folder, empty.schema).count() == 0
