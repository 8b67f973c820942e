"""Hash tree, roll-ups, hot keys, doubling and blocked prefixes against their plain definitions."""

import random

import pytest
from helpers import rows_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from riskspark.operators import chunks, dedup
from riskspark.operators.prefix import largest_before
from riskspark.operators.velocity import velocity_features
from riskspark.plans import hash_tree, monitors, reconcile, rollups
from riskspark.registry import queries

FOLDER = "/root/testdata/sf0.001"


def ids(spark, numbers):
    return spark.createDataFrame([(f"txn-{n}",) for n in numbers], "transaction_id string")


@pytest.mark.parametrize("bits,step", [(16, 4), (10, 3), (1, 4)])
def test_tree_reports_what_the_plain_comparison_reports(spark, bits, step):
    source = ids(spark, [*range(500), 7, 7, 7])
    enriched = ids(spark, [n for n in range(510) if n % 97]).unionByName(spark.createDataFrame([(None,)], "transaction_id string"))
    decisions = ids(spark, [n for n in range(505) if n % 50 and n % 97])
    assert hash_tree.report(source, enriched, decisions, bits=bits, step=step).first() == reconcile.report(source, enriched.dropna(), decisions).first()


def test_tree_of_equal_and_of_empty_tables(spark):
    some, none = ids(spark, range(50)), ids(spark, [])
    assert hash_tree.report(some, some, some).first() == reconcile.report(some, some, some).first()
    assert hash_tree.report(none, none, none).first() == reconcile.report(none, none, none).first()
    assert hash_tree.report(some, none, none).first() == reconcile.report(some, none, none).first()


def test_stored_trees_read_only_what_differs(spark, folder, monkeypatch):
    every = ids(spark, range(10_000))
    tables = {"a": every, "b": every.where("transaction_id <> 'txn-4711'"), "c": every.where("transaction_id <> 'txn-4711'")}
    for name, df in tables.items():
        hash_tree.store(df, "transaction_id", f"{folder}/{name}", bits=12, folder_bits=6)
    seen = []
    read = hash_tree.read_leaves

    def counted(spark, path, wanted, bits, folder_bits):
        watch = Observation()
        files = read(spark, path, wanted, bits, folder_bits).inputFiles()
        rows = spark.read.parquet(f"{path}/rows").where(F.col("_metadata.file_path").isin(files)).observe(watch, F.count(F.lit(1)).alias("n"))
        rows.write.format("noop").mode("overwrite").save()
        seen.append(watch.get["n"])
        return read(spark, path, wanted, bits, folder_bits)

    monkeypatch.setattr(hash_tree, "read_leaves", counted)
    row = hash_tree.report_stored(spark, *[f"{folder}/{name}" for name in tables], bits=12, folder_bits=6).first()
    assert row == reconcile.report(*tables.values()).first()
    assert row["missing_enriched"] == 1 and row["missing_decisions"] == 0
    assert len(seen) == 3 and all(n < 10_000 / 64 * 2 for n in seen)
    seen.clear()
    row = hash_tree.report_stored(spark, *[f"{folder}/{name}" for name in "bcb"], bits=12, folder_bits=6).first()
    assert row["source_ids"] == 9_999 and row["gap"] == 0 and seen == [0, 0, 0]


def decided(spark):
    rng = random.Random(2)
    rows = [
        (f"t{i}", f"2024-01-{1 + i % 20:02d}", rng.choice(["WEB", "POS"]), rng.choice(["BLOCK", "ALLOW"]), rng.random() * 100, rng.random() if i % 9 else None, rng.lognormvariate(3, 1))
        for i in range(20_000)
    ]
    rows.append(("lone", "2024-01-05", "API", "FLAG", 5.0, None, None))
    df = spark.createDataFrame(rows, "transaction_id string, day string, channel string, decision string, amount double, fraud_score double, latency_ms double")
    return df.withColumn("decision_date", F.to_date("day"))


def test_rollup_of_a_window_equals_its_rows(spark, folder):
    rows = decided(spark)
    rollups.refresh(rows, rollups.FRAUD_RATE, folder)
    window = ("2024-01-03", "2024-01-18")
    stored = rollups.read(spark, folder)
    assert stored.where(F.col("decision_date").between(*window)).count() == 16 * 4 + 1
    report = rollups.fraud_rate(stored, *window)
    inside = rows.where(F.col("decision_date").between(*window))
    plain = inside.groupBy("channel", "decision").agg(F.count("*").alias("n"), F.sum("amount").alias("a"), F.avg("fraud_score").alias("s"))
    got = rows_of(report.select("channel", "decision", "transaction_count", F.round("total_amount", 6), F.round("avg_fraud_score", 9)), "channel", "decision")
    assert got == rows_of(plain.select("channel", "decision", "n", F.round("a", 6), F.round("s", 9)), "channel", "decision")
    errors = rollups.rank_error(report, inside, ["channel", "decision"], "p99_latency_ms", "latency_ms", 0.99)
    assert all(r.rank_error is None or r.rank_error <= 0.01 for r in errors.collect())
    lone = report.where("channel = 'API'").first()
    assert (lone.transaction_count, lone.avg_fraud_score, lone.p99_latency_ms) == (1, None, None)


def test_rollup_days_are_replaced(spark, folder):
    rows = decided(spark)
    rollups.refresh(rows, rollups.FRAUD_RATE, folder)
    fifth = rows.where("day = '2024-01-05'")
    rollups.refresh(fifth.unionByName(fifth.limit(3)), rollups.FRAUD_RATE, folder)
    by_day = {str(r.decision_date): r.n for r in rollups.fraud_rate(rollups.read(spark, folder), by_day=True).groupBy("decision_date").agg(F.sum("transaction_count").alias("n")).collect()}
    assert by_day["2024-01-05"] == 1004 and by_day["2024-01-06"] == 1000 and len(by_day) == 20


def test_other_rollups_are_within_their_sketch(spark):
    rows = decided(spark).withColumn("model_version", F.col("channel")).withColumn("rule_name", F.col("channel"))
    for kind, report, groups in (
        (rollups.MODEL_VERSIONS, rollups.model_versions, ["model_version", "decision"]),
        (rollups.RULE_TRIGGERS, rollups.rule_triggers, ["rule_name", "decision"]),
    ):
        found = report(rollups.daily(rows, kind))
        assert found.agg(F.sum(kind.count)).first()[0] == 20_001
        for name, share in (("median_fraud_score", 0.5), ("p95_fraud_score", 0.95)):
            errors = rollups.rank_error(found, rows, groups, name, "fraud_score", share)
            assert all(r.rank_error is None or r.rank_error <= 0.01 for r in errors.collect())


def test_hot_keys_are_found_in_one_pass(spark):
    df = spark.range(40_000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 1 THEN NULL ELSE concat('k', id) END AS a", "id % 5 AS b", "id AS at")
    watch = Observation()
    found = chunks.hot_key_lists(df.observe(watch, F.count(F.lit(1)).alias("n")), {"a": F.col("a"), "b": F.col("b")}, hot_rows=5_000)
    assert watch.get["n"] == 40_000
    assert rows_of(found["a"], "_hot") == [("hot",)]
    assert rows_of(found["b"], "_hot") == [(n,) for n in range(5)]
    assert chunks.hot_keys(df, "a").count() == 0
    assert chunks.hot_keys(df.limit(0), "a").count() == 0


def reads(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_inputs_are_read_few_times(spark, monkeypatch):
    passes = []
    find = chunks.hot_key_lists

    def counted(df, keys, hot_rows=chunks.HOT_ROWS):
        passes.append(len(keys))
        return find(df, keys, hot_rows)

    monkeypatch.setattr(chunks, "hot_key_lists", counted)
    monkeypatch.setattr("riskspark.operators.assemble.hot_key_lists", counted)
    assert reads(queries()["velocity_features"](spark, FOLDER)) + len(passes) <= 2
    passes.clear()
    assert queries()["enriched_transactions"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().count("event_id#") > 0
    plan = queries()["enriched_transactions"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    events = sum("event_id#" in line or "user_id#" in line for line in plan.splitlines() if "Relation [" in line)
    assert events + len(passes) / 2 <= 3


def test_velocity_of_hot_and_of_all_keys_agree(spark):
    rng = random.Random(9)
    rows = [(f"t{i}", rng.choice("aaab"), 1_700_000_000_000 + rng.randrange(10_000_000), i) for i in range(600)]
    df = spark.createDataFrame(rows, "transaction_id string, account_id string, event_ms bigint, amount int").withColumn("amount", F.col("amount").cast("decimal(18,4)"))
    assert rows_of(velocity_features(df), "transaction_id") == rows_of(velocity_features(df, hot_rows=100), "transaction_id")


def first_within(rows, ttl):
    kept, last = [], {}
    for key, at, tie in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or at >= last[key] + ttl:
            last[key] = at
            kept.append((key, at, tie))
    return sorted(kept)


@pytest.mark.parametrize("ttl", [1, 7, 100, 5000])
def test_first_within_by_doubling(spark, ttl):
    rng = random.Random(ttl)
    rows = [(rng.choice("abcdef"), rng.randrange(rng.choice([50, 3000])), i) for i in range(700)]
    rows += [("z", n * ttl, n) for n in range(40)] + [("y", n * (ttl + 1) - 3, n) for n in range(40)]
    df = spark.createDataFrame(rows, "key string, at bigint, tie int")
    assert rows_of(dedup.first_within(df, "key", "at", "tie", ttl), "key", "at", "tie") == first_within(rows, ttl)


def test_seven_years_take_a_logarithm_of_jobs(spark, monkeypatch):
    writes = []
    store = dedup.stored
    monkeypatch.setattr(dedup, "stored", lambda df: writes.append(1) or store(df))
    ttl = 48 * 3_600_000
    rows = [("k", n * 50 * 3_600_000, n) for n in range(1200)]
    df = spark.createDataFrame(rows, "key string, at bigint, tie int")
    assert dedup.first_within(df, "key", "at", "tie", ttl).count() == 1200
    assert len(writes) + 1 <= 11 + 2


def test_largest_before_crosses_blocks(spark):
    rng = random.Random(1)
    orders = sorted(rng.sample(range(1 << 20), 500))
    rows = [(o, rng.randrange(1000) if rng.random() < 0.9 else None) for o in orders]
    expected, top = [], None
    for order, value in rows:
        expected.append((order, value, top))
        top = value if top is None else top if value is None else max(top, value)
    df = spark.createDataFrame(rows, "o bigint, v int")
    for bits, order_bits in ((4, 20), (12, 62), (20, 20)):
        assert rows_of(largest_before(df, "o", "v", "before", order_bits, bits), "o") == expected


def test_no_task_orders_all_minutes(spark):
    df = spark.range(5000).selectExpr("id * 30000 AS at", "id * 29000 - (id % 7) * 100000 AS mark")
    stalled = monitors.stalled_watermark(df, "at", "mark")
    plan = stalled._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    last, found = {}, []
    top, since = None, None
    for at, mark in rows_of(df, "at"):
        if top is None or mark > top:
            if since is not None and at - since > monitors.STALL_MS:
                found.append((since, at, at - since))
            top, since = mark, at
    assert rows_of(stalled, "from_ms") == found
