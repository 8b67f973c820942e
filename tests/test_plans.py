"""Plan shapes that matter at scale."""

import re

import pytest

from riskspark.registry import queries

FOLDER = "/root/testdata/sf0.001"


def plan(spark, name):
    return queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_small_broadcasts(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_cross_joins(spark, no_small_broadcasts, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["transaction_audit", "fraud_rate_daily", "compaction_latest", "dedup_batch_first"])
def test_latest_row_is_picked_before_the_shuffle(spark, no_small_broadcasts, name):
    text = plan(spark, name)
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit.*Partial", text)


def test_join_of_deduplicated_sides_needs_no_further_shuffle(spark, no_small_broadcasts):
    assert plan(spark, "transaction_audit").count("Exchange hashpartitioning") == 2


def test_velocity_shuffles_rows_once(spark, no_small_broadcasts):
    text = plan(spark, "velocity_features")
    rows = [line for line in text.splitlines() if "Exchange hashpartitioning(account_id" in line and "_chunk" in line]
    # No account is hot here, so nothing of the reduced chunks is left in the plan.
    assert len(rows) == 1
    assert text.count("BroadcastExchange") == 0


def test_scan_reads_only_what_is_needed(spark):
    text = plan(spark, "dlq_daily_counts")
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", text):
        assert "value" not in schema and "user_id" not in schema


def test_filters_reach_the_scan(spark):
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", plan(spark, "dlq_daily_counts"))
    assert scans and all("EqualTo(event_type,error)" in s for s in scans)
