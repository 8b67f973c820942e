"""Times the headline queries on the given tables and prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from riskspark import registry  # noqa: E402
from riskspark.session import build_session  # noqa: E402

HEADLINE = [
    "velocity_features",
    "device_profile",
    "geo_enrich",
    "enriched_transactions",
    "rule_eval_all",
    "fraud_rate_end_to_end",
    "transaction_audit",
    "audit_lookup",
    "fraud_rate_daily",
    "rule_triggers_daily",
    "model_versions",
    "rule_leaderboard",
    "feature_asof",
    "training_set",
    "label_feedback_join",
    "dedup_first_48h",
    "dlq_rolling_trend",
    "reconciliation",
    "reconciliation_tree",
    "fraud_rate_rollup",
    "ingest_validation",
    "pii_audit_findings",
    "latency_histogram",
]


def run(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    registry.queries()[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def shuffles(spark, name: str, folder: str) -> int:
    """Exchanges of rows in the plan of a query, without broadcasts and reused ones."""
    plan = registry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"[ +:-]Exchange (?:hash|range|SinglePartition|RoundRobin)", plan))


def streaming_rows_per_second(spark, folder: str, files: int = 4) -> float:
    """Rows a second of the enrichment job over all events, dealt out in `files` files of event order, one per micro-batch.

    Takes minutes, so it runs only where BENCH_STREAM is set.
    """
    from pyspark.sql import functions as F
    from pyspark.sql.functions import coalesce, lit

    from riskspark.registry.rules import SCALED_RULES
    from riskspark.schemas import RAW_EVENT
    from riskspark.sources import driver_tables as given
    from riskspark.sources.streams import file_stream
    from riskspark.streaming import job

    root = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    rows = given.transactions(spark, folder).withColumn("api_key_id", coalesce("api_key_id", lit("")))
    rows = rows.select("event_id", *[c for c in RAW_EVENT.names if c != "schema_version"])
    total = rows.count()
    for part in range(files):
        own = rows.where((F.col("event_id") * files / total).cast("int") == part).drop("event_id")
        own.coalesce(1).write.mode("append").parquet(f"{root}/in")
        time.sleep(1.1)  # files are taken in the order of their modification times
    schema = spark.read.parquet(f"{root}/in").schema
    start = time.perf_counter()
    events = file_stream(spark, f"{root}/in", schema, files_per_trigger=1)
    query = job.start(events, given.geo_ranges(spark, folder), SCALED_RULES, f"{root}/out", trigger={"availableNow": True})
    query.awaitTermination()
    return round(total / (time.perf_counter() - start), 1)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    run(spark, "table_counts", folder)  # starts the JVM's compilers; not timed
    # Each query runs twice: the first run includes code generation and class
    # loading, the second is the steady state a long-running session sees.
    first = {name: round(run(spark, name, folder), 3) for name in names}
    times = {name: round(run(spark, name, folder), 3) for name in names}
    exchanges = {name: shuffles(spark, name, folder) for name in names}
    rows = spark.read.parquet(f"{folder}/events.parquet").count()
    streamed = streaming_rows_per_second(spark, folder) if os.environ.get("BENCH_STREAM") else None
    spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "shuffles": exchanges,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    if "fraud_rate_end_to_end" in times:
        result["transactions_per_second"] = round(rows / times["fraud_rate_end_to_end"])
    if streamed is not None:
        result["streaming_rows_per_second"] = streamed
    print(json.dumps(result))


if __name__ == "__main__":
    main()
