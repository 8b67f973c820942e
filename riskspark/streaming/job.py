"""The running job: one enrichment stream, one micro-batch function, all sinks."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from riskspark.operators import decisions as dec
from riskspark.operators.assemble import as_record, assemble
from riskspark.operators.corrections import LATE_COLUMNS, corrected
from riskspark.operators.rules import Rule, evaluate
from riskspark.plans.dead_letters import processing_envelopes
from riskspark.schemas import DECISION, ENRICHED_TABLE
from riskspark.streaming import sinks
from riskspark.streaming.enrich import as_features, enriched_stream


@dataclass(frozen=True)
class Paths:
    """Folders of the job's tables under one shared root."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name in ("enriched", "decisions", "alerts", "late", "alert_letters", "features", "failures", "misfits", "checkpoint"):
            return f"{self.root}/{name}"
        raise AttributeError(name)


def late_letters(refused: DataFrame, source_topic: str) -> DataFrame:
    behind = F.col("watermark_ms") - F.col("event_ms")
    message = F.concat(F.lit("event is "), behind.cast("string"), F.lit(" ms behind the watermark"))
    rows = refused.select(
        "transaction_id",
        F.lit("LATE_EVENT_BEYOND_ALLOWED_LATENESS").alias("error_type"),
        message.alias("error_message"),
        F.timestamp_millis("watermark_ms").alias("watermark_at_rejection"),
        F.col("event_time").alias("event_time_at_rejection"),
    )
    return processing_envelopes(rows, source_topic, F.current_timestamp())


def batch_function(
    rules: Iterable[Rule],
    paths: Paths,
    source_topic: str,
    deliver: Callable[[DataFrame], None] | None,
    publish: Callable[[DataFrame], None] | None,
) -> Callable[[DataFrame, int], None]:
    """Writes all outputs of one micro-batch, which is computed once and kept for the writes."""
    rules = list(rules)

    def run(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            refused = kept.where(F.col("lateness") == "beyond")
            letters = late_letters(refused, source_topic)
            sinks.write_batch(letters, paths.late, "failed_day", F.to_date("failed_at"), batch_id)

            accepted = kept.where(F.col("lateness") != "beyond")
            # One instant for the whole batch, so that all tables agree on it.
            now_ms = F.lit(int(time.time() * 1000)).cast("bigint")
            record = assemble(as_features(accepted), now_ms)
            evaluated = evaluate(record, rules)
            order = ["enrichment_time", "account_id"]
            rows = as_record(record)
            late = accepted.where(F.col("lateness") == "within").select(*LATE_COLUMNS)
            first, last = late.agg(F.min(F.to_date("event_time")), F.max(F.to_date("event_time"))).first()
            stored = sinks.stored_before(batch.sparkSession, paths.enriched, batch_id) if first else None
            if stored is not None:
                # Two literal days either side, so that only these partitions are read.
                reach = dt.timedelta(days=2)
                nearby = stored.where(F.col("event_day").between(F.lit(first - reach), F.lit(last + reach)))
                again = corrected(nearby, late, now_ms)
                rows = rows.select(*ENRICHED_TABLE.names).unionByName(again.select(*ENRICHED_TABLE.names))
            sinks.write_record_table(
                rows, ENRICHED_TABLE, paths.enriched, "event_day", "event_time", batch_id, order, paths.misfits
            )
            decided = dec.decide(evaluated, now_ms)
            sinks.write_record_table(
                decided, DECISION, paths.decisions, "decision_day", "decision_time_ms", batch_id, ["decision_time_ms"],
                f"{paths.misfits}_decisions",
            )
            sinks.publish_features(record, paths.features, batch_id)
            alerts = dec.alerts(evaluated, now_ms)
            sinks.store_alerts(alerts, paths.alerts, batch_id, F.current_timestamp())
            if deliver is not None:
                sinks.deliver_alerts(alerts, deliver, paths.alert_letters, batch_id)
            if publish is not None:
                publish(sinks.keyed_json(rows, "account_id"))
        finally:
            kept.unpersist()

    return run


def start(
    events: DataFrame,
    ranges: DataFrame,
    rules: Iterable[Rule],
    root: str,
    source_topic: str = "txn.api",
    deliver: Callable[[DataFrame], None] | None = None,
    publish: Callable[[DataFrame], None] | None = None,
    trigger: dict | None = None,
    history: DataFrame | None = None,
) -> StreamingQuery:
    """Starts the job on a stream of events. State, offsets and tables live under `root`.

    `ranges` is the geo reference table, flattened when the query starts; restart it to take over a new one.
    `history` is the enriched table that a query without a checkpoint takes its first state from.

    `deliver` gets each batch's alerts and `publish` its enriched rows as keyed
    JSON, for instance to write them to a topic; both may see a batch again
    after a failure.
    """
    paths = Paths(root)
    write = sinks.logged("enrichment", paths.failures, batch_function(rules, paths, source_topic, deliver, publish))
    stream = enriched_stream(events, ranges, history)
    return (
        stream.writeStream.outputMode("append")
        .option("checkpointLocation", paths.checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
