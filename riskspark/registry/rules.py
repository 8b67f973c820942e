"""Rule families, the evaluator, decisions, alerts and backtests."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.functions import severity as sev
from riskspark.operators import decisions as dec
from riskspark.operators.dedup import insert_ignore
from riskspark.operators.rules import Rule, cross_border_count, evaluate
from riskspark.operators.scoring import score
from riskspark.plans import reports, shadow, views
from riskspark.registry.base import DAY, ENRICHED, TX, num, register, velocity_cte, with_ctes
from riskspark.registry.enrichment import FULL_CTES, enriched_now
from riskspark.sources import driver_tables as given

# The default thresholds hardly ever fire on the given tables, so these are lower.
SCALED_RULES = [
    Rule("VEL-001", "COUNT_1H", "velocity", {"field": "vel_count_1h", "count": 1}, "high"),
    Rule("VEL-002", "AMOUNT_24H", "velocity", {"field": "vel_amount_24h", "amount": 250.00}, "high"),
    Rule("VEL-003", "COUNT_24H", "velocity", {"field": "vel_count_24h", "count": 3}, "medium"),
    Rule("VEL-004", "AMOUNT_5M", "velocity", {"field": "vel_amount_5m", "amount": 150}, "low"),
    Rule("IT-001", "TRAVEL", "impossible_travel", {"window_ms": 300000}, "critical"),
    Rule("IT-002", "BORDERS", "impossible_travel", {"count": 3}, "high"),
    Rule("ND-001", "NEW_AMOUNT", "new_device", {"amount": 50.0}, "high"),
    Rule("ND-002", "NEW_RAPID", "new_device", {"device_count": 1, "vel_count": 1}, "medium"),
    Rule("ND-003", "KNOWN_FRAUD", "new_device", {}, "critical"),
    Rule("ND-004", "NEW_NETWORK", "new_device", {"network_class": "HOSTING"}, "high"),
    Rule("VEL-005", "SHADOW_COUNT", "velocity", {"field": "vel_count_24h", "count": 2}, "low", True, "shadow"),
    Rule("VEL-006", "OFF", "velocity", {"field": "vel_count_1m", "count": 0}, "critical", False),
]
STRICTER_RULES = [
    Rule("VEL-001", "COUNT_1H", "velocity", {"field": "vel_count_1h", "count": 2}, "high"),
    *SCALED_RULES[1:3],
    Rule("VEL-007", "COUNT_1M", "velocity", {"field": "vel_count_1m", "count": 1}, "medium"),
    *SCALED_RULES[4:],
]


def _when(condition: str, text: str) -> str:
    return f"CASE WHEN {condition} THEN '{text}' END"


ACTIVE = {
    "VEL-001": ("vel_count_1h > 1", 2),
    "VEL-002": ("vel_amount_24h > 250", 2),
    "VEL-003": ("vel_count_24h > 3", 1),
    "VEL-004": ("vel_amount_5m > 150", 0),
    "IT-001": ("prev_geo_country <> geo_country AND abs(event_ms - prev_txn_time_ms) <= 300000", 3),
    "ND-001": ("device_is_new = 1 AND amount > 50", 2),
    "ND-002": ("device_is_new = 1 AND device_count_24h >= 1 AND vel_count_1m >= 1", 1),
    "ND-003": ("device_known_fraud = 1", 3),
    "ND-004": ("device_is_new = 1 AND geo_network_class = 'HOSTING'", 2),
}


def _listed(pairs) -> str:
    return "list_filter([" + ", ".join(_when(c, r) for r, c in pairs) + "], lambda x: x IS NOT NULL)"


def evaluated_cte(active: dict, source: str = "full_rec", name: str = "evald") -> str:
    rank = "greatest(" + ", ".join(f"CASE WHEN {c} THEN {s} END" for c, s in active.values()) + ")"
    return f"""
{name}0 AS (
  SELECT *, {_listed((r, c) for r, (c, _) in active.items())} AS active,
         {_listed([('VEL-005:shadow', 'vel_count_24h > 2')])} AS shadow, {rank} AS top
  FROM {source}),
{name} AS (
  SELECT *, CASE WHEN len(active) > 0 THEN 'suspicious' ELSE 'clean' END AS determination,
         list_concat(active, shadow) AS matched,
         CASE top WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical' END AS highest_severity
  FROM {name}0)"""


EVALUATED = (*FULL_CTES, evaluated_cte(ACTIVE))


def evaluated_now(spark, folder):
    return evaluate(enriched_now(spark, folder), SCALED_RULES)


def joined(column: str) -> str:
    return f"array_to_string({column}, ',')"


@register(
    "rule_eval_velocity",
    with_ctes(TX, velocity_cte("tx"))
    + f"""SELECT transaction_id, {joined(_listed([('VEL-001', 'vel_count_1h > 1'), ('VEL-002', 'vel_amount_24h > 250'),
      ('VEL-003', 'vel_count_24h > 3'), ('VEL-004', 'vel_amount_5m > 150')]))} AS matched_rules FROM vel""",
)
def rule_eval_velocity(spark, folder):
    from riskspark.operators.velocity import velocity_features

    tx = given.transactions(spark, folder).select("transaction_id", "account_id", "event_ms", "amount")
    rules = [rule for rule in SCALED_RULES if rule.family == "velocity" and not rule.shadow]
    return evaluate(velocity_features(tx), rules).select("transaction_id", "matched_rules")


BOUNDARY = """
edge AS (SELECT *, CASE WHEN event_id % 5 <> 0 THEN 'C' || (k % 24) END AS prev_geo_country,
  CASE WHEN event_id % 5 <> 0 THEN event_ms - event_id % 5 * 600000 END AS prev_txn_time_ms FROM enr)"""


@register(
    "rule_eval_travel",
    with_ctes(TX, ENRICHED, BOUNDARY)
    + """SELECT transaction_id, enriched_ms AS enrichment_time,
  CASE WHEN prev_geo_country <> geo_country AND abs(event_ms - prev_txn_time_ms) <= 1200000 THEN 'IT-001' ELSE '' END AS matched_rules FROM edge""",
)
def rule_eval_travel(spark, folder):
    """Gaps of exactly the window occur and count."""
    rows = given.enriched_table(spark, folder).withColumn("txn_time_ms", F.col("event_ms"))
    rows = rows.withColumn("prev_txn_time_ms", F.unix_millis("prev_txn_time_ms"))
    rules = [
        Rule("IT-001", "TRAVEL", "impossible_travel", {"window_ms": 1200000}, "critical"),
        Rule("IT-002", "BORDERS", "impossible_travel", {"count": 3}, "high"),
    ]
    return evaluate(rows, rules).select("transaction_id", "enrichment_time", "matched_rules")


NEW_DEVICE = """
nd AS (SELECT *, CASE WHEN api_key_id IS NULL THEN NULL ELSE event_id % 5 = 0 END AS is_new,
  CAST(event_id % 4 AS INTEGER) AS c24, CASE WHEN geo_country IS NOT NULL THEN CASE WHEN k % 7 = 0 THEN 'HOSTING' ELSE 'RESIDENTIAL' END END AS cls,
  CASE WHEN api_key_id IS NOT NULL THEN event_id % 97 = 0 END AS fraud FROM enr)"""


@register(
    "rule_eval_new_device",
    with_ctes(TX, ENRICHED, NEW_DEVICE)
    + f"""SELECT transaction_id, enriched_ms AS enrichment_time,
  {joined(_listed([('ND-001', 'is_new AND amount > 50'), ('ND-002', 'is_new AND c24 >= 2 AND cnt >= 5'),
                   ('ND-003', 'fraud'), ('ND-004', "is_new AND cls = 'HOSTING'")]))} AS matched_rules FROM nd""",
)
def rule_eval_new_device(spark, folder):
    rows = given.enriched_table(spark, folder)
    rows = rows.withColumns(
        {
            "device_is_new": F.col("device_txn_count") == 1,
            "txn_amount": F.col("amount"),
            "device_count_24h": (F.col("event_id") % 4).cast("int"),
        }
    )
    rules = [
        Rule("ND-001", "AMOUNT", "new_device", {"amount": 50.0}, "high"),
        Rule("ND-002", "RAPID", "new_device", {"device_count": 2, "vel_count": 5}, "medium"),
        Rule("ND-003", "FRAUD", "new_device", {}, "critical"),
        Rule("ND-004", "NETWORK", "new_device", {"network_class": "HOSTING"}, "high"),
    ]
    return evaluate(rows, rules).select("transaction_id", "enrichment_time", "matched_rules")


@register(
    "rule_eval_all",
    with_ctes(*EVALUATED)
    + f"""SELECT transaction_id, determination, {joined('matched')} AS matched_rules, highest_severity,
  {joined('shadow')} AS shadow_triggers,
  CASE WHEN determination = 'clean' THEN {joined('shadow')} ELSE '' END AS shadow_fp,
  {joined('''list_filter([CASE WHEN prev_geo_country IS NULL THEN 'prev_geo_country' END,
    CASE WHEN prev_txn_time_ms IS NULL THEN 'prev_txn_time_ms' END, CASE WHEN geo_country IS NULL THEN 'geo_country' END,
    CASE WHEN device_is_new IS NULL THEN 'device_is_new' END, CASE WHEN device_count_24h IS NULL THEN 'device_count_24h' END,
    CASE WHEN device_known_fraud IS NULL THEN 'device_known_fraud' END,
    CASE WHEN geo_network_class IS NULL THEN 'geo_network_class' END], lambda x: x IS NOT NULL)''')} AS missing_fields
  FROM evald""",
)
def rule_eval_all(spark, folder):
    return evaluated_now(spark, folder).select(
        "transaction_id", "determination", "matched_rules", "highest_severity", "shadow_triggers", "shadow_fp", "missing_fields"
    )


DECISION_SQL = """CASE WHEN determination = 'clean' THEN 'ALLOW' WHEN highest_severity IN ('high', 'critical') THEN 'BLOCK' ELSE 'FLAG' END"""


@register(
    "fraud_decisions",
    with_ctes(*EVALUATED)
    + f"""SELECT transaction_id, {DECISION_SQL} AS decision,
  CASE {DECISION_SQL} WHEN 'ALLOW' THEN 0.0::DOUBLE WHEN 'FLAG' THEN 0.3::DOUBLE ELSE 0.8::DOUBLE END AS fraud_score,
  CASE WHEN determination = 'clean' THEN '' ELSE {joined('matched')} END AS rule_triggers, 'rule-only' AS model_version,
  enrichment_time + 2 AS decision_time_ms, 0.0::DOUBLE AS latency_ms, '1' AS schema_version, {joined('shadow')} AS shadow_triggers FROM evald""",
)
def fraud_decisions(spark, folder):
    return dec.decide(evaluated_now(spark, folder), F.unix_millis("enrichment_time") + 2)


@register(
    "fraud_alerts",
    with_ctes(*EVALUATED)
    + f"""SELECT transaction_id, account_id, {joined('matched')} AS rule_triggers, highest_severity AS severity,
  CASE WHEN highest_severity IN ('critical', 'high') THEN 'BLOCK' WHEN highest_severity = 'medium' THEN 'FLAG' ELSE 'ALLOW' END AS decision,
  enrichment_time + 2 AS evaluation_timestamp FROM evald WHERE determination = 'suspicious'""",
)
def fraud_alerts(spark, folder):
    alerts = dec.alerts(evaluated_now(spark, folder), F.unix_millis("enrichment_time") + 2)
    return dec.display_alerts(alerts)


@register(
    "fraud_rate_end_to_end",
    with_ctes(*EVALUATED)
    + f"""SELECT strftime(epoch_ms(CAST(enrichment_time + 2 AS BIGINT)), '%Y-%m-%d') AS decision_date, channel, {DECISION_SQL} AS decision,
  count(*) AS transaction_count, {num('sum(amount)')} AS total_amount,
  {num(f"avg(CASE {DECISION_SQL} WHEN 'ALLOW' THEN 0.0::DOUBLE WHEN 'FLAG' THEN 0.3::DOUBLE ELSE 0.8::DOUBLE END)")} AS avg_fraud_score,
  0.0::DOUBLE AS p99_latency_ms FROM evald GROUP BY ALL""",
)
def fraud_rate_end_to_end(spark, folder):
    """From raw transactions to the daily fraud rate, decisions carried along without a join."""
    decided = dec.decide(
        evaluated_now(spark, folder), F.unix_millis("enrichment_time") + 2, extra=("channel", "amount")
    )
    return decided.groupBy(F.to_date("decision_time_ms").alias("decision_date"), "channel", "decision").agg(
        F.count(F.lit(1)).alias("transaction_count"),
        F.sum("amount").alias("total_amount"),
        F.avg("fraud_score").alias("avg_fraud_score"),
        views.quantile("latency_ms", 0.99).alias("p99_latency_ms"),
    )


ALERTS = """
al AS (
  SELECT transaction_id, account_id, CASE WHEN amount >= 150 THEN 'critical' WHEN amount >= 100 THEN 'high' WHEN amount >= 60 THEN 'medium' ELSE 'low' END AS severity,
         rule_triggers, decided_ms AS evaluation_ms, event_id, k, CASE WHEN k % 9 = 0 THEN 'false-positive' WHEN k % 4 = 0 THEN 'confirmed-fraud' ELSE 'pending' END AS status
  FROM dec WHERE len(rule_triggers) > 0)"""


def given_alerts(spark, folder):
    """Alerts of the decision table, one per decision with triggers, copies included."""
    rows = given.decision_table(spark, folder).where(F.size("rule_triggers") > 0)
    severity = (
        F.when(F.col("amount") >= 150, "critical").when(F.col("amount") >= 100, "high").when(F.col("amount") >= 60, "medium").otherwise("low")
    )
    status = F.when(F.col("k") % 9 == 0, "false-positive").when(F.col("k") % 4 == 0, "confirmed-fraud").otherwise("pending")
    return rows.select(
        "transaction_id",
        "account_id",
        F.col("rule_triggers").alias("matched_rule_names"),
        severity.alias("severity"),
        F.col("decision_time_ms").alias("evaluation_timestamp"),
        F.col("decided_ms").alias("evaluation_ms"),
        status.alias("status"),
        "event_id",
    )


from riskspark.registry.base import DECIDED  # noqa: E402


@register(
    "alert_insert_ignore",
    with_ctes(TX, DECIDED, ALERTS)
    + """SELECT transaction_id, account_id, severity, evaluation_ms FROM al
  WHERE transaction_id NOT IN (SELECT transaction_id FROM al WHERE event_id % 3 = 0)
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY evaluation_ms) = 1""",
)
def alert_insert_ignore(spark, folder):
    alerts = given_alerts(spark, folder)
    stored = alerts.where(F.col("event_id") % 3 == 0)
    fresh = insert_ignore(stored, alerts, "transaction_id", "evaluation_ms")
    return fresh.select("transaction_id", "account_id", "severity", "evaluation_ms")


@register(
    "live_feed_latest",
    with_ctes(TX, DECIDED, ALERTS)
    + f"""SELECT transaction_id, account_id, {joined('rule_triggers')} AS rule_triggers, severity,
  CASE severity WHEN 'critical' THEN 'BLOCK' WHEN 'high' THEN 'BLOCK' WHEN 'medium' THEN 'FLAG' ELSE 'ALLOW' END AS decision,
  evaluation_ms AS evaluation_timestamp
  FROM (SELECT * FROM al QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY evaluation_ms) = 1)
  ORDER BY evaluation_ms DESC, transaction_id DESC LIMIT 100""",
)
def live_feed(spark, folder):
    return dec.live_feed(given_alerts(spark, folder))


@register(
    "alert_lookup",
    with_ctes(TX, DECIDED, ALERTS)
    + """SELECT transaction_id, account_id, severity, status, evaluation_ms FROM al WHERE account_id = 'acc-7' AND status = 'pending'""",
)
def alert_lookup(spark, folder):
    found = dec.find_alerts(given_alerts(spark, folder), account_id="acc-7", status="pending")
    return found.select("transaction_id", "account_id", "severity", "status", "evaluation_ms")


@register(
    "rule_flags",
    with_ctes(TX, DECIDED, ALERTS)
    + """SELECT r AS rule_id, CASE r WHEN 'VEL-001' THEN 'velocity' WHEN 'VEL-003' THEN 'velocity' WHEN 'ND-001' THEN 'new_device' ELSE 'unknown' END AS family,
  severity, count(*) AS flags FROM al, unnest(rule_triggers) AS u(r) WHERE NOT suffix(r, ':shadow') GROUP BY ALL""",
)
def rule_flags(spark, folder):
    return reports.rule_flags(given_alerts(spark, folder), SCALED_RULES)


@register(
    "rule_counters",
    with_ctes(*EVALUATED, "cat AS (SELECT * FROM (VALUES " + ", ".join(
        f"('{r.rule_id}', '{r.family}')" for r in SCALED_RULES if r.enabled) + ") AS v(rule_id, family))",
        "hits AS (SELECT replace(m, ':shadow', '') AS rule_id, suffix(m, ':shadow') AS sh, determination FROM evald, unnest(matched) AS u(m))")
    + """SELECT rule_id, family, (SELECT count(*) FROM evald) AS evaluations,
  count(*) FILTER (WHERE NOT sh) AS triggers, count(*) FILTER (WHERE sh) AS shadow_triggers,
  count(*) FILTER (WHERE sh AND determination = 'clean') AS shadow_fp
  FROM cat LEFT JOIN hits USING (rule_id) GROUP BY ALL""",
)
def rule_counters(spark, folder):
    return shadow.rule_counters(evaluated_now(spark, folder), SCALED_RULES)


SINCE = "(SELECT max(decided_ms) FROM dec1)"


@register(
    "shadow_rule_report",
    with_ctes(TX, DECIDED, f"""
hits AS (SELECT replace(m, ':shadow', '') AS rule_id, decision FROM dec1, unnest(shadow_triggers) AS u(m)
  WHERE decided_ms > 1706400000000 AND decided_ms <= {1706400000000 + DAY}),
agg AS (SELECT rule_id, count(*) AS n, count(*) FILTER (WHERE decision = 'ALLOW') AS fp FROM hits GROUP BY rule_id)""")
    + f"""SELECT rule_id, n AS shadow_triggers_24h, fp AS fp_count_24h, {num('fp / CAST(n AS DOUBLE)')} AS estimated_fp_rate,
  CASE WHEN n >= 100 AND fp / CAST(n AS DOUBLE) < 0.02 THEN 1 ELSE 0 END AS can_promote,
  CASE WHEN n < 100 THEN 'few_triggers:' || n WHEN fp / CAST(n AS DOUBLE) >= 0.02 THEN 'false_positive_rate' ELSE '' END AS reason FROM agg""",
)
def shadow_rule_report(spark, folder):
    current = dec.latest_decisions(given.decision_table(spark, folder))
    return shadow.shadow_report(current, 1706400000000, 1706400000000 + DAY)


@register(
    "rule_fp_rate_hourly",
    with_ctes(TX, DECIDED, ALERTS)
    + f"""SELECT evaluation_ms // 3600000 * 3600000 AS window_start, r AS rule_id, count(*) AS triggers,
  count(*) FILTER (WHERE status = 'false-positive') AS false_positives,
  {num("count(*) FILTER (WHERE status = 'false-positive') / CAST(count(*) AS DOUBLE)")} AS fp_rate,
  CASE WHEN count(*) FILTER (WHERE status = 'false-positive') / CAST(count(*) AS DOUBLE) > 0.05 THEN 1 ELSE 0 END AS demote
  FROM al, unnest(rule_triggers) AS u(r) WHERE NOT suffix(r, ':shadow') GROUP BY ALL""",
)
def rule_fp_rate_hourly(spark, folder):
    return shadow.active_fp_rate(given_alerts(spark, folder))


STRICT = {
    "VEL-001": ("vel_count_1h > 2", 2),
    **{k: ACTIVE[k] for k in ("VEL-002", "VEL-003")},
    "VEL-007": ("vel_count_1m > 1", 1),
    **{k: ACTIVE[k] for k in ("IT-001", "ND-001", "ND-002", "ND-003", "ND-004")},
}


@register(
    "rule_backtest_diff",
    with_ctes(*EVALUATED, evaluated_cte(STRICT, name="strict"), """
diff AS (
  SELECT a.determination AS before, b.determination AS after,
    list_concat(list_transform(list_filter(b.matched, lambda x: NOT list_contains(a.matched, x)), lambda x: 'gained|' || x),
                list_transform(list_filter(a.matched, lambda x: NOT list_contains(b.matched, x)), lambda x: 'lost|' || x)) AS ch
  FROM evald a JOIN strict b USING (transaction_id))""")
    + """SELECT before, after, split_part(c, '|', 1) AS change, split_part(c, '|', 2) AS rule_id, count(*) AS transactions
  FROM diff, unnest(CASE WHEN len(ch) = 0 THEN ['same|'] ELSE ch END) AS u(c) GROUP BY ALL""",
)
def rule_backtest_diff(spark, folder):
    return shadow.backtest(enriched_now(spark, folder), SCALED_RULES, STRICTER_RULES)


@register(
    "cross_border_count",
    with_ctes(TX, """
cb AS (SELECT *, 'C' || (k % 3) AS c FROM tx),
ch AS (SELECT *, coalesce(lag(c) OVER (PARTITION BY account_id ORDER BY event_ms, transaction_id) <> c, false) AS moved FROM cb)""")
    + """SELECT a.transaction_id, count(*) FILTER (WHERE b.moved) AS cross_border_count FROM ch a JOIN ch b ON a.account_id = b.account_id
  AND b.event_ms > a.event_ms - 86400000 AND (b.event_ms < a.event_ms OR (b.event_ms = a.event_ms AND b.transaction_id <= a.transaction_id))
  GROUP BY a.transaction_id""",
)
def border_changes(spark, folder):
    tx = given.transactions(spark, folder).select(
        "transaction_id", "account_id", "event_ms", F.concat(F.lit("C"), (F.col("k") % 3).cast("string")).alias("country")
    )
    counted = cross_border_count(tx, "account_id", "event_ms", "country", "transaction_id", DAY)
    return counted.select("transaction_id", "cross_border_count")


@register(
    "severity_maps",
    with_ctes(TX)
    + """SELECT transaction_id, s AS severity, CASE s WHEN 'low' THEN 0 WHEN 'medium' THEN 1 WHEN 'high' THEN 2 WHEN 'critical' THEN 3 END AS ordinal,
  CASE WHEN s IN ('high', 'critical') THEN 'BLOCK' ELSE 'FLAG' END AS scoring,
  CASE WHEN s IN ('high', 'critical') THEN 'BLOCK' WHEN s = 'medium' THEN 'FLAG' WHEN s = 'low' THEN 'ALLOW' ELSE 'UNKNOWN' END AS shown
  FROM (SELECT transaction_id, CASE CAST(k % 5 AS INTEGER) WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' WHEN 3 THEN 'critical' ELSE 'odd' END AS s FROM tx)""",
)
def severity_maps(spark, folder):
    names = F.array(*[F.lit(s) for s in (*sev.SEVERITIES, "odd")])
    rows = given.transactions(spark, folder).select("transaction_id", F.get(names, (F.col("k") % 5).cast("int")).alias("severity"))
    s = F.col("severity")
    return rows.select(
        "transaction_id", "severity", sev.ordinal(s).alias("ordinal"), sev.scoring_decision(s).alias("scoring"), sev.display_decision(s).alias("shown")
    )


@register(
    "model_score_fallback",
    with_ctes(TX)
    + f"""SELECT transaction_id, {num('least(1.0, amount / 200.0)')} AS fraud_probability, 'linear-1' AS model_version, 0 AS used_fallback FROM tx""",
)
def model_score(spark, folder):
    def load():
        return lambda batch: (batch["amount"].astype(float) / 200.0).clip(upper=1.0)

    rows = given.transactions(spark, folder).select("transaction_id", F.col("amount").cast("double").alias("amount"))
    scored = score(rows, ["amount"], load, "linear-1")
    return scored.select("transaction_id", "fraud_probability", "model_version", "used_fallback")
