from decimal import Decimal

import pytest

from riskspark.functions import severity as sev
from riskspark.operators import decisions as dec
from riskspark.operators.rules import Rule, evaluate
from riskspark.sources.rule_catalogue import DEFAULT_RULES, RuleConfigError, load_rules, parse_rules
from pyspark.sql import functions as F

SCHEMA = (
    "transaction_id string, account_id string, vel_count_1m int, vel_amount_5m decimal(18,4), geo_country string,"
    "prev_geo_country string, txn_time_ms bigint, prev_txn_time_ms bigint, device_is_new boolean,"
    "txn_amount decimal(18,4), device_count_24h int, device_known_fraud boolean, geo_network_class string"
)
CLEAN = dict(
    transaction_id="t", account_id="a", vel_count_1m=1, vel_amount_5m=Decimal("1"), geo_country="US",
    prev_geo_country="US", txn_time_ms=10_000_000, prev_txn_time_ms=9_999_000, device_is_new=False,
    txn_amount=Decimal("1"), device_count_24h=1, device_known_fraud=False, geo_network_class="RESIDENTIAL",
)


def outcome(spark, rules, **changes):
    names = [part.split()[0] for part in SCHEMA.replace("decimal(18,4)", "decimal").split(",")]
    row = {**CLEAN, **changes}
    df = spark.createDataFrame([tuple(row[n] for n in names)], SCHEMA)
    return evaluate(df, rules).collect()[0]


def hits(spark, rule, **changes):
    return outcome(spark, [rule], **changes).matched_rules == [rule.rule_id]


COUNT = Rule("VEL-001", "N", "velocity", {"field": "vel_count_1m", "count": 5}, "high")
AMOUNT = Rule("VEL-002", "A", "velocity", {"field": "vel_amount_5m", "amount": 2000.00}, "high")
TRAVEL = Rule("IT-001", "T", "impossible_travel", {"window_ms": 3_600_000}, "critical")


@pytest.mark.parametrize("value,expected", [(4, False), (5, False), (6, True), (None, False)])
def test_velocity_count_is_strict(spark, value, expected):
    assert hits(spark, COUNT, vel_count_1m=value) is expected


@pytest.mark.parametrize("value,expected", [("2000", False), ("2000.0001", True)])
def test_velocity_amount_is_strict(spark, value, expected):
    assert hits(spark, AMOUNT, vel_amount_5m=Decimal(value)) is expected


def test_velocity_without_condition_never_fires(spark):
    assert not hits(spark, Rule("X-1", "", "velocity", {"field": "vel_count_1m"}, "low"), vel_count_1m=99)
    assert not hits(spark, Rule("X-2", "", "velocity", {"count": 1}, "low"), vel_count_1m=99)
    assert not hits(spark, Rule("X-3", "", "velocity", {"field": "no_such", "count": 1}, "low"))


@pytest.mark.parametrize(
    "changes,expected",
    [
        ({}, False),
        ({"prev_geo_country": "FR"}, True),
        ({"prev_geo_country": "FR", "prev_txn_time_ms": 10_000_000 - 3_600_000}, True),
        ({"prev_geo_country": "FR", "prev_txn_time_ms": 10_000_000 - 3_600_001}, False),
        ({"prev_geo_country": "FR", "prev_txn_time_ms": 10_000_500}, True),
        ({"prev_geo_country": None}, False),
        ({"prev_geo_country": "FR", "geo_country": None}, False),
        ({"prev_geo_country": "FR", "prev_txn_time_ms": None}, False),
        ({"prev_geo_country": "FR", "txn_time_ms": None}, False),
    ],
)
def test_impossible_travel(spark, changes, expected):
    assert hits(spark, TRAVEL, **changes) is expected


def test_travel_count_rule_never_fires(spark):
    assert not hits(spark, Rule("IT-002", "", "impossible_travel", {"count": 3}, "high"), prev_geo_country="FR")


def test_new_device_family(spark):
    def rule(conditions):
        return Rule("ND-1", "", "new_device", conditions, "high")

    amount, rapid, network, fraud = rule({"amount": 500.0}), rule({"device_count": 3, "vel_count": 5}), rule({"network_class": "HOSTING"}), rule({})
    assert not hits(spark, amount, device_is_new=True, txn_amount=Decimal("500"))
    assert hits(spark, amount, device_is_new=True, txn_amount=Decimal("500.01"))
    assert not hits(spark, amount, device_is_new=None, txn_amount=Decimal("501"))
    assert hits(spark, rapid, device_is_new=True, device_count_24h=3, vel_count_1m=5)
    assert not hits(spark, rapid, device_is_new=True, device_count_24h=2, vel_count_1m=5)
    assert not hits(spark, rapid, device_is_new=True, device_count_24h=None, vel_count_1m=5)
    assert hits(spark, network, device_is_new=True, geo_network_class="HOSTING")
    assert not hits(spark, network, device_is_new=False, geo_network_class="HOSTING")
    assert hits(spark, fraud, device_known_fraud=True)
    assert not hits(spark, fraud, device_known_fraud=None)


def test_shadow_and_disabled_rules(spark):
    shadow = Rule("SH-1", "", "velocity", {"field": "vel_count_1m", "count": 0}, "critical", True, "shadow")
    off = Rule("OFF-1", "", "velocity", {"field": "vel_count_1m", "count": 0}, "critical", False)
    only = outcome(spark, [shadow, off])
    assert (only.determination, only.matched_rules, only.highest_severity) == ("clean", ["SH-1:shadow"], None)
    assert only.shadow_fp == ["SH-1:shadow"]
    both = outcome(spark, [shadow, COUNT], vel_count_1m=6)
    assert both.matched_rules == ["VEL-001", "SH-1:shadow"]
    assert (both.determination, both.highest_severity, both.shadow_fp) == ("suspicious", "high", [])


def test_highest_severity_and_missing(spark):
    result = outcome(spark, [COUNT, TRAVEL], vel_count_1m=9, prev_geo_country="FR", prev_txn_time_ms=None)
    assert (result.highest_severity, result.missing_fields) == ("high", ["prev_txn_time_ms"])
    result = outcome(spark, [COUNT, TRAVEL], vel_count_1m=9, prev_geo_country="FR")
    assert (result.matched_rules, result.highest_severity) == (["VEL-001", "IT-001"], "critical")


def test_no_rules(spark):
    result = outcome(spark, [])
    assert (result.determination, result.matched_rules, result.highest_severity) == ("clean", [], None)


def test_decisions_and_alerts(spark):
    medium = Rule("M-1", "", "velocity", {"field": "vel_count_1m", "count": 2}, "medium")
    shadow = Rule("SH-1", "", "velocity", {"field": "vel_count_1m", "count": 0}, "low", True, "shadow")
    df = spark.createDataFrame(
        [("t1", "a", 1), ("t2", "a", 3), ("t3", "a", 9)], "transaction_id string, account_id string, vel_count_1m int"
    )
    evaluated = evaluate(df, [COUNT, medium, shadow])
    got = {r.transaction_id: r for r in dec.decide(evaluated, F.lit(5).cast("bigint")).collect()}
    assert [(got[t].decision, got[t].fraud_score) for t in ("t1", "t2", "t3")] == [("ALLOW", 0.0), ("FLAG", 0.3), ("BLOCK", 0.8)]
    assert got["t1"].rule_triggers == [] and got["t1"].shadow_triggers == ["SH-1:shadow"]
    assert got["t3"].rule_triggers == ["VEL-001", "M-1", "SH-1:shadow"]
    alerts = {r.transaction_id: r.severity for r in dec.alerts(evaluated, F.lit(5).cast("bigint")).collect()}
    assert alerts == {"t2": "medium", "t3": "high"}


def test_severity_order():
    assert sev.SEVERITIES == ("low", "medium", "high", "critical")


GOOD = {"rule_id": "VEL-9", "name": "N", "family": "velocity", "conditions": {"field": "f", "count": 1}, "severity": "high", "enabled": True}


@pytest.mark.parametrize(
    "change",
    [
        {"rule_id": "x"}, {"rule_id": "-bad-"}, {"rule_id": "a/b"}, {"rule_id": 7}, {"family": "other"}, {"severity": "huge"},
        {"severity": 9}, {"enabled": "perhaps"}, {"mode": "dark"}, {"conditions": []}, {"extra": 1},
    ],
)
def test_bad_catalogue_entry_fails_all(change):
    with pytest.raises(RuleConfigError):
        parse_rules([GOOD, {**GOOD, **change}])


def test_catalogue(tmp_path):
    assert len(DEFAULT_RULES) == 10
    assert [r.severity for r in parse_rules([GOOD, {**GOOD, "severity": 0}, {**GOOD, "enabled": False}])] == ["high", "low"]
    with pytest.raises(RuleConfigError):
        parse_rules({"not": "a list"})
    with pytest.raises(RuleConfigError):
        load_rules(str(tmp_path / "none.yaml"))
    pytest.importorskip("yaml")
    path = tmp_path / "rules.yaml"
    path.write_text("- {rule_id: VEL-9, name: N, family: velocity, severity: low, enabled: true, mode: shadow, conditions: {field: f, count: 1}}\n")
    (rule,) = load_rules(str(path))
    assert rule.shadow and rule.severity == "low"
    path.write_text("- [unclosed")
    with pytest.raises(RuleConfigError):
        load_rules(str(path))
