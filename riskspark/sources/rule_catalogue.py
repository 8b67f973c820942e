"""The rule catalogue: a YAML list, checked entry by entry; one bad entry fails all."""

from __future__ import annotations

import re
from pathlib import Path

from riskspark.functions.severity import SEVERITIES
from riskspark.operators.rules import Rule, families

# Accepted keys, modes and the form of a rule id.
REQUIRED_KEYS = {"rule_id", "name", "family", "conditions", "severity", "enabled"}
OPTIONAL_KEYS = {"mode"}
MODES = ("active", "shadow")
RULE_ID = re.compile(r"[a-zA-Z0-9][a-zA-Z0-9\-_]{0,62}[a-zA-Z0-9]")

# The default rule set.
DEFAULT_RULES = [
    Rule("VEL-001", "HIGH_FREQUENCY_1M", "velocity", {"field": "vel_count_1m", "count": 5}, "high"),
    Rule("VEL-002", "HIGH_AMOUNT_5M", "velocity", {"field": "vel_amount_5m", "amount": 2000.00}, "high"),
    Rule("VEL-003", "BURST_COUNT_5M", "velocity", {"field": "vel_count_5m", "count": 10}, "medium"),
    Rule("VEL-004", "DAILY_AMOUNT_SPIKE", "velocity", {"field": "vel_amount_24h", "amount": 10000.00}, "medium"),
    Rule("IT-001", "IMPOSSIBLE_TRAVEL", "impossible_travel", {"window_ms": 3600000}, "critical"),
    Rule("IT-002", "CROSS_BORDER_VELOCITY", "impossible_travel", {"count": 3}, "high"),
    Rule("ND-001", "NEW_DEVICE_HIGH_AMOUNT", "new_device", {"amount": 500.00}, "high"),
    Rule("ND-002", "NEW_DEVICE_RAPID_TXN", "new_device", {"device_count": 3, "vel_count": 5}, "medium"),
    Rule("ND-003", "KNOWN_FRAUD_DEVICE", "new_device", {}, "critical"),
    Rule("ND-004", "NEW_DEVICE_FOREIGN", "new_device", {"network_class": "HOSTING"}, "high"),
]


class RuleConfigError(RuntimeError):
    """The catalogue is missing, malformed or has an invalid entry."""


def _checked(position: int, entry: object) -> Rule:
    def fail(why: str):
        raise RuleConfigError(f"rule {position}: {why}")

    if not isinstance(entry, dict):
        fail("not a mapping")
    missing, unknown = REQUIRED_KEYS - set(entry), set(entry) - REQUIRED_KEYS - OPTIONAL_KEYS
    if missing or unknown:
        fail(f"missing keys {sorted(missing)}, unknown keys {sorted(unknown)}")
    if not isinstance(entry["rule_id"], str) or not RULE_ID.fullmatch(entry["rule_id"]):
        fail("rule_id must be 2-64 letters, digits, hyphens or underscores")
    if not isinstance(entry["name"], str):
        fail("name must be text")
    if entry["family"] not in families():
        fail(f"unknown family {entry['family']!r}")
    if not isinstance(entry["conditions"], dict):
        fail("conditions must be a mapping")
    severity = entry["severity"]
    if isinstance(severity, int) and not isinstance(severity, bool) and 0 <= severity < len(SEVERITIES):
        severity = SEVERITIES[severity]
    if severity not in SEVERITIES:
        fail(f"invalid severity {severity!r}")
    if not isinstance(entry["enabled"], bool):
        fail("enabled must be true or false")
    mode = entry.get("mode", "active")
    if mode not in MODES:
        fail(f"invalid mode {mode!r}")
    return Rule(entry["rule_id"], entry["name"], entry["family"], entry["conditions"], severity, entry["enabled"], mode)


def parse_rules(entries: object) -> list[Rule]:
    """Enabled rules of a parsed catalogue."""
    if not isinstance(entries, list):
        raise RuleConfigError("the catalogue must be a list")
    rules = [_checked(position, entry) for position, entry in enumerate(entries)]
    return [rule for rule in rules if rule.enabled]


def load_rules(path: str) -> list[Rule]:
    """Enabled rules of a YAML file."""
    try:
        import yaml
    except ImportError as error:
        raise RuleConfigError("reading a catalogue file needs PyYAML") from error
    try:
        text = Path(path).read_text(encoding="utf-8")
    except FileNotFoundError as error:
        raise RuleConfigError(f"no catalogue at {path}") from error
    try:
        entries = yaml.safe_load(text)
    except yaml.YAMLError as error:
        raise RuleConfigError(f"malformed catalogue {path}: {error}") from error
    return parse_rules(entries)
