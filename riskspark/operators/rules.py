"""Rules compiled to Column expressions and evaluated in one projection."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions import severity as sev
from riskspark.functions.coerce import positive_or_false
from riskspark.operators import chunks

SHADOW_SUFFIX = ":shadow"


@dataclass(frozen=True)
class Rule:
    rule_id: str
    name: str
    family: str
    conditions: dict
    severity: str
    enabled: bool = True
    mode: str = "active"

    @property
    def shadow(self) -> bool:
        return self.mode == "shadow"


FamilyFunction = Callable[[dict], tuple[Column, list[str]]]
_FAMILIES: dict[str, FamilyFunction] = {}


def family(name: str) -> Callable[[FamilyFunction], FamilyFunction]:
    """Registers a rule family: conditions in, (condition Column, columns it reads) out."""

    def register(function: FamilyFunction) -> FamilyFunction:
        _FAMILIES[name] = function
        return function

    return register


def families() -> set[str]:
    return set(_FAMILIES)


def _decimal(value) -> Column:
    return F.lit(Decimal(str(value)))


NEVER = (None, [])  # no condition, reads nothing


@family("velocity")
def _velocity(conditions: dict):
    column = conditions.get("field")
    if column is None:
        return NEVER
    if "count" in conditions:
        return F.col(column) > F.lit(conditions["count"]), [column]
    if "amount" in conditions:
        return F.col(column) > _decimal(conditions["amount"]), [column]
    return NEVER


@family("impossible_travel")
def _impossible_travel(conditions: dict):
    reads = ["prev_geo_country", "prev_txn_time_ms", "geo_country", "txn_time_ms"]
    if "window_ms" not in conditions:
        return None, reads
    gap = F.abs(F.col("txn_time_ms") - F.col("prev_txn_time_ms"))
    moved = F.col("prev_geo_country") != F.col("geo_country")
    return moved & (gap <= F.lit(conditions["window_ms"])), reads


@family("new_device")
def _new_device(conditions: dict):
    is_new = F.col("device_is_new")
    if "amount" in conditions:
        return is_new & (F.col("txn_amount") > _decimal(conditions["amount"])), ["device_is_new", "txn_amount"]
    if "device_count" in conditions:
        rapid = (F.col("device_count_24h") >= F.lit(conditions["device_count"])) & (
            F.col("vel_count_1m") >= F.lit(conditions["vel_count"])
        )
        return is_new & rapid, ["device_is_new", "device_count_24h", "vel_count_1m"]
    if "network_class" in conditions:
        same = F.col("geo_network_class") == F.lit(conditions["network_class"])
        return is_new & same, ["device_is_new", "geo_network_class"]
    return F.col("device_known_fraud"), ["device_known_fraud"]


def compiled(rule: Rule, columns: Iterable[str]) -> tuple[Column, list[str]]:
    """(condition that is never null, columns the rule reads); a column the table lacks is null."""
    condition, reads = _FAMILIES[rule.family](rule.conditions)
    if condition is None or not set(reads) <= set(columns):
        return F.lit(False), reads
    return positive_or_false(condition), reads


def enabled_rules(rules: Iterable[Rule]) -> list[Rule]:
    return [rule for rule in rules if rule.enabled and rule.family in _FAMILIES]


def _matched(flags: list[tuple[Rule, Column]], suffix: str = "") -> Column:
    if not flags:
        return F.array().cast("array<string>")
    names = [F.when(flag, F.lit(rule.rule_id + suffix)) for rule, flag in flags]
    return F.array_compact(F.array(*names))


def evaluate(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Adds the outcome of all enabled rules.

    `matched_rules` lists active rule ids, then shadow ids with their suffix, both
    in catalogue order. Shadow rules never make a row suspicious; on a clean row
    each of them counts as a shadow false positive (`shadow_fp`).
    `missing_fields` names the columns rules read that are null on the row.
    """
    active, shadow, reads = [], [], []
    for rule in enabled_rules(rules):
        condition, needs = compiled(rule, df.columns)
        (shadow if rule.shadow else active).append((rule, condition))
        reads += [name for name in needs if name not in reads]
    ranks = [
        F.when(condition, F.lit(sev.SEVERITIES.index(rule.severity))) for rule, condition in active
    ]
    highest = F.array_max(F.array(*ranks)) if ranks else F.lit(None).cast("int")
    missing = [
        F.when(F.col(name).isNull() if name in df.columns else F.lit(True), F.lit(name))
        for name in reads
    ]
    empty = F.array().cast("array<string>")
    flagged = df.select(
        "*",
        _matched(active).alias("active_rules"),
        _matched(shadow, SHADOW_SUFFIX).alias("shadow_triggers"),
        sev.name_of(highest).alias("highest_severity"),
        (F.array_compact(F.array(*missing)) if missing else empty).alias("missing_fields"),
    )
    suspicious = F.size("active_rules") > 0
    return flagged.select(
        *df.columns,
        F.when(suspicious, "suspicious").otherwise("clean").alias("determination"),
        F.concat("active_rules", "shadow_triggers").alias("matched_rules"),
        "highest_severity",
        "shadow_triggers",
        F.when(suspicious, empty).otherwise(F.col("shadow_triggers")).alias("shadow_fp"),
        "missing_fields",
    )


def cross_border_count(
    df: DataFrame,
    key: str,
    time_ms: str,
    country: str,
    tiebreak: str,
    window_ms: int,
    hot_rows: int = chunks.HOT_ROWS,
) -> DataFrame:
    """Adds the number of country changes of a key within the last `window_ms`.

    The catalogue holds a rule that wants this number, but no evaluation reads
    it, so the rule never fires; the column is for callers who want the intent.
    A change enters the count at its row and leaves it `window_ms` later.
    """
    hot = chunks.hot_keys(df, key, hot_rows)
    order = F.when(F.col(country).isNotNull(), F.struct(time_ms, tiebreak))
    last = (
        chunks.hot_chunks(df, key, time_ms, hot)
        .groupBy(key, chunks.CHUNK)
        .agg(F.max_by(F.col(country), order).alias("_c"))
    )
    before = chunks.earlier_chunks(key, chunks.CHUNK)
    carry = last.select(key, chunks.CHUNK, F.last("_c", ignorenulls=True).over(before).alias("_prev"))
    rows = chunks.with_chunk(df, key, time_ms, [tiebreak], hot)
    earlier = Window.partitionBy(key, chunks.CHUNK).orderBy(time_ms, tiebreak).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.select("*", F.last(country, ignorenulls=True).over(earlier).alias("_seen"))
    linked = chunks.join_carry(seen, carry, key)
    changed = positive_or_false(F.coalesce("_seen", "_prev") != F.col(country))
    marked = linked.select(*df.columns, changed.cast("bigint").alias("_change"))
    enter = F.struct(F.lit(1).alias("entry"), F.col(time_ms).alias("at"))
    leave = F.struct(F.lit(0).alias("entry"), (F.col(time_ms) + F.lit(window_ms)).alias("at"))
    moves = marked.select("*", F.explode(F.array(enter, leave)).alias("_move")).select(
        *df.columns, F.col("_move.entry").alias("_entry"), F.col("_move.at").alias("_at"), "_change"
    )
    delta = F.when(F.col("_entry") == 1, F.col("_change")).otherwise(-F.col("_change"))
    totals = chunks.running_totals(moves, key, "_at", ["_entry", tiebreak], {"cross_border_count": delta}, hot_rows)
    return totals.where(F.col("_entry") == 1).select(*df.columns, "cross_border_count")
