"""Velocity against a replay of minute buckets, one row at a time."""

from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from riskspark.operators.velocity import VELOCITY_COLUMNS, WINDOWS, velocity_features

MIN = 60_000
SCHEMA = "transaction_id string, account_id string, event_ms bigint, amount decimal(18,4)"


def replay(rows, exact=False):
    """Expected values by definition."""
    ordered = sorted(rows, key=lambda r: (r[2], r[0]))
    out = {}
    for position, (tid, account, at, _) in enumerate(ordered):
        if account is None:
            out[tid] = [None] * 8
            continue
        values = []
        for minutes, _ in WINDOWS:
            if exact:
                inside = [r for r in ordered[: position + 1] if r[1] == account and r[2] > at - minutes * MIN]
            else:
                inside = [
                    r for r in ordered[: position + 1] if r[1] == account and r[2] // MIN >= at // MIN - minutes
                ]
            values += [len(inside), sum((r[3] for r in inside), Decimal(0))]
        out[tid] = values
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    result = velocity_features(df, **options).collect()
    assert len(result) == len(rows)
    return {r.transaction_id: [r[c] for c in VELOCITY_COLUMNS] for r in result}


def rows_at(*offsets, account="a", base=1_700_000_000_000 // MIN * MIN):
    return [(f"t{i:03d}", account, base + off, Decimal("10.5000")) for i, off in enumerate(offsets)]


EDGES = rows_at(
    -25 * 60 * MIN, -1441 * MIN, -1440 * MIN, -61 * MIN, -60 * MIN, -8 * MIN, -7 * MIN, -6 * MIN, -5 * MIN,
    -2 * MIN, -1 * MIN, -1, 0, 0, 1, 59_999, MIN,
)


@pytest.mark.parametrize("hot_rows", [1_000_000, 1])
@pytest.mark.parametrize("exact", [False, True])
def test_edges(spark, hot_rows, exact):
    rows = EDGES + [("n1", None, 5, Decimal(1)), ("n2", None, 5, Decimal(1)), *rows_at(0, 3, account="b")[:0]]
    assert run(spark, rows, hot_rows=hot_rows, exact=exact) == replay(rows, exact)


def test_first_event(spark):
    (values,) = run(spark, rows_at(0)).values()
    assert values == [1, Decimal("10.5000")] * 4


def test_empty(spark):
    assert run(spark, []) == {}


def test_chunk_must_divide_minute(spark):
    with pytest.raises(ValueError):
        velocity_features(spark.createDataFrame([], SCHEMA), chunk_ms=7_000)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "a", "a", "b"]), st.integers(0, 3 * 24 * 60 * MIN), st.integers(1, 10**7)),
        min_size=1,
        max_size=40,
    )
)
def test_random_sequences(spark, events):
    rows = [(f"t{i:03d}", a, t, Decimal(v) / 10_000) for i, (a, t, v) in enumerate(events)]
    expected = replay(rows)
    for hot_rows in (1_000_000, 2):
        got = run(spark, rows, hot_rows=hot_rows)
        assert got == expected
    for values in got.values():
        counts, amounts = values[0::2], values[1::2]
        assert counts == sorted(counts) and counts[0] >= 1
        assert amounts == sorted(amounts) and amounts[0] > 0
