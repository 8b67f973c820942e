"""Count and amount of an account's transactions over the last minutes and hours."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.clock import MINUTE_MS, minute_of
from riskspark.operators import chunks

# Window lengths in minutes and their column suffixes.
WINDOWS = ((1, "1m"), (5, "5m"), (60, "1h"), (1440, "24h"))
# End of fixed values.
VELOCITY_COLUMNS = [f"vel_{kind}_{label}" for _, label in WINDOWS for kind in ("count", "amount")]
_KINDS = {"count": "int", "amount": "decimal(18,4)"}


def _outside(window: Window, minutes: int) -> Window:
    """Frame of the rows whose minute is too old for a window of that many minutes."""
    return window.orderBy("_minute").rangeBetween(Window.unboundedPreceding, -(minutes + 1))


def velocity_features(
    df: DataFrame,
    key: str = "account_id",
    time_ms: str = "event_ms",
    amount: str = "amount",
    tiebreak: str = "transaction_id",
    exact: bool = False,
    history: DataFrame | None = None,
    hot: DataFrame | None = None,
    hot_rows: int = chunks.HOT_ROWS,
    chunk_ms: int = chunks.CHUNK_MS,
) -> DataFrame:
    """Adds `vel_count_*` and `vel_amount_*`, the current row included.

    By default a window of N minutes reaches back to the start of the minute
    N minutes before the row's own minute. With `exact` it is the true range of
    N minutes. Rows count in the order of time, then `tiebreak`.

    A value is the running total minus the total of the rows too old for the
    window; both frames grow from the start, so the cost is linear. `history` is
    a cheaper table with the same rows to reduce hot keys on, `hot` the list of
    hot keys where it is known.
    """
    if exact:
        return _exact(df, key, time_ms, amount, tiebreak, hot_rows, chunk_ms)
    if MINUTE_MS % chunk_ms:
        raise ValueError("a chunk must divide a minute")
    source = df if history is None else history
    if hot is None:
        hot = chunks.hot_keys(source, key, hot_rows)
    carry = _carry(source, key, time_ms, amount, hot, chunk_ms)
    rows = chunks.with_chunk(df, key, time_ms, [tiebreak], hot, chunk_ms).withColumn("_minute", minute_of(F.col(time_ms)))
    # One sort by (minute, time, tiebreak) serves both selects.
    inside = chunks.chunk_window(key, "_minute", time_ms, tiebreak)
    running = rows.select("*", F.count(F.lit(1)).over(inside).alias("_n"), F.sum(amount).over(inside).alias("_a"))
    part = Window.partitionBy(key, chunks.CHUNK)
    gone = []
    for minutes, label in WINDOWS:
        old = _outside(part, minutes)
        gone += [
            F.count(F.lit(1)).over(old).alias(f"_n_gone_{label}"),
            F.sum(amount).over(old).alias(f"_a_gone_{label}"),
        ]
    joined = chunks.join_carry(running.select("*", *gone), carry, key)
    zero, known = F.lit(0), F.col(key).isNotNull()
    outputs = []
    for _, label in WINDOWS:
        for short, kind in (("n", "count"), ("a", "amount")):
            value = (
                F.col(f"_{short}")
                - F.coalesce(F.col(f"_{short}_gone_{label}"), zero)
                + F.coalesce(F.col(f"_{short}_{label}"), zero)
            )
            outputs.append(F.when(known, value).cast(_KINDS[kind]).alias(f"vel_{kind}_{label}"))
    return joined.select(*df.columns, *outputs)


def _carry(source, key, time_ms, amount, hot, chunk_ms) -> DataFrame:
    """Per chunk of a hot key and window: what earlier chunks still contribute."""
    narrow = source.select(key, time_ms, amount)
    reduced = (
        chunks.hot_chunks(narrow, key, time_ms, hot, chunk_ms)
        .groupBy(key, chunks.CHUNK)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("a"))
        .withColumn("_minute", F.floor(F.col(chunks.CHUNK) / F.lit(MINUTE_MS // chunk_ms)).cast("bigint"))
    )
    before = chunks.earlier_chunks(key, "_minute", chunks.CHUNK)
    so_far = reduced.select("*", F.sum("n").over(before).alias("n_before"), F.sum("a").over(before).alias("a_before"))
    part = Window.partitionBy(key)
    gone = [
        F.sum(short).over(_outside(part, minutes)).alias(f"{short}_gone_{label}")
        for minutes, label in WINDOWS
        for short in ("n", "a")
    ]
    zero = F.lit(0)
    still = [
        (F.coalesce(f"{short}_before", zero) - F.coalesce(f"{short}_gone_{label}", zero)).alias(f"_{short}_{label}")
        for _, label in WINDOWS
        for short in ("n", "a")
    ]
    return so_far.select(key, chunks.CHUNK, "n_before", "a_before", *gone).select(key, chunks.CHUNK, *still)


def _exact(df, key, time_ms, amount, tiebreak, hot_rows, chunk_ms) -> DataFrame:
    """A row enters each window at its time and leaves it when it is the window's length old.

    The value at a row is then a running total of entries and exits, so no row
    is ever compared with another one. Exits at an instant come before entries.
    """
    entry = F.struct(F.lit(1).alias("entry"), F.col(time_ms).alias("at"), F.lit(None).cast("string").alias("leaves"))
    exits = [
        F.struct(
            F.lit(0).alias("entry"),
            (F.col(time_ms) + F.lit(minutes * MINUTE_MS)).alias("at"),
            F.lit(label).alias("leaves"),
        )
        for minutes, label in WINDOWS
    ]
    payload = F.when(F.col("move.entry") == 1, F.struct(*[F.col(c) for c in df.columns])).alias("row")
    moves = df.select("*", F.explode(F.array(entry, *exits)).alias("move")).select(
        F.col(key).alias("_key"),
        F.col("move.at").alias("_at"),
        F.col("move.entry").alias("_entry"),
        F.col("move.leaves").alias("_leaves"),
        F.col(tiebreak).alias("_tie"),
        F.col(amount).alias("_amount"),
        payload,
    )
    totals = {}
    for _, label in WINDOWS:
        sign = F.when(F.col("_entry") == 1, 1).when(F.col("_leaves") == label, -1).otherwise(0)
        totals[f"vel_count_{label}"] = sign.cast("bigint")
        totals[f"vel_amount_{label}"] = (sign * F.col("_amount")).cast("decimal(18,4)")
    running = chunks.running_totals(moves, "_key", "_at", ["_entry", "_tie"], totals, hot_rows, chunk_ms)
    return running.where(F.col("_entry") == 1).select(
        "row.*", *[F.col(c).cast(_KINDS[c.split("_")[1]]).alias(c) for c in VELOCITY_COLUMNS]
    )
