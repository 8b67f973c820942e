"""Keyed state of the stream: seen transactions, velocity buckets, device profiles.

Rows of a key are handled per micro-batch in the order of time and id, with
numpy over the batch instead of a loop over rows. What a key holds in memory is
its share of one micro-batch (bounded by the trigger's row limit) plus its minute
buckets of a day.

Rows of any age reach the processors (see `enrich.watermarked`); the watermark is
what they compare rows with, so that late rows can be reported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from riskspark.functions.clock import DAY_MS, HOUR_MS, MINUTE_MS
from riskspark.operators.device import IDLE_MS, RECENT_MINUTES
from riskspark.operators.velocity import WINDOWS

# How long things are kept and how late a row may be.
DEDUP_MS = 48 * HOUR_MS
RETENTION_MS = (24 * 3600 + 41) * 1000
OUT_OF_ORDER_MS = 10_000
ALLOWED_LATENESS_MS = 30_000
# End of fixed values.
MONEY_UNITS = 10_000  # amounts are kept as whole numbers of 1/10000


class _Ordered(StatefulProcessor):
    """Common part: rows of a key sorted, and one timer per key that frees its state."""

    time = "event_ms"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.timer = handle.getValueState("timer", T.StructType([T.StructField("at", T.LongType())]))

    def sorted_rows(self, rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
        frame = pd.concat(list(rows), ignore_index=True)
        return frame.sort_values([self.time, "transaction_id"], kind="stable", ignore_index=True)

    def free_at(self, at: int) -> None:
        if self.timer.exists():
            previous = self.timer.get()[0]
            if previous >= at:
                return
            self.handle.deleteTimer(previous)
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def close(self) -> None:
        pass

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Takes over what `seed` worked out from stored rows; runs once per key, before the first batch of a new query."""
        self.seed(initialState)

    def seed(self, rows: pd.DataFrame) -> None:
        raise NotImplementedError


SEEN_ID = T.StructType([T.StructField("id", T.StringType())])
SEEN_AT = T.StructType([T.StructField("at", T.LongType())])


class FirstSeen(_Ordered):
    """Lets the first row of a transaction through; copies do not prolong the 48 h.

    A key is a bucket of transactions, with one entry per id, so a call handles many ids. Entries whose time is
    over are dropped when the bucket's timer fires, an hour after the oldest of them at the latest.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.seen = handle.getMapState("seen", SEEN_ID, SEEN_AT)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self.sorted_rows(rows)
        keep, known, changed = [], {}, set()
        for position, (name, at) in enumerate(zip(frame["transaction_id"].tolist(), frame[self.time].tolist(), strict=True)):
            if name not in known:
                known[name] = self.seen.getValue((name,))[0] if self.seen.containsKey((name,)) else None
            last = known[name]
            if last is None or at >= last + DEDUP_MS:
                known[name] = int(at)
                changed.add(name)
                keep.append(position)
        for name in changed:
            self.seen.updateValue((name,), (known[name],))
        if keep:
            if not self.timer.exists():
                self._wake(min(known[name] for name in changed))
            yield frame.iloc[keep]

    def seed(self, rows: pd.DataFrame) -> None:
        for name, at in zip(rows["transaction_id"].tolist(), rows["at"].tolist(), strict=True):
            self.seen.updateValue((name,), (int(at),))
        if not self.timer.exists():
            self._wake(int(rows["at"].min()))

    def _wake(self, oldest: int) -> None:
        at = oldest + DEDUP_MS + HOUR_MS
        self.handle.registerTimer(at)
        self.timer.update((at,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        over, left = [], []
        for name, at in ((entry[0][0], entry[1][0]) for entry in self.seen.iterator()):
            if at + DEDUP_MS <= now:
                over.append(name)
            else:
                left.append(at)
        for name in over:
            self.seen.removeKey((name,))
        self.timer.clear()
        if left:
            self._wake(min(left))
        return iter(())


BUCKET_KEY = T.StructType([T.StructField("minute", T.LongType())])
BUCKET_VALUE = T.StructType([T.StructField("n", T.LongType()), T.StructField("units", T.LongType())])


def read_buckets(state) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stored minute buckets in order: minutes, counts, amounts."""
    entries = sorted((key[0], value[0], value[1]) for key, value in state.iterator())
    columns = list(zip(*entries)) if entries else [(), (), ()]
    return tuple(np.asarray(column, dtype=np.int64) for column in columns)


def rolling(buckets, minutes: np.ndarray, units: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Count and amount over the last `span` minutes at each of the sorted new rows.

    Stored buckets newer than a row's own minute do not count for it.
    """
    stored, counts, sums = buckets
    low = np.searchsorted(stored, minutes - span, "left")
    high = np.searchsorted(stored, minutes, "right")
    stored_n = np.concatenate([[0], np.cumsum(counts)])
    stored_units = np.concatenate([[0], np.cumsum(sums)])
    first = np.searchsorted(minutes, minutes - span, "left")
    position = np.arange(len(minutes))
    new_units = np.concatenate([[0], np.cumsum(units)])
    n = stored_n[high] - stored_n[low] + position + 1 - first
    total = stored_units[high] - stored_units[low] + new_units[position + 1] - new_units[first]
    return n, total


def store_buckets(state, buckets, minutes: np.ndarray, units: np.ndarray, oldest: int) -> None:
    """Adds the new rows to their buckets and drops buckets older than `oldest`."""
    stored = dict(zip(buckets[0].tolist(), zip(buckets[1].tolist(), buckets[2].tolist())))
    for minute in stored:
        if minute < oldest:
            state.removeKey((minute,))
    changed, index = np.unique(minutes, return_inverse=True)
    counts = np.bincount(index, minlength=len(changed))
    sums = np.zeros(len(changed), dtype=np.int64)
    np.add.at(sums, index, units)
    for minute, n, total in zip(changed.tolist(), counts.tolist(), sums.tolist()):
        if minute >= oldest:
            known = stored.get(minute, (0, 0))
            state.updateValue((minute,), (known[0] + n, known[1] + total))


def add_buckets(state, rows: pd.DataFrame) -> None:
    """Stored minute buckets as they are; `rows` has minute, n, units."""
    for minute, n, units in zip(rows["minute"].tolist(), rows["n"].tolist(), rows["units"].tolist(), strict=True):
        state.updateValue((int(minute),), (int(n), int(units)))


class Velocity(_Ordered):
    """Adds `lateness`, the velocity columns (amounts in units) and the watermark of the decision.

    A row later than allowed is passed on marked `beyond`, without velocity.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.buckets = handle.getMapState("buckets", BUCKET_KEY, BUCKET_VALUE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self.sorted_rows(rows)
        watermark = timerValues.getCurrentWatermarkInMs()
        narrow = watermark if watermark > 0 else None
        times = frame[self.time].to_numpy(dtype=np.int64)
        lateness = np.full(len(frame), "on_time", dtype=object)
        if narrow is not None:
            lateness[times < narrow] = "within"
            lateness[times < narrow - ALLOWED_LATENESS_MS] = "beyond"
        frame["lateness"] = lateness
        frame["watermark_ms"] = pd.Series([narrow] * len(frame), dtype="Int64")
        accepted = frame[lateness != "beyond"].copy()
        refused = frame[lateness == "beyond"].copy()
        for _, label in WINDOWS:
            for name in (f"vel_count_{label}", f"vel_units_{label}"):
                refused[name] = pd.Series([None] * len(refused), dtype="Int64", index=refused.index)
        if len(accepted):
            minutes = np.floor_divide(accepted[self.time].to_numpy(dtype=np.int64), MINUTE_MS)
            units = accepted["amount_units"].to_numpy(dtype=np.int64)
            known = read_buckets(self.buckets)
            for span, label in WINDOWS:
                n, total = rolling(known, minutes, units, span)
                accepted[f"vel_count_{label}"] = pd.Series(n, dtype="Int64", index=accepted.index)
                accepted[f"vel_units_{label}"] = pd.Series(total, dtype="Int64", index=accepted.index)
            oldest = (max(0, watermark) - RETENTION_MS) // MINUTE_MS
            store_buckets(self.buckets, known, minutes, units, oldest)
            self.free_at(int(accepted[self.time].max()) + RETENTION_MS)
        yield pd.concat([accepted, refused], ignore_index=True)

    def seed(self, rows: pd.DataFrame) -> None:
        add_buckets(self.buckets, rows)
        self.free_at((int(rows["minute"].max()) + 1) * MINUTE_MS + RETENTION_MS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.buckets.clear()
        self.timer.clear()
        return iter(())


PROFILE = T.StructType(
    [
        T.StructField("first_ms", T.LongType()),
        T.StructField("n", T.LongType()),
        T.StructField("last_ms", T.LongType()),
        T.StructField("country", T.StringType()),
    ]
)


class Device(_Ordered):
    """Adds the device columns. Rows without a device, and refused ones, pass with nulls."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.profile = handle.getValueState("profile", PROFILE)
        self.buckets = handle.getMapState("buckets", BUCKET_KEY, BUCKET_VALUE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        frame = self.sorted_rows(rows)
        active = frame["has_device"].to_numpy(dtype=bool)
        known, other = frame[active].copy(), frame[~active].copy()
        if len(known):
            self._advance(known, timerValues)
        numbers = ("device_first_ms", "device_txn_count", "prev_ms", "device_count_24h")
        for name in numbers:
            other[name] = pd.Series([None] * len(other), dtype="Int64", index=other.index)
        other["prev_geo_country"] = pd.Series([None] * len(other), dtype=object, index=other.index)
        yield pd.concat([known, other], ignore_index=True)

    def _advance(self, rows: pd.DataFrame, timerValues) -> None:
        times = rows[self.time].to_numpy(dtype=np.int64)
        if self.profile.exists():
            first, n, last, country = self.profile.get()
        else:
            first, n, last, country = None, 0, None, None
        before = np.concatenate([[times[0] - IDLE_MS - 1 if last is None else last], times[:-1]])
        fresh = times - before > IDLE_MS
        life = np.maximum.accumulate(np.where(fresh, np.arange(len(times)), -1))
        position = np.arange(len(times))
        continues = life < 0
        count = np.where(continues, n + position + 1, position - life + 1)
        start = np.where(continues, 0 if first is None else first, times[np.maximum(life, 0)])
        countries = rows["geo_country"].where(rows["geo_country"].notna(), None).tolist()
        earlier = [country, *countries[:-1]]
        index = rows.index
        rows["device_first_ms"] = pd.Series(start, dtype="Int64", index=index)
        rows["device_txn_count"] = pd.Series(count, dtype="Int64", index=index)
        rows["prev_ms"] = pd.Series([None if f else int(b) for f, b in zip(fresh, before)], dtype="Int64", index=index)

        minutes = np.floor_divide(times, MINUTE_MS)
        units = np.zeros(len(times), dtype=np.int64)
        known = read_buckets(self.buckets)
        recent, _ = rolling(known, minutes, units, RECENT_MINUTES)
        rows["device_count_24h"] = pd.Series(recent, dtype="Int64", index=index)
        rows["prev_geo_country"] = pd.Series([None if f else c for f, c in zip(fresh, earlier)], dtype=object, index=index)
        oldest = (max(0, timerValues.getCurrentWatermarkInMs()) - DAY_MS) // MINUTE_MS - 1
        store_buckets(self.buckets, known, minutes, units, oldest)
        self.profile.update((int(start[-1]), int(count[-1]), int(times[-1]), countries[-1]))
        self.free_at(int(times[-1]) + IDLE_MS + 1)

    def seed(self, rows: pd.DataFrame) -> None:
        add_buckets(self.buckets, rows)
        first, n, last, country = (rows[c].iloc[0] for c in ("first_ms", "total", "last_ms", "country"))
        self.profile.update((int(first), int(n), int(last), country))
        self.free_at(int(last) + IDLE_MS + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.profile.clear()
        self.buckets.clear()
        self.timer.clear()
        return iter(())
