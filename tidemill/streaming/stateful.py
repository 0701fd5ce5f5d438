"""Keyed state with user-defined logic: running totals, seen items, and the rising-value alarm with timers."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tidemill.session import use_rocksdb


class RunningTotal(StatefulProcessor):
    """Value state holding a key's total; one output row per key and micro-batch with the new total."""

    def __init__(self, key: str, value: str):
        self.key, self.value = key, value

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.total = handle.getValueState("total", "total long, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        total, n = self.total.get() if self.total.exists() else (0, 0)
        for chunk in rows:
            total, n = total + int(chunk[self.value].sum()), n + len(chunk)
        self.total.update((total, n))
        yield pd.DataFrame({self.key: [key[0]], "total": [total], "n": [n]})


class TotalChanges(RunningTotal):
    """The same state, as a change log: per key and micro-batch the old total is retracted and the new one added."""

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.total.exists()
        old = self.total.get()[0] if known else None
        for new in super().handleInputRows(key, rows, timerValues):
            changes = [(key[0], False, old)] if known else []
            changes.append((key[0], True, int(new["total"].iloc[0])))
            yield pd.DataFrame(changes, columns=[self.key, "op", "total"])


class SeenItems(StatefulProcessor):
    """Map state of a key's items and their counts; emits how many distinct ones there are after each micro-batch.

    The map is read once per key and micro-batch, and only what changed is written. With ``ttl_ms`` an item that did not
    come for so long is forgotten, and counts as new when it comes again.
    """

    def __init__(self, key: str, item: str, ttl_ms: int | None = None):
        self.key, self.item, self.ttl_ms = key, item, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getMapState("seen", "item string", "n long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = {item[0]: n[0] for item, n in self.seen.iterator()}
        news: Counter = Counter()
        for chunk in rows:
            news.update(chunk[self.item].value_counts().to_dict())
        for item, n in news.items():
            self.seen.updateValue((item,), (known.get(item, 0) + int(n),))
        yield pd.DataFrame({self.key: [key[0]], "n_distinct": [len(known.keys() | news.keys())]})


class Reduced(StatefulProcessor):
    """Reducing state: a key's values folded into one by ``reduce``, which sees two arrays' worth at a time.

    A row with ``clear`` true wipes the state: what came before it in ``order`` no longer counts, and it brings no value
    itself. With ``ttl_ms`` a key that got no row for so long starts anew. Emits ``value, n`` (null, 0 when wiped) of each
    key that got rows. A task holds a key's rows of one micro-batch, as two numbers each.
    """

    def __init__(self, key: str, reduce: Callable[[np.ndarray], int], ttl_ms: int | None = None):
        self.key, self.reduce, self.ttl_ms = key, reduce, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.reduced = handle.getValueState("reduced", "value long, n long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        wiped, orders, values = None, [], []
        for chunk in rows:
            clears = chunk.loc[chunk["clear"], "at"]
            if len(clears):
                wiped = max(int(clears.max()), wiped if wiped is not None else int(clears.max()))
            kept = chunk.loc[~chunk["clear"]]
            orders.append(kept["at"].to_numpy(np.int64))
            values.append(kept["value"].to_numpy(np.int64))
        order, value = np.concatenate(orders), np.concatenate(values)
        if wiped is not None:
            value = value[order > wiped]
            self.reduced.clear()
        old, n = self.reduced.get() if self.reduced.exists() else (None, 0)
        both = value if old is None else np.append(value, old)
        if len(both):
            old, n = int(self.reduce(both)), n + len(value)
            self.reduced.update((old, n))
        yield pd.DataFrame({self.key: [key[0]], "value": pd.array([old], "Int64"), "n": [n]})


class RisingAlarm(StatefulProcessor):
    """The streaming twin of ``operators.alarms.rising_alarms``: readings wait in list state until the watermark passes them.

    Only then are they taken, in the order of time, so readings may come in any order within the delay and over any
    number of micro-batches. A key has one timer: the earliest waiting reading or the end of its open watch. What a task
    holds of a key are the readings of one delay, not of a micro-batch.
    """

    def __init__(self, key: str, threshold: float, hold_ms: int, reset_on_drop: bool):
        self.key, self.threshold, self.hold_ms, self.reset_on_drop = key, threshold, hold_ms, reset_on_drop

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "at long, seq long, value double")
        self.rising = handle.getListState("rising", "at long, value double")
        self.timer = handle.getValueState("timer", "at long")

    def _wake_at(self, at: int | None) -> None:
        """Make ``at`` the key's only timer."""
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
            self.timer.clear()
        if at is not None:
            self.handle.registerTimer(at)
            self.timer.update((at,))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        low = None
        for chunk in rows:
            taken = list(zip(chunk["at_ms"].astype("int64").tolist(), chunk["seq"].tolist(), chunk["value"].tolist(), strict=True))
            self.waiting.appendList(taken)
            low = min([t[0] for t in taken] + [low] * (low is not None))
        if low is not None and not (self.timer.exists() and self.timer.get()[0] <= low):
            self._wake_at(low)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        waiting = sorted(tuple(r) for r in self.waiting.get()) if self.waiting.exists() else []
        rising = [tuple(r) for r in self.rising.get()] if self.rising.exists() else []
        due = [r for r in waiting if r[0] <= passed]
        later = waiting[len(due) :]
        out = []
        for at, _, value in due:
            if rising and at > rising[0][0] + self.hold_ms:
                out += self._close(rising)
                rising = []
            if rising and self.reset_on_drop and value < rising[-1][1]:
                rising = []
            elif value >= self.threshold and (not rising or value > rising[-1][1]):
                rising.append((at, value))
        if rising and rising[0][0] + self.hold_ms <= passed:
            out += self._close(rising)
            rising = []
        for state, rows in ((self.waiting, later), (self.rising, rising)):
            state.put(rows) if rows else state.clear()
        self._wake_at(min([r[0] for r in later[:1]] + [r[0] + self.hold_ms for r in rising[:1]], default=None))
        if out:
            yield self._frame(key, out)

    def _close(self, listed: list) -> list:
        if len(listed) < 2:
            return []
        return [(listed[0][0], listed[0][1], listed[-1][1], listed[0][0] + self.hold_ms)]

    def _frame(self, key, rows: list) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["opened_ms", "first_value", "peak_value", "alarm_ms"])
        out.insert(0, self.key, key[0])
        return out


def _key_type(df: DataFrame, key: str) -> str:
    return f"`{key}` {dict(df.dtypes)[key]}"


def stream_running_total(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Per micro-batch the new total of each key that got rows; ``value`` is a whole number (cents, counts)."""
    use_rocksdb(stream.sparkSession)
    return (
        stream.select(key, value)
        .groupBy(key)
        .transformWithStateInPandas(
            RunningTotal(key, value), f"{_key_type(stream, key)}, total long, n long", "Update", "None"
        )
    )


def stream_change_log(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Per micro-batch the changes of the totals of each key that got rows: ``key, op, total``."""
    use_rocksdb(stream.sparkSession)
    return (
        stream.select(key, value)
        .groupBy(key)
        .transformWithStateInPandas(
            TotalChanges(key, value), f"{_key_type(stream, key)}, op boolean, total long", "Append", "None"
        )
    )


def stream_reduced(
    stream: DataFrame, key: str, value: str, order: str, reduce: Callable[[np.ndarray], int], clear: Column | None = None, ttl_s: float | None = None
) -> DataFrame:
    """Per micro-batch ``key, value, n``: the values of each key that got rows, reduced since its last ``clear`` row.

    ``value`` and ``order`` are whole numbers; rows without one of them are left out. ``reduce`` folds an array into one number
    and may fold its own results. With ``ttl_s`` a key is forgotten that long (of processing time) after its last
    row; run it with ``only_new``.
    """
    use_rocksdb(stream.sparkSession)
    wipes = F.coalesce(clear, F.lit(False)) if clear is not None else F.lit(False)
    rows = stream.select(key, F.col(order).cast("long").alias("at"), F.coalesce(F.col(value).cast("long"), F.when(wipes, 0)).alias("value"), wipes.alias("clear"))
    ttl_ms = None if ttl_s is None else round(ttl_s * 1000)
    return (
        rows.where("at IS NOT NULL AND value IS NOT NULL")
        .groupBy(key)
        .transformWithStateInPandas(
            Reduced(key, reduce, ttl_ms), f"{_key_type(stream, key)}, value long, n long", "Update", "None" if ttl_ms is None else "ProcessingTime"
        )
    )


def stream_distinct(stream: DataFrame, key: str, item: str, ttl_s: float | None = None) -> DataFrame:
    """Per micro-batch the distinct items so far of each key that got rows; with ``ttl_s`` those of that long at most
    (run it with ``only_new``)."""
    ttl_ms = None if ttl_s is None else round(ttl_s * 1000)
    use_rocksdb(stream.sparkSession)
    return (
        stream.select(key, F.col(item).cast("string").alias(item))
        .groupBy(key)
        .transformWithStateInPandas(
            SeenItems(key, item, ttl_ms), f"{_key_type(stream, key)}, n_distinct long", "Update", "None" if ttl_ms is None else "ProcessingTime"
        )
    )


def stream_rising_alarms(
    stream: DataFrame,
    key: str,
    ts: str,
    value: str,
    order: str,
    delay: str = "0 seconds",
    threshold: float = 60.0,
    hold_s: float = 5.0,
    reset_on_drop: bool = False,
) -> DataFrame:
    """Alarms as they become due: ``key, opened_ms, first_value, peak_value, alarm_ms``.

    Readings may be out of order by ``delay``; later ones are dropped. ``order`` decides between readings of one time.
    """
    use_rocksdb(stream.sparkSession)
    readings = stream.where(F.col(ts).isNotNull() & F.col(value).isNotNull()).select(
        key,
        F.col(ts).cast("timestamp").alias("at"),
        F.unix_millis(F.col(ts).cast("timestamp")).alias("at_ms"),
        F.col(order).cast("long").alias("seq"),
        F.col(value).cast("double").alias("value"),
    )
    schema = f"{_key_type(stream, key)}, opened_ms long, first_value double, peak_value double, alarm_ms long"
    processor = RisingAlarm(key, threshold, round(hold_s * 1000), reset_on_drop)
    marked = readings.withWatermark("at", delay)
    if not reset_on_drop:
        marked = marked.where(F.col("value") >= threshold)  # lower readings neither open nor end a watch
    return (
        marked.groupBy(key)
        .transformWithStateInPandas(processor, schema, "Append", "EventTime")
    )
