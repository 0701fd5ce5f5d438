"""Alarm on values that rise above a threshold and keep rising.

A reading at or above the threshold opens a watch of ``hold_s`` seconds. If another reading in the watch exceeds the
opening one, the watch ends in an alarm. The next watch opens with the first such reading after the watch. With
``reset_on_drop`` a reading below the one before it ends the watch at once, without alarm.

Watches of one key follow from each other, so they cannot be cut by key and time freely. Each (key, slice) of the order
works out where every possible entry would leave it; the entries are then chained over the few slices of a key; and each
slice lists its watches from its now known entry. No task ever holds a whole heavy key. All other keys stream through their
tasks in order, many keys a batch, without a call per key.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.groups import key_borders, whole_groups
from tidemill.operators.slices import SLICE, WHOLE_KEY, SlicedOrder, join_on


def _next_watch(at: np.ndarray, high: np.ndarray, drop: np.ndarray, hold: int):
    """For a watch opened at each row: first row after it, first drop in it, and the row that opens the next one."""
    n = len(at)
    over = np.searchsorted(at, at + hold, side="right")
    drops = np.append(np.flatnonzero(drop), n)
    fell = drops[np.searchsorted(drops, np.arange(n), side="right").clip(max=len(drops) - 1)]
    highs = np.append(np.flatnonzero(high), n)
    resume = np.where(fell < over, fell + 1, over)
    return over, fell, highs[np.searchsorted(highs, resume)], highs


def _slice_entries(rows: pd.DataFrame, hold: int) -> dict:
    """Per possible first watch of a slice, the watch still open at its end."""
    at, ids = rows["_at"].to_numpy(), rows["_id"].to_numpy()
    drop = rows["_drop"].to_numpy()
    over, fell, following, highs = _next_watch(at, rows["_high"].to_numpy(), drop, hold)
    n = len(at)
    first_drop = int(np.flatnonzero(drop)[0]) if drop.any() else n
    furthest = min(int(np.searchsorted(at, at[0] + hold, side="right")), n)
    starts = np.arange(furthest + 1)
    if first_drop + 1 <= n:
        starts = np.append(starts, first_drop + 1)
    entries = np.unique(highs[np.searchsorted(highs, starts)])
    entries = entries[entries < n]
    # follow the chain of watches to its last one in this slice, doubling the step
    last, step = np.arange(n), np.append(following, n)
    last = np.append(last, n)
    while (step[entries] < n).any():
        last = np.where(step < n, last[np.minimum(step, n)], last)
        step = step[np.minimum(step, n)]
    end = last[entries]
    ended = (fell[end] < over[end]) & (fell[end] < n) if len(end) else np.zeros(0, dtype=bool)
    return {
        "entry_at": at[entries].tolist(),
        "entry_id": ids[entries].tolist(),
        "open_until": [None if e else int(at[i] + hold) for i, e in zip(end, ended)],
        "open_id": [None if e else int(ids[i]) for i, e in zip(end, ended)],
        "drop_at": int(at[first_drop]) if first_drop < n else None,
        "after_drop": int(np.searchsorted(entries, first_drop + 1)) if first_drop < n else len(entries),
    }


def _chain(slices: pd.DataFrame) -> pd.DataFrame:
    """Walk one key's slices in order: which watch is open on entry, and which row opens the first new one."""
    until, watch, out = None, None, []
    for s in slices.sort_values(SLICE).itertuples(index=False):
        dropped = until is not None and not pd.isna(s.drop_at) and s.drop_at <= until
        if until is None:
            pick = 0
        elif dropped:
            pick = int(s.after_drop)
        else:
            pick = int(np.searchsorted(np.asarray(s.entry_at), until, side="right"))
        has_entry = pick < len(s.entry_at)
        out.append((until, watch, s.entry_id[pick] if has_entry else None))
        if has_entry:
            until, watch = s.open_until[pick], s.open_id[pick]
            until, watch = (None, None) if until is None or pd.isna(until) else (int(until), int(watch))
        elif dropped:
            until, watch = None, None
    ordered = slices.sort_values(SLICE)
    known = pd.DataFrame(out, columns=["_until", "_open", "_entry"]).astype("Int64")
    return pd.concat([ordered.drop(columns=_ENTRY_COLUMNS).reset_index(drop=True), known], axis=1)


_ENTRY_COLUMNS = ["entry_at", "entry_id", "open_until", "open_id", "drop_at", "after_drop"]
_ENTRY_SCHEMA = (
    "entry_at array<long>, entry_id array<long>, open_until array<long>, open_id array<long>, "
    "drop_at long, after_drop int"
)


def _slice_watches(rows: pd.DataFrame, hold: int) -> list[tuple]:
    """The watches of one slice: (watch id, opened at, opening value, peak seen here, dropped here)."""
    at, ids, values = rows["_at"].to_numpy(), rows["_id"].to_numpy(), rows["_value"].to_numpy()
    drop = rows["_drop"].to_numpy()
    over, fell, following, _ = _next_watch(at, rows["_high"].to_numpy(), drop, hold)
    n, out = len(at), []
    until, watch, entry = (rows[c].iloc[0] for c in ("_until", "_open", "_entry"))
    if not pd.isna(until):
        covered = int(np.searchsorted(at, until, side="right"))
        dropped = np.flatnonzero(drop[:covered])
        covered = int(dropped[0]) if len(dropped) else covered
        if covered or len(dropped):
            peak = float(values[:covered].max()) if covered else None
            out.append((int(watch), None, None, peak, bool(len(dropped))))
    i = n if pd.isna(entry) else int(np.flatnonzero(ids == entry)[0])
    return out + _watches_from(i, at, ids, values, over, fell, following)


def _watches_from(i: int, at, ids, values, over, fell, following) -> list[tuple]:
    """The watches that follow from each other, the first one opened by row ``i``."""
    out = []
    while i < len(at):
        end = min(over[i], fell[i])
        out.append((int(ids[i]), int(at[i]), float(values[i]), float(values[i:end].max()), bool(fell[i] < over[i])))
        i = following[i]
    return out


_WATCH_COLUMNS = ["watch", "opened", "first_value", "peak_value", "dropped"]
_WATCH_SCHEMA = "watch long, opened long, first_value double, peak_value double, dropped boolean"
_READING = ["_at", "_id", "_value", "_high", "_drop"]


def _whole_keys(rows: DataFrame, key: str, hold: int) -> DataFrame:
    """The watches of keys that are no task's burden: sorted, and worked on key by key within large batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in whole_groups(batches, key):
            at, ids, values, high, drop = (frame[c].to_numpy() for c in _READING)
            borders = np.flatnonzero(key_borders(frame[key]))
            names, found, counts = frame[key].iloc[borders], [], []
            for start, end in itertools.pairwise([*borders.tolist(), len(frame)]):
                part = slice(start, end)
                over, fell, following, highs = _next_watch(at[part], high[part], drop[part], hold)
                listed = _watches_from(int(highs[0]), at[part], ids[part], values[part], over, fell, following)
                found += listed
                counts.append(len(listed))
            out = pd.DataFrame(found, columns=_WATCH_COLUMNS)
            out.insert(0, key, names.repeat(counts).reset_index(drop=True))
            yield out

    key_type = dict(rows.dtypes)[key]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select(key, *_READING).repartition(parts, key).sortWithinPartitions(key, "_at", "_id")
    return dealt.mapInPandas(run, f"`{key}` {key_type}, {_WATCH_SCHEMA}")


def rising_alarms(
    df: DataFrame,
    key: str,
    ts: str,
    value: str,
    order: str,
    threshold: float = 60.0,
    hold_s: float = 5.0,
    reset_on_drop: bool = False,
) -> DataFrame:
    """Alarms per key: ``key, opened_at, first_value, peak_value, alarm_at`` (times as timestamps).

    Readings are taken in the order of (``ts``, ``order``); ``order`` is a whole number unique per reading.
    """
    hold = round(hold_s * 1_000_000)
    readings = df.where(F.col(value).isNotNull() & F.col(ts).isNotNull()).select(
        key,
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"),
        F.col(order).cast("long").alias("_id"),
        F.col(value).cast("double").alias("_value"),
        (F.col(value) >= threshold).alias("_high"),
    )
    if not reset_on_drop:
        readings = readings.where("_high")  # lower readings neither open nor end a watch
    plan = SlicedOrder(readings, [key], ["_at", "_id"])
    rows = plan.add(readings)
    group = [key, SLICE]
    if reset_on_drop:
        before = F.lag("_value").over(plan.within())
        if plan.split:
            last = rows.groupBy(*group).agg(F.max_by("_value", F.struct("_at", "_id")).alias("_last"))
            earlier = Window.partitionBy(key).orderBy(SLICE)
            last = last.where(F.col(SLICE) != WHOLE_KEY).select(*group, F.lag("_last").over(earlier).alias("_last"))
            rows = plan.attach(rows, last)
            before = F.coalesce(before, F.col("_last"))
        rows = rows.withColumn("_drop", F.coalesce(F.col("_value") < before, F.lit(False))).drop("_last")
    else:
        rows = rows.withColumn("_drop", F.lit(False))

    key_type = dict(readings.dtypes)[key]
    ordering = ["_at", "_id"]

    def entries(part: pd.DataFrame) -> pd.DataFrame:
        found = _slice_entries(part.sort_values(ordering), hold)
        return pd.DataFrame([{**part[group].iloc[0].to_dict(), **found}])

    def watches(part: pd.DataFrame) -> pd.DataFrame:
        found = _slice_watches(part.sort_values(ordering), hold)
        out = pd.DataFrame(found, columns=_WATCH_COLUMNS)
        out.insert(0, key, part[key].iloc[0])
        return out.astype({"opened": "Int64"})

    light = rows.where(F.col(SLICE) == WHOLE_KEY) if plan.split else rows
    whole = _whole_keys(light, key, hold)
    if plan.split:
        rows = rows.where(F.col(SLICE) != WHOLE_KEY)
        per_slice = rows.groupBy(*group).applyInPandas(entries, f"`{key}` {key_type}, {SLICE} int, {_ENTRY_SCHEMA}")
        known = per_slice.groupBy(key).applyInPandas(
            _chain, f"`{key}` {key_type}, {SLICE} int, _until long, _open long, _entry long"
        )
        pieces = join_on(rows, known, group).groupBy(*group).applyInPandas(watches, f"`{key}` {key_type}, {_WATCH_SCHEMA}")
        whole = whole.unionByName(pieces.groupBy(key, "watch").agg(*(F.max(c).alias(c) for c in _WATCH_COLUMNS[1:])))
    rising = whole.where((F.col("peak_value") > F.col("first_value")) & ~F.col("dropped"))
    return rising.select(
        key,
        F.timestamp_micros("opened").alias("opened_at"),
        "first_value",
        "peak_value",
        F.timestamp_micros(F.col("opened") + hold).alias("alarm_at"),
    )
