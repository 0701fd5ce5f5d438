"""Time and count windows."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemill.functions.times import minute_label
from tidemill.operators.aggregates import combine_groups
from tidemill.operators.groups import key_borders
from tidemill.operators.running import number_rows

_MERGE = {"sum": F.sum, "count": F.sum, "max": F.max, "min": F.min}
_FIRST = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}

_ROWS_AT_ONCE = 10_000

Measures = Mapping[str, tuple[str, Column | str]]


def _flat_window(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "window"]
    bounds = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
    return df.select(*bounds, *rest)


def tumbling(df: DataFrame, ts: str, size: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates per key and window ``[start, start + size)``; no keys means one window over all rows."""
    return _flat_window(df.groupBy(F.window(ts, size).alias("window"), *keys).agg(*aggregates))


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregates per key and overlapping window; each row counts in ``size / slide`` windows. Also for streams."""
    return _flat_window(df.groupBy(F.window(ts, size, slide).alias("window"), *keys).agg(*aggregates))


def sliding_panes(
    df: DataFrame, ts: str, size_s: int, slide_s: int, keys: Sequence[str], measures: Measures
) -> DataFrame:
    """The batch form of ``sliding`` for mergeable measures and many windows per row.

    Rows meet once per pane and only panes are copied per window, at the price of a second shuffle. ``measures`` maps a name to ("sum"|"count"|"max"|"min", column).
    """
    pane_s = gcd(size_s, slide_s)
    pane = F.window(ts, f"{pane_s} seconds")["start"]
    panes = df.groupBy(pane.alias("_pane"), *keys).agg(*[_FIRST[how](c).alias(n) for n, (how, c) in measures.items()])
    at = F.unix_seconds("_pane")
    newest = at - F.pmod(at, F.lit(slide_s))
    oldest = newest - F.floor((size_s - 1 - F.pmod(at, F.lit(slide_s))) / slide_s).cast("long") * slide_s
    spread = panes.withColumn("_start", F.explode(F.sequence(oldest, newest, F.lit(slide_s).cast("long"))))
    merged = spread.groupBy("_start", *keys).agg(*[_MERGE[how](n).alias(n) for n, (how, _) in measures.items()])
    start = F.timestamp_seconds("_start")
    end = F.timestamp_seconds(F.col("_start") + size_s)
    return merged.select(start.alias("window_start"), end.alias("window_end"), *keys, *measures)


def sampling(df: DataFrame, ts: str, size_s: int, every_s: int, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Windows of ``size_s`` that start each ``every_s`` seconds, with a pause between: rows of the pause count nowhere."""
    if every_s < size_s:
        raise ValueError("a sampling window has every_s >= size_s")
    start = F.window(ts, f"{every_s} seconds")["start"]
    inside = df.withColumn("window_start", start).where(
        F.col(ts).cast("timestamp") < F.col("window_start") + F.make_dt_interval(secs=F.lit(size_s))
    )
    summed = inside.groupBy("window_start", *keys).agg(*aggregates)
    end = F.col("window_start") + F.make_dt_interval(secs=F.lit(size_s))
    return summed.select("window_start", end.alias("window_end"), *[c for c in summed.columns if c != "window_start"])


def count_tumbling(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, *aggregates: Column
) -> DataFrame:
    """Aggregates per ``size`` consecutive rows of a key (of all rows without keys); an unfilled window is not emitted.

    ``window_no`` counts from 0.
    """
    numbered = number_rows(df, keys, order, "_rn")
    window_no = F.floor((F.col("_rn") - 1) / size).cast("long").alias("window_no")
    full = numbered.groupBy(*keys, window_no).agg(*aggregates, F.count("*").alias("_n")).where(F.col("_n") == size)
    return full.drop("_n")


def count_sliding(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], size: int, slide: int, measures: Measures
) -> DataFrame:
    """Every ``slide`` rows of a key, ``measures`` over its last ``size`` rows (fewer at the start).

    ``upto`` is the number of the row that fired. Rows meet once per run of ``gcd(size, slide)`` rows; runs are then
    copied to the windows that hold them, so no window has to look back across tasks.
    """
    numbered = number_rows(df, keys, order, "_rn")
    return windows_of_runs(first_of(numbered, keys, size, slide, measures), keys, size, slide, measures)


def merge_of(measures: Measures) -> list[Column]:
    """Aggregates that put partial results of ``measures`` together."""
    return [_MERGE[how](n).alias(n) for n, (how, _) in measures.items()]


def first_of(numbered: DataFrame, keys: Sequence[str], size: int, slide: int, measures: Measures) -> DataFrame:
    """Rows with their number ``_rn`` as partial results per run: keys, ``_run`` (its last number), measures, ``_last`` row met."""
    step = gcd(size, slide)
    run = F.ceil(F.col("_rn") / step).cast("long") * step
    return numbered.groupBy(*keys, run.alias("_run")).agg(
        *[_FIRST[how](c).alias(n) for n, (how, c) in measures.items()], F.max("_rn").alias("_last")
    )


def windows_of_runs(runs: DataFrame, keys: Sequence[str], size: int, slide: int, measures: Measures, *more: Column) -> DataFrame:
    """The windows whose last row is in ``runs``: keys, ``upto``, measures, and ``more`` aggregates over their runs."""
    first = F.ceil(F.col("_run") / slide).cast("long") * slide
    last = F.floor((F.col("_run") + size - 1) / slide).cast("long") * slide
    spread = runs.where(last >= first).withColumn("upto", F.explode(F.sequence(first, last, F.lit(slide).cast("long"))))
    fired = spread.groupBy(*keys, "upto").agg(*merge_of(measures), F.max("_last").alias("_last"), *more)
    return fired.where(F.col("_last") == F.col("upto")).drop("_last")


def window_apply(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    combine: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
) -> DataFrame:
    """A user function over the rows of each (key, window), for what aggregates cannot say.

    ``combine`` sees every row of a window together with key, ``window_start`` and ``window_end``, in pieces: it reduces
    rows to fewer rows per window and is applied again to its own results (see ``combine_groups``), so that a window with a
    third of all rows needs no task that holds them. ``df`` brings the columns of ``schema`` except the window bounds.
    """
    names = [f.name for f in StructType.fromDDL(schema)]
    bounds = {"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}
    flat = df.withColumn("_w", F.window(ts, size)).withColumns(bounds).select(*names)
    return combine_groups(flat, [*keys, "window_start"], combine, schema)


WindowFunction = Callable[[tuple, pd.Timestamp, pd.Timestamp, Iterator[pd.DataFrame]], Iterable[tuple]]


def _same(a: tuple, b: tuple) -> bool:
    return all(x == y or (pd.isna(x) and pd.isna(y)) for x, y in zip(a, b, strict=True))


def _cut_at_borders(batches: Iterator[pd.DataFrame], group: Sequence[str]) -> Iterator[tuple[list, pd.DataFrame]]:
    """Pieces of one group each, with the group's number and values in a list that is the same object for all its pieces."""
    current = None
    for rows in batches:
        if not len(rows):
            continue
        by = rows[list(group)]
        starts = [*np.flatnonzero(key_borders(by)).tolist(), len(rows)]
        values = by.iloc[starts[:-1]].itertuples(index=False, name=None)
        for at, (start, end) in zip(values, itertools.pairwise(starts), strict=True):
            if current is None or not _same(current, at):
                current = at
            yield current, rows.iloc[start:end]


def window_rows(placed: DataFrame, keys: Sequence[str], order: Sequence[str], function: WindowFunction, schema: str) -> DataFrame:
    """``window_process`` for rows that have their ``window_start`` and ``window_end``."""
    spark = placed.sparkSession
    group = [*keys, "window_start", "window_end"]
    types = {f.name: f.dataType for f in placed.schema.fields}
    own = StructType.fromDDL(schema)
    out = StructType([StructField(g, types[g]) for g in group] + own.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = []
        for at, pieces in itertools.groupby(_cut_at_borders(batches, group), key=_ByObject):
            at = at.value
            key = tuple(None if pd.isna(k) else k for k in at[: len(keys)])
            held += [(*key, *at[len(keys) :], *row) for row in function(key, at[-2], at[-1], (rows for _, rows in pieces))]
            if len(held) >= _ROWS_AT_ONCE:
                yield pd.DataFrame(held, columns=out.names)
                held = []
        if held:
            yield pd.DataFrame(held, columns=out.names)

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = placed.repartition(parts, *keys, "window_start").sortWithinPartitions(*group, *order)
    return dealt.mapInPandas(run, out)


class _ByObject:
    """A piece's group: equal only to itself."""

    def __init__(self, piece: tuple):
        self.value = piece[0]

    def __eq__(self, other: object) -> bool:
        return isinstance(other, _ByObject) and self.value is other.value


def window_process(df: DataFrame, ts: str, size: str, keys: Sequence[str], order: Sequence[str], function: WindowFunction, schema: str) -> DataFrame:
    """A user function over all rows of each (key, window) in order, for what no merge of partial results can say.

    ``function(key, window_start, window_end, pieces)`` gets the rows as frames that follow each other, sorted by ``order``,
    and gives result tuples of ``schema``; key and bounds are put in front of them. The rows stream through: a window is
    sorted on disk if need be and never held, unless the function does. One window's rows are one task's work.
    """
    placed = df.withColumn("_w", F.window(ts, size)).withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")
    return window_rows(placed, keys, order, function, schema)


def minute_traffic(df: DataFrame, ts: str, domain: str, traffic: Column, size: str = "60 seconds") -> DataFrame:
    """Traffic per domain and window, labelled with the minute of the latest row: ``time, domain, traffics``."""
    summed = tumbling(df, ts, size, [domain], traffic.alias("traffics"), F.max(ts).alias("_last"))
    return summed.select(minute_label(F.col("_last")).alias("time"), F.col(domain).alias("domain"), "traffics")
