"""Sessions: runs of rows of one key with no pause, with a fixed or a per-row gap."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.slices import SLICE, SlicedOrder
from tidemill.session import written

_MERGE = {"sum": F.sum, "max": F.max, "min": F.min}


def _opened(rows: DataFrame, plan: SlicedOrder, ts: str, end: Column, touch_merges: bool) -> DataFrame:
    """Sliced rows plus ``_end`` and the start of their session as far as their own slice shows it (else null)."""
    rows = rows.withColumn("_end", end)
    reach = F.max("_end").over(plan.within().rowsBetween(Window.unboundedPreceding, -1))
    if plan.split:
        rows = plan.attach(rows, plan.earlier(rows, {"_reach": (F.max("_end"), "max")}))
        reach = F.greatest(reach, F.col("_reach"))
    rows = rows.withColumn("_so_far", reach)
    away = F.col(ts) > F.col("_so_far") if touch_merges else F.col(ts) >= F.col("_so_far")
    rows = rows.withColumn("_new", F.when(F.col("_so_far").isNull() | away, F.col(ts)))
    # Starts rise with the rows, so the latest start is the largest one.
    start = F.max("_new").over(plan.within().rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("_start", start)


def _carry_over(rows: DataFrame, plan: SlicedOrder) -> DataFrame:
    """Fill in the starts that lie in an earlier slice."""
    if not plan.split:
        return rows
    carried = plan.earlier(rows, {"_carried": (F.max("_start"), "max")})
    return plan.attach(rows, carried).withColumn("_start", F.coalesce("_start", "_carried"))


def label_sessions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap: Column,
    touch_merges: bool = False,
    name: str = "session_start",
) -> DataFrame:
    """``df`` plus the start time of each row's session.

    A row opens a session when it is at least its key's furthest ``ts + gap`` so far away. With ``touch_merges`` a row
    exactly at that point still belongs to the session (the rule of the built-in session window). ``gap`` is an interval.
    """
    plan = SlicedOrder(df, keys, [ts])
    rows = _opened(plan.add(df), plan, ts, F.col(ts) + gap, touch_merges)
    return _carry_over(rows, plan).select(*df.columns, F.col("_start").alias(name))


def session_totals(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap: Column,
    totals: dict[str, tuple[Column, str]],
    touch_merges: bool = False,
) -> DataFrame:
    """One row per session: keys, ``session_start``, ``session_end`` (last row plus its gap), and ``totals``.

    ``totals`` maps a name to (aggregate, how two partial results merge). The rows are read in order once; each slice is
    summed up to its own sessions right there, and only those are merged across slices.
    """
    merged = [_MERGE[how](n).alias(n) for n, (_, how) in totals.items()]
    summed = [agg.alias(n) for n, (agg, _) in totals.items()]
    end = F.col(ts) + gap
    plan = SlicedOrder(df, keys, [ts])
    if plan.has_heavy_ties:
        # Many rows at one instant cannot be cut apart by time: combine them first.
        df = df.groupBy(*keys, ts).agg(F.max(end).alias("_until"), *summed)
        df, end, summed = written(df, "instants"), F.col("_until"), merged
    opened = _opened(plan.add(df), plan, ts, end, touch_merges)
    pieces = opened.groupBy(*keys, SLICE, "_start").agg(F.max("_end").alias("_end"), *summed)
    if plan.split:
        pieces = _carry_over(written(pieces, "sessions"), plan)
        pieces = pieces.groupBy(*keys, "_start").agg(F.max("_end").alias("_end"), *merged)
    return pieces.select(
        *keys, F.col("_start").alias("session_start"), F.col("_end").alias("session_end"), *totals
    )
