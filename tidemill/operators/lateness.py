"""Event time against arrival order: which rows come too late for their window, and what refires.

Deterministic per-row rule. Before a row arrives the watermark is the largest event time so far minus the delay; it never
moves back. For the row's window ``[start, end)``:

* ``on_time``: the watermark has not reached ``end``;
* ``late_refire``: it has, but not ``end + lateness``: the window fires again with all rows so far;
* ``dropped``: anything later, kept as a side output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.running import Running, running
from tidemill.session import written


def classify_arrivals(
    df: DataFrame, ts: str, arrival: Sequence[str], size_s: int, delay_s: int, lateness_s: int, high_before: int | None = None
) -> DataFrame:
    """Add ``window_start``, ``window_end`` (epoch seconds) and ``arrival_class``; all rows share one watermark.

    ``high_before``: the largest event time, in microseconds, of what arrived before ``df``.
    """
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    seen = running(df.withColumn("_at", at), [], arrival, [Running("_high", "max", F.col("_at"), inclusive=False)])
    start = F.timestamp_micros(F.col("_at") - F.pmod(F.col("_at"), F.lit(size_s * 1_000_000)))
    if high_before is not None:
        seen = seen.withColumn("_high", F.greatest("_high", F.lit(high_before)))
    mark = F.col("_high") - F.lit(delay_s * 1_000_000)
    end = (F.col("window_start") + size_s) * 1_000_000
    verdict = (
        F.when(F.col("_high").isNull() | (mark < end), "on_time")
        .when(mark < end + lateness_s * 1_000_000, "late_refire")
        .otherwise("dropped")
    )
    placed = seen.withColumn("window_start", F.unix_seconds(start))
    return placed.select(
        *df.columns, "window_start", (F.col("window_start") + size_s).alias("window_end"), verdict.alias("arrival_class")
    )


def split_arrivals(classified: DataFrame) -> dict[str, DataFrame]:
    """The three streams: on time, refiring, and the late side output."""
    return {c: classified.where(F.col("arrival_class") == c) for c in ("on_time", "late_refire", "dropped")}


def firing_log(classified: DataFrame, ts: str, keys: Sequence[str], arrival: Sequence[str], value: Column, delay_s: int) -> DataFrame:
    """Every firing of every (key, window): the first with all on-time rows, then one per late row within the allowance.

    Columns: keys, ``window_start``, ``window_end``, ``firing`` (0 for the first), ``n`` and ``total`` so far. A window whose
    end the final watermark has not reached has not fired.
    """
    group = [*keys, "window_start", "window_end"]
    valued = written(
        classified.select(*dict.fromkeys([*group, *arrival, ts, "arrival_class"]), value.alias("_v")), "classified"
    )  # read by the first firings, the refirings and the final watermark
    final = valued.agg(
        (F.max(F.unix_micros(F.col(ts).cast("timestamp"))) - F.lit(delay_s * 1_000_000)).alias("_final")
    )
    first = (
        valued.where(F.col("arrival_class") == "on_time")
        .groupBy(*group)
        .agg(F.count("*").alias("n"), F.sum("_v").alias("total"))
        .join(F.broadcast(final), F.col("window_end") * 1_000_000 <= F.col("_final"))  # one row
        .select(*group, F.lit(0).cast("long").alias("firing"), "n", "total")
    )
    late = running(
        valued.where(F.col("arrival_class") == "late_refire"),
        group,
        arrival,
        [Running("_late_n", "count"), Running("_late_total", "sum", F.col("_v"))],
    )
    base = first.select(*[F.col(c).alias(f"_g_{c}") for c in group], F.col("n").alias("_n"), F.col("total").alias("_t"))
    on = [F.col(f"_g_{c}").eqNullSafe(F.col(c)) for c in group]
    refired = late.join(base, on, "left").select(
        *group,
        F.col("_late_n").alias("firing"),
        (F.coalesce(F.col("_n"), F.lit(0)) + F.col("_late_n")).alias("n"),
        (F.coalesce(F.col("_t"), F.lit(0)) + F.col("_late_total")).alias("total"),
    )
    return first.unionByName(refired)
