"""Running values per key in row order: totals, numbers, extremes, change logs, running distinct counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.slices import SlicedOrder


@dataclass(frozen=True)
class Running:
    """One running value. ``how`` is sum, count, max or min; ``inclusive`` counts the current row in."""

    name: str
    how: str
    value: Column | None = None
    inclusive: bool = True


_AGG = {"sum": F.sum, "count": F.count, "max": F.max, "min": F.min}


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Sequence[Running],
    plan: SlicedOrder | None = None,
) -> DataFrame:
    """``df`` plus one running column per measure. ``order`` must be unique per key for a definite answer.

    ``plan`` reuses slices planned before, on this or a similar DataFrame.
    """
    plan = plan or SlicedOrder(df, keys, order)
    inputs = {f"_in{i}": (m.value if m.value is not None else F.lit(1)) for i, m in enumerate(measures)}
    rows = plan.add(df.withColumns(inputs))
    if plan.split:
        totals = {
            f"_before{i}": (_AGG[m.how](f"_in{i}"), "sum" if m.how == "count" else m.how)
            for i, m in enumerate(measures)
        }
        rows = plan.attach(rows, plan.earlier(rows, totals))
    ends = [Window.currentRow if m.inclusive else -1 for m in measures]
    local = {
        f"_local{i}": _AGG[m.how](f"_in{i}").over(plan.within().rowsBetween(Window.unboundedPreceding, ends[i]))
        for i, m in enumerate(measures)
    }
    rows = rows.withColumns(local)
    out = {
        m.name: _combine(m.how, F.col(f"_local{i}"), F.col(f"_before{i}")) if plan.split else F.col(f"_local{i}")
        for i, m in enumerate(measures)
    }
    kept = [c for c in df.columns if c not in out]
    return rows.select(*kept, *[c.alias(n) for n, c in out.items()])


def _combine(how: str, local: Column, before: Column) -> Column:
    if how == "count":
        return F.coalesce(local, F.lit(0)) + F.coalesce(before, F.lit(0))
    if how == "sum":
        return F.coalesce(local + before, local, before)
    return F.greatest(local, before) if how == "max" else F.least(local, before)


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """1, 2, 3, ... per key in order."""
    return running(df, keys, order, [Running(name, "count")])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """Each row carries its key's total so far."""
    return running(df, keys, order, [Running(name, "sum", value)])


def change_log(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    plan: SlicedOrder | None = None,
) -> DataFrame:
    """Each update of a key's total as a retraction of the old total and an addition of the new one.

    ``op`` is false for the retracted and true for the added value; a key's first row only adds.
    """
    totals = running(
        df.withColumn("_v", value),
        keys,
        order,
        [Running("_total", "sum", F.col("_v")), Running("_n", "count")],
        plan,
    )
    old = F.when(F.col("_n") > 1, F.struct(F.lit(False).alias("op"), (F.col("_total") - F.col("_v")).alias(name)))
    new = F.struct(F.lit(True).alias("op"), F.col("_total").alias(name))
    changes = totals.withColumn("_c", F.explode(F.array_compact(F.array(old, new))))
    return changes.select(*df.columns, "_c.*")


def running_distinct(
    df: DataFrame, group: Sequence[str], item: str, order: str, name: str = "n_distinct"
) -> DataFrame:
    """Each row carries how many distinct ``item`` its group has seen so far (a null item counts as none).

    First sightings are found by a partial-aggregating ``min(order)``, not by ranking each (group, item), and enter the
    running sum as marker rows placed just before the row they belong to. ``order`` must be unique in a group.
    """
    seen = df.where(F.col(item).isNotNull()).groupBy(*group, item).agg(F.min(order).alias(order))
    markers = seen.select(*group, order, F.lit(0).alias("_row"), F.lit(1).alias("_first"))
    rows = df.withColumns({"_row": F.lit(1), "_first": F.lit(0)})
    both = rows.unionByName(markers, allowMissingColumns=True)
    plan = SlicedOrder(rows, group, [order, "_row"])
    counted = running(both, group, [order, "_row"], [Running(name, "sum", F.col("_first"))], plan)
    return counted.where(F.col("_row") == 1).drop("_row", "_first")
