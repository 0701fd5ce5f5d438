"""Ordered passes that never put a whole key, or a whole table, into one task.

A running total, a row number or "the maximum so far" needs its rows in order. A plain window does that with
one task per key, which fails when one key holds a third of the rows or when there is no key at all. Here the
order axis is cut into slices of similar row counts. Rows of a heavy key are windowed per (key, slice); what the
earlier slices contribute is a small per-slice total, summed up over the slices and joined back.

The cuts and the choice of heavy keys only decide how work is spread: any of them give the same rows and values. So a
``SlicedOrder`` may be planned on one DataFrame and used on another with the same keys and order.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

SLICE = "_slice"
WHOLE_KEY = -1

ROWS_PER_SLICE = "spark.tidemill.rowsPerSlice"
DEFAULT_ROWS_PER_SLICE = 250_000
# Cut points and heavy keys are held as literals in the plan, so their number is bounded. Beyond the bound slices
# grow in rows; the windows over them sort and spill.
MAX_SLICES = 8192
_SAMPLED_PER_SLICE = 200
BROADCAST_VALUES = 500_000


def rows_per_slice(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(ROWS_PER_SLICE, str(DEFAULT_ROWS_PER_SLICE)))


def slice_count(df: DataFrame, rows: int) -> int:
    """Slices for ``rows`` rows, at most MAX_SLICES: a table within one slice takes the plain window, which is cheaper."""
    return max(1, min(math.ceil(rows / rows_per_slice(df)), MAX_SLICES))


def join_on(left: DataFrame, right: DataFrame, names: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join that keeps one copy of the key columns."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in names})
    on = reduce(lambda a, b: a & b, [left[n].eqNullSafe(renamed[f"_r_{n}"]) for n in names])
    return left.join(renamed, on, how).drop(*[f"_r_{n}" for n in names])


def ascending(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order]


@dataclass(frozen=True)
class _Axis:
    """An order column as numbers that never go against its order.

    ``position`` may give different values the same number (rounded longs, the first bytes of a text). ``finer`` tells
    those apart: it orders the values of one position, and where ``exact`` a zero means one single value.
    """

    position: Column
    finer: Column | None = None
    exact: bool = False


_TEXT_BYTES = 6  # of a text per number: 48 bits are exact in a double


def _text_axis(column: str, df: DataFrame) -> _Axis:
    """By the bytes after those that all texts of ``df`` begin with. Texts outside its range come before or after them all."""
    ends = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if ends["lo"] is None:
        return _Axis(F.lit(None).cast("double"))
    lo, hi = ends["lo"].encode(), ends["hi"].encode()
    skip = next((i for i, (x, y) in enumerate(zip(lo, hi, strict=False)) if x != y), min(len(lo), len(hi)))

    def number(start: int) -> Column:
        # a text that ends earlier comes before all longer ones
        digits = F.substring(F.hex(F.encode(column, "UTF-8")), 2 * start + 1, 2 * _TEXT_BYTES)
        return F.conv(F.rpad(digits, 2 * _TEXT_BYTES, "0"), 16, 10).cast("double")

    value = F.col(column)
    below, above = value < F.lit(ends["lo"]), value > F.lit(ends["hi"])
    position = F.when(below, -1.0).when(above, 2.0 ** (8 * _TEXT_BYTES)).otherwise(number(skip))
    return _Axis(position, F.when(below | above, 0.0).otherwise(number(skip + _TEXT_BYTES)))


def _axis(column: str, df: DataFrame) -> _Axis:
    kind = df.schema[column].dataType.simpleString()
    value = F.col(column)
    if kind in ("timestamp", "timestamp_ntz", "bigint"):
        whole = value if kind == "bigint" else F.unix_micros(value.cast("timestamp"))
        rounded = whole.cast("double")
        # the part that a double cannot hold, in decimals so that it cannot overflow
        return _Axis(rounded, (whole.cast("decimal(38,0)") - rounded.cast("decimal(38,0)")).cast("double"), True)
    if kind.startswith("decimal"):
        return _Axis(value.cast("double"))
    if kind in ("tinyint", "smallint", "int", "float", "double", "boolean"):
        number = (value.cast("int") if kind == "boolean" else value).cast("double")
        return _Axis(number, F.lit(0.0), True)
    if kind == "date":
        return _Axis(F.unix_date(value).cast("double"), F.lit(0.0), True)
    if kind == "string":
        return _text_axis(column, df)
    # no number keeps the order of such a type: its rows stay in one slice
    return _Axis(F.when(value.isNotNull(), F.lit(0.0)))


def _bucket(df: DataFrame, source: str, target: str, cuts: Sequence[float]) -> DataFrame:
    splits = [-math.inf, *cuts, math.inf]
    if len(splits) < 3:
        return df.withColumn(target, F.lit(0))
    cut = Bucketizer(inputCol=source, outputCol=target, splits=splits, handleInvalid="keep")
    # rows without a position come last, as in the order itself
    return cut.transform(df).withColumn(target, F.coalesce(F.col(target).cast("int"), F.lit(len(splits))))


@dataclass(frozen=True)
class _Cuts:
    first: list[float]
    tied: list[float]
    second: list[float]
    heavy_ties: bool = False


@dataclass(frozen=True)
class _Inside:
    """What orders the rows of one position further: ``side`` (negative, zero, positive), then ``place`` where it is zero."""

    side: Column
    place: Column | None


def _inside(axes: Sequence[_Axis]) -> _Inside:
    first = axes[0]
    if first.exact:  # zero means one value, so the next column decides
        return _Inside(first.finer, axes[1].position if len(axes) > 1 else None)
    return _Inside(F.lit(0.0), first.finer)


def _find_cuts(df: DataFrame, axes: Sequence[_Axis], n: int, rows: int) -> _Cuts:
    """About ``n`` cut points on the first order column, and inside positions that many rows share."""
    fraction = min(1.0, _SAMPLED_PER_SLICE * n / max(rows, 1))
    inside = _inside(axes)
    place = [] if inside.place is None else [inside.place.alias("b")]
    sampled = df.select(axes[0].position.alias("a"), inside.side.alias("side"), *place)
    if fraction < 1.0:
        sampled = sampled.sample(fraction, seed=7)
    steps = [i / n for i in range(1, n)]
    if not steps:
        return _Cuts([], [], [])
    found = sampled.agg(F.percentile_approx("a", steps, 10 * n).alias("q")).first()["q"] or []
    values, counts = np.unique(np.array(found, dtype="float64"), return_counts=True)
    heavy = bool((counts > 1).any())
    tied = [float(v) for v in values[counts > 1]] if place else []
    if not tied:
        return _Cuts([float(v) for v in values], [], [], heavy)
    # A tied value gets a slice range of its own, cut further by what comes next: one cut per slice's worth of rows.
    first = sorted({*map(float, values), *(float(np.nextafter(v, math.inf)) for v in tied)})
    per_slice = max(1, int(min(rows, _SAMPLED_PER_SLICE * n) / n))
    numbered = sampled.where(F.col("a").isin(tied) & (F.col("side") == 0) & F.col("b").isNotNull()).withColumn(
        "rn", F.row_number().over(Window.partitionBy("a").orderBy("b"))
    )
    inner = numbered.where(F.col("rn") % per_slice == 0).select("b").distinct().collect()  # about n values at most
    return _Cuts(first, tied, sorted(float(r["b"]) for r in inner), heavy)


class SlicedOrder:
    """How the rows of ``df``, keyed by ``keys`` and ordered by ``order``, are spread over tasks."""

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str]):
        self.keys, self.order = list(keys), list(order)
        self.heavy: DataFrame | None = None
        if not self.keys:
            rows = df.count()
            n = slice_count(df, rows)
            self.split = n > 1
        else:
            rows, largest = self._largest_keys(df)
            n = slice_count(df, rows)
            # Keys that one slice could not hold: fewer than there are slices.
            heavy = largest.filter(pc.field("_n") > max(rows_per_slice(df), rows / MAX_SLICES)).drop_columns(["_n"])
            self.split = n > 1 and heavy.num_rows > 0
            if self.split:
                self.heavy = df.sparkSession.createDataFrame(heavy, df.select(*self.keys).schema)
                self.heavy_keys = heavy.num_rows
        self._axes = [_axis(c, df) for c in self.order[:2]] if self.split else []
        self._cuts = _find_cuts(df, self._axes, n, rows) if self.split else None

    def _largest_keys(self, df: DataFrame) -> tuple[int, pa.Table]:
        """Row count of the table and, in the same pass, the MAX_SLICES keys with most rows."""
        total = Observation()
        per_key = df.groupBy(*self.keys).agg(F.count("*").alias("_n")).observe(total, F.sum("_n").alias("rows"))
        largest = per_key.orderBy(F.col("_n").desc()).limit(MAX_SLICES).toArrow()
        return (total.get["rows"] or 0) if largest.num_rows else 0, largest

    @property
    def has_heavy_ties(self) -> bool:
        """Whether some value of the first order column holds about a slice of rows by itself."""
        return self.split and self._cuts.heavy_ties

    def add(self, df: DataFrame) -> DataFrame:
        """``df`` with its slice number; rows of keys that are not heavy share one slice per key."""
        if not self.split:
            return df.withColumn(SLICE, F.lit(WHOLE_KEY))
        cuts = self._cuts
        out = _bucket(df.withColumn("_pos", self._axes[0].position), "_pos", SLICE, cuts.first)
        if cuts.tied:
            inside = _inside(self._axes)
            out = _bucket(out.withColumns({"_pos2": inside.place, "_side": inside.side}), "_pos2", "_sub", cuts.second)
            last = len(cuts.second) + 4
            placed = F.when(F.col("_side") < 0, 0).when(F.col("_side") > 0, last).otherwise(F.col("_sub") + 1)
            within = F.when(F.col("_pos").isin(cuts.tied), placed).otherwise(F.lit(0))
            out = out.withColumn(SLICE, F.col(SLICE) * F.lit(last + 1) + within).drop("_pos2", "_side", "_sub")
        out = out.drop("_pos")
        if self.heavy is not None:
            marked = F.broadcast(self.heavy.withColumn("_heavy", F.lit(True)))
            out = join_on(out, marked, self.keys)
            out = out.withColumn(SLICE, F.when(F.col("_heavy"), F.col(SLICE)).otherwise(F.lit(WHOLE_KEY))).drop("_heavy")
        return out

    def within(self):
        """Window over one key's slice, in order."""
        return Window.partitionBy(*self.keys, SLICE).orderBy(*ascending(self.order))

    def over_slices(self):
        """Window over the per-slice totals of one key: at most one row per slice."""
        return Window.partitionBy(*(self.keys or [F.lit(0)])).orderBy(SLICE)

    def earlier(self, sliced: DataFrame, totals: dict[str, tuple[Column, str]]) -> DataFrame:
        """Per (key, slice), the totals of all earlier slices. ``totals``: name -> (aggregate, "sum"|"max"|"min")."""
        heavy = sliced.where(F.col(SLICE) != WHOLE_KEY) if self.keys else sliced
        per_slice = heavy.groupBy(*self.keys, SLICE).agg(*[agg.alias(name) for name, (agg, _) in totals.items()])
        before = self.over_slices().rowsBetween(Window.unboundedPreceding, -1)
        merge = {"sum": F.sum, "max": F.max, "min": F.min}
        return per_slice.select(
            *self.keys, SLICE, *[merge[how](name).over(before).alias(name) for name, (_, how) in totals.items()]
        )

    def attach(self, sliced: DataFrame, small: DataFrame) -> DataFrame:
        """Join values per (key, slice) of heavy keys to the rows.

        Their number is bounded by heavy keys times slices. Within BROADCAST_VALUES they are broadcast, so that the rows
        are shuffled once, for the window; beyond it this is a shuffle join.
        """
        keys = self.heavy_keys if self.keys else 1
        values = keys * (len(self._cuts.first) + 2 + len(self._cuts.tied) * (len(self._cuts.second) + 1))
        return join_on(sliced, F.broadcast(small) if values <= BROADCAST_VALUES else small, [*self.keys, SLICE])
