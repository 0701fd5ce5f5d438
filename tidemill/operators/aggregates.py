"""Grouped aggregates beyond the built-in ones, row counters, and user functions with partial combining."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemill.operators.slices import join_on


# Partial results a task of ``combine_groups`` keeps before it reduces them or passes them on.
_HELD_ROWS = 50_000


def row_of_extreme(
    df: DataFrame, keys: Sequence[str], value: str, tie: str, largest: bool = True, row: Sequence[str] | None = None
) -> DataFrame:
    """Per key (or overall) the whole row with the largest or smallest value; among equals the one with least ``tie``.

    A ``tie`` that is no number takes a second pass: the rows with a key's largest value, and the least of these.
    """
    whole = F.struct(*(row or [c for c in df.columns if c not in keys]))
    numbers = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    if largest and not dict(df.dtypes)[tie].startswith(numbers):
        top = df.groupBy(*keys).agg(F.max(value).alias("_top"))
        marked = join_on(df, top, keys) if keys else df.join(F.broadcast(top))  # one row without keys
        best = F.min_by(whole, F.col(tie))
        found = marked.where(F.col(value) == F.col("_top")).groupBy(*keys).agg(best.alias("_row"))
        return found.where(F.col("_row").isNotNull()).select(*keys, "_row.*")
    if largest:
        best = F.max_by(whole, F.struct(F.col(value), -F.col(tie)))
    else:
        best = F.min_by(whole, F.struct(F.col(value), F.col(tie)))
    found = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(best.alias("_row"))
    return found.where(F.col("_row").isNotNull()).select(*keys, "_row.*")


def _joined(parts: list[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(parts, ignore_index=True)


def combine_groups(
    df: DataFrame, keys: Sequence[str], combine: Callable[[pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Reduce groups with a user function, first where the rows are and then per key, without holding a whole group.

    ``combine`` gets rows of many groups and returns fewer rows per group. It must accept its own results as input again
    and be associative (input and output share ``schema``). Rows reach it in batches; after the shuffle they are sorted by
    key and only the last group's result so far is carried from batch to batch.
    """

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(combine(batch))
            if sum(map(len, held)) > _HELD_ROWS:
                held = [combine(_joined(held))]
                if len(held[0]) > _HELD_ROWS // 2:
                    yield held.pop()
        if held:
            yield combine(_joined(held))

    def final(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        last = None
        for batch in batches:
            end = batch["_group"].iloc[-1]
            closed = batch["_group"] != end
            if last is not None and last != end:
                yield combine(_joined([*held, batch[closed].drop(columns="_group")]))
                held = []
            elif closed.any():
                yield combine(_joined([batch[closed].drop(columns="_group")]))
            held = [combine(_joined([*held, batch[~closed].drop(columns="_group")]))]
            last = end
        yield from held

    partial = df.mapInPandas(local, schema).withColumn("_group", F.xxhash64(*keys))
    return partial.repartition("_group").sortWithinPartitions("_group").mapInPandas(final, schema)


def counted(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """``df`` with a row counter beside the data flow, readable from the observation after the first action."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen


def approx_distinct(df: DataFrame, keys: Sequence[str], item: str, name: str, error: float = 0.02) -> DataFrame:
    """Distinct items per group from a small fixed-size sketch."""
    return df.groupBy(*keys).agg(F.approx_count_distinct(item, error).alias(name))


def distinct_count(df: DataFrame, keys: Sequence[str], item: str, name: str) -> DataFrame:
    """Exact distinct items per group: duplicates go in a first, evenly spread round, then plain counts."""
    pairs = df.where(F.col(item).isNotNull()).select(*keys, item).distinct()
    return pairs.groupBy(*keys).agg(F.count("*").alias(name))


def filtered_max(df: DataFrame, keep: Column | str, key: str, value: str, name: str) -> DataFrame:
    """The largest value per key among the rows kept."""
    return df.where(keep).groupBy(key).agg(F.max(value).alias(name))
