"""Equi-joins, lookups and the cross product.

No side is hinted without a check: the planner's size estimate and AQE's measured size choose between broadcast and
shuffle join, and AQE splits heavy keys. ``broadcast_if_small`` is for the places that need the hint; it counts first.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.layout import row_salt

BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that the side is small; a larger side is left to a shuffle join."""
    return F.broadcast(df) if df.count() <= max_rows else df


def _on(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[a] == right[b] for a, b in keys])


def inner_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], out: Sequence[Column]) -> DataFrame:
    """Rows with equal keys, shaped by ``out``."""
    return left.join(right, _on(left, right, keys), "inner").select(*out)


def pair_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows with equal keys as a pair of whole rows: ``left``, ``right``."""
    pair = [F.struct(*[df[c] for c in df.columns]).alias(n) for n, df in (("left", left), ("right", right))]
    return left.join(right, _on(left, right, keys), "inner").select(*pair)


def left_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], out: Sequence[Column]) -> DataFrame:
    """All left rows; ``out`` fills in for a missing right side."""
    return left.join(right, _on(left, right, keys), "left").select(*out)


def right_join(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], out: Sequence[Column]) -> DataFrame:
    """All right rows; ``out`` fills in for a missing left side."""
    return left.join(right, _on(left, right, keys), "right").select(*out)


def full_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[tuple[str, str]],
    out: Sequence[Column],
    right_only: Sequence[Column],
) -> DataFrame:
    """All rows of both sides; ``right_only`` shapes right rows without a partner (it may use right columns only).

    Built as a left join plus an anti join, because AQE can split a heavy key in those two and not in a full join.
    """
    both = left.join(right, _on(left, right, keys), "left").select(*out)
    known = left.select(*[left[a].alias(f"_k{i}") for i, (a, _) in enumerate(keys)]).distinct()
    on = reduce(lambda a, b: a & b, [right[b] == known[f"_k{i}"] for i, (_, b) in enumerate(keys)])
    return both.unionByName(right.join(known, on, "left_anti").select(*right_only))


def cross_product(left: DataFrame, right: DataFrame, blocks: int | None = None) -> DataFrame:
    """Every left row with every right row.

    A right side counted small is broadcast. Otherwise left rows are dealt to blocks and right rows copied to each block,
    so the work is an evenly spread equi-join on the block number. There are twice as many blocks as shuffle partitions or
    cores, whichever are more.
    """
    if blocks is None:
        spark = left.sparkSession
        blocks = 2 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    small = broadcast_if_small(right, 10_000)
    if small is not right:
        return left.join(small)
    dealt = left.withColumn("_block", row_salt(left, blocks))
    copied = right.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn(
        "_block", F.col("_block").cast("long")
    )
    return dealt.join(copied, "_block").drop("_block")


def lookup(
    data: DataFrame,
    dimension: DataFrame,
    keys: Sequence[tuple[str, str]],
    values: Mapping[str, Column | None],
) -> DataFrame:
    """``data`` plus columns of a dimension with unique keys; ``values`` maps a column to its default (None: null)."""
    wanted = dimension.select(
        *[F.col(b).alias(f"_k{i}") for i, (_, b) in enumerate(keys)], *[F.col(v).alias(f"_v_{v}") for v in values]
    )
    on = reduce(lambda a, b: a & b, [data[a] == F.col(f"_k{i}") for i, (a, _) in enumerate(keys)])
    found = data.join(wanted, on, "left")
    filled = [
        (F.col(f"_v_{v}") if default is None else F.coalesce(F.col(f"_v_{v}"), default)).alias(v)
        for v, default in values.items()
    ]
    return found.select(*[data[c] for c in data.columns], *filled)
