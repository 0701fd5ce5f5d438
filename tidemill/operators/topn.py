"""First n and top n. Spark keeps at most n rows per group and task before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.windows import sliding, sliding_panes

# Up to so many windows per row, copying rows and combining them before the one shuffle is cheaper than panes.
MAX_COPIES = 12


def first_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*order).limit(n)


def first_n_per_group(df: DataFrame, keys: Sequence[str], n: int, *order: Column, rank: str | None = None) -> DataFrame:
    """The first n rows of each group; give ``order`` a unique last column."""
    numbered = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = numbered.where(F.col("_rank") <= n)
    return kept.withColumnRenamed("_rank", rank) if rank else kept.drop("_rank")


def hot_items(
    clicks: DataFrame, ts: str, item: str, n: int, size_s: int = 30, slide_s: int = 10, group: Sequence[str] = ()
) -> DataFrame:
    """Each ``slide_s`` seconds the n items with most clicks in the last ``size_s`` seconds, overall or per group."""
    keys = [*group, item]
    if size_s <= MAX_COPIES * slide_s:
        counts = sliding(clicks, ts, f"{size_s} seconds", f"{slide_s} seconds", keys, F.count("*").alias("clicks"))
    else:
        counts = sliding_panes(clicks, ts, size_s, slide_s, keys, {"clicks": ("count", F.lit(1))})
    order = (F.col("clicks").desc(), F.col(item).asc())
    return first_n_per_group(counts, ["window_start", "window_end", *group], n, *order, rank="rank")
