"""Relational and wide-column table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_options(
    url: str,
    table: str,
    split_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int | None = None,
    fetch_size: int = 10_000,
    **extra: str,
) -> dict[str, str]:
    """Options of a relational scan; with a split column the ranges are read in parallel."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), "pushDownPredicate": "true", **extra}
    if split_column is not None:
        if None in (lower, upper, partitions):
            raise ValueError("a split column needs lower, upper and partitions")
        options |= {
            "partitionColumn": split_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


CELLS = "rowkey string, family string, qualifier string, value string"


def fold_cells(cells: DataFrame, family: str = "info", separator: str = "_") -> DataFrame:
    """Per row key, all values of a family joined in qualifier order: ``rowkey, value``.

    The result holds a whole row's cells in one text value, so a row's cells meet in one task by nature.
    """
    in_family = cells.where((F.col("family") == family) & F.col("value").isNotNull())
    folded = F.sort_array(F.collect_list(F.struct("qualifier", "value")))
    return in_family.groupBy("rowkey").agg(
        F.array_join(F.transform(folded, lambda c: c["value"]), separator).alias("value")
    )
