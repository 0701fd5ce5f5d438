"""How rows are laid out over partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def even_parts(df: DataFrame, partitions: int) -> DataFrame:
    """Deal rows evenly over partitions, whatever their keys."""
    return df.repartition(partitions)


def hash_parts(df: DataFrame, partitions: int, *keys: str) -> DataFrame:
    """Equal keys share a partition. A heavy key makes a heavy partition; see ``salted_parts``."""
    return df.repartition(partitions, *keys)


def row_salt(df: DataFrame, salts: int) -> Column:
    """A number below ``salts`` per row. It depends on the row and its partition only, so a task that runs again gives the
    same numbers, and copies of one row in different partitions are spread.
    """
    return F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(salts))


def salted_parts(df: DataFrame, partitions: int, salts: int, *keys: str) -> DataFrame:
    """Like ``hash_parts`` but each key is spread over up to ``salts`` partitions."""
    salted = df.withColumn("_salt", row_salt(df, salts))
    return salted.repartition(partitions, *keys, "_salt").drop("_salt")


def range_parts(df: DataFrame, partitions: int, *order: str) -> DataFrame:
    """Near keys share a partition; more order columns split heavy values."""
    return df.repartitionByRange(partitions, *order)


def sort_in_parts(df: DataFrame, *order: Column | str) -> DataFrame:
    """Sort inside each partition, without a shuffle."""
    return df.sortWithinPartitions(*order)


def with_partition(df: DataFrame, name: str = "partition") -> DataFrame:
    """Tag each row with the number of its partition."""
    return df.withColumn(name, F.spark_partition_id())


def rows_by_partition(tagged: DataFrame, *extra: Column, name: str = "partition") -> DataFrame:
    """Rows handled per partition, and further aggregates, of rows tagged by ``with_partition``."""
    return tagged.groupBy(name).agg(F.count("*").alias("n"), *extra)


def salted_totals(df: DataFrame, keys: Sequence[str], salts: int, sums: dict[str, Column]) -> DataFrame:
    """Sums per key in two steps, for inputs whose map-side combining does little (many keys per task, one of them heavy)."""
    salted = df.withColumn("_salt", row_salt(df, salts))
    halfway = salted.groupBy(*keys, "_salt").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return halfway.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums])
