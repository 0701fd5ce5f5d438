"""Keyed targets: documents and cells where the last write wins, and lists that grow at the front."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.running import Running, number_rows, running
from tidemill.sources.tables import fold_cells
from tidemill.streaming.runs import BATCH, all_versions, current_rows, update_files


def last_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The last written row of each key; combined early, so a key written often costs little."""
    values = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_row")).select(*keys, "_row.*")


def merge_by_key(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target after an upsert: rows whose key is not written, plus the written rows (one per key)."""
    untouched = target.join(changes.select(*keys), list(keys), "left_anti")
    return untouched.unionByName(changes.select(*target.columns))


def document_id(time: Column, domain: Column) -> Column:
    return F.concat_ws("-", time, domain)


def put_cells(writes: DataFrame, rowkey: str, qualifier: Column, value: Column, order: str, family: str = "info") -> DataFrame:
    """The wide-column table after a series of puts: ``rowkey, family, qualifier, value``."""
    cells = writes.select(
        F.col(rowkey).alias("rowkey"),
        F.lit(family).alias("family"),
        qualifier.alias("qualifier"),
        value.alias("value"),
        F.col(order).alias("_order"),
    )
    return last_per_key(cells, ["rowkey", "family", "qualifier"], F.col("_order")).drop("_order")


# What a copied row's value gets appended, and the column it is put in.
COPY_MARK = "test"
COPY_COLUMN = "n1"


def copied_lines(cells: DataFrame, family: str = "info") -> DataFrame:
    """Each row of a wide-column table as the line ``key + mark, tab, folded value``."""
    folded = fold_cells(cells, family)
    return folded.select(F.concat("rowkey", F.lit(COPY_MARK), F.lit("\t"), "value").alias("line"))


def lines_to_cells(lines: DataFrame, line: str = "line", order: Column | None = None) -> DataFrame:
    """Put ``key, tab, value`` lines into one column of the row."""
    parts = F.split(F.col(line), "\t", 2)
    split = lines.select(
        parts[0].alias("rowkey"), parts[1].alias("v"), (order if order is not None else F.lit(0)).alias("_seq")
    )
    return put_cells(split, "rowkey", F.lit(COPY_COLUMN), F.col("v"), "_seq")


def push_front(df: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """The lists after pushing each value at the front of its key's list, as rows ``key, pos, value``.

    ``pos`` 1 is the front. Lists stay rows: a list that holds a third of all values never becomes one value.
    """
    descending = df.withColumn("_back", -F.col(order))
    placed = running(descending, [key], ["_back"], [Running("pos", "count")])
    return placed.select(key, "pos", F.col(value).alias("value"))


def push_batch(stored: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Stored lists after a batch of lists (both ``key, pos, value``) is pushed in front of them."""
    grown = batch.groupBy(key).agg(F.count("*").alias("_n"))
    moved = stored.join(grown, key, "left").withColumn("pos", F.col("pos") + F.coalesce("_n", F.lit(0))).drop("_n")
    return batch.select(*stored.columns).unionByName(moved.select(*stored.columns))


@dataclass(frozen=True)
class KeyedTable:
    """A table on files where the last write of a key wins. A batch adds its rows as a version of their keys; a batch that
    comes again replaces itself, and readers take the newest version (``compact_updates`` drops the older ones)."""

    path: str
    keys: tuple[str, ...]

    def upsert(self, stream: DataFrame, checkpoint: str, shared: bool = False) -> None:
        """Write everything a stream has. Rows of one key within a batch must be combined before."""
        update_files(stream, self.path, checkpoint, shared)

    def rows(self, spark: SparkSession) -> DataFrame:
        return current_rows(spark, self.path, self.keys)


@dataclass(frozen=True)
class ListTable:
    """Lists on files that grow at the front. Batches are kept as they came; positions are worked out on reading."""

    path: str
    key: str
    order: str

    def push(self, stream: DataFrame, checkpoint: str) -> None:
        """Push everything a stream has: batches in their order, the rows of one by ``order`` (a whole number)."""
        update_files(stream, self.path, checkpoint)

    def rows(self, spark: SparkSession) -> DataFrame:
        """The pushed rows with ``pos``, 1 at the front."""
        pushed = all_versions(spark, self.path).withColumns({"_b": -F.col(BATCH), "_o": -F.col(self.order)})
        columns = [c for c in pushed.columns if c not in ("query_id", BATCH, "_b", "_o")]
        return number_rows(pushed, [self.key], ["_b", "_o"], "pos").select(*columns, "pos")
