"""All-or-nothing batches: staged rows become visible when their batch is entered in a ledger.

A batch is known by its query and its number. It is written under both, then one ledger entry commits it. A failure before
the entry leaves nothing visible; a batch that comes again overwrites its own staging, and is skipped once committed.
Readers see committed batches only. Several queries share a ledger only if it says so.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.streaming.runs import BATCH, QUERY, for_each_batch, query_id, read_or_none, refuse_foreign

_ENTRY = f"{QUERY} string, {BATCH} long, n long"


@dataclass(frozen=True)
class Ledger:
    path: str
    shared: bool = False

    def committed(self, spark: SparkSession) -> DataFrame:
        """The committed batches: ``query_id, batch_id, n``."""
        found = read_or_none(lambda: spark.read.schema(_ENTRY).json(f"{self.path}/ledger"))
        return spark.createDataFrame([], _ENTRY) if found is None else found

    def _staging(self, query: str, batch_id: int) -> str:
        return f"{self.path}/rows/{QUERY}={query}/{BATCH}={batch_id}"

    def stage(self, batch: DataFrame, batch_id: int, query: str) -> None:
        batch.write.mode("overwrite").parquet(self._staging(query, batch_id))

    def commit(self, spark: SparkSession, batch_id: int, query: str) -> None:
        n = spark.read.parquet(self._staging(query, batch_id)).agg(F.count("*").alias("n"))
        entry = n.select(F.lit(query).alias(QUERY), F.lit(batch_id).cast("long").alias(BATCH), "n")
        entry.write.mode("append").json(f"{self.path}/ledger")

    def write(self, batch: DataFrame, batch_id: int, query: str, before_commit: Callable[[int], None] | None = None) -> None:
        """Write one batch of ``query``; ``before_commit`` lets a test fail between the two phases."""
        spark = batch.sparkSession
        known = self.committed(spark)
        if not self.shared:
            refuse_foreign(known, query, self.path)
        if known.where((F.col(QUERY) == query) & (F.col(BATCH) == batch_id)).head(1):
            return
        self.stage(batch, batch_id, query)
        if before_commit:
            before_commit(batch_id)
        self.commit(spark, batch_id, query)

    def rows(self, spark: SparkSession) -> DataFrame:
        """Rows of committed batches, with ``query_id`` and ``batch_id``; other batches' folders are pruned."""
        staged = spark.read.parquet(f"{self.path}/rows")
        staged = staged.withColumns({QUERY: F.col(QUERY).cast("string"), BATCH: F.col(BATCH).cast("long")})
        return staged.join(self.committed(spark).select(QUERY, BATCH).distinct(), [QUERY, BATCH], "left_semi")

    def drain(self, stream: DataFrame, checkpoint: str) -> None:
        """Write everything a stream has, batch by batch, as the query that owns the checkpoint."""
        query = query_id(stream.sparkSession, checkpoint)
        for_each_batch(stream, lambda batch, batch_id: self.write(batch, batch_id, query), checkpoint, "append")

    def compact(self, spark: SparkSession, path: str) -> Ledger:
        """A ledger in a new place with the committed rows, and its entries in one file."""
        self.rows(spark).write.partitionBy(QUERY, BATCH).parquet(f"{path}/rows")
        self.committed(spark).coalesce(1).write.json(f"{path}/ledger")
        return Ledger(path, self.shared)
