"""Running a streaming query over what has arrived, and tables it appends to or keeps up to date.

State and progress live under the checkpoint folder. A query started again with the same checkpoint goes on where it
stopped: no row is lost and none counts twice.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemill.session import use_rocksdb

_EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"

BATCH = "batch_id"
QUERY = "query_id"


class ForeignTarget(RuntimeError):
    """A target holds batches of another query, and was not declared to be shared."""


def read_or_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """What ``read`` gives, or None where its path does not exist yet; any other error is an error."""
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity of the query that owns a checkpoint: made on first use and kept beside it.

    Batch numbers start again with every checkpoint, so a batch is known by both. Later ids sort after earlier ones.
    """
    path = f"{checkpoint.rstrip('/')}-{QUERY}"
    known = read_or_none(lambda: spark.read.text(path))
    if known is None:
        made = f"{time.time_ns() // 1_000_000:013d}-{uuid.uuid4().hex[:12]}"
        spark.createDataFrame([(made,)], "value string").coalesce(1).write.text(path)
        known = spark.read.text(path)
    return known.first()[0]


def refuse_foreign(known: DataFrame | None, query: str, path: str) -> None:
    """Raise if ``known`` (with ``query_id``) has rows of another query."""
    other = known.where(F.col(QUERY) != query).select(QUERY).head(1) if known is not None else []
    if other:
        raise ForeignTarget(f"{path} holds batches of query {other[0][0]}; pass shared=True to add query {query}")


def stream_table(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A parquet table, and files added to it later, as a stream."""
    reader = use_rocksdb(spark).readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Name the event-time column and bound its disorder. Zone-less times are read in the session zone (UTC)."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything that has arrived, in as many batches as the source limits make, then stop."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_files(stream: DataFrame, path: str, checkpoint: str, format: str = "parquet") -> None:
    """Finished rows to files; each row lands exactly once."""
    run_available(stream.writeStream.outputMode("append").format(format).option("path", path), checkpoint)


@contextmanager
def _only_batches_with_rows(spark: SparkSession) -> Iterator[None]:
    """Queries started here run no batch without new rows."""
    before = spark.conf.get(_EMPTY_BATCHES)
    spark.conf.set(_EMPTY_BATCHES, "false")
    try:
        yield
    finally:
        spark.conf.set(_EMPTY_BATCHES, before)


def for_each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, mode: str, only_new: bool = False
) -> None:
    """``write`` every batch of what has arrived.

    State that expires by processing time always asks for one more batch, which may find something expired. Such a stream
    ends only with ``only_new``: no batch without new rows.
    """
    with _only_batches_with_rows(stream.sparkSession) if only_new else nullcontext():
        run_available(stream.writeStream.outputMode(mode).foreachBatch(write), checkpoint)


def update_files(stream: DataFrame, path: str, checkpoint: str, shared: bool = False, only_new: bool = False) -> None:
    """Every batch's new and changed rows under ``path/query_id=…/batch_id=…``; a repeated batch replaces its own folder.

    A query with a checkpoint of its own never touches another one's batches. Only with ``shared`` may it add to a table
    that another query has written. ``only_new`` as in ``for_each_batch``.
    """
    spark = stream.sparkSession
    query = query_id(spark, checkpoint)
    if not shared:
        refuse_foreign(read_or_none(lambda: spark.read.schema(_PLACE).parquet(path)), query, path)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{QUERY}={query}/{BATCH}={batch_id}")

    for_each_batch(stream, write, checkpoint, "update", only_new)


_PLACE = f"{QUERY} string, {BATCH} long"


def all_versions(spark: SparkSession, path: str) -> DataFrame:
    """Every row ever written to a table of updates, with its ``query_id`` and ``batch_id``."""
    changes = spark.read.parquet(path)
    return changes.withColumns({QUERY: F.col(QUERY).cast("string"), BATCH: F.col(BATCH).cast("long")})


def _newest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    values = [c for c in changes.columns if c not in keys]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(QUERY, BATCH)).alias("_row")).select(*keys, "_row.*")


def current_rows(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest version of each key in a table written by ``update_files``: of the latest query, then the latest batch."""
    return _newest(all_versions(spark, path), keys).drop(QUERY, BATCH)


def compact_updates(spark: SparkSession, path: str, target: str, keys: Sequence[str]) -> None:
    """The newest versions only, as a new table of the same layout that the same queries can go on with."""
    _newest(all_versions(spark, path), keys).write.partitionBy(QUERY, BATCH).parquet(target)
