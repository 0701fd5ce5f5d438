"""Relational inserts from batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemill.streaming.runs import for_each_batch


def jdbc_write_options(url: str, table: str, batch_rows: int = 10_000, partitions: int = 16, **extra: str) -> dict[str, str]:
    """Options of a parallel, batched insert; ``partitions`` bounds the connections."""
    return {"url": url, "dbtable": table, "batchsize": str(batch_rows), "numPartitions": str(partitions), **extra}


def insert_rows(df: DataFrame, **options) -> None:
    """Append rows to a table, each partition over one connection."""
    df.write.format("jdbc").options(**jdbc_write_options(**options)).mode("append").save()


def insert_stream(stream: DataFrame, checkpoint: str, **options) -> None:
    """Append each micro-batch; at least once. Use ``sinks.ledger`` where a repeated batch must not show."""
    for_each_batch(stream, lambda batch, _: insert_rows(batch, **options), checkpoint, "append")
