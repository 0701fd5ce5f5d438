"""Message-log writes. Spark delivers at least once; a message id lets readers drop repeats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def to_messages(df: DataFrame, topic: str, value: Column, key: Column | None = None, stamp: Column | None = None) -> DataFrame:
    """Rows as messages ``topic, key, value`` (and ``timestamp``)."""
    columns = [
        F.lit(topic).alias("topic"),
        (key if key is not None else F.lit(None)).cast("binary").alias("key"),
        value.cast("string").cast("binary").alias("value"),
    ]
    if stamp is not None:
        columns.append(stamp.cast("timestamp").alias("timestamp"))
    return df.select(*columns)


def message_id(query: str, *row_key: str) -> Column:
    """An id that is the same whenever a row is sent again."""
    return F.concat_ws(":", F.lit(query), *[F.col(c).cast("string") for c in row_key])


def first_of_each(messages: DataFrame, id_column: str = "key") -> DataFrame:
    """Messages without repeated deliveries: the earliest offset of each id."""
    others = [c for c in messages.columns if c != id_column]
    kept = messages.groupBy(id_column).agg(F.min_by(F.struct(*others), F.struct("partition", "offset")).alias("_m"))
    return kept.select(id_column, "_m.*").select(*messages.columns)


def write_messages(stream: DataFrame, servers: str, checkpoint: str, **options: str):
    """Send message rows to a broker; needs Spark's Kafka package. Returns the running query."""
    writer = stream.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.options(**options).option("checkpointLocation", checkpoint).start()
