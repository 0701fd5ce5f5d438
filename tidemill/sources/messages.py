"""Message-log sources. Every row has the envelope of Spark's Kafka source, from a broker or from replay files."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.records import json_fields, typed_fields

ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)


def source_options(
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    start: str | Mapping[int, int] | int = "latest",
) -> dict[str, str]:
    """Options of a Kafka read.

    ``start`` is "earliest", "latest", a mapping partition -> next offset to read, or a time in epoch milliseconds. It
    applies to a first start only: a restart goes on from the checkpoint. With ``pattern`` new topics and partitions
    are found while running and read from their beginning.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give a topic or a pattern")
    options = {"kafka.bootstrap.servers": servers}
    options["subscribe" if topic else "subscribePattern"] = topic or pattern
    if isinstance(start, str):
        options["startingOffsets"] = start
    elif isinstance(start, int):
        options["startingTimestamp"] = str(start)
    elif topic is None:
        raise ValueError("offsets per partition need a single topic")
    else:
        options["startingOffsets"] = json.dumps({topic: {str(p): o for p, o in start.items()}})
    return options


def read_messages(spark: SparkSession, stream: bool = True, **options: str) -> DataFrame:
    """Messages of a broker; needs Spark's Kafka package on the class path."""
    reader = (spark.readStream if stream else spark.read).format("kafka")
    return reader.options(**options).load()


def replay_messages(spark: SparkSession, path: str, stream: bool = False, files_per_batch: int | None = None) -> DataFrame:
    """Messages kept as parquet files with the envelope columns."""
    if not stream:
        return spark.read.schema(ENVELOPE).parquet(path)
    reader = spark.readStream.schema(ENVELOPE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def from_offsets(messages: DataFrame, start: Mapping[int, int]) -> DataFrame:
    """Messages at or after the start offset of their partition; a partition not named is read from its beginning."""
    named = F.create_map(*[F.lit(int(x)) for pair in start.items() for x in pair])
    first = F.coalesce(F.try_element_at(named, F.col("partition")), F.lit(0))
    return messages.where(F.col("offset") >= first)


def text_values(messages: DataFrame) -> DataFrame:
    """The message values as text in ``value``, with topic, partition and offset."""
    return messages.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset")


def json_values(messages: DataFrame, schema: T.StructType | str) -> DataFrame:
    """JSON message values as columns beside topic, partition and offset."""
    return json_fields(text_values(messages), "value", schema)


def delimited_values(messages: DataFrame, separator: str, schema: list[tuple[str, str]], strict: bool = True) -> DataFrame:
    """Delimited message values as typed columns beside topic, partition and offset."""
    return typed_fields(text_values(messages), "value", separator, schema, strict)
