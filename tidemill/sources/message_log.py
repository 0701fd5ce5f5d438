"""A message log in files as a streaming source: offsets per partition, start positions, partitions found while running.

The log lies in folders ``topic=…/partition=…`` of parquet files with the other envelope columns. Positions are the next
offset to read per topic and partition. They start where the query's options say, on its first start only; from then on the
checkpoint knows them. A partition or topic that appears later is read from its first message.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemill.sources.messages import ENVELOPE

FORMAT = "message_log"

_PLACE = re.compile(r"topic=([^/]+)/partition=(\d+)/[^/]+\.parquet$")
_COLUMNS = ["key", "value", "topic", "partition", "offset", "timestamp"]
_TYPES = {"topic": pa.string(), "partition": pa.int32(), "offset": pa.int64(), "timestamp": pa.timestamp("us", "UTC")}

Positions = dict[str, dict[str, int]]  # topic, partition, next offset to read


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def append_log(messages: DataFrame, path: str) -> None:
    """Add messages (envelope columns) to a log; a file holds messages of one partition in the order of their offsets."""
    ordered = messages.repartition("topic", "partition").sortWithinPartitions("topic", "partition", "offset")
    ordered.write.mode("append").partitionBy("topic", "partition").parquet(path)


@dataclass(frozen=True)
class _Segment:
    """A file and the offsets in it, the last one excluded."""

    file: str
    topic: str
    partition: int
    first: int
    end: int


@dataclass
class _Piece(InputPartition):
    file: str
    topic: str
    partition: int
    low: int
    high: int


class LogReader(DataSourceStreamReader):
    def __init__(self, options: Mapping[str, str]):
        self.path = options["path"]
        self.pattern = options.get("pattern", ".*")
        self.start = json.loads(options.get("start", '"earliest"'))
        self._known: dict[str, _Segment] = {}

    def _segments(self) -> list[_Segment]:
        """All files of the topics asked for; the footers of new ones are read for their offsets."""
        files, top = open_folder(self.path)
        for found in files.get_file_info(fs.FileSelector(top, recursive=True, allow_not_found=True)):
            place = _PLACE.search(found.path)
            if found.type != fs.FileType.File or not place or found.path in self._known:
                continue
            footer = pq.read_metadata(found.path, filesystem=files)
            at = footer.schema.names.index("offset")
            stats = [footer.row_group(i).column(at).statistics for i in range(footer.num_row_groups) if footer.row_group(i).num_rows]
            if stats:
                topic, partition = place.group(1), int(place.group(2))
                self._known[found.path] = _Segment(found.path, topic, partition, min(s.min for s in stats), max(s.max for s in stats) + 1)
        return [s for s in self._known.values() if re.fullmatch(self.pattern, s.topic)]

    @staticmethod
    def _positions(segments: list[_Segment], end: bool) -> Positions:
        out: Positions = {}
        for s in segments:
            of = out.setdefault(s.topic, {})
            key = str(s.partition)
            of[key] = max(of.get(key, s.end), s.end) if end else min(of.get(key, s.first), s.first)
        return out

    def _at_time(self, segments: list[_Segment], millis: int) -> Positions:
        """Per partition the first offset whose message is not older; the end where all are."""
        files, _ = open_folder(self.path)
        out = self._positions(segments, end=True)
        since = pa.scalar(millis * 1000, pa.timestamp("us", "UTC"))
        for s in segments:
            rows = pq.read_table(s.file, columns=["offset", "timestamp"], filesystem=files, partitioning=None)
            young = rows.filter(pc.greater_equal(pc.cast(rows["timestamp"], pa.timestamp("us", "UTC")), since))["offset"]
            if len(young):
                of = out[s.topic]
                of[str(s.partition)] = min(of[str(s.partition)], pc.min(young).as_py())
        return out

    def initialOffset(self) -> Positions:
        segments = self._segments()
        if self.start == "earliest":
            return {}  # every partition counts as one that appears later
        if self.start == "latest":
            return self._positions(segments, end=True)
        if isinstance(self.start, int):
            return self._at_time(segments, self.start)
        return {t: {str(p): int(o) for p, o in of.items()} for t, of in self.start.items()}

    def latestOffset(self) -> Positions:
        return self._positions(self._segments(), end=True)

    def partitions(self, start: Positions, end: Positions) -> list[_Piece]:
        """A task per file that has messages from ``start`` to before ``end``."""
        pieces = []
        for s in self._segments():
            key = str(s.partition)
            low, high = start.get(s.topic, {}).get(key, s.first), end.get(s.topic, {}).get(key, 0)
            if max(low, s.first) < min(high, s.end):
                pieces.append(_Piece(s.file, s.topic, s.partition, low, high))
        return pieces

    def read(self, piece: _Piece) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(self.path)
        with files.open_input_file(piece.file) as source:
            for batch in pq.ParquetFile(source).iter_batches():
                offset = batch.column("offset")
                rows = batch.filter(pc.and_(pc.greater_equal(offset, piece.low), pc.less(offset, piece.high)))
                n = rows.num_rows
                whole = {"topic": pa.repeat(pa.scalar(piece.topic), n), "partition": pa.repeat(pa.scalar(piece.partition, pa.int32()), n)}
                columns = {c: whole[c] if c in whole else rows.column(c) for c in _COLUMNS}
                yield pa.RecordBatch.from_pydict({c: pc.cast(x, _TYPES[c]) if c in _TYPES else x for c, x in columns.items()})


class MessageLog(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return ENVELOPE

    def streamReader(self, schema) -> LogReader:
        return LogReader(self.options)


def stream_log(spark: SparkSession, path: str, start: str | int | Mapping[str, Mapping[int, int]] = "earliest", pattern: str = ".*") -> DataFrame:
    """The messages of a log's topics, as a stream with the envelope columns.

    ``start`` is "earliest", "latest", a time in epoch milliseconds, or the next offset to read per topic and partition
    (partitions not named are read from their first message). It applies to a query's first start only. ``pattern`` is a
    regular expression for whole topic names.
    """
    spark.dataSource.register(MessageLog)
    return spark.readStream.format(FORMAT).options(path=path, start=json.dumps(start), pattern=pattern).load()


def log_rows(spark: SparkSession, path: str) -> DataFrame:
    """The whole log as a batch."""
    typed = {"partition": F.col("partition").cast("int"), "topic": F.col("topic").cast("string")}
    return spark.read.parquet(path).withColumns(typed).select(*_COLUMNS)
