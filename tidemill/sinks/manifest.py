"""Two-phase commits as a streaming sink: tasks write files, the commit publishes a manifest that names them.

Nothing a task has written shows before its batch's manifest is in place, which is one rename. A failed batch is aborted and
leaves no manifest; a batch that comes again after its manifest was published is not published twice. Readers take the files
of the manifests. Every ``COMPACT_EVERY`` batches a manifest repeats all files so far, so a reader opens one of these and the
few behind it, however many batches there were.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage

from tidemill.sources.message_log import open_folder
from tidemill.streaming.runs import query_id, run_available

FORMAT = "manifest_table"
COMPACT_EVERY = 10


class ForeignManifest(RuntimeError):
    """A table was written by another query."""


@dataclass
class _Written(WriterCommitMessage):
    file: str | None
    rows: int


class Manifests:
    """The manifests of a table: one per batch of the query that owns it."""

    def __init__(self, path: str):
        self.files, self.top = open_folder(path)

    def _folder(self) -> list[fs.FileInfo]:
        found = self.files.get_file_info(fs.FileSelector(f"{self.top}/manifests", allow_not_found=True))
        return sorted((f for f in found if f.type == fs.FileType.File and f.base_name.endswith(".json")), key=lambda f: f.base_name)

    def _place(self, batch_id: int) -> str:
        return f"{self.top}/manifests/{batch_id:020d}.json"

    def _open(self, path: str) -> dict:
        with self.files.open_input_file(path) as f:
            return json.loads(f.read())

    def owner(self) -> str | None:
        return next((self._open(f.path)["query"] for f in reversed(self._folder())), None)

    def has(self, batch_id: int) -> bool:
        return self.files.get_file_info(self._place(batch_id)).type == fs.FileType.File

    def current(self) -> list[str]:
        """The files of all published batches, from the last manifest that has them all and those behind it."""
        names: list[str] = []
        for found in reversed(self._folder()):
            manifest = self._open(found.path)
            names = manifest["files"] + names
            if manifest["whole"]:
                break
        return names

    def publish(self, query: str, batch_id: int, files: list[str]) -> None:
        whole = batch_id % COMPACT_EVERY == COMPACT_EVERY - 1
        entry = {"query": query, "batch": batch_id, "whole": whole, "files": self.current() + files if whole else files}
        self.files.create_dir(f"{self.top}/manifests", recursive=True)
        draft = f"{self.top}/manifests/draft-{uuid.uuid4().hex}"
        with self.files.open_output_stream(draft) as f:
            f.write(json.dumps(entry).encode())
        self.files.move(draft, self._place(batch_id))

    def forget(self, names: list[str]) -> None:
        for name in names:
            self.files.delete_file(f"{self.top}/data/{name}")


class ManifestWriter(DataSourceStreamArrowWriter):
    def __init__(self, options: Mapping[str, str]):
        self.path, self.query = options["path"], options["query"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        """A task's rows as one file under a name of its own; no file without rows."""
        files, top = open_folder(self.path)
        name, rows, writer = f"{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in iterator:
                if batch.num_rows:
                    if writer is None:
                        files.create_dir(f"{top}/data", recursive=True)
                        writer = pq.ParquetWriter(f"{top}/data/{name}", batch.schema, filesystem=files)
                    writer.write_batch(batch)
                    rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return _Written(name if writer is not None else None, rows)

    def commit(self, messages: list[_Written | None], batchId: int) -> None:
        table, names = Manifests(self.path), [m.file for m in messages if m is not None and m.file]
        if table.owner() not in (None, self.query):
            table.forget(names)
            raise ForeignManifest(f"{self.path} belongs to query {table.owner()}, not {self.query}")
        if table.has(batchId):
            table.forget(names)  # published before the query stopped
        else:
            table.publish(self.query, batchId, names)

    def abort(self, messages: list[_Written | None], batchId: int) -> None:
        Manifests(self.path).forget([m.file for m in messages if m is not None and m.file])


class ManifestTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> ManifestWriter:
        return ManifestWriter(self.options)


def commit_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Add a stream's rows to a table, all or nothing per batch; the table belongs to the query that owns the checkpoint."""
    spark = stream.sparkSession
    spark.dataSource.register(ManifestTable)
    writer = stream.writeStream.outputMode("append").format(FORMAT).options(path=path, query=query_id(spark, checkpoint))
    run_available(writer, checkpoint)


def committed_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all published batches, as a batch."""
    names = Manifests(path).current()
    return spark.read.schema(schema).parquet(*(f"{path}/data/{n}" for n in names)) if names else spark.createDataFrame([], schema)
