"""Counting rows beside the data flow of a stream, once per batch, however often a batch is tried."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener


class ObservedCounts(StreamingQueryListener):
    """Rows that passed ``counted``, per query and batch.

    A batch reports when it is done, and a batch that comes again after a failure or a restart replaces its former count. Add it
    with ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self, name: str):
        self.name = name
        self._counts: dict[tuple[str, int], int] = {}
        self._ended: set[str] = set()
        self._news = threading.Condition()

    def counted(self, stream: DataFrame) -> DataFrame:
        return stream.observe(self.name, F.count(F.lit(1)).alias("n"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            with self._news:
                # The id belongs to the checkpoint, so it is the same after a restart.
                self._counts[(str(event.progress.id), event.progress.batchId)] = row["n"]
                self._news.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._news:
            self._ended.add(str(event.runId))
            self._news.notify_all()

    def wait_for_runs(self, n: int, seconds: float = 60) -> None:
        """Until so many runs have ended and reported: reports come a little after the run itself."""
        until = time.monotonic() + seconds
        with self._news:
            while len(self._ended) < n:
                if not self._news.wait(until - time.monotonic()):
                    raise TimeoutError(f"{len(self._ended)} of {n} runs have ended")

    def batches(self) -> dict[tuple[str, int], int]:
        with self._news:
            return dict(self._counts)

    def total(self) -> int:
        return sum(self.batches().values())
