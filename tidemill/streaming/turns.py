"""Streams that carry tables from one micro-batch to the next, and rows that wait until the watermark has passed them.

What a query carries lies in two slots that are written in turn: batch n reads the slot of batch n - 1 and replaces the
other one. So nothing piles up, and a batch that comes again after a failure finds what its first run found and replaces what
that run wrote. Each batch is a pass over plain tables: a key with a third of all rows is spread as in any batch job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.streaming.runs import BATCH, QUERY, for_each_batch, query_id, read_or_none, refuse_foreign

NEVER = -(1 << 62)  # a watermark before all times
FOREVER = 1 << 62  # and after all: the end of the input


class StateMissing(RuntimeError):
    """A batch does not find what the batch before it should have left."""


class CarriedTables:
    """Named tables that belong to one query's batches, and the query's results batch by batch."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str):
        self.spark, self.path, self.query = spark, path, query_id(spark, checkpoint)
        refuse_foreign(self._entries(), self.query, path)

    def _entries(self) -> DataFrame | None:
        return read_or_none(lambda: self.spark.read.schema(f"{QUERY} string, {BATCH} long, slot int").parquet(f"{self.path}/entries"))

    def last(self) -> int | None:
        """The last batch that left its tables."""
        known = self._entries()
        return None if known is None else known.agg(F.max(BATCH)).first()[0]

    def load(self, batch_id: int, *names: str) -> list[DataFrame | None]:
        """The tables that the batch before ``batch_id`` left; None for each before the first batch."""
        if not batch_id:
            return [None] * len(names)
        slot, known = (batch_id - 1) % 2, self._entries()
        if known is None or not known.where((F.col("slot") == slot) & (F.col(BATCH) == batch_id - 1)).head(1):
            raise StateMissing(f"{self.path} has no tables of batch {batch_id - 1}")
        return [self.spark.read.parquet(f"{self.path}/state/{n}/{slot}") for n in names]

    def save(self, batch_id: int, results: Mapping[str, DataFrame], tables: Mapping[str, DataFrame]) -> None:
        """Results, then the tables for the next batch, then the entry that makes them valid."""
        slot = batch_id % 2
        for name, rows in results.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/{name}/{QUERY}={self.query}/{BATCH}={batch_id}")
        for name, rows in tables.items():
            rows.write.mode("overwrite").parquet(f"{self.path}/state/{name}/{slot}")
        entry = self.spark.createDataFrame([(self.query, batch_id)], f"{QUERY} string, {BATCH} long")
        entry.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/entries/slot={slot}")


def results(spark: SparkSession, path: str, name: str = "rows") -> DataFrame:
    """What a query has written so far."""
    return spark.read.parquet(f"{path}/{name}").drop(QUERY, BATCH)


Step = Callable[[DataFrame, int], tuple[DataFrame, DataFrame]]


class Turns:
    """A stream whose rows wait in a carried table until the watermark (microseconds) passes them.

    ``step(rows, passed)`` gets all waiting rows and the new ones, and gives what comes out of them and what still waits.
    The watermark is the least over ``holding`` sides of their largest ``ts`` so far minus the delay; it never moves back, and
    a holding side without any row holds it before all times. New rows that are ``late`` for the watermark before them go to
    the side output ``late`` instead. ``side`` names the side of a row (one side by default).
    """

    def __init__(
        self,
        stream: DataFrame,
        path: str,
        checkpoint: str,
        ts: str,
        delay_s: float,
        step: Step,
        late: Callable[[int], Column],
        side: Column | None = None,
        holding: Sequence[str] = ("",),
    ):
        self.stream, self.spark = stream, stream.sparkSession
        self.tables = CarriedTables(self.spark, path, checkpoint)
        self.path, self.checkpoint, self.ts, self.delay = path, checkpoint, ts, round(delay_s * 1_000_000)
        self.step, self.late, self.side, self.holding = step, late, F.lit("") if side is None else side, list(holding)

    def _passed(self, marks: dict[str, int]) -> int:
        return min((marks.get(s, NEVER) for s in self.holding), default=NEVER) - self.delay

    def _turn(self, batch: DataFrame, batch_id: int) -> None:
        waiting, marked = self.tables.load(batch_id, "waiting", "marks")
        marks = {r["side"]: r["high"] for r in marked.collect()} if marked is not None else {}  # a row per side
        before = self._passed(marks)
        batch = batch.persist()
        at = F.unix_micros(F.col(self.ts).cast("timestamp"))
        for r in batch.groupBy(self.side.alias("side")).agg(F.max(at).alias("high")).where("high IS NOT NULL").collect():
            marks[r["side"]] = max(r["high"], marks.get(r["side"], NEVER))
        late = F.coalesce(self.late(before), F.lit(False))
        new = batch.where(~late)
        out, rest = self.step(new if waiting is None else waiting.unionByName(new), self._passed(marks))
        left = self.spark.createDataFrame(list(marks.items()), "side string, high long").coalesce(1)
        self.tables.save(batch_id, {"rows": out, "late": batch.where(late)}, {"waiting": rest, "marks": left})
        batch.unpersist()

    def run(self) -> None:
        """Take in what has arrived."""
        for_each_batch(self.stream, self._turn, self.checkpoint, "append")

    def finish(self) -> None:
        """The input has ended: everything that waits comes out. Calling it again replaces its own results."""
        last = self.tables.last()
        if last is not None:
            (waiting,) = self.tables.load(last + 1, "waiting")
            out, _ = self.step(waiting, FOREVER)
            out.write.mode("overwrite").parquet(f"{self.path}/rows/{QUERY}={self.tables.query}/{BATCH}={FOREVER}")

    def rows(self) -> DataFrame:
        return results(self.spark, self.path)

    def late_rows(self) -> DataFrame:
        return results(self.spark, self.path, "late")

    def waiting(self) -> DataFrame | None:
        last = self.tables.last()
        return None if last is None else self.tables.load(last + 1, "waiting")[0]
