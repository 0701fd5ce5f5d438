"""Streams whose rows count in order: late rows told apart, rows numbered per key.

Each micro-batch is an ordered pass of its own, cut into slices like any batch, and starts from what earlier batches left:
the largest event time, or the rows per key. These leftovers are tables of one entry per batch, so a batch that comes
again starts from the same ones and replaces what it wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.lateness import classify_arrivals
from tidemill.operators.running import Running, number_rows, running
from tidemill.operators.windows import Measures, first_of, merge_of, windows_of_runs
from tidemill.session import written
from tidemill.streaming.runs import BATCH, QUERY, for_each_batch, query_id, read_or_none, refuse_foreign
from tidemill.streaming.turns import NEVER, CarriedTables


class _Leftovers:
    """Per batch of one query some rows that the next batches start from, and the batch's results beside them."""

    def __init__(self, spark: SparkSession, path: str, checkpoint: str, schema: str):
        self.spark, self.path, self.query, self.schema = spark, path, query_id(spark, checkpoint), schema
        refuse_foreign(self._entries(), self.query, path)

    def _entries(self) -> DataFrame | None:
        return read_or_none(lambda: self.spark.read.schema(f"{self.schema}, {QUERY} string, {BATCH} long").parquet(f"{self.path}/left"))

    def before(self, batch_id: int) -> DataFrame | None:
        known = self._entries()
        return None if known is None else known.where(F.col(BATCH) < batch_id)

    def save(self, rows: DataFrame, left: DataFrame, batch_id: int) -> None:
        """The results first: without its entry in ``left`` a batch is not over, and comes again."""
        place = f"{QUERY}={self.query}/{BATCH}={batch_id}"
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/{place}")
        left.write.mode("overwrite").parquet(f"{self.path}/left/{place}")


def stream_arrivals(
    stream: DataFrame, path: str, checkpoint: str, ts: str, arrival: Sequence[str], size_s: int, delay_s: int, lateness_s: int
) -> None:
    """Classify a stream's rows as on time, refiring or dropped (the late side output), in the order of ``arrival``.

    Adds to ``path`` what ``classify_arrivals`` gives for all rows so far; read it with ``ordered_rows``.
    """
    spark = stream.sparkSession
    left = _Leftovers(spark, path, checkpoint, "high long")

    def write(batch: DataFrame, batch_id: int) -> None:
        known = left.before(batch_id)
        high = known.agg(F.max("high")).first()[0] if known is not None else None
        rows = classify_arrivals(batch, ts, arrival, size_s, delay_s, lateness_s, high)
        left.save(rows, batch.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("high")), batch_id)

    for_each_batch(stream, write, checkpoint, "append")


def stream_numbers(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> None:
    """Number a stream's rows 1, 2, 3, ... per key: batches in their order, the rows of one by ``order``."""
    spark = stream.sparkSession
    types = {f.name: f.dataType.simpleString() for f in stream.schema.fields}
    left = _Leftovers(spark, path, checkpoint, ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n long"]))

    def write(batch: DataFrame, batch_id: int) -> None:
        numbered, known = number_rows(batch, keys, order, name), left.before(batch_id)
        if known is not None:
            so_far = known.groupBy(*keys).agg(F.sum("n").alias("_so_far"))
            on = [batch_key.eqNullSafe(so_far[k]) for k in keys for batch_key in [numbered[k]]]
            joined = numbered.join(so_far, on, "left") if keys else numbered.join(F.broadcast(so_far))  # one row without keys
            numbered = joined.select(
                *[numbered[c] for c in batch.columns], (F.col(name) + F.coalesce("_so_far", F.lit(0))).alias(name)
            )
        left.save(numbered, batch.groupBy(*keys).agg(F.count("*").alias("n")), batch_id)

    for_each_batch(stream, write, checkpoint, "append")


def ordered_rows(spark: SparkSession, path: str) -> DataFrame:
    """What ``stream_arrivals`` or ``stream_numbers`` has written so far."""
    return spark.read.parquet(f"{path}/rows").drop(QUERY, BATCH)


def full_count_windows(numbered: DataFrame, keys: Sequence[str], size: int, *aggregates: Column, name: str = "rn") -> DataFrame:
    """Aggregates per ``size`` consecutive numbers of a key; the unfilled window waits for further rows."""
    no = F.floor((F.col(name) - 1) / size).cast("long").alias("window_no")
    return numbered.groupBy(*keys, no).agg(*aggregates, F.count("*").alias("_n")).where(F.col("_n") == size).drop("_n")


def _by_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``left`` with the other columns of ``right``, which has one row per key; null keys are equal."""
    if not keys:
        return left.join(F.broadcast(right))  # one row
    named = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    return left.join(named, on, "left").drop(*(f"_of_{k}" for k in keys))


def stream_firings(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str,
    keys: Sequence[str],
    arrival: Sequence[str],
    value: Column,
    size_s: int,
    delay_s: int,
    lateness_s: int,
) -> None:
    """Every firing of every (key, window) of a stream, as ``firing_log`` gives them for all rows so far.

    A window fires when the watermark reaches its end, and again with each late row within the allowance, with all rows so
    far. Carried from batch to batch are the largest event time and the totals of the windows that may still fire: a window
    is forgotten once the watermark has passed its end by the allowance. Rows that come later still are in the result
    ``dropped``. Read them with ``turns.results``.
    """
    spark = stream.sparkSession
    tables = CarriedTables(spark, path, checkpoint)
    group = [*keys, "window_start", "window_end"]
    micros = 1_000_000

    def write(batch: DataFrame, batch_id: int) -> None:
        known, marked = tables.load(batch_id, "windows", "high")
        before = marked.first()[0] if marked is not None else None
        rows = written(
            classify_arrivals(batch.withColumn("_v", value), ts, arrival, size_s, delay_s, lateness_s, before), "classified"
        )
        newest = rows.agg(F.max(F.unix_micros(F.col(ts).cast("timestamp")))).first()[0]
        high = max((h for h in (before, newest) if h is not None), default=None)
        mark = F.lit(NEVER if high is None else high - delay_s * micros)

        on_time = rows.where("arrival_class = 'on_time'").groupBy(*group).agg(F.count("*").alias("n"), F.sum("_v").alias("total"))
        late_rows = rows.where("arrival_class = 'late_refire'")
        late = late_rows.groupBy(*group).agg(F.count("*").alias("late_n"), F.sum("_v").alias("late_total"))
        zero, no = F.lit(0).cast("long"), F.lit(False)
        parts = on_time.select(*group, "n", "total", zero.alias("late_n"), zero.alias("late_total"), no.alias("fired")).unionByName(
            late.select(*group, zero.alias("n"), zero.alias("total"), "late_n", "late_total", no.alias("fired"))
        )
        if known is not None:
            parts = parts.unionByName(known)
        sums = [F.sum(c).alias(c) for c in ("n", "total", "late_n", "late_total")]
        windows = written(parts.groupBy(*group).agg(*sums, F.max("fired").alias("fired")), "windows")

        reached = F.col("window_end") * micros <= mark
        first = windows.where(reached & ~F.col("fired") & (F.col("n") > 0)).select(*group, zero.alias("firing"), "n", "total")
        counted = running(late_rows, group, arrival, [Running("_late_n", "count"), Running("_late_total", "sum", F.col("_v"))])
        # Totals before this batch: what the window has now, less what came late in this batch.
        now = _by_keys(windows, late.withColumnsRenamed({"late_n": "_n_new", "late_total": "_total_new"}), group)
        base = now.select(
            *group,
            "n",
            "total",
            (F.col("late_n") - F.coalesce("_n_new", zero)).alias("_n_before"),
            (F.col("late_total") - F.coalesce("_total_new", zero)).alias("_total_before"),
        )
        again = _by_keys(counted.select(*group, "_late_n", "_late_total"), base, group).select(
            *group,
            (F.col("_n_before") + F.col("_late_n")).alias("firing"),
            (F.col("n") + F.col("_n_before") + F.col("_late_n")).alias("n"),
            (F.col("total") + F.col("_total_before") + F.col("_late_total")).alias("total"),
        )
        open_ = windows.where((F.col("window_end") + lateness_s) * micros > mark).withColumn("fired", F.col("fired") | reached)
        dropped = rows.where("arrival_class = 'dropped'").select(*batch.columns)
        left = spark.createDataFrame([(high,)], "high long").coalesce(1)
        tables.save(batch_id, {"rows": first.unionByName(again), "dropped": dropped}, {"windows": open_, "high": left})

    for_each_batch(stream, write, checkpoint, "append")


def stream_count_sliding(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], order: Sequence[str], size: int, slide: int, measures: Measures
) -> None:
    """``count_sliding`` of a stream: batches in their order, the rows of one by ``order``; read it with ``turns.results``.

    Carried per key is a ring: the partial results of its last ``size`` rows, one per run of ``gcd(size, slide)`` rows. The
    rows of a batch are numbered and summed in slices, so a hot key is no task of its own. Keys stay for good.
    """
    tables = CarriedTables(stream.sparkSession, path, checkpoint)
    names = list(measures)

    def write(batch: DataFrame, batch_id: int) -> None:
        (ring,) = tables.load(batch_id, "ring")
        numbered = number_rows(batch, keys, order, "_rn")
        if ring is not None:
            so_far = ring.groupBy(*keys).agg(F.max("_last").alias("_so_far"))
            numbered = _by_keys(numbered, so_far, keys).withColumn("_rn", F.col("_rn") + F.coalesce("_so_far", F.lit(0)))
        runs = first_of(numbered, keys, size, slide, measures).withColumn("_fresh", F.lit(True))
        if ring is not None:
            both = runs.unionByName(ring.withColumn("_fresh", F.lit(False)))
            runs = both.groupBy(*keys, "_run").agg(*merge_of(measures), F.max("_last").alias("_last"), F.max("_fresh").alias("_fresh"))
        runs = written(runs, "runs")
        fired = windows_of_runs(runs, keys, size, slide, measures, F.max(F.when(F.col("_run") == F.col("upto"), F.col("_fresh"))).alias("_new"))
        newest = runs.groupBy(*keys).agg(F.max("_last").alias("_newest"))
        kept = _by_keys(runs, newest, keys).where(F.col("_run") > F.col("_newest") - size)
        tables.save(batch_id, {"rows": fired.where("_new").drop("_new")}, {"ring": kept.select(*keys, "_run", *names, "_last")})

    for_each_batch(stream, write, checkpoint, "append")
