"""Streaming jobs whose rows wait, and jobs over two streams. Each leaves a table that must equal its batch answer."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog.base import QUERIES, events, query, sql_cents, sql_label, sql_window, table
from tidemill.catalog.joining import _pair_rows, _snapshots
from tidemill.catalog.streams import _in_files, _paths
from tidemill.catalog.timing import _COUNT_MEASURES, DELAY, LATENESS, SIZE, arrivals
from tidemill.functions.exact import cents
from tidemill.functions.records import typed_fields
from tidemill.functions.times import second_label
from tidemill.operators.running import number_rows
from tidemill.operators.windows import tumbling, window_process
from tidemill.plans.jobs import TrafficWithUser, traffic_lines
from tidemill.session import new_dir, use_utc, written
from tidemill.sinks.manifest import commit_files, committed_rows
from tidemill.sources.message_log import append_log, stream_log
from tidemill.streaming.enrich import SnapshotTable, stream_snapshot_lookup
from tidemill.streaming.observed import ObservedCounts
from tidemill.streaming.ordered import stream_count_sliding, stream_firings
from tidemill.streaming.runs import append_files, current_rows, for_each_batch, stream_table, update_files, with_event_time
from tidemill.streaming.stateful import stream_reduced
from tidemill.streaming.turns import results
from tidemill.streaming.windows import session_join_turns, window_turns

_C = sql_cents("value")
_DISORDER = [0, 2, 1, 3]  # the third quarter of the month comes before the second
_DISORDER_S = 16 * 86400


def _disordered(spark: SparkSession, sf: str) -> DataFrame:
    return _in_files(table(use_utc(spark), sf, "events"), "event_id", _DISORDER)


# The data come in four parts of eight days, each after the snapshots that are known at its start.
_PART_DAYS, _PARTS = 8, 4
_PART_SQL = f"least({_PARTS - 1}, greatest(0, date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // {_PART_DAYS}))"


@query(
    "stream_snapshot_lookup",
    f"""
    WITH s AS (
        SELECT CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS valid_from, user_id, max(event_id) AS rule
        FROM events WHERE event_type = 'signup' GROUP BY ALL),
    d AS (SELECT event_id, user_id, {_PART_SQL} AS part FROM events),
    v AS (
        SELECT part, (SELECT max(valid_from) FROM s WHERE valid_from <= TIMESTAMP '2024-01-01' + INTERVAL (part * {_PART_DAYS}) DAY) AS version
        FROM range({_PARTS}) t(part))
    SELECT d.event_id, d.user_id, s.rule FROM d JOIN v USING (part) JOIN s ON s.valid_from = v.version AND s.user_id = d.user_id
    """,
)
def _stream_snapshot_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Rules from a control stream, replaced as a whole; both queries stop after each part and go on from their checkpoints."""
    base = new_dir(spark, "rules")
    rows = events(spark, sf).select("event_id", "user_id", "ts")
    start = F.lit("2024-01-01").cast("timestamp")
    day = F.floor((F.unix_seconds("ts") - F.unix_seconds(start)) / 86400)
    part = F.coalesce(F.least(F.lit(_PARTS - 1), F.greatest(F.lit(0), F.floor(day / _PART_DAYS))), F.lit(_PARTS - 1))
    control, rules = _snapshots(spark, sf), SnapshotTable(f"{base}/rules", "valid_from")
    for no in range(_PARTS):
        known = start + F.make_dt_interval(days=F.lit(no * _PART_DAYS))
        before = start + F.make_dt_interval(days=F.lit((no - 1) * _PART_DAYS))
        news = control.where((F.col("valid_from") <= known) & ((F.col("valid_from") > before) | F.lit(no == 0)))
        news.write.mode("append").parquet(f"{base}/control")
        rules.publish(stream_table(spark, f"{base}/control"), f"{base}/progress-rules")
        rows.where(part == no).write.mode("append").parquet(f"{base}/data")
        stream_snapshot_lookup(
            stream_table(spark, f"{base}/data"), rules, [("user_id", "user_id")], {"rule": "long"}, f"{base}/found", f"{base}/progress"
        )
    return results(spark, f"{base}/found").select("event_id", "user_id", "rule")


@query("stream_asof_enrich", QUERIES["asof_enrich"].sql)
def _stream_asof_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic lines and user maps, both out of order: a line waits for the map in force at its time."""
    path, progress = _paths(spark, "enriched")
    rows = _disordered(spark, sf)
    domain = F.concat(F.lit("user-"), "user_id")
    level = F.when(F.col("event_type") == "error", "E").otherwise("M")
    lines = traffic_lines(rows, level, second_label(F.col("ts").cast("timestamp")), domain, cents(F.col("value")))
    maps = _snapshots(spark, sf).select("valid_from", domain.alias("domain"), F.col("rule").cast("string").alias("user"))
    control = _in_files(maps.withColumn("day", F.unix_seconds("valid_from")), "day", _DISORDER).drop("day")
    job = TrafficWithUser(lines, control, path, progress, _DISORDER_S)
    job.turns.run()
    job.turns.finish()
    return job.lines()


@query("stream_firings", QUERIES["late_refire_log"].sql)
def _stream_firings(spark: SparkSession, sf: str) -> DataFrame:
    """A window fires at the watermark and again on each late row within the allowance."""
    path, progress = _paths(spark, "firings")
    rows = _in_files(arrivals(spark, sf), "arrived")
    stream_firings(rows, path, progress, "ts", ["event_type"], ["arrived", "event_id"], cents(F.col("value")), SIZE, DELAY, LATENESS)
    return results(spark, path).drop("window_end")


def _sliding(spark: SparkSession, sf: str, keys: list[str], size: int, slide: int) -> DataFrame:
    path, progress = _paths(spark, "rings")
    rows = _in_files(table(use_utc(spark), sf, "events"), "event_id").withColumn("v", cents(F.col("value")))
    stream_count_sliding(rows, path, progress, keys, ["event_id"], size, slide, _COUNT_MEASURES)
    return results(spark, path)


@query("stream_count_sliding", QUERIES["count_sliding"].sql)
def _stream_count_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Every five rows of a user over the last ten, across batches."""
    return _sliding(spark, sf, ["user_id"], 10, 5)


@query("stream_count_sliding_all", QUERIES["count_sliding_all"].sql)
def _stream_count_sliding_all(spark: SparkSession, sf: str) -> DataFrame:
    return _sliding(spark, sf, [], 10, 4)


_MEDIAN_SQL = f"""
    WITH r AS (
        SELECT *, {sql_window('ts', 86400)} AS w, {_C} AS c, lag({_C}) OVER (PARTITION BY user_id, {sql_window('ts', 86400)} ORDER BY ts, event_id) AS before
        FROM events)
    SELECT user_id, {sql_label('w')} AS window_start, {sql_label('w + 86400')} AS window_end, count(*) AS n,
           list_sort(list(c))[(count(*) - 1) // 2 + 1] AS median_c, count(*) FILTER (c > before) AS n_rises
    FROM r GROUP BY user_id, w
"""


def _describe(key: tuple, start: pd.Timestamp, end: pd.Timestamp, pieces: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """What needs all rows in order: the lower median, and how often a value exceeds the one before it."""
    c = np.concatenate([rows["c"].to_numpy() for rows in pieces])
    middle = (len(c) - 1) // 2
    yield len(c), int(np.partition(c, middle)[middle]), int((c[1:] > c[:-1]).sum())


_DESCRIBED = "n long, median_c long, n_rises long"


def _median_rows(described: DataFrame) -> DataFrame:
    bounds = [second_label(F.col(c)).alias(c) for c in ("window_start", "window_end")]
    return described.select("user_id", *bounds, "n", "median_c", "n_rises")


@query("window_median", _MEDIAN_SQL)
def _window_median(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("user_id", "ts", "event_id", cents(F.col("value")).alias("c"))
    return _median_rows(window_process(rows, "ts", "86400 seconds", ["user_id"], ["ts", "event_id"], _describe, _DESCRIBED))


@query("stream_window_process", _MEDIAN_SQL)
def _stream_window_process(spark: SparkSession, sf: str) -> DataFrame:
    """The same function on a stream out of order: a window's rows wait for the watermark."""
    path, progress = _paths(spark, "described")
    rows = _disordered(spark, sf).select("user_id", F.col("ts").cast("timestamp").alias("ts"), "event_id", cents(F.col("value")).alias("c"))
    turns = window_turns(rows, path, progress, "ts", "86400 seconds", ["user_id"], ["ts", "event_id"], _describe, _DESCRIBED, _DISORDER_S)
    turns.run()
    turns.finish()
    return _median_rows(turns.rows())


@query("stream_session_join", QUERIES["window_join_session"].sql)
def _stream_session_join(spark: SparkSession, sf: str) -> DataFrame:
    """Purchases and signups of a user in one session; sessions close behind the watermark of both streams."""
    path, progress = _paths(spark, "sessions")

    def side(kind: str) -> DataFrame:
        rows = events(spark, sf).where(F.col("event_type") == kind).select("user_id", "ts", "event_id", "value")
        return _in_files(rows, "event_id")

    turns = session_join_turns(side("purchase"), side("signup"), path, progress, ["user_id"], "ts", 21600, 10)
    turns.run()
    turns.finish()
    return _pair_rows(turns.rows(), second_label(F.col("session_start")).alias("session_start"))


@query(
    "stream_union",
    f"""
    WITH w AS (SELECT {sql_window('ts', 86400)} AS w, event_type FROM events WHERE event_type IN ('purchase', 'signup')),
    closed AS (SELECT min(high) AS high FROM (SELECT epoch_us(max(ts)) // 1000 * 1000 - 10000000 AS high FROM events WHERE event_type IN ('purchase', 'signup') GROUP BY event_type))
    SELECT {sql_label('w')} AS window_start, count(*) AS n, count(*) FILTER (event_type = 'signup') AS n_signups
    FROM w, closed WHERE (w + 86400) * 1000000 <= high GROUP BY w
    """,
)
def _stream_union(spark: SparkSession, sf: str) -> DataFrame:
    """Two streams in one, one of them a batch behind: the watermark is the least of both, so none of its rows is late."""
    path, progress = _paths(spark, "union")
    kinds = events(spark, sf).select("event_id", "event_type", "ts")
    ahead = kinds.where("event_type = 'purchase'")
    behind = kinds.where("event_type = 'signup'")
    # An extra first folder with the earliest rows only puts all others one batch back.
    first = behind.agg(F.min("event_id")).first()[0] or 0
    late = _in_files(behind.withColumn("turn", F.when(F.col("event_id") == first, F.lit(-(1 << 40))).otherwise(F.col("event_id"))), "turn")
    both = with_event_time(_in_files(ahead, "event_id"), "ts", "10 seconds").unionByName(with_event_time(late.drop("turn"), "ts", "10 seconds"))
    n_signups = F.count(F.when(F.col("event_type") == "signup", 1)).alias("n_signups")
    append_files(tumbling(both, "ts", "86400 seconds", [], F.count("*").alias("n"), n_signups).drop("window_end"), path, progress)
    return spark.read.parquet(path).withColumn("window_start", second_label(F.col("window_start")))


@query("stream_observed_count", "SELECT count(*) AS n_written, count(*) AS n_observed FROM events")
def _stream_observed_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows counted beside the flow; the third batch fails once, and comes again when the query is started again."""
    path, progress = _paths(spark, "observed")
    rows, counter = _in_files(table(use_utc(spark), sf, "events").select("event_id"), "event_id"), ObservedCounts("rows")
    failed = []

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise _Planned("the batch is written but not over")

    spark.streams.addListener(counter)
    try:
        try:
            for_each_batch(counter.counted(rows), write, progress, "append")
        except Exception as e:
            if _Planned.__name__ not in str(e):
                raise
        for_each_batch(counter.counted(rows), write, progress, "append")
        counter.wait_for_runs(1 + len(failed))
    finally:
        spark.streams.removeListener(counter)
    return spark.read.parquet(path).agg(F.count("*").alias("n_written"), F.lit(counter.total()).cast("long").alias("n_observed"))


class _Planned(RuntimeError):
    """A failure on purpose."""


@query(
    "stream_reducing_state",
    f"""
    WITH z AS (SELECT event_type, max(event_id) FILTER (user_id % 50 = 0) AS wiped FROM events GROUP BY event_type)
    SELECT e.event_type, CAST(max({_C}) AS BIGINT) AS value, count(*) AS n FROM events e JOIN z USING (event_type)
    WHERE event_id > coalesce(wiped, -1) GROUP BY e.event_type
    """,
)
def _stream_reducing_state(spark: SparkSession, sf: str) -> DataFrame:
    """The largest value per type since an event of certain users last wiped the state."""
    path, progress = _paths(spark, "reduced")
    rows = _in_files(table(use_utc(spark), sf, "events"), "event_id").withColumn("c", cents(F.col("value")))
    update_files(stream_reduced(rows, "event_type", "c", "event_id", np.max, F.col("user_id") % 50 == 0), path, progress)
    return current_rows(spark, path, ["event_type"]).where("n > 0")


_LOG_SQL = f"""
    SELECT event_id, {_C} AS c, user_id % 3 AS p, row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS o FROM events
"""


@query(
    "stream_offsets",
    f"""
    SELECT CAST(p AS INTEGER) AS partition, o AS "offset", event_id, c FROM ({_LOG_SQL})
    WHERE o >= CASE p WHEN 0 THEN 23 WHEN 1 THEN 31 ELSE 0 END
    """,
)
def _stream_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """A message log read from given offsets, batch by batch; its third partition appears after the first batch."""
    base = new_dir(spark, "log")
    rows = events(spark, sf).where(F.col("user_id").isNotNull())
    partition = F.pmod("user_id", F.lit(3)).cast("int")
    numbered = number_rows(rows.withColumn("partition", partition), ["partition"], ["event_id"], "rn")
    offset = (F.col("rn") - 1).cast("long").alias("offset")
    value = F.concat_ws(",", "event_id", cents(F.col("value"))).cast("binary").alias("value")
    log = written(numbered.select(F.lit(None).cast("binary").alias("key"), value, F.lit("events").alias("topic"), "partition", offset, F.col("ts").alias("timestamp")), "messages")
    half = F.col("offset") < 100
    for part in (log.where("partition < 2").where(half), log.where("partition < 2").where(~half).unionByName(log.where("partition = 2"))):
        append_log(part, f"{base}/log")
        messages = stream_log(spark, f"{base}/log", start={"events": {0: 23, 1: 31}})
        commit_files(messages.select("partition", "offset", F.col("value").cast("string").alias("value")), f"{base}/read", f"{base}/progress")
    read = committed_rows(spark, f"{base}/read", "partition int, offset long, value string")
    return typed_fields(read, "value", ",", [("event_id", "long"), ("c", "long")])
