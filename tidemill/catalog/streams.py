"""Streaming jobs run over the event files to their end. Each leaves a table that must equal its batch answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog.base import events, query, sql_cents, sql_label, sql_ts_label, sql_window, table
from tidemill.catalog.rows import DOCUMENTS, traffic_log
from tidemill.catalog.timing import CLASSES_SQL, DELAY, LATENESS, SIZE, arrivals
from tidemill.functions.exact import cents
from tidemill.functions.records import json_fields
from tidemill.functions.times import second_label
from tidemill.operators.temporal import stream_interval_join, window_join
from tidemill.operators.windows import tumbling
from tidemill.plans.jobs import json_messages, traffic_documents, word_count
from tidemill.session import new_dir, use_utc
from tidemill.sinks.files import BUCKET, stream_buckets
from tidemill.sinks.keyed import KeyedTable, ListTable, put_cells
from tidemill.sinks.ledger import Ledger
from tidemill.sources.files import stream_lines
from tidemill.streaming.ordered import full_count_windows, ordered_rows, stream_arrivals, stream_numbers
from tidemill.streaming.runs import append_files, compact_updates, current_rows, query_id, stream_table, update_files, with_event_time
from tidemill.streaming.stateful import stream_change_log, stream_distinct, stream_rising_alarms
from tidemill.streaming.windows import stream_distinct_rows, stream_session_totals, stream_totals, stream_word_windows

_C = sql_cents("value")


_RANGES = 4
_ROWS_PER_FILE = 50_000


def _in_files(rows: DataFrame, by: str, turns: list[int] | None = None) -> DataFrame:
    """A table as folders of files that come one folder per batch: cut along the whole number ``by``, in order or in the given turns.

    Every folder has the same number of files, one batch takes that many. Rows without ``by`` come in the last folder.
    """
    spark = rows.sparkSession
    path = new_dir(spark, "arrivals")
    cuts = sorted(set(rows.agg(F.percentile_approx(by, [i / _RANGES for i in range(1, _RANGES)])).first()[0] or []))
    no = sum((F.coalesce(F.col(by) > F.lit(c), F.lit(True)).cast("int") for c in cuts), F.lit(0))
    sizes = {r["no"]: r["n"] for r in rows.groupBy(no.alias("no")).agg(F.count("*").alias("n")).collect()}  # at most _RANGES rows
    files = max(1, min([int(spark.conf.get("spark.sql.shuffle.partitions")), *(n // _ROWS_PER_FILE for n in sizes.values())]))
    for i in [i for i in turns or range(_RANGES) if i in sizes] or [0]:  # the source reads files in the order they were written
        part = rows.where(no == i)
        (part.repartition(files) if files > 1 else part.coalesce(1)).write.mode("append").parquet(path)
    return stream_table(spark, path, files_per_batch=files)


def _events(spark: SparkSession, sf: str, late: bool = False) -> DataFrame:
    """The events, whose times rise with their ids, in time order or with the second quarter last."""
    return _in_files(table(use_utc(spark), sf, "events"), "event_id", [0, 2, 3, 1] if late else None)


def _paths(spark: SparkSession, label: str) -> tuple[str, str]:
    base = new_dir(spark, label)
    return f"{base}/table", f"{base}/progress"


@query(
    "stream_tumbling",
    f"""
    SELECT {sql_label(sql_window('ts', 3600))} AS window_start, event_type, CAST(sum({_C}) AS BIGINT) AS c, count(*) AS n
    FROM events GROUP BY ALL
    """,
)
def _stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    target, progress = _paths(spark, "tumbling")
    rows = with_event_time(_events(spark, sf), "ts", "10 seconds")
    sums = tumbling(rows, "ts", "3600 seconds", ["event_type"], F.sum(cents(F.col("value"))).alias("c"), F.count("*").alias("n"))
    update_files(sums.drop("window_end"), target, progress)
    current = current_rows(spark, target, ["window_start", "event_type"])
    return current.withColumn("window_start", second_label(F.col("window_start")))


@query(
    "stream_word_windows",
    f"""
    SELECT {sql_label(sql_window('ts', 86400))} AS window_start, word, count(*) AS n
    FROM (SELECT ts, unnest(string_split(lower(event_type || ' User' || user_id), ' ')) AS word FROM events) GROUP BY ALL
    """,
)
def _stream_word_windows(spark: SparkSession, sf: str) -> DataFrame:
    target, progress = _paths(spark, "words")
    text = F.concat_ws(" ", "event_type", F.concat(F.lit("User"), "user_id")).alias("text")
    lines = _events(spark, sf).select("ts", text)
    update_files(stream_word_windows(lines, "ts", "text", "86400 seconds", "5 seconds").drop("window_end"), target, progress)
    return current_rows(spark, target, ["window_start", "word"]).withColumn("window_start", second_label(F.col("window_start")))


@query(
    "stream_window_join",
    f"""
    SELECT a.user_id, {sql_label(sql_window('a.ts', 36000))} AS window_start, a.event_id AS l_event_id, b.event_id AS r_event_id
    FROM events a JOIN events b ON a.user_id = b.user_id AND {sql_window('a.ts', 36000)} = {sql_window('b.ts', 36000)}
    WHERE a.event_type = 'purchase' AND b.event_type = 'signup'
    """,
)
def _stream_window_join(spark: SparkSession, sf: str) -> DataFrame:
    target, progress = _paths(spark, "pairs")

    def side(kind: str) -> DataFrame:
        rows = _events(spark, sf).where(F.col("event_type") == kind).select("user_id", "ts", "event_id")
        return with_event_time(rows, "ts", "1 second")

    pairs = window_join(side("purchase"), side("signup"), ["user_id"], "ts", "36000 seconds")
    append_files(pairs.select("user_id", "window_start", "l_event_id", "r_event_id"), target, progress)
    return spark.read.parquet(target).select(
        "user_id", second_label(F.col("window_start")).alias("window_start"), "l_event_id", "r_event_id"
    )


@query("stream_dedup", "SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    target, progress = _paths(spark, "seen")
    rows = _events(spark, sf).withColumn("day", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd"))
    first = stream_distinct_rows(rows, "ts", ["user_id", "event_type", "day"], "1 day")
    append_files(first.select("user_id", "event_type", "day"), target, progress)
    return spark.read.parquet(target)


@query(
    "stream_sessions",
    f"""
    WITH m AS (
        SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 28800000000 THEN 0 ELSE 1 END AS opened
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (SELECT *, sum(opened) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM m),
    t AS (
        SELECT user_id, min(ts) AS first, max(ts) + INTERVAL 8 HOUR AS until, count(*) AS n FROM s GROUP BY user_id, no)
    SELECT user_id, {sql_ts_label('first')} AS session_start, n FROM t
    WHERE until <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND
    """,
)
def _stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions the watermark has closed."""
    target, progress = _paths(spark, "sessions")
    rows = with_event_time(_events(spark, sf), "ts", "10 seconds")
    append_files(stream_session_totals(rows, ["user_id"], "ts", 28800, F.count("*").alias("n")), target, progress)
    return spark.read.parquet(target).select("user_id", second_label(F.col("session_start")).alias("session_start"), "n")


@query("stream_state", f"SELECT user_id, CAST(sum({_C}) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY user_id")
def _stream_state(spark: SparkSession, sf: str) -> DataFrame:
    """The running reduce per key; each batch writes the new value of the keys it touched."""
    target, progress = _paths(spark, "totals")
    sums = [F.sum(cents(F.col("value"))).alias("total"), F.count("*").alias("n")]
    update_files(stream_totals(_events(spark, sf, late=True), ["user_id"], *sums), target, progress)
    return current_rows(spark, target, ["user_id"])


@query("stream_seen_items", "SELECT user_id, count(DISTINCT event_type) AS n_distinct FROM events GROUP BY user_id")
def _stream_seen_items(spark: SparkSession, sf: str) -> DataFrame:
    """A keyed map state of the items seen."""
    target, progress = _paths(spark, "items")
    update_files(stream_distinct(_events(spark, sf, late=True), "user_id", "event_type"), target, progress)
    return current_rows(spark, target, ["user_id"])


@query(
    "stream_alarms",
    """
    WITH RECURSIVE h AS (SELECT user_id AS k, event_id, epoch_us(ts) // 1000 AS ms, value FROM events WHERE value >= 60),
    a AS (
        SELECT k, min(event_id) AS id, min(ms) AS opened FROM h GROUP BY k
        UNION ALL
        SELECT n.k, n.id, n.ms FROM (
            SELECT a.k, min(h.event_id) AS id, min(h.ms) AS ms FROM a JOIN h
              ON h.k = a.k AND h.ms > a.opened + 86400000 GROUP BY a.k) n),
    w AS (
        SELECT a.k, a.opened, max(h.value) FILTER (h.event_id = a.id) AS first_value, max(h.value) AS peak_value
        FROM a JOIN h ON h.k = a.k AND h.ms BETWEEN a.opened AND a.opened + 86400000 GROUP BY a.k, a.opened)
    SELECT k AS user_id, opened AS opened_ms, first_value, peak_value, opened + 86400000 AS alarm_ms FROM w
    WHERE peak_value > first_value AND opened + 86400000 <= (SELECT max(epoch_us(ts)) // 1000 FROM events) - 1382400000
    """,
)
def _stream_alarms(spark: SparkSession, sf: str) -> DataFrame:
    """Alarms of a keyed list state with timers, per user, over files that come in the wrong order: the third quarter of
    the month before the second. The delay is 16 days; watches the watermark has not passed stay unreported."""
    target, progress = _paths(spark, "alarms")
    rows = _in_files(table(use_utc(spark), sf, "events"), "event_id", [0, 2, 1, 3])
    append_files(stream_rising_alarms(rows, "user_id", "ts", "value", "event_id", "16 days", hold_s=86400), target, progress)
    return spark.read.parquet(target)


@query("stream_resume", "SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type")
def _stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A query stopped half-way and started again from its checkpoint: nothing lost, nothing twice."""
    base = new_dir(spark, "resume")
    source, target, progress = f"{base}/source", f"{base}/table", f"{base}/progress"
    rows = events(spark, sf).select("event_id", "event_type", "ts")
    late = F.coalesce(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"), F.lit(True))
    for part in (rows.where(~late), rows.where(late)):
        part.write.mode("append").parquet(source)
        append_files(stream_table(spark, source), target, progress)
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query("sink_ledger", f"SELECT event_id, user_id, {_C} AS c FROM events")
def _sink_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """JSON messages of two sources to one table with all-or-nothing batches; each query comes again with its checkpoint."""
    base = new_dir(spark, "ledger")
    ledger = Ledger(f"{base}/table", shared=True)
    rows = _events(spark, sf).select("event_id", "user_id", cents(F.col("value")).alias("c"))
    sent = json_messages(rows, "event_id", "user_id", "c")
    parsed = json_fields(sent, "value", "event_id long, user_id long, c long")
    for half in (0, 1, 0, 1):
        ledger.drain(parsed.where(F.coalesce(F.col("event_id") % 2, F.lit(0)) == half), f"{base}/progress-{half}")
    ledger.write(ledger.rows(spark).where("batch_id = 0"), 0, query_id(spark, f"{base}/progress-0"))
    return ledger.rows(spark).drop("query_id", "batch_id")


@query("update_two_queries", f"SELECT user_id, event_type, CAST(sum({_C}) AS BIGINT) AS total, count(*) AS n FROM events GROUP BY ALL")
def _update_two_queries(spark: SparkSession, sf: str) -> DataFrame:
    """Two queries with batches of equal numbers keep one table up to date, which is then compacted."""
    base = new_dir(spark, "shared")
    sums = [F.sum(cents(F.col("value"))).alias("total"), F.count("*").alias("n")]
    keys = ["user_id", "event_type"]
    for half in (0, 1):
        rows = _events(spark, sf).where(F.coalesce(F.col("user_id") % 2, F.lit(0)) == half)
        update_files(stream_totals(rows, keys, *sums), f"{base}/table", f"{base}/progress-{half}", shared=True)
    compact_updates(spark, f"{base}/table", f"{base}/compact", keys)
    return current_rows(spark, f"{base}/compact", keys)


@query("stream_doc_upsert", DOCUMENTS)
def _stream_doc_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of log lines kept up to date by their id, batch by batch; the query runs twice from one checkpoint."""
    path, progress = _paths(spark, "documents")
    target = KeyedTable(path, ("id",))
    lines = traffic_log(_events(spark, sf))
    for _ in range(2):
        target.upsert(traffic_documents(lines, delay="10 seconds"), progress)
    return target.rows(spark)


@query("stream_cells_put", "SELECT user_id AS rowkey, 'info' AS family, event_type AS qualifier, max(event_id) AS value FROM events GROUP BY ALL")
def _stream_cells_put(spark: SparkSession, sf: str) -> DataFrame:
    """Puts into a wide-column table: the last one of each cell stays."""
    path, progress = _paths(spark, "cells")
    target = KeyedTable(path, ("rowkey", "family", "qualifier"))
    target.upsert(put_cells(_events(spark, sf), "user_id", F.col("event_type"), F.col("event_id"), "event_id"), progress)
    return target.rows(spark)


@query("stream_list_push", "SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS pos FROM events")
def _stream_list_push(spark: SparkSession, sf: str) -> DataFrame:
    path, progress = _paths(spark, "lists")
    target = ListTable(path, "user_id", "event_id")
    target.push(_events(spark, sf).select("user_id", "event_id"), progress)
    return target.rows(spark)


@query(
    "stream_late",
    f"""
    {CLASSES_SQL} SELECT event_type, cls AS arrival_class, count(*) AS n, CAST(sum({_C}) AS BIGINT) AS c, CAST(sum(w) AS BIGINT) AS starts
    FROM k GROUP BY ALL
    """,
)
def _stream_late(spark: SparkSession, sf: str) -> DataFrame:
    """Lateness told apart batch by batch: on time, refiring, and the late side output."""
    path, progress = _paths(spark, "late")
    stream_arrivals(_in_files(arrivals(spark, sf), "arrived"), path, progress, "ts", ["arrived", "event_id"], SIZE, DELAY, LATENESS)
    sums = [F.count("*").alias("n"), F.sum(cents(F.col("value"))).alias("c"), F.sum("window_start").alias("starts")]
    return ordered_rows(spark, path).groupBy("event_type", "arrival_class").agg(*sums)


def _count_windows(key: str) -> str:
    part = f"PARTITION BY {key}" if key else ""
    columns = f"{key}, " if key else ""
    return f"""
    WITH n AS (SELECT *, (row_number() OVER ({part} ORDER BY event_id) - 1) // 7 AS no FROM events)
    SELECT {columns}CAST(no AS BIGINT) AS window_no, CAST(sum({_C}) AS BIGINT) AS c, max(event_id) AS last_id FROM n
    GROUP BY {columns}no HAVING count(*) = 7
    """


def _stream_count_windows(spark: SparkSession, sf: str, keys: list[str]) -> DataFrame:
    path, progress = _paths(spark, "numbers")
    stream_numbers(_events(spark, sf), path, progress, keys, ["event_id"])
    sums = [F.sum(cents(F.col("value"))).alias("c"), F.max("event_id").alias("last_id")]
    return full_count_windows(ordered_rows(spark, path), keys, 7, *sums)


@query("stream_count_windows", _count_windows("event_type"))
def _stream_count_windows_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of seven rows per type; what does not fill one waits for the next batch."""
    return _stream_count_windows(spark, sf, ["event_type"])


@query("stream_count_windows_all", _count_windows(""))
def _stream_count_windows_all(spark: SparkSession, sf: str) -> DataFrame:
    return _stream_count_windows(spark, sf, [])


@query(
    "stream_interval_join",
    """
    SELECT a.user_id, a.event_id AS l_event_id, b.event_id AS r_event_id FROM events a JOIN events b
      ON a.user_id = b.user_id AND b.ts BETWEEN a.ts - INTERVAL 2 HOUR AND a.ts + INTERVAL 4 HOUR
    WHERE a.event_type = 'view' AND b.event_type = 'click'
    """,
)
def _stream_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    target, progress = _paths(spark, "near")

    def side(kind: str) -> DataFrame:
        rows = _events(spark, sf).where(F.col("event_type") == kind).select("user_id", "ts", "event_id")
        return with_event_time(rows, "ts", "1 hour")

    near = stream_interval_join(side("view"), side("click"), ["user_id"], "ts", -7200, 14400)
    append_files(near.select("user_id", "l_event_id", "r_event_id"), target, progress)
    return spark.read.parquet(target)


@query("stream_change_log", f"SELECT event_type, CAST(sum({_C}) AS BIGINT) AS total, CAST(1 AS BIGINT) AS open FROM events GROUP BY event_type")
def _stream_change_log(spark: SparkSession, sf: str) -> DataFrame:
    """The changes of the totals, summed up: retractions and additions leave one open total per type."""
    target, progress = _paths(spark, "changes")
    rows = _events(spark, sf, late=True).select("event_type", cents(F.col("value")).alias("c"))
    append_files(stream_change_log(rows, "event_type", "c"), target, progress)
    sign = F.when(F.col("op"), 1).otherwise(-1)
    return spark.read.parquet(target).groupBy("event_type").agg(F.sum(sign * F.col("total")).alias("total"), F.sum(sign).alias("open"))


@query("stream_line_words", "SELECT word, count(*) AS n FROM (SELECT unnest([event_type, 'user' || user_id]) AS word FROM events) GROUP BY word")
def _stream_line_words(spark: SparkSession, sf: str) -> DataFrame:
    """Words of text files as they come."""
    base = new_dir(spark, "lines")
    rows = table(use_utc(spark), sf, "events")
    line = F.concat_ws(" ", "event_type", F.concat(F.lit("User"), "user_id")).alias("value")
    for part in (0, 1, 2):
        rows.where(F.coalesce(F.col("event_id") % 3, F.lit(0)) == part).select(line).write.mode("append").text(f"{base}/source")
    update_files(word_count(stream_lines(spark, f"{base}/source", 2)), f"{base}/table", f"{base}/progress")
    return current_rows(spark, f"{base}/table", ["word"])


@query(
    "stream_bucket_files",
    "SELECT strftime(date_trunc('day', ts), '%Y-%m-%d--%H%M') AS bucket, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1",
)
def _stream_bucket_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files by time bucket, written as a stream until all of it has arrived."""
    target, progress = _paths(spark, "buckets")
    days = _events(spark, sf).select("event_id", F.date_trunc("day", "ts").alias("day"))
    running = stream_buckets(days, target, "day", "0 seconds", progress)
    running.processAllAvailable()
    running.stop()
    written_rows = spark.read.schema(f"event_id long, day timestamp, {BUCKET} string").parquet(target)
    return written_rows.groupBy(BUCKET).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))
