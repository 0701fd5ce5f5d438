"""Streams against batches, restarts, replays, and the file sinks."""

import glob
import random

import pytest
from pyspark.sql import functions as F

from test_alarms import readings, step_by_step
from tidemill.catalog.base import events
from tidemill.functions.exact import cents
from tidemill.functions.times import arrival_time
from tidemill.operators.running import number_rows
from tidemill.operators.sessions import session_totals
from tidemill.operators.shape import union_all
from tidemill.operators.temporal import interval_join, stream_interval_join, window_join
from tidemill.operators.windows import sliding, tumbling
from tidemill.session import new_dir, shared_dir
from tidemill.sinks.files import compact_buckets, stream_buckets, write_buckets
from tidemill.sinks.keyed import KeyedTable, ListTable
from tidemill.sinks.ledger import Ledger
from tidemill.sources.files import stream_lines
from tidemill.sources.messages import from_offsets, json_values, replay_messages
from tidemill.streaming.ordered import ordered_rows, stream_numbers
from tidemill.streaming.runs import (
    ForeignTarget,
    append_files,
    compact_updates,
    current_rows,
    for_each_batch,
    stream_table,
    update_files,
    with_event_time,
)
from tidemill.streaming.stateful import (
    stream_change_log,
    stream_distinct,
    stream_rising_alarms,
    stream_running_total,
)
from tidemill.streaming.windows import stream_distinct_rows, stream_session_totals, stream_word_windows


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def replay(spark, sf_dir):
    """The events as files that arrive one after the other, in time order."""
    path = new_dir(spark, "replay")
    df = events(spark, sf_dir)
    n = df.count()
    for i in range(4):
        part = df.where((F.col("event_id") >= n * i // 4) & (F.col("event_id") < n * (i + 1) // 4))
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def places(spark, label):
    base = new_dir(spark, label)
    return f"{base}/table", f"{base}/progress"


def test_windows_over_batches(spark, replay):
    def sums(df, window):
        return window(df).drop("window_end")

    for label, window in [
        ("tumbling", lambda d: tumbling(d, "ts", "1 hour", ["event_type"], F.count("*").alias("n"))),
        ("sliding", lambda d: sliding(d, "ts", "2 hours", "1 hour", ["event_type"], F.count("*").alias("n"))),
    ]:
        target, progress = places(spark, label)
        stream = with_event_time(stream_table(spark, replay, 1), "ts", "10 seconds")
        update_files(sums(stream, window), target, progress)
        assert len(glob.glob(f"{target}/query_id=*/batch_id=*")) >= 4
        want = sums(spark.read.parquet(replay), window)
        assert rows(current_rows(spark, target, ["window_start", "event_type"])) == rows(want)


def test_append_mode_gives_closed_windows_only(spark, replay):
    target, progress = places(spark, "closed")
    stream = with_event_time(stream_table(spark, replay, 1), "ts", "10 seconds")
    append_files(tumbling(stream, "ts", "1 hour", ["event_type"], F.count("*").alias("n")), target, progress)
    last = spark.read.parquet(replay).agg(F.max("ts")).first()[0]
    batch = tumbling(spark.read.parquet(replay), "ts", "1 hour", ["event_type"], F.count("*").alias("n"))
    closed = batch.where(F.col("window_end") <= F.lit(last) - F.expr("interval 10 seconds"))
    assert rows(spark.read.parquet(target)) == rows(closed)


def test_sessions_at_exactly_the_gap(spark):
    source = new_dir(spark, "gap")
    spark.createDataFrame([(t,) for t in (0, 3, 5, 12, 15, 24, 30, 42, 500)], "s long").coalesce(1).write.parquet(source)
    target, progress = places(spark, "gap")
    stream = with_event_time(stream_table(spark, source).withColumn("ts", F.timestamp_seconds("s")), "ts", "0 seconds")
    append_files(stream_session_totals(stream, [], "ts", 6, F.count("*").alias("n")), target, progress)
    got = spark.read.parquet(target)
    batch = spark.read.parquet(source).withColumn("ts", F.timestamp_seconds("s"))
    gap = F.make_dt_interval(secs=F.lit(6))
    want = session_totals(batch, [], "ts", gap, {"n": (F.count("*"), "sum")}).where("session_start < timestamp_seconds(500)")
    assert rows(got) == rows(want) and sorted(r["n"] for r in got.collect()) == [1, 1, 1, 2, 3]


def test_stream_joins(spark, replay):
    def side(kind, stream):
        df = stream_table(spark, replay, 1) if stream else spark.read.parquet(replay)
        df = df.where(F.col("event_type") == kind).select("user_id", "ts", "event_id")
        return with_event_time(df, "ts", "1 hour") if stream else df

    names = ["user_id", "window_start", "l_event_id", "r_event_id"]
    target, progress = places(spark, "windowed")
    pairs = window_join(side("view", True), side("click", True), ["user_id"], "ts", "10 hours")
    append_files(pairs.select(names), target, progress)
    want = window_join(side("view", False), side("click", False), ["user_id"], "ts", "10 hours").select(names)
    assert want.count() > 0 and rows(spark.read.parquet(target)) == rows(want)

    names = ["user_id", "l_event_id", "r_event_id"]
    target, progress = places(spark, "interval")
    near = stream_interval_join(side("view", True), side("click", True), ["user_id"], "ts", -7200, 14400)
    append_files(near.select(names), target, progress)
    want = interval_join(side("view", False), side("click", False), ["user_id"], "ts", -7200, 14400).select(names)
    assert want.count() > 0 and rows(spark.read.parquet(target)) == rows(want)


def test_word_windows_and_dedupe(spark, replay):
    target, progress = places(spark, "words")
    lines = stream_table(spark, replay, 1).select("ts", "event_type")
    counts = stream_word_windows(lines, "ts", "event_type", "2 days", "5 seconds", "1 day").drop("window_end")
    update_files(counts, target, progress)
    batch = spark.read.parquet(replay).groupBy(F.window("ts", "2 days", "1 day")["start"].alias("w"), "event_type").count()
    assert rows(current_rows(spark, target, ["window_start", "word"])) == rows(batch)

    target, progress = places(spark, "first")
    keyed = stream_table(spark, replay, 1).withColumn("day", F.to_date("ts"))
    append_files(stream_distinct_rows(keyed, "ts", ["user_id", "day"], "1 day").select("user_id", "day"), target, progress)
    want = spark.read.parquet(replay).select("user_id", F.to_date("ts").alias("day")).distinct()
    assert rows(spark.read.parquet(target)) == rows(want)


def test_keyed_state(spark, replay):
    batch = spark.read.parquet(replay)
    target, progress = places(spark, "totals")
    stream = stream_table(spark, replay, 1).select("user_id", cents(F.col("value")).alias("c"))
    update_files(stream_running_total(stream, "user_id", "c"), target, progress)
    want = batch.groupBy("user_id").agg(F.sum(cents(F.col("value"))), F.count("*"))
    assert rows(current_rows(spark, target, ["user_id"])) == rows(want)

    target, progress = places(spark, "items")
    update_files(stream_distinct(stream_table(spark, replay, 1), "user_id", "event_type"), target, progress)
    want = batch.groupBy("user_id").agg(F.count_distinct("event_type"))
    assert rows(current_rows(spark, target, ["user_id"])) == rows(want)


def test_change_log_of_a_stream(spark, replay):
    target, progress = places(spark, "changes")
    stream = stream_table(spark, replay, 1).select("event_type", cents(F.col("value")).alias("c"))
    append_files(stream_change_log(stream, "event_type", "c"), target, progress)
    log = spark.read.parquet(target)
    assert log.where("not op").count() == log.where("op").count() - log.select("event_type").distinct().count() > 0
    left = log.groupBy("event_type").agg(F.sum(F.when(F.col("op"), F.col("total")).otherwise(-F.col("total"))))
    want = spark.read.parquet(replay).groupBy("event_type").agg(F.sum(cents(F.col("value"))))
    assert rows(left) == rows(want)


@pytest.mark.parametrize("reset", [False, True])
def test_alarm_stream_matches_the_rule(spark, reset):
    rng = random.Random(4)
    data = sorted(((rng.randint(1, 4), float(rng.randint(55, 75)), rng.randint(0, 300)) for _ in range(200)), key=lambda r: r[2])
    source = new_dir(spark, "racks")
    df = readings(spark, data)
    for part in (df.where("s < 100"), df.where("s >= 100 and s < 200"), df.where("s >= 200")):
        part.coalesce(1).write.mode("append").parquet(source)
    # readings far later let every open watch end
    readings(spark, [(9, 1.0, 10_000)]).coalesce(1).write.mode("append").parquet(source)
    target, progress = places(spark, "alarms")
    stream = stream_rising_alarms(stream_table(spark, source, 1), "rack", "ts", "temperature", "seq", reset_on_drop=reset)
    append_files(stream, target, progress)
    got = sorted(
        (r["rack"], r["opened_ms"] // 1000, r["first_value"], r["peak_value"]) for r in spark.read.parquet(target).collect()
    )
    assert got == step_by_step(data, 5, reset)


def test_resume_after_a_failed_batch(spark, replay):
    """The second batch fails once; the restarted query gives the one-shot result."""
    target, progress = places(spark, "failing")
    failures = []

    def write(batch, batch_id):
        if batch_id == 1 and not failures:
            failures.append(batch_id)
            raise RuntimeError("lost")
        batch.write.mode("overwrite").parquet(f"{target}/query_id=one/batch_id={batch_id}")

    counts = stream_table(spark, replay, 1).groupBy("event_type").agg(F.count("*").alias("n"))
    with pytest.raises(Exception, match="lost"):
        for_each_batch(counts, write, progress, "update")
    for_each_batch(counts, write, progress, "update")
    want = spark.read.parquet(replay).groupBy("event_type").count()
    assert rows(current_rows(spark, target, ["event_type"])) == rows(want)


def test_ledger(spark, replay):
    base = new_dir(spark, "ledger")
    ledger = Ledger(base)
    batch = spark.read.parquet(replay).select("event_id", "user_id")
    half, rest = batch.where("event_id % 2 = 0"), batch.where("event_id % 2 = 1")

    def fail(batch_id):
        raise RuntimeError("before commit")

    ledger.write(half, 0, "one")
    with pytest.raises(RuntimeError):
        ledger.write(rest, 1, "one", before_commit=fail)
    assert rows(ledger.rows(spark).select("event_id")) == rows(half.select("event_id"))  # nothing of batch 1 shows
    ledger.write(rest, 1, "one")
    once = rows(ledger.rows(spark).select("event_id"))
    assert once == rows(batch.select("event_id"))
    ledger.write(rest, 1, "one")
    ledger.write(half, 0, "one")
    assert rows(ledger.rows(spark).select("event_id")) == once
    assert ledger.committed(spark).count() == 2
    with pytest.raises(ForeignTarget):
        ledger.write(half, 0, "two")
    moved = ledger.compact(spark, new_dir(spark, "compact"))
    moved.write(rest, 1, "one")
    assert rows(moved.rows(spark).select("event_id")) == once and moved.committed(spark).count() == 2


def test_two_queries_on_one_target(spark, replay):
    """Batch numbers meet; neither query may hide or replace the other one's rows, nor may a renewed checkpoint."""
    events = stream_table(spark, replay, 2).select("event_id", "user_id")
    even, odd = events.where("event_id % 2 = 0"), events.where("event_id % 2 = 1")
    everything = rows(spark.read.parquet(replay).select("event_id"))
    base = new_dir(spark, "two")
    ledger = Ledger(f"{base}/ledger", shared=True)
    for name, stream in (("a", even), ("b", odd), ("a", even)):  # the first comes again with its old checkpoint
        ledger.drain(stream, f"{base}/{name}")
    assert rows(ledger.rows(spark).select("event_id")) == everything
    with pytest.raises(Exception, match="shared"):
        Ledger(f"{base}/ledger").drain(even, f"{base}/renewed")

    target = f"{base}/updates"
    update_files(even, target, f"{base}/c")
    with pytest.raises(ForeignTarget):
        update_files(odd, target, f"{base}/d")
    update_files(odd, target, f"{base}/d", shared=True)
    update_files(even, target, f"{base}/e", shared=True)  # a renewed checkpoint writes its rows once more
    assert rows(current_rows(spark, target, ["event_id"]).select("event_id")) == everything
    compact_updates(spark, target, f"{base}/small", ["event_id"])
    assert spark.read.parquet(f"{base}/small").count() == len(everything)
    update_files(odd, f"{base}/small", f"{base}/d", shared=True)
    assert rows(current_rows(spark, f"{base}/small", ["event_id"]).select("event_id")) == everything


def test_replayed_messages(spark):
    path = new_dir(spark, "messages")
    spark.createDataFrame(
        [(None, f'{{"value": {i}}}'.encode(), "t", i % 2, i // 2, None) for i in range(8)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    ).write.parquet(path)
    target, progress = places(spark, "decoded")
    stream = json_values(from_offsets(replay_messages(spark, path, stream=True), {0: 2}), "value long")
    append_files(stream.select("partition", "offset", "value"), target, progress)
    assert rows(spark.read.parquet(target)) == [(0, 2, 4), (0, 3, 6), (1, 0, 1), (1, 1, 3), (1, 2, 5), (1, 3, 7)]


def test_union_of_streams_and_arrival_windows(spark, replay):
    target, progress = places(spark, "union")
    one, two = (stream_table(spark, replay).where(F.col("event_type") == k).select("event_id") for k in ("view", "click"))
    both = union_all(one, two, two).withColumn("ts", arrival_time())
    update_files(tumbling(both, "ts", "1 day", [], F.count("*").alias("n")), target, progress)
    kinds = {r["event_type"]: r["count"] for r in spark.read.parquet(replay).groupBy("event_type").count().collect()}
    assert sum(r["n"] for r in spark.read.parquet(target).collect()) == kinds["view"] + 2 * kinds["click"]


def test_line_stream(spark):
    folder = new_dir(spark, "lines")
    spark.createDataFrame([("a b",), ("a",)], "value string").write.text(f"{folder}/sub")
    target, progress = places(spark, "lines")
    append_files(stream_lines(spark, folder), target, progress)
    assert {r["line"] for r in spark.read.parquet(target).collect()} == {"a", "a b"}


def test_buckets_and_compaction(spark, replay):
    df = spark.read.parquet(replay).select("event_id", F.date_trunc("day", "ts").alias("day"))
    path, compact = new_dir(spark, "buckets"), new_dir(spark, "compact")
    for part in range(3):
        write_buckets(df.where(F.col("event_id") % 3 == part), path, "day")
    compact_buckets(spark, path, compact)
    before, after = (glob.glob(f"{p}/bucket=*/*.parquet") for p in (path, compact))
    buckets = len(glob.glob(f"{compact}/bucket=*"))
    assert len(after) < len(before) and len(after) == buckets
    assert rows(spark.read.parquet(compact).select("event_id")) == rows(df.select("event_id"))
    assert all("--0000" in b for b in glob.glob(f"{compact}/bucket=*"))

    target, progress = places(spark, "rolling")
    running = stream_buckets(stream_table(spark, replay, 1).select("event_id", "ts"), target, "ts", "0 seconds", progress)
    running.processAllAvailable()
    running.stop()
    assert spark.read.parquet(target).count() == df.count()


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_alarm_over_disordered_batches(spark):
    """A reading that comes in a later batch but was earlier in time opens the watch."""
    source = new_dir(spark, "disordered")
    for part in ([(1, 62.0, 100)], [(1, 70.0, 97)], [(1, 1.0, 10_000)], [(1, 1.0, 20_000)]):
        readings(spark, part).coalesce(1).write.mode("append").parquet(source)
    target, progress = places(spark, "disordered")
    stream = stream_rising_alarms(stream_table(spark, source, 1), "rack", "ts", "temperature", "seq", "10 seconds", hold_s=5.0)
    append_files(stream, target, progress)
    assert spark.read.parquet(target).count() == 0


@pytest.mark.parametrize("reset", [False, True])
def test_alarms_of_shuffled_files_match_the_rule(spark, reset):
    rng = random.Random(8)
    data = sorted({(rng.randint(1, 3), rng.randint(0, 200)) for _ in range(150)}, key=lambda r: r[1])
    data = [(rack, float(rng.randint(55, 75)), s) for rack, s in data]
    source = new_dir(spark, "shuffled")
    df = readings(spark, data)
    for no in (2, 0, 3, 1):
        df.where(F.pmod(F.xxhash64("seq"), F.lit(4)) == no).coalesce(1).write.mode("append").parquet(source)
    for far in (10_000, 20_000):  # the watermark follows one batch behind
        readings(spark, [(9, 99.0, far)]).coalesce(1).write.mode("append").parquet(source)
    target, progress = places(spark, "shuffled")
    stream = stream_rising_alarms(stream_table(spark, source, 1), "rack", "ts", "temperature", "seq", "300 seconds", reset_on_drop=reset)
    append_files(stream, target, progress)
    got = sorted((r["rack"], r["opened_ms"] // 1000, r["first_value"], r["peak_value"]) for r in spark.read.parquet(target).collect())
    assert got == step_by_step(data, 5, reset)


def test_numbers_and_arrivals_survive_a_failed_batch(spark, replay):
    """A batch that comes again starts from what the batches before it left."""
    target, progress = places(spark, "numbered")
    for _ in range(2):  # the second run finds nothing new
        stream_numbers(stream_table(spark, replay, 1), target, progress, ["event_type"], ["event_id"])
    batch = spark.read.parquet(replay)
    want = number_rows(batch, ["event_type"], ["event_id"], "rn").select("event_id", "rn")
    assert rows(ordered_rows(spark, target).select("event_id", "rn")) == rows(want)
    left = spark.read.parquet(f"{target}/left")
    assert left.select("batch_id").distinct().count() >= 4
    with pytest.raises(ForeignTarget):
        stream_numbers(stream_table(spark, replay, 1), target, f"{progress}-other", ["event_type"], ["event_id"])


def test_lists_and_keyed_tables(spark):
    source = new_dir(spark, "pushes")
    for part in ([("k", 1), ("m", 9)], [("k", 2), ("k", 3)]):
        spark.createDataFrame(part, "key string, v long").coalesce(1).write.mode("append").parquet(source)
    target, progress = places(spark, "lists")
    lists = ListTable(target, "key", "v")
    for _ in range(2):
        lists.push(stream_table(spark, source, 1), progress)
    assert rows(lists.rows(spark).select("key", "pos", "v")) == [("k", 1, 3), ("k", 2, 2), ("k", 3, 1), ("m", 1, 9)]
    target, progress = places(spark, "keyed")
    table = KeyedTable(target, ("key",))
    table.upsert(stream_table(spark, source, 1).groupBy("key").agg(F.max("v").alias("v")), progress)
    assert rows(table.rows(spark)) == [("k", 3), ("m", 9)]
