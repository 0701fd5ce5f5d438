"""Rows that wait for the watermark, tables carried between batches, two streams in one: restarts, replays, late rows, bounds."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.catalog import QUERIES
from tidemill.catalog.streams import _in_files
from tidemill.operators.lateness import classify_arrivals, firing_log
from tidemill.operators.temporal import session_join, snapshot_lookup
from tidemill.operators.windows import count_sliding, tumbling, window_process
from tidemill.session import new_dir
from tidemill.streaming.enrich import SnapshotTable, asof_turns, stream_snapshot_lookup
from tidemill.streaming.ordered import stream_count_sliding, stream_firings
from tidemill.streaming.runs import ForeignTarget, append_files, current_rows, stream_table, update_files, with_event_time
from tidemill.streaming.stateful import stream_distinct, stream_reduced
from tidemill.streaming.turns import CarriedTables, StateMissing, results
from tidemill.streaming.windows import session_join_turns, window_turns


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def places(spark, label):
    base = new_dir(spark, label)
    return f"{base}/table", f"{base}/progress"


class Source:
    """Files that come one per batch, and more of them later."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path = spark, schema, new_dir(spark, "source")
        spark.createDataFrame([], schema).write.parquet(self.path)

    def add(self, *batches):
        for batch in batches:
            self.spark.createDataFrame(batch, self.schema).coalesce(1).write.mode("append").parquet(self.path)
        return self

    def stream(self):
        return stream_table(self.spark, self.path, files_per_batch=1)


def forget_last_commit(checkpoint):
    """As if the query had died between a batch's work and its commit: the batch comes again."""
    commits = f"{checkpoint}/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    for name in (f"{commits}/{last}", f"{commits}/.{last}.crc"):
        if os.path.exists(name):
            os.remove(name)
    return last


def at(seconds):
    return F.timestamp_seconds(F.lit(seconds))


# Tables carried from batch to batch


def test_carried_tables(spark):
    path, progress = places(spark, "carried")
    tables = CarriedTables(spark, path, progress)
    assert tables.load(0, "a", "b") == [None, None] and tables.last() is None
    for n in range(4):
        tables.save(n, {"rows": spark.range(n, n + 1)}, {"a": spark.range(10 * n, 10 * n + 2)})
        assert tables.last() == n
    assert rows(tables.load(4, "a")[0]) == [(30,), (31,)] and rows(results(spark, path)) == [(0,), (1,), (2,), (3,)]
    # batch 3 once more finds what it found, and replaces what it left
    assert rows(tables.load(3, "a")[0]) == [(20,), (21,)]
    tables.save(3, {"rows": spark.range(7, 8)}, {"a": spark.range(5)})
    assert rows(results(spark, path)) == [(0,), (1,), (2,), (7,)] and tables.load(4, "a")[0].count() == 5
    with pytest.raises(StateMissing):
        tables.load(2, "a")
    with pytest.raises(ForeignTarget):
        CarriedTables(spark, path, f"{progress}-of-another")


# Snapshots pinned per batch


RULES, IDS = "version int, id int, rule string", "id int, n int"


def test_newest_snapshot_as_a_whole(spark):
    path, progress = places(spark, "rules")
    control, data = Source(spark, RULES), Source(spark, IDS)
    rules = SnapshotTable(f"{path}-rules", "version")

    def look_up():
        stream_snapshot_lookup(data.stream(), rules, [("id", "id")], {"rule": "string"}, path, progress)
        return rows(results(spark, path).select("id", "n", "rule"))

    def publish(*batches):
        control.add(*batches)
        rules.publish(control.stream(), f"{progress}-rules")

    data.add([(1, 0), (2, 0)])
    assert look_up() == []  # no snapshot yet
    publish([(1, 1, "a"), (1, 2, "b")])
    data.add([(1, 1), (2, 1), (3, 1), (None, 1)])
    seen = [(1, 1, "a"), (2, 1, "b")]
    assert look_up() == seen
    publish([(2, 2, "c"), (2, 3, "d")])
    data.add([(1, 2), (2, 2), (3, 2)])  # 1 is in the old snapshot only
    seen = sorted([*seen, (2, 2, "c"), (3, 2, "d")], key=str)
    assert look_up() == seen
    # the batch comes again after another snapshot: it keeps the one it took
    publish([(3, 1, "e")])
    forget_last_commit(progress)
    assert look_up() == seen
    # an older version published late does not win; a version that comes again replaces itself; an empty one has no entries
    publish([(2, 9, "late")], [(3, 2, "f")])
    data.add([(1, 3), (2, 3), (9, 3)])
    seen = sorted([*seen, (2, 3, "f")], key=str)
    assert look_up() == seen
    publish([(4, None, None)])
    data.add([(1, 4), (2, 4), (None, 4)])
    assert look_up() == seen
    with pytest.raises(ForeignTarget):
        stream_snapshot_lookup(data.stream(), rules, [("id", "id")], {"rule": "string"}, path, f"{progress}-other")


# Event-time versions over two streams


LOG, MAPS = "id int, k string, t int", "from int, k string, v string"


def _asof(spark, log, maps, path, progress, delay, **more):
    data = log.stream().withColumn("ts", F.timestamp_seconds("t"))
    control = maps.stream().withColumn("valid_from", F.timestamp_seconds("from"))
    return asof_turns(data, control, "ts", "valid_from", [("k", "k")], {"v": F.lit("")}, True, path, progress, delay, **more)


def test_rows_wait_for_the_version_of_their_time(spark):
    path, progress = places(spark, "asof")
    log = Source(spark, LOG).add([(1, "a", 10), (2, "a", 50), (3, None, 12)])
    maps = Source(spark, MAPS).add([(0, "a", "zero"), (40, "a", "forty")])
    _asof(spark, log, maps, path, progress, 30).run()
    turns = _asof(spark, log, maps, path, progress, 30)
    assert rows(turns.rows().select("id", "v")) == [(1, "zero"), (3, "")]
    waiting = turns.waiting()
    assert [r.data.id for r in waiting.where("side = 'data'").collect()] == [2]
    # both versions are kept: the first is in force at the watermark, the other comes later
    assert rows(waiting.where("side = 'control'").select("control.from")) == [(0,), (40,)]
    # a version that comes late, but before the watermark, counts; a row behind the watermark does not
    log.add([(4, "a", 100), (5, "a", 19), (6, "b", 60)])
    maps.add([(45, "a", "forty-five"), (45, "b", "b"), (90, "c", "ninety")])
    _asof(spark, log, maps, path, progress, 30).run()
    assert rows(turns.rows().select("id", "v")) == [(1, "zero"), (2, "forty-five"), (3, ""), (6, "b")]
    assert rows(turns.late_rows().select("data.id")) == [(5,)]
    assert rows(turns.waiting().where("side = 'control'").select("control.from").distinct()) == [(45,), (90,)]
    forget_last_commit(progress)
    again = _asof(spark, log, maps, path, progress, 30)
    again.run()
    assert rows(again.rows().select("id", "v")) == [(1, "zero"), (2, "forty-five"), (3, ""), (6, "b")]
    for _ in range(2):
        again.finish()
        assert rows(again.rows().select("id", "v")) == [(1, "zero"), (2, "forty-five"), (3, ""), (4, ""), (6, "b")]


def test_a_quiet_control_stream_holds_rows_back(spark):
    path, progress = places(spark, "holds")
    log = Source(spark, LOG).add([(1, "a", 10), (2, "a", 500)])
    maps = Source(spark, MAPS).add([(0, "a", "zero")])
    turns = _asof(spark, log, maps, path, progress, 0, control_holds=True)
    turns.run()
    assert rows(turns.rows().select("id")) == []
    maps.add([(100, "a", "hundred")])
    _asof(spark, log, maps, path, progress, 0, control_holds=True).run()
    assert rows(turns.rows().select("id", "v")) == [(1, "zero")]


@pytest.mark.parametrize("seed", [1, 2])
def test_asof_in_any_order_equals_the_batch(spark, seed):
    rng = random.Random(seed)
    data = [(i, rng.choice("abc"), rng.randrange(1000)) for i in range(120)] + [(900, "a", None)]
    versions = [(f, k, f"{k}{f}") for f in rng.sample(range(1000), 6) for k in rng.sample("abc", 2)]
    rng.shuffle(data)
    path, progress = places(spark, "any")
    log = Source(spark, LOG).add(data[:40], data[40:80], data[80:])
    maps = Source(spark, MAPS).add(versions)
    turns = _asof(spark, log, maps, path, progress, 1000)
    turns.run()
    turns.finish()
    batch = snapshot_lookup(
        spark.createDataFrame(data, LOG).withColumn("ts", F.timestamp_seconds("t")),
        spark.createDataFrame(versions, MAPS).withColumn("valid_from", F.timestamp_seconds("from")),
        "ts", "valid_from", [("k", "k")], {"v": F.lit("")}, True,
    )
    assert rows(turns.rows().select("id", "v")) == rows(batch.select("id", "v"))


# Firings


ARRIVALS = "seq int, k string, t int, c long"


def test_firings_over_any_batches(spark):
    rng = random.Random(5)
    data, now = [], 0
    for i in range(400):
        now += rng.randrange(4)
        data.append((i, rng.choice("ab") if rng.random() < 0.9 else None, max(0, now - rng.choice((0, 0, 0, 3, 8, 15, 40))), rng.randrange(100)))
    whole = spark.createDataFrame(data, ARRIVALS).withColumn("ts", F.timestamp_seconds("t"))
    classified = classify_arrivals(whole, "ts", ["seq"], 10, 3, 12)
    want = firing_log(classified, "ts", ["k"], ["seq"], F.col("c"), 3)
    path, progress = places(spark, "firings")
    source = Source(spark, ARRIVALS)
    cuts = [0, 37, 38, 160, 300, 400]
    for start, end in zip(cuts, cuts[1:], strict=False):
        source.add(data[start:end])
        stream = source.stream().withColumn("ts", F.timestamp_seconds("t"))
        stream_firings(stream, path, progress, "ts", ["k"], ["seq"], F.col("c"), 10, 3, 12)
        if end == 160:
            forget_last_commit(progress)
    assert rows(results(spark, path).select(want.columns)) == rows(want)
    assert rows(results(spark, path, "dropped").select("seq")) == rows(classified.where("arrival_class = 'dropped'").select("seq"))
    # only windows that may still fire are carried on
    tables = CarriedTables(spark, path, progress)
    windows, high = tables.load(tables.last() + 1, "windows", "high")
    mark = high.first()[0] // 1_000_000 - 3
    assert windows.where(F.col("window_end") + 12 <= mark).count() == 0 < windows.count() < 12


# Count windows


@pytest.mark.parametrize("size, slide, keys", [(10, 5, ["k"]), (7, 3, ["k"]), (4, 6, ["k"]), (10, 4, [])])
def test_sliding_counts_over_any_batches(spark, size, slide, keys):
    rng = random.Random(size)
    data = [(i, "hot" if rng.random() < 0.7 else rng.choice(["x", "y", None]), 0, rng.randrange(100)) for i in range(150)]
    measures = {"c": ("sum", "c"), "n": ("count", "seq"), "last": ("max", "seq")}
    want = count_sliding(spark.createDataFrame(data, ARRIVALS), keys, ["seq"], size, slide, measures)
    path, progress = places(spark, "rings")
    source = Source(spark, ARRIVALS)
    for part in (data[:1], data[1:60], data[60:63], data[63:]):
        source.add(part)
        stream_count_sliding(source.stream(), path, progress, keys, ["seq"], size, slide, measures)
    forget_last_commit(progress)
    stream_count_sliding(source.stream(), path, progress, keys, ["seq"], size, slide, measures)
    assert rows(results(spark, path).select(want.columns)) == rows(want) and want.count() > 20
    tables = CarriedTables(spark, path, progress)
    (ring,) = tables.load(tables.last() + 1, "ring")
    runs = ring.groupBy(*keys).count().agg(F.max("count")).first()[0]
    assert runs <= size // np.gcd(size, slide) + 1


# Functions that see all rows of a window


def test_a_window_streams_through_the_function(spark):
    def first_and_longest(key, start, end, pieces):
        n, last, rises, sizes = 0, None, 0, 0
        for frame in pieces:
            sizes = max(sizes, len(frame))
            for c in frame["c"]:
                n, rises, last = n + 1, rises + (last is not None and c > last), c
        yield key[0], n, rises, sizes

    data = [(i, "hot", i % 50, (i * 7919) % 101) for i in range(9000)] + [(i, None, i, i) for i in range(20)] + [(1, "x", None, 5)]
    df = spark.createDataFrame(data, ARRIVALS).withColumn("ts", F.timestamp_seconds("t"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = window_process(df, "ts", "60 seconds", ["k"], ["seq"], first_and_longest, "name string, n int, rises int, piece int").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    hot = [c for _, k, _, c in data if k == "hot"]
    rises = sum(b > a for a, b in zip(hot, hot[1:], strict=False))
    assert {(r.k, r.name, r.n, r.rises) for r in got} == {("hot", "hot", 9000, rises), (None, None, 20, 19)}
    assert max(r.piece for r in got) <= 1000  # the window came in pieces
    assert [(r.window_end - r.window_start).seconds for r in got] == [60, 60]


def test_a_function_need_not_take_all_rows(spark):
    def one(key, start, end, pieces):
        yield (int(next(pieces)["c"].iloc[0]),)

    data = [(i, f"k{i % 40}", 0, i) for i in range(4000)]
    df = spark.createDataFrame(data, ARRIVALS).withColumn("ts", F.timestamp_seconds("t"))
    got = window_process(df, "ts", "60 seconds", ["k"], ["seq"], one, "c0 int")
    assert {(r.k, r.c0) for r in got.collect()} == {(f"k{i}", i) for i in range(40)}
    assert window_process(df.limit(0), "ts", "60 seconds", ["k"], ["seq"], one, "c0 int").collect() == []


def test_window_functions_on_a_stream(spark):
    def listed(key, start, end, pieces):
        yield (" ".join(str(c) for frame in pieces for c in frame["c"]),)

    def turns(stream):
        return window_turns(stream.withColumn("ts", F.timestamp_seconds("t")), path, progress, "ts", "10 seconds", ["k"], ["t", "seq"], listed, "cs string", 5)

    path, progress = places(spark, "listed")
    source = Source(spark, ARRIVALS).add([(1, "a", 8, 80), (2, "a", 1, 10), (3, "b", 12, 1), (4, None, None, 9)])
    turns(source.stream()).run()
    job = turns(source.stream())
    assert rows(job.rows().select("k", "cs")) == []  # the watermark is at 7
    source.add([(5, "a", 5, 50), (6, "b", 19, 2)], [(7, "a", 9, 90), (8, "b", 11, 0)])
    turns(source.stream()).run()
    assert rows(job.rows().select("k", "cs")) == [("a", "10 50 80")]
    assert rows(job.late_rows().select("seq")) == [(7,)]
    forget_last_commit(progress)
    turns(source.stream()).run()
    job.finish()
    assert rows(job.rows().select("k", "cs")) == [("a", "10 50 80"), ("b", "0 1 2")]


# Session joins


def test_sessions_of_two_streams(spark):
    schema = "k string, t int, id int"

    def timed(df):
        return df.withColumn("ts", F.timestamp_seconds("t"))

    rng = random.Random(11)
    sides = [sorted([("abc"[rng.randrange(3)], rng.randrange(400), i) for i in range(80)], key=lambda r: r[1]) for _ in range(2)]
    want = session_join(*(timed(spark.createDataFrame(s, schema)) for s in sides), ["k"], "ts", F.expr("interval 7 seconds"))
    path, progress = places(spark, "sessions")
    one, two = (Source(spark, schema).add(s[:30], s[30:31], s[31:]) for s in sides)

    def turns():
        return session_join_turns(timed(one.stream()), timed(two.stream()), path, progress, ["k"], "ts", 7, 0)

    turns().run()
    closed = rows(turns().rows().select("k", "session_start", "l_id", "r_id"))
    every = rows(want.select("k", "session_start", "l_id", "r_id"))
    assert set(closed) < set(every) or closed == every
    mark = min(max(r[1] for r in s) for s in sides)
    ends = {(k, s) for k, s, *_ in every} - {(k, s) for k, s, *_ in closed}
    assert len(closed) > 0 and all(max(t for s in sides for k2, t, _ in s if k2 == k) + 7 > mark for k, _ in ends)
    forget_last_commit(progress)
    turns().run()
    turns().finish()
    assert rows(turns().rows().select("k", "session_start", "l_id", "r_id")) == every


# Watermark of several inputs


def test_watermark_of_two_inputs(spark):
    """The slower stream's rows count under the least watermark, and are late under the largest."""
    counted = {}
    for policy in ("min", "max"):
        fast = Source(spark, LOG).add(*([(i, "f", t)] for i, t in enumerate((5, 500, 501, 502, 503))))
        slow = Source(spark, LOG).add(*([(i, "s", t)] for i, t in enumerate((1, 2, 6, 7, 8))))
        both = [with_event_time(s.stream().withColumn("ts", F.timestamp_seconds("t")), "ts", "1 second") for s in (fast, slow)]
        path, progress = places(spark, policy)
        spark.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
        try:
            update_files(tumbling(both[0].unionByName(both[1]), "ts", "10 seconds", [], F.count("*").alias("n")), path, progress)
        finally:
            spark.conf.unset("spark.sql.streaming.multipleWatermarkPolicy")
        counted[policy] = current_rows(spark, path, ["window_start", "window_end"]).agg(F.sum("n")).first()[0]
    assert counted["max"] < counted["min"] == 10


def test_a_quiet_input_closes_no_window(spark):
    fast, slow = Source(spark, LOG).add([(1, "f", 5)], [(2, "f", 500)]), Source(spark, LOG)
    both = [with_event_time(s.stream().withColumn("ts", F.timestamp_seconds("t")), "ts", "1 second") for s in (fast, slow)]
    path, progress = places(spark, "quiet")
    append_files(tumbling(both[0].unionByName(both[1]), "ts", "10 seconds", [], F.count("*").alias("n")), path, progress)
    assert spark.read.schema("n long").parquet(path).count() == 0


# Reducing state


def test_reducing_state_is_wiped(spark):
    path, progress = places(spark, "reduced")
    source = Source(spark, "k string, seq int, v int")

    def newest():
        update_files(stream_reduced(source.stream(), "k", "v", "seq", np.max, F.col("v") < 0), path, progress)
        return {r.k: (r.value, r.n) for r in current_rows(spark, path, ["k"]).collect()}

    source.add([("a", 1, 5), ("a", 2, 9), ("b", 3, 7), ("b", 4, None), (None, 5, 1)])
    assert newest() == {"a": (9, 2), "b": (7, 1), None: (1, 1)}
    source.add([("a", 7, 3), ("a", 6, -1), ("a", 5, 99), ("b", 8, 2)])
    assert newest() == {"a": (3, 1), "b": (7, 2), None: (1, 1)}
    source.add([("a", 9, -1), ("b", 10, 8)])
    assert newest() == {"a": (None, 0), "b": (8, 3), None: (1, 1)}
    source.add([("a", 11, 4)])
    assert newest()["a"] == (4, 1)


def test_state_expires(spark):
    """A key that got no row for longer than its time to live starts anew."""
    import time

    path, progress = places(spark, "expiring")
    source = Source(spark, "k string, seq int, v int").add([("a", 1, 5), ("a", 2, 9)])

    def run():
        update_files(stream_reduced(source.stream(), "k", "v", "seq", np.max, ttl_s=4), path, progress, only_new=True)
        update_files(stream_distinct(source.stream(), "k", "v", ttl_s=4), f"{path}-items", f"{progress}-items", only_new=True)
        (one,), (items,) = current_rows(spark, path, ["k"]).collect(), current_rows(spark, f"{path}-items", ["k"]).collect()
        return one.value, one.n, items.n_distinct

    assert run() == (9, 2, 2)
    time.sleep(5)
    source.add([("a", 3, 1)])
    assert run() == (1, 1, 1)


def test_document_state_is_bounded(spark, sf_dir):
    """The document job forgets windows behind its watermark."""
    from tidemill.catalog.base import events
    from tidemill.catalog.rows import traffic_log
    from tidemill.plans.jobs import traffic_documents
    from tidemill.sinks.keyed import KeyedTable

    path, progress = places(spark, "documents")
    lines = traffic_log(_in_files(events(spark, sf_dir), "event_id"))
    target = KeyedTable(path, ("id",))
    target.upsert(traffic_documents(lines, delay="10 seconds"), progress)
    held = spark.read.format("statestore").option("path", progress).load().count()
    assert held <= 20 < target.rows(spark).count()


# Arrivals of the stream queries


def test_arrivals_keep_every_row(spark):
    df = spark.createDataFrame([(i, i % 7) for i in range(50)] + [(None, 1)] * 9, "id long, v int")
    stream = _in_files(df, "id", [0, 2, 3, 1])
    path, progress = places(spark, "copied")
    append_files(stream, path, progress)
    assert rows(spark.read.parquet(path)) == rows(df)
    assert [int(f) for f in sorted(os.listdir(f"{progress}/commits")) if f.isdigit()] == [0, 1, 2, 3]
    empty = _in_files(df.limit(0), "id")
    append_files(empty, f"{path}-empty", f"{progress}-empty")
    assert spark.read.schema("id long").parquet(f"{path}-empty").count() == 0


def test_queries_over_rows_without_ids(spark, tmp_path, sf_dir):
    """Events without an id, a user or a time are in the answers of the queries that cut by these."""
    odd = spark.read.parquet(f"{sf_dir}/events.parquet").limit(300)
    nothing = {"event_id": "long", "user_id": "long", "ts": "timestamp_ntz"}
    extra = odd.limit(5).withColumns({c: F.lit(None).cast(t) for c, t in nothing.items()})
    odd.unionByName(extra.select(odd.columns)).write.parquet(f"{tmp_path}/events.parquet")
    n = 305
    assert QUERIES["sink_ledger"].run(spark, str(tmp_path)).count() == n
    assert QUERIES["update_two_queries"].run(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == n
    assert QUERIES["stream_resume"].run(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == n
    assert QUERIES["stream_state"].run(spark, str(tmp_path)).agg(F.sum("n")).first()[0] == n
    assert QUERIES["list_push_batches"].run(spark, str(tmp_path)).count() == n
    words = {r.word: r.n for r in QUERIES["stream_line_words"].run(spark, str(tmp_path)).collect()}
    assert sum(words[t] for t in {r.event_type for r in odd.select("event_type").distinct().collect()}) == n
