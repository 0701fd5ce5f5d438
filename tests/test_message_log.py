"""The message log as a streaming source, and the two-phase file sink: positions, new partitions, failures, replays."""

import os

import pytest
from pyspark.sql import functions as F

from test_turns import Source, forget_last_commit, places, rows
from tidemill.session import new_dir
from tidemill.sinks.manifest import COMPACT_EVERY, Manifests, commit_files, committed_rows
from tidemill.sources.message_log import LogReader, append_log, log_rows, stream_log
from tidemill.streaming.runs import append_files


def messages(spark, *parts):
    """(topic, partition, offsets) as messages whose value is their place; the time is a second per offset."""
    made = [(f"{t}-{p}-{o}".encode(), t, p, o) for t, p, offsets in parts for o in offsets]
    df = spark.createDataFrame(made, "value binary, topic string, partition int, offset long")
    return df.select(F.lit(None).cast("binary").alias("key"), "value", "topic", "partition", "offset", F.timestamp_seconds("offset").alias("timestamp"))


@pytest.fixture
def log(spark):
    path = f"{new_dir(spark, 'log')}/log"
    append_log(messages(spark, ("a", 0, range(10)), ("a", 1, range(5, 12)), ("b", 0, range(3))), path)
    return path


def read(spark, path, progress, log, **more):
    append_files(stream_log(spark, log, **more).select(F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp"), path, progress)
    return sorted(r.value for r in spark.read.parquet(path).collect())


def names(*parts):
    return sorted(f"{t}-{p}-{o}" for t, p, offsets in parts for o in offsets)


@pytest.mark.parametrize(
    "start, want",
    [
        ("earliest", [("a", 0, range(10)), ("a", 1, range(5, 12))]),
        ("latest", []),
        ({"a": {0: 7}}, [("a", 0, range(7, 10)), ("a", 1, range(5, 12))]),
        (8000, [("a", 0, range(8, 10)), ("a", 1, range(8, 12))]),
        (99_000, []),
    ],
)
def test_start_positions(spark, log, start, want):
    path, progress = places(spark, "read")
    assert read(spark, path, progress, log, start=start, pattern="a") == names(*want)
    # what comes later is read from there, and a partition that appears from its first message; the start no longer counts
    append_log(messages(spark, ("a", 0, range(10, 12)), ("a", 7, range(40, 43)), ("aa", 0, range(2))), log)
    assert read(spark, path, progress, log, start="latest", pattern="a") == names(*want, ("a", 0, range(10, 12)), ("a", 7, range(40, 43)))


def test_topics_by_pattern(spark, log):
    path, progress = places(spark, "read")
    assert read(spark, path, progress, log, pattern="[bc]") == names(("b", 0, range(3)))
    append_log(messages(spark, ("c", 2, range(4)), ("cc", 0, range(4))), log)
    assert read(spark, path, progress, log, pattern="[bc]") == names(("b", 0, range(3)), ("c", 2, range(4)))


def test_a_replayed_batch_reads_the_same(spark, log):
    path, progress = places(spark, "read")
    read(spark, path, progress, log)
    append_log(messages(spark, ("a", 0, range(10, 14))), log)
    want = read(spark, path, progress, log)
    append_log(messages(spark, ("a", 0, range(14, 20))), log)
    forget_last_commit(progress)
    assert set(read(spark, path, progress, log)) >= set(want)  # the batch again, and perhaps what came since
    assert read(spark, path, progress, log) == sorted([*want, *names(("a", 0, range(14, 20)))])


def test_envelope(spark, log):
    stream = stream_log(spark, log)
    assert [f.name for f in stream.schema.fields] == ["key", "value", "topic", "partition", "offset", "timestamp"]
    path, progress = places(spark, "whole")
    append_files(stream, path, progress)
    assert rows(spark.read.parquet(path)) == rows(log_rows(spark, log)) and log_rows(spark, log).count() == 20


def test_positions_without_spark(spark, log):
    """A task per file with something to read; an offset between two files belongs to the second."""
    append_log(messages(spark, ("b", 0, range(3, 6))), log)
    reader = LogReader({"path": log, "pattern": "b", "start": '"latest"'})
    assert reader.initialOffset() == {"b": {"0": 6}} == reader.latestOffset()
    pieces = reader.partitions({"b": {"0": 3}}, {"b": {"0": 5}})
    assert len(pieces) == 1 and [b.column("offset").to_pylist() for b in reader.read(pieces[0])] == [[3, 4]]
    assert len(reader.partitions({}, {"b": {"0": 6}})) == 2 and reader.partitions({"b": {"0": 6}}, {"b": {"0": 6}}) == []
    assert LogReader({"path": f"{log}-none"}).latestOffset() == {}


# Two-phase commits


NUMBERS = "id int, bad boolean"


def test_batches_are_all_or_nothing(spark):
    """A failing task, a failing commit, a batch published before the query died: nothing is lost, nothing shows twice."""
    path, progress = places(spark, "committed")
    source = Source(spark, NUMBERS).add([(1, False), (2, False)])

    def seen():
        return rows(committed_rows(spark, path, "id int"))

    def run(fails=False):
        broken = F.when(F.col("bad"), F.raise_error(F.lit("a bad row"))).otherwise(F.lit(None).cast("string"))
        checked = source.stream().where(broken.isNull()) if fails else source.stream()
        commit_files(checked.select("id"), path, progress)

    assert seen() == []
    run()
    assert seen() == [(1,), (2,)]
    source.add([(3, False), (4, True)])
    with pytest.raises(Exception, match="a bad row"):
        run(fails=True)
    assert seen() == [(1,), (2,)]  # the other task's file shows nowhere
    blocked = Manifests(path)._place(2)
    os.makedirs(f"{blocked}/in-the-way")
    with pytest.raises(Exception):
        run()
    assert seen() == [(1,), (2,)]
    os.rmdir(f"{blocked}/in-the-way")
    os.rmdir(blocked)
    run()
    assert seen() == [(1,), (2,), (3,), (4,)]
    forget_last_commit(progress)
    run()
    assert seen() == [(1,), (2,), (3,), (4,)]
    files = [f for f in os.listdir(f"{path}/data") if f.endswith(".parquet")]
    assert set(Manifests(path).current()) <= set(files)
    with pytest.raises(Exception, match="belongs to query"):
        commit_files(source.stream().select("id"), path, f"{progress}-of-another")
    assert seen() == [(1,), (2,), (3,), (4,)]


def test_readers_open_few_manifests(tmp_path):
    table = Manifests(str(tmp_path))
    opened = []
    real = table._open
    table._open = lambda path: opened.append(path) or real(path)
    for batch in range(3 * COMPACT_EVERY + 4):
        table.publish("q", batch, [f"f{batch}"])
    opened.clear()
    assert table.current() == [f"f{i}" for i in range(3 * COMPACT_EVERY + 4)] and len(opened) == 5
    assert table.has(3) and not table.has(99) and table.owner() == "q"
