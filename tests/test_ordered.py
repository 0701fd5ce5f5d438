"""Ordered passes against plain Python, with heavy keys, ties and nulls, so that slices are really used."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemill.operators.running import Running, change_log, number_rows, running, running_distinct, running_sum
from tidemill.operators.sessions import label_sessions, session_totals
from tidemill.operators.slices import ROWS_PER_SLICE, SLICE, SlicedOrder


@pytest.fixture(autouse=True)
def small_slices(spark):
    spark.conf.set(ROWS_PER_SLICE, "40")
    yield
    spark.conf.unset(ROWS_PER_SLICE)


def skewed_rows(n=600, seed=3):
    """Key 'hot' holds a third of the rows, the rest is spread over many keys; one key is null."""
    rng = random.Random(seed)
    keys = ["hot"] * (n // 3) + [None] * (n // 6) + [f"k{i % 40}" for i in range(n - n // 3 - n // 6)]
    rng.shuffle(keys)
    return [(k, i, rng.randint(-5, 20)) for i, k in enumerate(keys)]


def test_heavy_keys_are_split_and_light_ones_are_not(spark):
    df = spark.createDataFrame(skewed_rows(), "k string, seq long, v int")
    plan = SlicedOrder(df, ["k"], ["seq"])
    per_key = {r["k"]: r["n"] for r in plan.add(df).groupBy("k").agg(F.count_distinct(SLICE).alias("n")).collect()}
    assert per_key["hot"] > 4 and per_key[None] > 4
    assert all(n == 1 for k, n in per_key.items() if k not in ("hot", None))


@pytest.mark.parametrize("keys", [["k"], []])
def test_running_values(spark, keys):
    data = skewed_rows()
    df = spark.createDataFrame(data, "k string, seq long, v int").repartition(7)
    got = running(
        df,
        keys,
        ["seq"],
        [
            Running("n", "count"),
            Running("total", "sum", F.col("v")),
            Running("high", "max", F.col("v"), inclusive=False),
            Running("low", "min", F.col("v")),
        ],
    ).collect()
    want, state = {}, {}
    for k, seq, v in data:
        n, total, high, low = state.get(k if keys else 0, (0, 0, None, None))
        n, total, low = n + 1, total + v, v if low is None else min(low, v)
        want[seq] = (n, total, high, low)
        state[k if keys else 0] = (n, total, v if high is None else max(high, v), low)
    assert {r["seq"]: (r["n"], r["total"], r["high"], r["low"]) for r in got} == want


def test_ties_on_the_first_order_column(spark):
    """Most rows share one position; the second column must still split and order them."""
    rows = [(100 if i % 4 else i, i) for i in range(500)]
    df = spark.createDataFrame(rows, "at long, id long").repartition(5)
    plan = SlicedOrder(df, [], ["at", "id"])
    sizes = [r["count"] for r in plan.add(df).groupBy(SLICE).count().collect()]
    assert max(sizes) < 250
    got = {(r["at"], r["id"]): r["rn"] for r in number_rows(df, [], ["at", "id"]).collect()}
    assert got == {row: i + 1 for i, row in enumerate(sorted(rows))}


def as_type(kind, i):
    """Distinct values that rise with ``i`` in the order Spark gives the type."""
    return {
        "text": f"a common beginning of all {i:05d}",
        "words": ["", "B", "a", "aa", "ab\x00", "b" * 30, "é", "ünder", "日本", "\U0001f600"][i % 10] if i < 10 else f"\U0001f600{i:04d}",
        "nanos": 1_700_000_000_000_000_000 + i * 3,
        "low": -(2**63) + i,
        "date": dt.date(2020, 1, 1) + dt.timedelta(days=i),
        "decimal": Decimal(10**25 + i) / 100,
        "instant": dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=i),
        "flag": i,
    }[kind]


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("kind", ["text", "words", "nanos", "low", "date", "decimal", "instant"])
@pytest.mark.parametrize("repeats", [1, 60])
def test_any_sortable_order(spark, kind, keys, repeats):
    """One key holds most rows; values repeat, and the second column goes against the first one's near ties."""
    types = {"text": "string", "words": "string", "nanos": "long", "low": "long", "date": "date", "decimal": "decimal(38,2)", "instant": "timestamp"}
    n = 420
    data = [("hot" if i % 6 else f"k{i % 4}", as_type(kind, i // repeats), n - i) for i in range(n)]
    df = spark.createDataFrame(data, f"k string, at {types[kind]}, i long").repartition(5)
    assert SlicedOrder(df, keys, ["at", "i"]).split
    got = {r["i"]: r["rn"] for r in number_rows(df, keys, ["at", "i"]).collect()}
    want, seen = {}, {}
    for k, _, i in sorted(data, key=lambda r: (r[1].encode() if isinstance(r[1], str) else r[1], r[2])):
        seen[k if keys else 0] = seen.get(k if keys else 0, 0) + 1
        want[i] = seen[k if keys else 0]
    assert got == want


def test_texts_outside_the_planned_range(spark):
    planned = spark.createDataFrame([(f"pre{i:04d}",) for i in range(200)], "at string")
    used = spark.createDataFrame([(t,) for t in ("a", "pre", "prd9", "pre0005", "pre9", "q", "pre0100")], "at string")
    got = running(used, [], ["at"], [Running("n", "count")], SlicedOrder(planned, [], ["at"])).collect()
    assert [r["at"] for r in sorted(got, key=lambda r: r["n"])] == ["a", "prd9", "pre", "pre0005", "pre0100", "pre9", "q"]


def test_rows_without_a_position_come_last(spark):
    rows = [(i if i % 5 else None, i) for i in range(200)]
    df = spark.createDataFrame(rows, "at long, id long").repartition(5)
    got = {r["id"]: r["rn"] for r in number_rows(df, [], ["at", "id"]).collect()}
    ranked = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    assert got == {i: n + 1 for n, (_, i) in enumerate(ranked)}


def test_sessions_with_most_rows_at_one_instant(spark):
    points = [100] * 300 + [0, 1, 2, 50, 99, 104, 106, 200] * 5
    df = spark.createDataFrame([(t,) for t in points], "s long").repartition(4).withColumn("ts", F.timestamp_seconds("s"))
    assert SlicedOrder(df, [], ["ts"]).has_heavy_ties
    got = session_totals(df, [], "ts", seconds(F.lit(4)), {"n": (F.count("*"), "sum")}).collect()
    found = sorted((int(r["session_start"].timestamp()), int(r["session_end"].timestamp()), r["n"]) for r in got)
    assert found == brute_sessions(points, lambda t: 4, False)


def test_running_sum_golden(spark):
    rows = [("篮球", 1, 1), ("篮球", 2, 2), ("篮球", 3, 3), ("足球", 4, 3), ("足球", 5, 2), ("足球", 6, 3)]
    df = spark.createDataFrame(rows, "k string, seq long, v int")
    got = running_sum(df, ["k"], ["seq"], F.col("v"), "total").orderBy("seq").collect()
    assert [r["total"] for r in got] == [1, 3, 6, 3, 5, 8]


def test_change_log(spark):
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 1), ("a", 3, 2)], "k string, seq long, v int")
    got = change_log(df, ["k"], ["seq"], F.col("v"), "total").orderBy("seq", "op").collect()
    assert [(r["k"], r["op"], r["total"]) for r in got] == [
        ("a", True, 5),
        ("b", True, 1),
        ("a", False, 5),
        ("a", True, 7),
    ]


def test_running_distinct(spark):
    rng = random.Random(5)
    data = [("u" if i % 3 else f"u{i % 7}", i, rng.choice("abcdefgh")) for i in range(400)]
    df = spark.createDataFrame(data, "u string, seq long, item string").repartition(6)
    seen, want = {}, {}
    for u, seq, item in data:
        seen.setdefault(u, set()).add(item)
        want[seq] = len(seen[u])
    got = running_distinct(df, ["u"], "item", "seq").collect()
    assert {r["seq"]: r["n_distinct"] for r in got} == want


def brute_sessions(points, gap_of, touch):
    """Sessions of one key: list of (start, end, count)."""
    out = []
    for t in sorted(points):
        far = out[-1][1] if out else None
        if far is None or (t > far if touch else t >= far):
            out.append([t, t + gap_of(t), 1])
        else:
            out[-1][1] = max(far, t + gap_of(t))
            out[-1][2] += 1
    return sorted(map(tuple, out))


def seconds(col):
    return F.make_dt_interval(secs=col)


def test_session_golden(spark):
    df = spark.createDataFrame([(t,) for t in (0, 3, 5, 12, 15, 24, 30, 42)], "s long")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    got = session_totals(df, [], "ts", seconds(F.lit(6)), {"n": (F.count("*"), "sum")})
    assert sorted((int(r["session_start"].timestamp()), r["n"]) for r in got.collect()) == [
        (0, 3), (12, 2), (24, 1), (30, 1), (42, 1)]


@pytest.mark.parametrize("touch", [False, True])
@pytest.mark.parametrize("dynamic", [False, True])
@pytest.mark.parametrize("keys", [["k"], []])
def test_sessions_match_brute_force(spark, touch, dynamic, keys):
    rng = random.Random(11)
    data = [("hot" if i % 3 == 0 else f"k{rng.randint(0, 30)}", rng.randint(0, 1500)) for i in range(500)]
    # now and then a gap that reaches over several slices
    gap_of = (lambda t: 400 if t % 97 == 0 else t % 5 + 1) if dynamic else (lambda t: 3)
    gap = F.when(F.col("s") % 97 == 0, 400).otherwise(F.col("s") % 5 + 1) if dynamic else F.lit(3)
    df = spark.createDataFrame(data, "k string, s long").repartition(5).withColumn("ts", F.timestamp_seconds("s"))
    got = session_totals(df, keys, "ts", seconds(gap), {"n": (F.count("*"), "sum")}, touch)
    points = {}
    for k, t in data:
        points.setdefault(k if keys else None, []).append(t)
    want = sorted((k or "", *s) for k, ts in points.items() for s in brute_sessions(ts, gap_of, touch))
    rows = sorted(
        (r["k"] if keys else "", int(r["session_start"].timestamp()), int(r["session_end"].timestamp()), r["n"])
        for r in got.collect()
    )
    assert rows == want
    labelled = label_sessions(df, keys, "ts", seconds(gap), touch)
    assert labelled.count() == len(data)
