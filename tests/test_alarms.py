"""The rising-value alarm against a row-by-row reading of its rule."""

import random

import pytest
from pyspark.sql import functions as F

from tidemill.operators.alarms import rising_alarms
from tidemill.operators.slices import ROWS_PER_SLICE


@pytest.fixture(autouse=True)
def small_slices(spark):
    spark.conf.set(ROWS_PER_SLICE, "60")
    yield
    spark.conf.unset(ROWS_PER_SLICE)

RACKS = [(1, 65.0, 0), (1, 66.0, 1), (1, 50.0, 2), (2, 65.0, 0), (2, 64.0, 1), (3, 61.0, 0), (3, 62.0, 7)]


def readings(spark, data):
    """(rack, temperature, second) rows in arrival order."""
    rows = [(r, t, s, i) for i, (r, t, s) in enumerate(data)]
    df = spark.createDataFrame(rows, "rack int, temperature double, s long, seq long")
    return df.withColumn("ts", F.timestamp_seconds("s"))


def step_by_step(data, hold, reset):
    """(rack, opened, first, peak) of every alarm."""
    out, by_rack = [], {}
    for i, (rack, value, s) in enumerate(data):
        by_rack.setdefault(rack, []).append((s, i, value))
    for rack, series in by_rack.items():
        listed = []  # (time, value)

        def close():
            if len(listed) > 1:
                out.append((rack, listed[0][0], listed[0][1], listed[-1][1]))

        for s, _, value in sorted(series):
            if listed and s > listed[0][0] + hold:
                close()
                listed = []
            if listed and reset and value < listed[-1][1]:
                listed = []
            elif value >= 60 and (not listed or value > listed[-1][1]):
                listed.append((s, value))
        close()
    return sorted(out)


def found(df):
    return sorted((r["rack"], int(r["opened_at"].timestamp()), r["first_value"], r["peak_value"]) for r in df.collect())


@pytest.mark.parametrize("reset,racks", [(False, {1}), (True, set())])
def test_golden(spark, reset, racks):
    alarms = rising_alarms(readings(spark, RACKS), "rack", "ts", "temperature", "seq", reset_on_drop=reset)
    assert {r["rack"] for r in alarms.collect()} == racks


@pytest.mark.parametrize("reset", [False, True])
@pytest.mark.parametrize("hold,spread", [(5, 3000), (40, 900), (400, 2000), (3, 40)])
def test_matches_step_by_step(spark, reset, hold, spread):
    """Heavy racks are cut into slices; holds shorter and longer than a slice; many readings at one instant."""
    rng = random.Random(hold * 10 + reset)
    data = [
        (1 if rng.random() < 0.5 else rng.randint(2, 12), float(rng.randint(55, 75)), rng.randint(0, spread))
        for _ in range(500)
    ]
    got = rising_alarms(readings(spark, data).repartition(5), "rack", "ts", "temperature", "seq", 60.0, hold, reset)
    assert found(got) == step_by_step(data, hold, reset)
