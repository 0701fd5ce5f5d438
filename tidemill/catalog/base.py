"""Registry of the named queries: a Spark job over the tables of a folder, and where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import use_utc

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a job under a name; ``sql`` gives the same rows from the same tables."""

    def add(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with its time as an instant (stored zone-less, meant as UTC)."""
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def seconds(n: float) -> Column:
    """An interval of ``n`` seconds."""
    return F.make_dt_interval(secs=F.lit(n))


# SQL fragments shared by the twins.


def sql_cents(amount: str) -> str:
    return f"CAST(floor({amount} * 100 + 0.5) AS BIGINT)"


def sql_money(amount: str) -> str:
    return f"CAST(SUM({sql_cents(amount)}) AS DOUBLE) / 100"


def sql_window(ts: str, size_s: int) -> str:
    """Start of the window holding ``ts``, in epoch seconds."""
    return f"((epoch_us({ts}) // {size_s * 1_000_000}) * {size_s})"


def sql_label(seconds_expr: str) -> str:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss``."""
    return f"strftime(make_timestamp(CAST({seconds_expr} AS BIGINT) * 1000000), '%Y-%m-%d %H:%M:%S')"


def sql_ts_label(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"
