"""Compare a query with its SQL twin: same columns, same types by family, same rows in any order."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads TO 8")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(df: pd.DataFrame) -> Counter:
    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
            return None
        if hasattr(v, "item"):
            v = v.item()
        return round(v, 6) if isinstance(v, float) else v

    columns = sorted(df.columns)
    return Counter(tuple(cell(v) for v in row) for row in df[columns].itertuples(index=False, name=None))


def kind(dtype) -> str:
    return "text" if dtype.kind in "OUT" else {"i": "int", "u": "int", "f": "float", "b": "bool", "M": "time"}.get(dtype.kind, dtype.kind)


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got, want = spark_df.toPandas(), con.sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    types = {c: (str(got[c].dtype), str(want[c].dtype)) for c in got.columns if kind(got[c].dtype) != kind(want[c].dtype)}
    if types:
        return f"types {types}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not len(want):
        return "both answers are empty: nothing is compared"
    a, b = normal(got), normal(want)
    if a != b:
        return f"rows only here {list((a - b).items())[:3]}, only in SQL {list((b - a).items())[:3]}"
    return None
