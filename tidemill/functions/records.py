"""Delimited and JSON records to typed rows, with the rejected ones kept apart."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.functions.text import field, fields
from tidemill.functions.times import LOG_TIME, parse_time


def typed_fields(
    df: DataFrame, line: str, separator: str, schema: Sequence[tuple[str, str]], strict: bool = True
) -> DataFrame:
    """A delimited line as typed columns, by position.

    ``strict`` fails the job on a value that does not parse; otherwise such a value becomes null.
    """
    parts = fields(F.col(line), separator, drop_trailing_empty=False)
    rest = [c for c in df.columns if c != line]
    split = df.withColumn("_f", parts)
    typed = [
        (field(F.col("_f"), i).cast(kind) if strict else field(F.col("_f"), i).try_cast(kind)).alias(name)
        for i, (name, kind) in enumerate(schema)
    ]
    return split.select(*rest, *typed)


def has_fields(line: Column, separator: str, count: int) -> Column:
    """True for a non-empty line with exactly ``count`` fields."""
    whole = F.coalesce(line, F.lit(""))
    return (F.length(whole) > 0) & (F.size(fields(whole, separator)) == count)


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(kept rows, rejected rows); a null verdict rejects."""
    verdict = F.coalesce(valid, F.lit(False))
    return df.where(verdict), df.where(~verdict)


def must_hold(df: DataFrame, valid: Column, message: str) -> DataFrame:
    """Strict mode: the job fails on the first row that does not satisfy ``valid``."""
    checked = F.when(F.coalesce(valid, F.lit(False)), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return df.where(checked)


# Field positions of the traffic log line and the level that counts as business traffic.
TRAFFIC_FIELDS = {"level": 2, "time": 3, "domain": 5, "traffic": 6}
BUSINESS_LEVEL = "E"


def traffic_fields(df: DataFrame, line: str = "value") -> DataFrame:
    """Tab separated traffic log lines as ``level, time_text, ts, domain, traffic``; ``ts`` is null for a bad time."""
    part = {n: field(F.col("_f"), i) for n, i in TRAFFIC_FIELDS.items()}
    rest = [c for c in df.columns if c != line]
    return df.withColumn("_f", fields(F.col(line), "\t")).select(
        *rest,
        part["level"].alias("level"),
        part["time"].alias("time_text"),
        parse_time(part["time"], LOG_TIME).alias("ts"),
        part["domain"].alias("domain"),
        part["traffic"].try_cast("long").alias("traffic"),
    )


def clean_traffic(df: DataFrame, line: str = "value") -> tuple[DataFrame, DataFrame]:
    """(clean rows ``ts, domain, traffic`` of the business level, rows rejected for their time or traffic value)."""
    kept, rejected = split_valid(traffic_fields(df, line), F.col("ts").isNotNull() & F.col("traffic").isNotNull())
    return kept.where(F.col("level") == BUSINESS_LEVEL).drop("level", "time_text"), rejected


def json_fields(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """A JSON text column replaced by its fields."""
    rest = [c for c in df.columns if c != column]
    return df.withColumn("_j", F.from_json(F.col(column).cast("string"), schema)).select(*rest, "_j.*")


def as_json(*columns: str) -> Column:
    """A JSON message of the named columns."""
    return F.to_json(F.struct(*columns))
