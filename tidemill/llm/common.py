"""Helpers the operators share: text normal forms as columns, free column names, registry of the queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import use_utc

# White space as the contracts define it, and the letters they lower-case.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = "[\\x20\\x09-\\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_MOST_BYTES = 4 << 20

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class LlmQuery:
    run: Run
    sql: str | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all other letters as they are. Pure ASCII text takes the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, UPPER.lower())
    )


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores added until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with a new text, and its length where the table keeps one; same columns in the same order."""
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.char_length(text).cast(docs.schema["n_chars"].dataType)
    return docs.withColumns(changed)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_batches(spark: SparkSession) -> SparkSession:
    """Texts go to Python workers in batches of a few megabytes, however long they are."""
    if spark.conf.get(_BATCH_BYTES) != str(_MOST_BYTES):
        spark.conf.set(_BATCH_BYTES, str(_MOST_BYTES))
    return spark
