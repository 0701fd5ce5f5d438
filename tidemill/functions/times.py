"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date-time formats of the log inputs, labels and bucket folders.
LOG_TIME = "yyyy-MM-dd HH:mm:ss"
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"
MINUTE_LABEL = "yyyy-MM-dd HH:mm"
BUCKET_LABEL = "yyyy-MM-dd--HHmm"


def from_millis(millis: Column) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(millis)


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def parse_time(text: Column, pattern: str = LOG_TIME) -> Column:
    """The timestamp, or null when the text does not follow the pattern."""
    return F.try_to_timestamp(text, F.lit(pattern))


def second_label(ts: Column) -> Column:
    return F.date_format(ts, LOG_TIME)


def minute_label(ts: Column) -> Column:
    return F.date_format(ts, MINUTE_LABEL)


def bucket_label(ts: Column) -> Column:
    return F.date_format(ts, BUCKET_LABEL)


def day_and_time(text: Column) -> tuple[Column, Column]:
    """``"yyyy-MM-dd HH:mm:ss"`` as its date part and its time part."""
    parts = F.split(text, " ")
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def arrival_time() -> Column:
    """The processing time: when the micro-batch or the batch job that holds the row runs. For windows by arrival."""
    return F.current_timestamp()
