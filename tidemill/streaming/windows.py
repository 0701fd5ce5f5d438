"""Windows, joins and de-duplication on streams with watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.sessions import label_sessions
from tidemill.operators.shape import split_words
from tidemill.operators.temporal import session_pairs
from tidemill.operators.windows import WindowFunction, window_rows
from tidemill.session import written
from tidemill.streaming.runs import with_event_time
from tidemill.streaming.turns import Turns


def stream_session_totals(stream: DataFrame, keys: Sequence[str], ts: str, gap_s: float, *aggregates: Column) -> DataFrame:
    """Sessions of a watermarked stream; rows exactly one gap apart are separate sessions.

    The built-in session window joins rows at exactly the gap, so it is given one microsecond less, and the end is
    moved back.
    """
    micros = round(gap_s * 1_000_000) - 1
    window = F.session_window(ts, f"{micros} microseconds").alias("session")
    # a streaming session needs a key, and a literal one would be optimized away
    one_key = F.pmod(F.unix_micros(ts), F.lit(1)).alias("_all")
    summed = stream.groupBy(*(keys or [one_key]), window).agg(*aggregates)
    end = F.col("session.end") + F.make_dt_interval(secs=F.lit(0.000001))
    rest = [c for c in summed.columns if c not in (*keys, "session", "_all")]
    return summed.select(*keys, F.col("session.start").alias("session_start"), end.alias("session_end"), *rest)


def stream_totals(stream: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Running aggregates per key without a window; run it in update mode. Keys stay in state for good."""
    return stream.groupBy(*keys).agg(*aggregates)


def stream_distinct_rows(stream: DataFrame, ts: str, keys: Sequence[str], delay: str) -> DataFrame:
    """The first row of each key; a repeat counts as one while it arrives within the delay."""
    return with_event_time(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def stream_word_windows(
    lines: DataFrame, ts: str, text: str, size: str, delay: str, slide: str | None = None
) -> DataFrame:
    """Word counts per event-time window, tumbling or sliding: ``window_start, window_end, word, n``."""
    words = split_words(with_event_time(lines, ts, delay).select(ts, text), text)
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    counts = words.groupBy(window.alias("w"), "word").agg(F.count("*").alias("n"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "word", "n")


def window_turns(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    ts: str,
    size: str,
    keys: Sequence[str],
    order: Sequence[str],
    function: WindowFunction,
    schema: str,
    delay_s: float,
) -> Turns:
    """``window_process`` on a stream: ``run()`` the result for what has arrived, ``finish()`` it at the end.

    A window's rows wait until the watermark reaches its end; then the function sees all of them in order, with key and
    bounds. Rows of a window that has fired go to ``late_rows``. Rows without a time are in no window.
    """

    window = F.window(F.col(ts).cast("timestamp"), size)
    placed = stream.where(F.col(ts).isNotNull()).withColumn("_w", window)
    placed = placed.withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")}).drop("_w")
    end = F.unix_micros("window_end")

    def step(rows: DataFrame, passed: int) -> tuple[DataFrame, DataFrame]:
        due = end <= F.lit(passed)
        return window_rows(rows.where(due), keys, order, function, schema), rows.where(~due)

    return Turns(placed, path, checkpoint, ts, delay_s, step, lambda passed: end <= F.lit(passed))


def session_join_turns(
    left: DataFrame, right: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str, gap_s: float, delay_s: float
) -> Turns:
    """``session_join`` of two streams: ``run()`` the result for what has arrived, ``finish()`` it at the end.

    Rows of both sides wait together; a session is closed, and its pairs come out, when the watermark has reached the end
    of its gap. The watermark is the least of both sides', so a quiet side keeps sessions open. A row that the watermark has
    passed by the gap goes to ``late_rows``, as its session may be closed.
    """
    gap, micros = F.make_dt_interval(secs=F.lit(float(gap_s))), round(gap_s * 1_000_000)

    def tagged(df: DataFrame, side: str) -> DataFrame:
        none = {"l": F.lit(None).cast(left.schema), "r": F.lit(None).cast(right.schema)}
        structs = [(F.struct(*df.columns) if name == side else empty).alias(name) for name, empty in none.items()]
        return df.where(F.col(ts).isNotNull()).select(*keys, F.col(ts).cast("timestamp").alias(ts), F.lit(side).alias("side"), *structs)

    def step(rows: DataFrame, passed: int) -> tuple[DataFrame, DataFrame]:
        labelled = written(label_sessions(rows, keys, ts, gap), "labelled")
        own = [*keys, "session_start"]
        last = labelled.groupBy(*own).agg((F.unix_micros(F.max(ts)) + micros).alias("_end"))
        closed = last.where(F.col("_end") <= F.lit(passed)).select(*(F.col(c).alias(f"_of_{c}") for c in own))
        on = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in own]
        due = labelled.join(closed, on, "left_semi")
        return session_pairs(due, left.columns, right.columns, keys), labelled.join(closed, on, "left_anti").select(*rows.columns)

    def late(passed: int) -> Column:
        return F.unix_micros(ts) + micros <= F.lit(passed)

    both = tagged(left, "l").unionByName(tagged(right, "r"))
    return Turns(both, path, checkpoint, ts, delay_s, step, late, F.col("side"), ("l", "r"))
