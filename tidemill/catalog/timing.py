"""Time windows, count windows, sessions, lateness and alarms."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog.base import events, query, seconds, sql_cents, sql_label, sql_ts_label, sql_window
from tidemill.functions.exact import cents, from_cents, money_sum
from tidemill.functions.times import second_label
from tidemill.operators.alarms import rising_alarms
from tidemill.operators.lateness import classify_arrivals, firing_log
from tidemill.operators.sessions import session_totals
from tidemill.operators.windows import (
    count_sliding,
    count_tumbling,
    minute_traffic,
    sampling,
    sliding,
    sliding_panes,
    tumbling,
    window_apply,
)
from tidemill.plans.jobs import rack_alarms

_C = sql_cents("value")


def _labelled(df: DataFrame, *rest: str | Column) -> DataFrame:
    bounds = [second_label(F.col(c)).alias(c) for c in ("window_start", "window_end")]
    return df.select(*bounds, *rest)


def _tumbling_sql(size_s: int, key: str) -> str:
    w = sql_window("ts", size_s)
    return f"""
        SELECT {sql_label(w)} AS window_start, {sql_label(f'{w} + {size_s}')} AS window_end, {key + ',' if key else ''}
               CAST(sum({_C}) AS DOUBLE) / 100 AS total, count(*) AS n
        FROM events GROUP BY ALL
    """


def _sums() -> list[Column]:
    return [money_sum(F.col("value")).alias("total"), F.count("*").alias("n")]


@query("tumbling_sum", _tumbling_sql(3600, "event_type"))
def _tumbling_sum(spark: SparkSession, sf: str) -> DataFrame:
    out = tumbling(events(spark, sf), "ts", "3600 seconds", ["event_type"], *_sums())
    return _labelled(out, "event_type", "total", "n")


@query("tumbling_all", _tumbling_sql(25200, ""))
def _tumbling_all(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(tumbling(events(spark, sf), "ts", "25200 seconds", [], *_sums()), "total", "n")


def _sliding_sql(size_s: int, slide_s: int) -> str:
    starts = ", ".join(f"{sql_window('ts', slide_s)} - {i * slide_s}" for i in range(-(-size_s // slide_s)))
    return f"""
        SELECT {sql_label('w')} AS window_start, {sql_label(f'w + {size_s}')} AS window_end, event_type,
               CAST(sum({_C}) AS DOUBLE) / 100 AS total, count(*) AS n
        FROM (SELECT *, unnest([{starts}]) AS w FROM events)
        WHERE epoch_us(ts) < (w + {size_s}) * 1000000 GROUP BY ALL
    """


@query("sliding_sum", _sliding_sql(7200, 3600))
def _sliding_sum(spark: SparkSession, sf: str) -> DataFrame:
    out = sliding(events(spark, sf), "ts", "7200 seconds", "3600 seconds", ["event_type"], *_sums())
    return _labelled(out, "event_type", "total", "n")


@query("sliding_panes", _sliding_sql(10000, 3600))
def _sliding_panes(spark: SparkSession, sf: str) -> DataFrame:
    """A size that is no multiple of the slide."""
    measures = {"c": ("sum", cents(F.col("value"))), "n": ("count", F.lit(1))}
    out = sliding_panes(events(spark, sf), "ts", 10000, 3600, ["event_type"], measures)
    return _labelled(out, "event_type", from_cents(F.col("c")).alias("total"), "n")


@query(
    "sampling_window",
    f"""
    SELECT {sql_label('w')} AS window_start, {sql_label('w + 7200')} AS window_end, event_type,
           CAST(sum({_C}) AS DOUBLE) / 100 AS total, count(*) AS n
    FROM (SELECT *, {sql_window('ts', 18000)} AS w FROM events)
    WHERE epoch_us(ts) < (w + 7200) * 1000000 GROUP BY ALL
    """,
)
def _sampling_window(spark: SparkSession, sf: str) -> DataFrame:
    out = sampling(events(spark, sf), "ts", 7200, 18000, ["event_type"], *_sums())
    return _labelled(out, "event_type", "total", "n")


@query(
    "window_apply",
    f"""
    SELECT {sql_label(sql_window('ts', 86400))} AS window_start, {sql_label(f"{sql_window('ts', 86400)} + 86400")} AS window_end,
           user_id, count(*) AS n, arg_min({_C}, event_id) AS first_c, arg_max({_C}, event_id) AS last_c
    FROM events GROUP BY ALL
    """,
)
def _window_apply(spark: SparkSession, sf: str) -> DataFrame:
    """A user function that sees key, window and all rows of the window."""

    def describe(rows: pd.DataFrame) -> pd.DataFrame:
        windows = rows.groupby(["user_id", "window_start", "window_end"], sort=False)
        n = windows["n"].sum().reset_index()
        first = rows.loc[windows["first_id"].idxmin(), ["user_id", "window_start", "first_id", "first_c"]]
        last = rows.loc[windows["last_id"].idxmax(), ["user_id", "window_start", "last_id", "last_c"]]
        return n.merge(first, on=["user_id", "window_start"]).merge(last, on=["user_id", "window_start"])

    c = cents(F.col("value"))
    rows = events(spark, sf).select(
        "user_id", "ts", F.lit(1).cast("long").alias("n"), F.col("event_id").alias("first_id"), c.alias("first_c"),
        F.col("event_id").alias("last_id"), c.alias("last_c"),
    )
    schema = (
        "user_id long, window_start timestamp, window_end timestamp, n long, "
        "first_id long, first_c long, last_id long, last_c long"
    )
    out = window_apply(rows, "ts", "86400 seconds", ["user_id"], describe, schema)
    return _labelled(out, "user_id", "n", "first_c", "last_c")


@query(
    "minute_traffic",
    f"""
    SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS time, event_type AS domain, CAST(sum({_C}) AS BIGINT) AS traffics
    FROM events GROUP BY event_type, {sql_window('ts', 60)}
    """,
)
def _minute_traffic(spark: SparkSession, sf: str) -> DataFrame:
    return minute_traffic(events(spark, sf), "ts", "event_type", F.sum(cents(F.col("value"))))


def _count_sql(size: int, key: str) -> str:
    part = f"PARTITION BY {key} " if key else ""
    return f"""
        WITH r AS (SELECT *, row_number() OVER ({part}ORDER BY event_id) - 1 AS rn FROM events)
        SELECT {key + ',' if key else ''} CAST(rn // {size} AS BIGINT) AS window_no, CAST(sum({_C}) AS BIGINT) AS c,
               min(event_id) AS first_id
        FROM r GROUP BY ALL HAVING count(*) = {size}
    """


def _counted_rows(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("event_id", "event_type", "user_id", cents(F.col("value")).alias("v"))


@query("count_tumbling", _count_sql(5, "user_id"))
def _count_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    return count_tumbling(
        _counted_rows(spark, sf), ["user_id"], ["event_id"], 5, F.sum("v").alias("c"), F.min("event_id").alias("first_id")
    )


@query("count_tumbling_hot", _count_sql(7, "event_type"))
def _count_tumbling_hot(spark: SparkSession, sf: str) -> DataFrame:
    """Few keys, each with a large share of the rows."""
    return count_tumbling(
        _counted_rows(spark, sf), ["event_type"], ["event_id"], 7, F.sum("v").alias("c"), F.min("event_id").alias("first_id")
    )


@query("count_tumbling_all", _count_sql(5, ""))
def _count_tumbling_all(spark: SparkSession, sf: str) -> DataFrame:
    return count_tumbling(
        _counted_rows(spark, sf), [], ["event_id"], 5, F.sum("v").alias("c"), F.min("event_id").alias("first_id")
    )


def _count_sliding_sql(size: int, slide: int, key: str) -> str:
    part = f"PARTITION BY {key} " if key else ""
    frame = f"OVER ({part}ORDER BY event_id ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW)"
    return f"""
        WITH r AS (
            SELECT *, row_number() OVER ({part}ORDER BY event_id) AS upto, CAST(sum({_C}) {frame} AS BIGINT) AS c,
                   count(*) {frame} AS n, max(event_id) {frame} AS last_id
            FROM events)
        SELECT {key + ',' if key else ''} upto, c, n, last_id FROM r WHERE upto % {slide} = 0
    """


_COUNT_MEASURES = {"c": ("sum", "v"), "n": ("count", "event_id"), "last_id": ("max", "event_id")}


@query("count_sliding", _count_sliding_sql(10, 5, "user_id"))
def _count_sliding(spark: SparkSession, sf: str) -> DataFrame:
    return count_sliding(_counted_rows(spark, sf), ["user_id"], ["event_id"], 10, 5, _COUNT_MEASURES)


@query("count_sliding_all", _count_sliding_sql(10, 4, ""))
def _count_sliding_all(spark: SparkSession, sf: str) -> DataFrame:
    return count_sliding(_counted_rows(spark, sf), [], ["event_id"], 10, 4, _COUNT_MEASURES)


def _session_sql(gap_s: int, key: str) -> str:
    part = f"PARTITION BY {key} " if key else ""
    return f"""
        WITH m AS (
            SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < {gap_s * 1_000_000} THEN 0 ELSE 1 END AS opened
            FROM events WINDOW w AS ({part}ORDER BY ts, event_id)),
        s AS (SELECT *, sum(opened) OVER ({part}ORDER BY ts, event_id) AS no FROM m)
        SELECT {key + ',' if key else ''} {sql_ts_label('min(ts)')} AS session_start,
               {sql_ts_label(f'max(ts) + INTERVAL {gap_s} SECOND')} AS session_end,
               count(*) AS n, CAST(sum({_C}) AS BIGINT) AS c
        FROM s GROUP BY {key + ',' if key else ''} no
    """



def _sessions(rows: DataFrame, keys: list[str], gap: Column, touch: bool = False) -> DataFrame:
    totals = {"n": (F.count("*"), "sum"), "c": (F.sum(cents(F.col("value"))), "sum")}
    out = session_totals(rows, keys, "ts", gap, totals, touch)
    bounds = [second_label(F.col(c)).alias(c) for c in ("session_start", "session_end")]
    return out.select(*keys, *bounds, "n", "c")


@query("session_gap", _session_sql(28800, "user_id"))
def _session_gap(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(events(spark, sf), ["user_id"], seconds(28800))


@query("session_hot", _session_sql(1200, "event_type"))
def _session_hot(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(events(spark, sf), ["event_type"], seconds(1200))


@query("session_all", _session_sql(600, ""))
def _session_all(spark: SparkSession, sf: str) -> DataFrame:
    return _sessions(events(spark, sf), [], seconds(600))


@query(
    "session_dynamic",
    f"""
    WITH g AS (SELECT *, epoch_us(ts) AS t_us, epoch_us(ts) + (7200 + {_C}) * 1000000 AS until FROM events),
    m AS (
        SELECT *, CASE WHEN t_us <= max(until) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                       THEN 0 ELSE 1 END AS opened FROM g),
    s AS (SELECT *, sum(opened) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM m)
    SELECT user_id, {sql_ts_label('min(ts)')} AS session_start, {sql_ts_label('make_timestamp(max(until))')} AS session_end,
           count(*) AS n, CAST(sum({_C}) AS BIGINT) AS c
    FROM s GROUP BY user_id, no
    """,
)
def _session_dynamic(spark: SparkSession, sf: str) -> DataFrame:
    """Each event keeps its session open for two hours plus a second per cent of its value."""
    gap = F.make_dt_interval(secs=cents(F.col("value")) + 7200)
    return _sessions(events(spark, sf), ["user_id"], gap, touch=True)


# Arrival order: events come in bursts out of order, up to six hours late.
_ARRIVAL_SQL = "SELECT *, epoch_us(ts) // 1000000 + (event_id * 7919 % 13) * 1800 AS arrived FROM events"
SIZE, DELAY, LATENESS = 7200, 10800, 7200

CLASSES_SQL = f"""
    WITH a AS ({_ARRIVAL_SQL}),
    m AS (
        SELECT *, {sql_window('ts', SIZE)} AS w,
               max(epoch_us(ts)) OVER (ORDER BY arrived, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                   - {DELAY * 1_000_000} AS mark
        FROM a),
    k AS (
        SELECT *, CASE WHEN mark IS NULL OR mark < (w + {SIZE}) * 1000000 THEN 'on_time'
                       WHEN mark < (w + {SIZE} + {LATENESS}) * 1000000 THEN 'late_refire' ELSE 'dropped' END AS cls
        FROM m)
"""


def arrivals(spark: SparkSession, sf: str) -> DataFrame:
    arrived = F.unix_seconds("ts") + F.pmod(F.col("event_id") * 7919, F.lit(13)) * 1800
    return events(spark, sf).select("event_id", "event_type", "ts", "value", arrived.alias("arrived"))


def _classified(spark: SparkSession, sf: str) -> DataFrame:
    return classify_arrivals(arrivals(spark, sf), "ts", ["arrived", "event_id"], SIZE, DELAY, LATENESS)


@query(
    "late_classes",
    f"{CLASSES_SQL} SELECT event_id, CAST(w AS BIGINT) AS window_start, cls AS arrival_class FROM k",
)
def _late_classes(spark: SparkSession, sf: str) -> DataFrame:
    return _classified(spark, sf).select("event_id", "window_start", "arrival_class")


@query(
    "late_side_output",
    f"{CLASSES_SQL} SELECT event_type, count(*) AS n, CAST(sum({_C}) AS BIGINT) AS c FROM k WHERE cls = 'dropped' GROUP BY 1",
)
def _late_side_output(spark: SparkSession, sf: str) -> DataFrame:
    late = _classified(spark, sf).where(F.col("arrival_class") == "dropped")
    return late.groupBy("event_type").agg(F.count("*").alias("n"), F.sum(cents(F.col("value"))).alias("c"))


@query(
    "late_refire_log",
    f"""
    {CLASSES_SQL},
    final AS (SELECT max(epoch_us(ts)) - {DELAY * 1_000_000} AS f FROM events),
    base AS (SELECT event_type, w, count(*) AS n, sum({_C}) AS c FROM k WHERE cls = 'on_time' GROUP BY ALL),
    late AS (
        SELECT event_type, w, row_number() OVER g AS firing, sum({_C}) OVER g AS c FROM k WHERE cls = 'late_refire'
        WINDOW g AS (PARTITION BY event_type, w ORDER BY arrived, event_id))
    SELECT event_type, CAST(w AS BIGINT) AS window_start, CAST(0 AS BIGINT) AS firing, n, CAST(c AS BIGINT) AS total
    FROM base, final WHERE (w + {SIZE}) * 1000000 <= f
    UNION ALL
    SELECT l.event_type, CAST(l.w AS BIGINT), firing, coalesce(b.n, 0) + firing, CAST(coalesce(b.c, 0) + l.c AS BIGINT)
    FROM late l LEFT JOIN base b ON l.event_type = b.event_type AND l.w = b.w
    """,
)
def _late_refire_log(spark: SparkSession, sf: str) -> DataFrame:
    log = firing_log(
        _classified(spark, sf), "ts", ["event_type"], ["arrived", "event_id"], cents(F.col("value")), DELAY
    )
    return log.drop("window_end")


_HOLD = 18000  # five hours
_USER_HOLD = 43200  # twelve hours: about one more reading of the same user


def _alarm_tail(key: str, hold: int) -> str:
    return f"""
    SELECT k AS {key}, {sql_ts_label('opened')} AS opened_at, first_value, peak_value,
           {sql_ts_label(f'opened + INTERVAL {hold} SECOND')} AS alarm_at
    """


@query(
    "rising_alarm",
    f"""
    WITH RECURSIVE h AS (SELECT event_type AS k, event_id, ts, value FROM events WHERE value >= 60),
    a AS (
        SELECT k, min(event_id) AS id, min(ts) AS opened FROM h GROUP BY k
        UNION ALL
        SELECT n.k, n.id, n.at FROM (
            SELECT a.k, min(h.event_id) AS id, min(h.ts) AS at FROM a JOIN h
              ON h.k = a.k AND h.ts > a.opened + INTERVAL {_HOLD} SECOND GROUP BY a.k) n),
    w AS (
        SELECT a.k, a.opened, max(h.value) FILTER (h.event_id = a.id) AS first_value, max(h.value) AS peak_value
        FROM a JOIN h ON h.k = a.k AND h.ts BETWEEN a.opened AND a.opened + INTERVAL {_HOLD} SECOND
        GROUP BY a.k, a.opened)
    {_alarm_tail('event_type', _HOLD)} FROM w WHERE peak_value > first_value
    """,
)
def _rising_alarm(spark: SparkSession, sf: str) -> DataFrame:
    return _alarms(spark, sf, "event_type", _HOLD, reset_on_drop=False)


@query(
    "rising_alarm_reset",
    f"""
    WITH RECURSIVE e AS (
        SELECT user_id AS k, ts, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    st AS (
        SELECT k, rn, ts, value, CASE WHEN value >= 60 THEN ts END AS opened, value AS opening, CASE WHEN value >= 60 THEN value END AS peak,
               CAST(NULL AS TIMESTAMP) AS closed, CAST(NULL AS DOUBLE) AS c_first, CAST(NULL AS DOUBLE) AS c_peak
        FROM e WHERE rn = 1
        UNION ALL
        SELECT k, rn, ts, value,
               CASE WHEN live AND dropped THEN NULL WHEN live THEN opened WHEN value >= 60 THEN ts END,
               CASE WHEN live THEN opening ELSE value END,
               CASE WHEN live AND dropped THEN NULL WHEN live THEN greatest(peak, value) WHEN value >= 60 THEN value END,
               CASE WHEN NOT live THEN opened END, CASE WHEN NOT live THEN opening END, CASE WHEN NOT live THEN peak END
        FROM (
            SELECT e.k, e.rn, e.ts, e.value, s.opened, s.opening, s.peak,
                   s.opened IS NOT NULL AND e.ts <= s.opened + INTERVAL {_USER_HOLD} SECOND AS live, e.value < s.value AS dropped
            FROM st s JOIN e ON e.k = s.k AND e.rn = s.rn + 1)),
    done AS (
        SELECT k, closed AS opened, c_first AS first_value, c_peak AS peak_value FROM st WHERE closed IS NOT NULL
        UNION ALL
        SELECT k, opened, opening, peak FROM st WHERE opened IS NOT NULL
          AND rn = (SELECT max(rn) FROM e WHERE e.k = st.k))
    {_alarm_tail('user_id', _USER_HOLD)} FROM done WHERE peak_value > first_value
    """,
)
def _rising_alarm_reset(spark: SparkSession, sf: str) -> DataFrame:
    return _alarms(spark, sf, "user_id", _USER_HOLD, reset_on_drop=True)


def _alarms(spark: SparkSession, sf: str, key: str, hold: int, reset_on_drop: bool) -> DataFrame:
    alarms = rising_alarms(events(spark, sf), key, "ts", "value", "event_id", 60.0, hold, reset_on_drop)
    return alarms.select(
        key,
        second_label(F.col("opened_at")).alias("opened_at"),
        "first_value",
        "peak_value",
        second_label(F.col("alarm_at")).alias("alarm_at"),
    )


@query(
    "rack_alarm",
    f"""
    WITH RECURSIVE h AS (SELECT user_id AS k, epoch_us(ts) // 1000 AS ms, value FROM events WHERE value >= 60),
    a AS (
        SELECT k, min(ms) AS opened FROM h GROUP BY k
        UNION ALL
        SELECT n.k, n.ms FROM (
            SELECT a.k, min(h.ms) AS ms FROM a JOIN h ON h.k = a.k AND h.ms > a.opened + {_USER_HOLD * 1000} GROUP BY a.k) n),
    w AS (
        SELECT a.k, a.opened, max(h.value) FILTER (h.ms = a.opened) AS first_value, max(h.value) AS peak_value
        FROM a JOIN h ON h.k = a.k AND h.ms BETWEEN a.opened AND a.opened + {_USER_HOLD * 1000} GROUP BY a.k, a.opened)
    SELECT CAST(k AS INTEGER) AS rack, opened AS opened_ms, first_value, peak_value FROM w WHERE peak_value > first_value
    """,
)
def _rack_alarm(spark: SparkSession, sf: str) -> DataFrame:
    """From ``rack,temperature,timestamp`` lines to alarms; every user is a rack."""
    lines = events(spark, sf).select(F.concat_ws(",", "user_id", "value", F.unix_millis("ts")).alias("line"))
    alarms = rack_alarms(lines, hold_s=_USER_HOLD)
    return alarms.select("rack", F.unix_millis("opened_at").alias("opened_ms"), "first_value", "peak_value")
