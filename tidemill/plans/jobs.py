"""End-to-end jobs put together from the operators. Each takes DataFrames, batch or streaming where it says so."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.exact import money_sum
from tidemill.functions.records import as_json, clean_traffic, has_fields, split_valid, typed_fields
from tidemill.functions.text import field, fields, joined
from tidemill.functions.times import ACCESS_LOG_TIME, day_and_time, parse_time, to_millis
from tidemill.operators.alarms import rising_alarms
from tidemill.operators.running import running_distinct
from tidemill.operators.shape import split_words
from tidemill.operators.temporal import snapshot_lookup, window_join
from tidemill.operators.windows import minute_traffic
from tidemill.sinks.keyed import document_id
from tidemill.streaming.enrich import asof_turns

# What an unknown user is called in enriched traffic lines.
NO_USER = ""


def word_count(lines: DataFrame, text: str = "line") -> DataFrame:
    """Words and how often they occur; batch or stream."""
    return split_words(lines.select(text), text).groupBy("word").agg(F.count("*").alias("n"))


def traffic_documents(lines: DataFrame, line: str = "value", size: str = "60 seconds", delay: str | None = None) -> DataFrame:
    """Traffic log lines to one document per domain and window: ``id, time, domain, traffics``.

    A stream names the ``delay`` its lines may have: later ones are dropped, and windows the watermark has passed leave the state.
    """
    clean, _ = clean_traffic(lines, line)
    if delay is not None:
        clean = clean.withWatermark("ts", delay)
    summed = minute_traffic(clean, "ts", "domain", F.sum("traffic"), size)
    return summed.select(document_id(F.col("time"), F.col("domain")).alias("id"), "time", "domain", "traffics")


def traffic_with_user(lines: DataFrame, snapshots: DataFrame, line: str = "value") -> DataFrame:
    """Traffic log lines with the user of their domain at that time, as tab separated text.

    ``snapshots``: ``valid_from, domain, user``; the newest map replaces the one before.
    """
    clean, _ = clean_traffic(lines, line)
    return _user_lines(
        snapshot_lookup(clean, snapshots, "ts", "valid_from", [("domain", "domain")], {"user": F.lit(NO_USER)}, keep_unknown=True)
    )


def _user_lines(found: DataFrame) -> DataFrame:
    return found.select(joined("\t", to_millis(F.col("ts")), F.col("domain"), F.col("traffic"), F.col("user")).alias("line"))


class TrafficWithUser:
    """``traffic_with_user`` of two streams: lines wait until the watermark has passed them, see ``asof_turns``."""

    def __init__(self, lines: DataFrame, snapshots: DataFrame, path: str, checkpoint: str, delay_s: float, line: str = "value"):
        clean, _ = clean_traffic(lines, line)
        self.turns = asof_turns(
            clean, snapshots, "ts", "valid_from", [("domain", "domain")], {"user": F.lit(NO_USER)}, True, path, checkpoint, delay_s
        )

    def lines(self) -> DataFrame:
        return _user_lines(self.turns.rows())


# Fields of the access log, of the order and the rate messages, and of the student lines.
ACCESS_LOG = ("ip", "user_id", "time", "method", "path")
ORDER_FIELDS = [("ts", "long"), ("category", "string"), ("subcat", "int"), ("currency", "string"), ("price", "int")]
RATE_FIELDS = [("ts", "long"), ("currency", "string"), ("rate", "int")]
STUDENT_FIELDS = [("id", "int"), ("name", "string"), ("age", "int")]


def access_log(lines: DataFrame, line: str = "line") -> DataFrame:
    """Blank separated access log lines as ``ip, user_id, ts, method, path``."""
    part = {n: field(F.col("_f"), i) for i, n in enumerate(ACCESS_LOG)}
    return lines.withColumn("_f", fields(F.col(line), " ")).select(
        part["ip"].alias("ip"),
        part["user_id"].cast("long").alias("user_id"),
        parse_time(part["time"], ACCESS_LOG_TIME).alias("ts"),
        part["method"].alias("method"),
        part["path"].alias("path"),
    )


def page_views(lines: DataFrame, line: str = "line") -> DataFrame:
    """Page views per address: ``ip, pv``."""
    return access_log(lines, line).groupBy("ip").agg(F.count("*").alias("pv"))


def orders_in_rate(orders: DataFrame, rates: DataFrame, size: str = "10 seconds") -> DataFrame:
    """Order and rate message values (``value`` text) joined per currency and window, with the converted price.

    Works on batches, and on streams once both sides have a watermark on ``at``.
    """

    def timed(df: DataFrame, layout: list) -> DataFrame:
        typed = typed_fields(df.select("value"), "value", ",", layout)
        return typed.withColumn("at", F.timestamp_millis("ts"))

    pairs = window_join(timed(orders, ORDER_FIELDS), timed(rates, RATE_FIELDS), ["currency"], "at", size)
    return pairs.withColumn("converted", F.col("l_price") * F.col("r_rate"))


def distinct_games(lines: DataFrame, line: str = "line") -> DataFrame:
    """``seq, line`` rows with lines ``?|yyyy-MM-dd HH:mm:ss|user|url``: distinct urls so far per user and day."""
    f = fields(F.col(line), "|")
    day, time = day_and_time(field(f, 1))
    parsed = lines.select("seq", field(f, 2).alias("user_id"), day.alias("day"), time.alias("time"), field(f, 3).alias("url"))
    return running_distinct(parsed, ["user_id", "day"], "url", "seq")


def rack_readings(lines: DataFrame, line: str = "line") -> DataFrame:
    """``rack,temperature,timestamp`` lines as ``rack, temperature, ts``."""
    typed = typed_fields(lines, line, ",", [("rack", "int"), ("temperature", "double"), ("at", "long")])
    return typed.withColumn("ts", F.timestamp_millis("at")).drop("at")


def rack_alarms(lines: DataFrame, line: str = "line", threshold: float = 60.0, hold_s: float = 5.0, reset_on_drop: bool = False) -> DataFrame:
    """Alarms of racks whose temperature rises above the threshold and keeps rising, from their lines."""
    readings = rack_readings(lines, line).withColumn("seq", F.unix_millis("ts"))
    return rising_alarms(readings, "rack", "ts", "temperature", "seq", threshold, hold_s, reset_on_drop)


def timed_words(lines: DataFrame, line: str = "line") -> tuple[DataFrame, DataFrame]:
    """``ts,word`` lines as (rows ``ts, word``, lines that are empty or have another number of fields)."""
    good, bad = split_valid(lines, has_fields(F.col(line), ",", 2))
    typed = typed_fields(good, line, ",", [("at", "long"), ("word", "string")])
    return typed.withColumn("ts", F.timestamp_millis("at")).drop("at"), bad


def students(lines: DataFrame, line: str = "line") -> DataFrame:
    """``id,name,age`` lines as rows of the student table."""
    return typed_fields(lines.select(line), line, ",", STUDENT_FIELDS)


def sales_by_customer(sales: DataFrame, customer: str, amount: Column) -> DataFrame:
    return sales.groupBy(customer).agg(money_sum(amount).alias("money"))


def json_messages(df: DataFrame, *columns: str) -> DataFrame:
    """Rows as JSON text messages ``value``."""
    return df.select(as_json(*columns).alias("value"))


def traffic_lines(df: DataFrame, level: Column, ts: Column, domain: Column, traffic: Column) -> DataFrame:
    """Rows as traffic log lines, in the layout ``clean_traffic`` reads, with its closing tab."""
    blank = F.lit("-")
    parts = [blank, blank, level, ts, blank, domain, traffic]
    return df.select(F.concat(joined("\t", *parts), F.lit("\t")).alias("value"))

