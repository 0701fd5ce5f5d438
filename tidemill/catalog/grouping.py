"""Aggregates, running values and top n."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog.base import events, query, sql_cents, sql_label, sql_money, sql_ts_label, sql_window, table
from tidemill.functions.exact import cents, from_cents
from tidemill.functions.times import ACCESS_LOG_TIME, second_label
from tidemill.operators.aggregates import (
    approx_distinct,
    combine_groups,
    counted,
    distinct_count,
    filtered_max,
    row_of_extreme,
)
from tidemill.operators.running import change_log, running_distinct, running_sum
from tidemill.operators.topn import first_n, first_n_per_group, hot_items
from tidemill.plans.jobs import access_log, distinct_games, page_views, sales_by_customer
from tidemill.session import new_dir
from tidemill.sources.files import register


def _access_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as access log lines; a user's address is derived from the user number."""
    ip = F.concat(F.lit("10.0."), F.floor(F.col("user_id") / 256), F.lit("."), F.col("user_id") % 256)
    time = F.date_format("ts", ACCESS_LOG_TIME)
    line = F.concat_ws(" ", ip, "user_id", time, F.lit("GET"), F.concat(F.lit("/"), "event_type"))
    return events(spark, sf).select(line.alias("line"))


_IP = "'10.0.' || (user_id // 256) || '.' || (user_id % 256)"
_PV = f"SELECT {_IP} AS ip, count(*) AS pv FROM events GROUP BY ALL"


@query("reduce_pv", _PV)
def _reduce_pv(spark: SparkSession, sf: str) -> DataFrame:
    return page_views(_access_lines(spark, sf))


@query(
    "access_log",
    f"""
    SELECT {_IP} AS ip, user_id, {sql_ts_label('ts')} AS time, 'GET' AS method, '/' || event_type AS path FROM events
    """,
)
def _access_log(spark: SparkSession, sf: str) -> DataFrame:
    parsed = access_log(_access_lines(spark, sf))
    return parsed.select("ip", "user_id", second_label(F.col("ts")).alias("time"), "method", "path")


@query("agg_min_max_sum", f"SELECT max(pv) AS most, min(pv) AS least, CAST(sum(pv) AS BIGINT) AS total FROM ({_PV})")
def _agg_min_max_sum(spark: SparkSession, sf: str) -> DataFrame:
    return page_views(_access_lines(spark, sf)).agg(
        F.max("pv").alias("most"), F.min("pv").alias("least"), F.sum("pv").alias("total")
    )


@query("top_ip", f"SELECT ip, pv FROM ({_PV}) ORDER BY pv DESC, ip LIMIT 3")
def _top_ip(spark: SparkSession, sf: str) -> DataFrame:
    return first_n(page_views(_access_lines(spark, sf)), 3, F.col("pv").desc(), F.col("ip"))


@query(
    "group_apply",
    f"""
    SELECT user_id, count(*) AS n, CAST(sum({sql_cents('value')}) AS BIGINT) AS c, max({sql_cents('value')}) AS top
    FROM events GROUP BY user_id
    """,
)
def _group_apply(spark: SparkSession, sf: str) -> DataFrame:
    """A user function over groups, combined where the rows are and merged per key."""

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.groupby("user_id", as_index=False, dropna=False).agg({"n": "sum", "c": "sum", "top": "max"})

    c = cents(F.col("value"))
    rows = events(spark, sf).select("user_id", F.lit(1).cast("long").alias("n"), c.alias("c"), c.alias("top"))
    return combine_groups(rows, ["user_id"], combine, "user_id long, n long, c long, top long")


@query(
    "row_of_extreme",
    f"""
    SELECT event_type, event_id, user_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) = 1
    """,
)
def _row_of_extreme(spark: SparkSession, sf: str) -> DataFrame:
    return row_of_extreme(events(spark, sf), ["event_type"], "value", "event_id", True, ["event_id", "user_id", "value"])


@query(
    "row_of_least",
    "SELECT event_id, user_id, value FROM events ORDER BY value, event_id LIMIT 1",
)
def _row_of_least(spark: SparkSession, sf: str) -> DataFrame:
    return row_of_extreme(events(spark, sf), [], "value", "event_id", False, ["event_id", "user_id", "value"])


@query("distinct_keys", "SELECT DISTINCT user_id, event_type FROM events")
def _distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    return events(spark, sf).select("user_id", "event_type").distinct()


_SALES = f"SELECT o_custkey, {sql_money('o_totalprice')} AS money FROM orders GROUP BY o_custkey"


@query("sales_sql", _SALES)
def _sales_sql(spark: SparkSession, sf: str) -> DataFrame:
    register(table(spark, sf, "orders"), "sales")
    return spark.sql(
        """
        SELECT o_custkey, CAST(sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS DOUBLE) / 100.0D AS money
        FROM sales GROUP BY o_custkey
        """
    )


@query("sales_by_customer", _SALES)
def _sales_by_customer(spark: SparkSession, sf: str) -> DataFrame:
    return sales_by_customer(table(spark, sf, "orders"), "o_custkey", F.col("o_totalprice"))


_FILTERED = "SELECT p_brand, max(p_size) AS max_size FROM part WHERE p_retailprice >= 905 GROUP BY p_brand"


@query("filtered_max", _FILTERED)
def _filtered_max(spark: SparkSession, sf: str) -> DataFrame:
    return filtered_max(table(spark, sf, "part"), "p_retailprice >= 905", "p_brand", "p_size", "max_size")


@query("filtered_max_sql", _FILTERED)
def _filtered_max_sql(spark: SparkSession, sf: str) -> DataFrame:
    sql = "SELECT p_brand, max(p_size) AS max_size FROM {parts} WHERE p_retailprice >= 905 GROUP BY p_brand"
    return spark.sql(sql, parts=table(spark, sf, "part"))


@query("observed_count", "SELECT count(*) AS seen, count(*) AS written FROM events")
def _observed_count(spark: SparkSession, sf: str) -> DataFrame:
    """Rows counted beside a write, next to the rows found in what was written."""
    rows, seen = counted(events(spark, sf).select("event_id"), "seen")
    path = new_dir(spark, "observed")
    rows.write.parquet(path)
    return spark.read.parquet(path).agg(F.lit(seen.get["seen"]).cast("long").alias("seen"), F.count("*").alias("written"))


@query(
    "running_sum",
    f"""
    SELECT event_id, event_type,
           CAST(sum({sql_cents('value')}) OVER (PARTITION BY event_type ORDER BY event_id) AS DOUBLE) / 100 AS total
    FROM events
    """,
)
def _running_sum(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", "event_type", "value")
    summed = running_sum(rows, ["event_type"], ["event_id"], cents(F.col("value")), "total")
    return summed.select("event_id", "event_type", from_cents(F.col("total")).alias("total"))


@query(
    "changelog",
    f"""
    WITH t AS (
        SELECT event_id, user_id, {sql_cents('value')} AS c,
               CAST(sum({sql_cents('value')}) OVER w AS BIGINT) AS total, row_number() OVER w AS n
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    SELECT event_id, user_id, true AS op, total FROM t
    UNION ALL SELECT event_id, user_id, false, total - c FROM t WHERE n > 1
    """,
)
def _changelog(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", "user_id", cents(F.col("value")).alias("c"))
    return change_log(rows, ["user_id"], ["event_id"], F.col("c"), "total").drop("c")


_DISTINCT = """
    WITH f AS (
        SELECT event_id, {group}, CASE WHEN row_number() OVER (PARTITION BY {group}, {item} ORDER BY event_id) = 1
               THEN 1 ELSE 0 END AS first
        FROM {source})
    SELECT event_id, {group}, CAST(sum(first) OVER (PARTITION BY {group} ORDER BY event_id) AS BIGINT) AS n_distinct FROM f
"""


@query("running_distinct", _DISTINCT.format(group="event_type", item="user_id", source="events"))
def _running_distinct(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", "event_type", "user_id")
    return running_distinct(rows, ["event_type"], "user_id", "event_id").drop("user_id")


@query(
    "distinct_games",
    f"""
    WITH g AS (
        SELECT event_id, 'u' || user_id AS user_id, strftime(ts, '%Y-%m-%d') AS day, event_type AS url FROM events),
    f AS (
        SELECT *, CASE WHEN row_number() OVER (PARTITION BY user_id, day, url ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS first
        FROM g)
    SELECT event_id AS seq, user_id, day, CAST(sum(first) OVER (PARTITION BY user_id, day ORDER BY event_id) AS BIGINT) AS n
    FROM f
    """,
)
def _distinct_games(spark: SparkSession, sf: str) -> DataFrame:
    time = second_label(F.col("ts"))
    line = F.concat_ws("|", F.lit("-"), time, F.concat(F.lit("u"), "user_id"), "event_type").alias("line")
    counted_rows = distinct_games(events(spark, sf).select(F.col("event_id").alias("seq"), line))
    return counted_rows.select("seq", "user_id", "day", F.col("n_distinct").alias("n"))


@query("distinct_per_group", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def _distinct_per_group(spark: SparkSession, sf: str) -> DataFrame:
    return distinct_count(events(spark, sf), ["event_type"], "user_id", "users")


@query(
    "approx_distinct",
    "SELECT event_type, count(DISTINCT user_id) AS users, true AS close FROM events GROUP BY event_type",
)
def _approx_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """The sketch next to the exact count, and whether it is within three standard errors of two per cent."""
    rows = events(spark, sf).select("event_type", "user_id")
    sketch = approx_distinct(rows, ["event_type"], "user_id", "about", 0.02)
    both = distinct_count(rows, ["event_type"], "user_id", "users").join(sketch, "event_type")
    close = F.abs(F.col("about") - F.col("users")) <= F.col("users") * 0.06 + 1
    return both.select("event_type", "users", close.alias("close"))


@query("first_n", "SELECT event_id, ts_label, value FROM (SELECT *, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_label FROM events) ORDER BY event_id LIMIT 100")
def _first_n(spark: SparkSession, sf: str) -> DataFrame:
    rows = events(spark, sf).select("event_id", second_label(F.col("ts")).alias("ts_label"), "value")
    return first_n(rows, 100, F.col("event_id"))


@query(
    "first_n_group",
    "SELECT user_id, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id) <= 2",
)
def _first_n_group(spark: SparkSession, sf: str) -> DataFrame:
    return first_n_per_group(events(spark, sf).select("user_id", "event_id"), ["user_id"], 2, F.col("event_id"))


@query(
    "sorted_first_n",
    """
    SELECT p_brand, p_partkey, p_retailprice FROM part
    QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice, p_partkey) <= 2
    """,
)
def _sorted_first_n(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_brand", "p_partkey", "p_retailprice")
    return first_n_per_group(parts, ["p_brand"], 2, F.col("p_retailprice"), F.col("p_partkey"))


def _hot_sql(group: str) -> str:
    starts = ", ".join(f"{sql_window('ts', 14400)} - {i * 14400}" for i in range(3))
    keys = f"w, {group}" if group else "w"
    return f"""
        WITH s AS (SELECT *, unnest([{starts}]) AS w FROM events),
        c AS (SELECT {keys}, user_id, count(*) AS clicks FROM s GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY clicks DESC, user_id) AS rank FROM c)
        SELECT {sql_label('w')} AS window_start, {group + ',' if group else ''} user_id, clicks, rank FROM r WHERE rank <= 3
    """


@query("hot_items", _hot_sql(""))
def _hot_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every four hours the three most active users of the last twelve."""
    hot = hot_items(events(spark, sf), "ts", "user_id", 3, 43200, 14400)
    return hot.select(second_label(F.col("window_start")).alias("window_start"), "user_id", "clicks", F.col("rank").cast("long").alias("rank"))


@query("hot_items_group", _hot_sql("event_type"))
def _hot_items_group(spark: SparkSession, sf: str) -> DataFrame:
    hot = hot_items(events(spark, sf), "ts", "user_id", 3, 43200, 14400, ["event_type"])
    return hot.select(
        second_label(F.col("window_start")).alias("window_start"), "event_type", "user_id", "clicks", F.col("rank").cast("long").alias("rank")
    )
