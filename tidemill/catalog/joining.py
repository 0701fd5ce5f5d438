"""Joins, lookups and time-based joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.catalog.base import events, query, seconds, sql_cents, sql_label, sql_ts_label, sql_window, table
from tidemill.functions.exact import cents
from tidemill.functions.times import second_label, to_millis
from tidemill.operators.joins import cross_product, full_join, inner_join, left_join, lookup, pair_join, right_join
from tidemill.operators.running import change_log
from tidemill.operators.slices import SlicedOrder
from tidemill.operators.temporal import interval_join, session_join, snapshot_lookup, version_at, window_join
from tidemill.plans.jobs import orders_in_rate, traffic_lines, traffic_with_user
from tidemill.session import new_dir
from tidemill.sinks.files import write_lines
from tidemill.sources.files import read_lines

# What stands for a missing partner and for an unknown name.
MISSING = "---"
UNKNOWN_NAME = "未知学生姓名"


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


def _rich(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with a positive balance, so that orders without a partner exist."""
    return table(spark, sf, "customer").where(F.col("c_acctbal") > 0).select("c_custkey", "c_name")


_KEY = [("o_custkey", "c_custkey")]


@query(
    "join_inner",
    "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey",
)
def _join_inner(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return inner_join(_orders(spark, sf), customer, _KEY, [F.col(c) for c in ("o_orderkey", "c_name", "o_totalprice")])


@query(
    "join_pair",
    """
    SELECT o_orderkey, o_custkey, o_orderpriority, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
    """,
)
def _join_pair(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf).drop("o_totalprice")
    return pair_join(orders, table(spark, sf, "customer").select("c_custkey", "c_name"), _KEY).select("left.*", "right.*")


@query(
    "join_left",
    f"""
    SELECT o_orderkey, o_custkey, coalesce(c_name, '{MISSING}') AS c_name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
    """,
)
def _join_left(spark: SparkSession, sf: str) -> DataFrame:
    out = [F.col("o_orderkey"), F.col("o_custkey"), F.coalesce("c_name", F.lit(MISSING)).alias("c_name")]
    return left_join(_orders(spark, sf), _rich(spark, sf), _KEY, out)


@query(
    "join_right",
    f"""
    SELECT coalesce(CAST(o_orderkey AS VARCHAR), '{MISSING}') AS o_orderkey, c_custkey, c_name
    FROM orders RIGHT JOIN customer ON o_custkey = c_custkey
    """,
)
def _join_right(spark: SparkSession, sf: str) -> DataFrame:
    order = F.coalesce(F.col("o_orderkey").cast("string"), F.lit(MISSING)).alias("o_orderkey")
    customer = table(spark, sf, "customer").select("c_custkey", "c_name")
    return right_join(_orders(spark, sf), customer, _KEY, [order, F.col("c_custkey"), F.col("c_name")])


@query(
    "join_full",
    f"""
    SELECT coalesce(o_custkey, c_custkey) AS custkey, coalesce(CAST(o_orderkey AS VARCHAR), '{MISSING}') AS o_orderkey,
           coalesce(c_name, '{MISSING}') AS c_name
    FROM orders FULL JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey
    """,
)
def _join_full(spark: SparkSession, sf: str) -> DataFrame:
    with_order = [
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.coalesce("c_name", F.lit(MISSING)).alias("c_name"),
    ]
    without = [F.col("c_custkey").alias("custkey"), F.lit(MISSING).alias("o_orderkey"), F.col("c_name")]
    return full_join(_orders(spark, sf), _rich(spark, sf), _KEY, with_order, without)


@query("join_cross", "SELECT s_suppkey, r_name FROM supplier, region")
def _join_cross(spark: SparkSession, sf: str) -> DataFrame:
    return cross_product(table(spark, sf, "supplier").select("s_suppkey"), table(spark, sf, "region").select("r_name"))


@query(
    "lookup_default",
    f"""
    SELECT c_custkey, c_nationkey, coalesce(n_name, '{UNKNOWN_NAME}') AS n_name
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 1
    """,
)
def _lookup_default(spark: SparkSession, sf: str) -> DataFrame:
    known = table(spark, sf, "nation").where(F.col("n_regionkey") == 1)
    data = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return lookup(data, known, [("c_nationkey", "n_nationkey")], {"n_name": F.lit(UNKNOWN_NAME)})


@query(
    "lookup_file",
    f"""
    SELECT o_orderkey, o_custkey, coalesce(c_name, '{UNKNOWN_NAME}') AS name
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_mktsegment = 'MACHINERY'
    """,
)
def _lookup_file(spark: SparkSession, sf: str) -> DataFrame:
    """The dimension is a file of ``id,name`` lines."""
    path = new_dir(spark, "names")
    chosen = table(spark, sf, "customer").where(F.col("c_mktsegment") == "MACHINERY")
    write_lines(chosen.select(F.concat_ws(",", "c_custkey", "c_name").alias("line")), path)
    parts = F.split(F.col("line"), ",", 2)
    names = read_lines(spark, path).select(parts[0].cast("long").alias("id"), parts[1].alias("name"))
    data = _orders(spark, sf).select("o_orderkey", "o_custkey")
    return lookup(data, names, [("o_custkey", "id")], {"name": F.lit(UNKNOWN_NAME)})


@query(
    "lookup_external",
    """
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
    """,
)
def _lookup_external(spark: SparkSession, sf: str) -> DataFrame:
    """Several columns of a table per id, nulls where the id is unknown."""
    table_rows = table(spark, sf, "customer").where(F.col("c_acctbal") > 0)
    data = _orders(spark, sf).select("o_orderkey", "o_custkey")
    return lookup(data, table_rows, _KEY, {"c_name": None, "c_mktsegment": None})


@query(
    "join_changelog",
    f"""
    WITH joined AS (
        SELECT o_orderkey AS id, CAST(c_custkey AS VARCHAR) AS idn, o_orderpriority, {sql_cents('o_totalprice')} AS c
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0),
    totals AS (
        SELECT id, idn, o_orderpriority, c,
               CAST(sum(c) OVER (PARTITION BY o_orderpriority ORDER BY id) AS BIGINT) AS total,
               row_number() OVER (PARTITION BY o_orderpriority ORDER BY id) AS n
        FROM joined)
    SELECT id, idn, o_orderpriority, true AS op, total FROM totals
    UNION ALL
    SELECT id, idn, o_orderpriority, false, total - c FROM totals WHERE n > 1
    """,
)
def _join_changelog(spark: SparkSession, sf: str) -> DataFrame:
    """A left join feeding a running total per priority, as additions and retractions."""
    idn = F.col("c_custkey").cast("string").alias("idn")
    out = [F.col("o_orderkey").alias("id"), idn, F.col("o_orderpriority"), F.col("o_totalprice")]
    joined = left_join(_orders(spark, sf), _rich(spark, sf), _KEY, out).withColumn("c", cents(F.col("o_totalprice")))
    # the join keeps every order once, so the slices can be planned on the orders alone
    plan = SlicedOrder(_orders(spark, sf).withColumnRenamed("o_orderkey", "id"), ["o_orderpriority"], ["id"])
    logged = change_log(joined.drop("o_totalprice"), ["o_orderpriority"], ["id"], F.col("c"), "total", plan)
    return logged.drop("c")


def _kind(spark: SparkSession, sf: str, kind: str) -> DataFrame:
    rows = events(spark, sf).where(F.col("event_type") == kind)
    return rows.select("user_id", "ts", "event_id", "value")


def _pairs_sql(size_s: int, slide_s: int) -> str:
    """Pairs of purchases and signups of a user per shared window."""
    n = -(-size_s // slide_s)
    spread = f"""
        SELECT user_id, event_id, value, event_type, w FROM (
            SELECT *, unnest([{', '.join(f"{sql_window('ts', slide_s)} - {i * slide_s}" for i in range(n))}]) AS w
            FROM events)
        WHERE epoch_us(ts) < (w + {size_s}) * 1000000
    """
    return f"""
        WITH s AS ({spread})
        SELECT a.user_id, {sql_label('a.w')} AS window_start, a.event_id AS l_event_id, b.event_id AS r_event_id,
               a.value * b.value AS product
        FROM s a JOIN s b ON a.user_id = b.user_id AND a.w = b.w
        WHERE a.event_type = 'purchase' AND b.event_type = 'signup'
    """


def _pair_rows(pairs: DataFrame, *bounds) -> DataFrame:
    return pairs.select("user_id", *bounds, "l_event_id", "r_event_id", (F.col("l_value") * F.col("r_value")).alias("product"))


@query("window_join", _pairs_sql(36000, 36000))
def _window_join(spark: SparkSession, sf: str) -> DataFrame:
    pairs = window_join(_kind(spark, sf, "purchase"), _kind(spark, sf, "signup"), ["user_id"], "ts", "36000 seconds")
    return _pair_rows(pairs, second_label(F.col("window_start")).alias("window_start"))


@query("window_join_sliding", _pairs_sql(36000, 18000))
def _window_join_sliding(spark: SparkSession, sf: str) -> DataFrame:
    pairs = window_join(
        _kind(spark, sf, "purchase"), _kind(spark, sf, "signup"), ["user_id"], "ts", "36000 seconds", "18000 seconds"
    )
    return _pair_rows(pairs, second_label(F.col("window_start")).alias("window_start"))


@query(
    "window_join_session",
    f"""
    WITH e AS (SELECT * FROM events WHERE event_type IN ('purchase', 'signup')),
    marked AS (
        SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 21600000000 THEN 0 ELSE 1 END AS opened
        FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    s AS (
        SELECT *, sum(opened) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no FROM marked),
    started AS (SELECT *, min(ts) OVER (PARTITION BY user_id, no) AS start FROM s)
    SELECT a.user_id, {sql_ts_label('a.start')} AS session_start, a.event_id AS l_event_id, b.event_id AS r_event_id,
           a.value * b.value AS product
    FROM started a JOIN started b ON a.user_id = b.user_id AND a.no = b.no
    WHERE a.event_type = 'purchase' AND b.event_type = 'signup'
    """,
)
def _window_join_session(spark: SparkSession, sf: str) -> DataFrame:
    pairs = session_join(_kind(spark, sf, "purchase"), _kind(spark, sf, "signup"), ["user_id"], "ts", seconds(21600))
    return _pair_rows(pairs, second_label(F.col("session_start")).alias("session_start"))


@query(
    "interval_join",
    """
    SELECT a.user_id, a.event_id AS l_event_id, b.event_id AS r_event_id, a.value * b.value AS product
    FROM events a JOIN events b ON a.user_id = b.user_id
    WHERE a.event_type = 'purchase' AND b.event_type = 'signup'
      AND epoch_us(b.ts) BETWEEN epoch_us(a.ts) - 7200000000 AND epoch_us(a.ts) + 14400000000
    """,
)
def _interval_join(spark: SparkSession, sf: str) -> DataFrame:
    return _pair_rows(
        interval_join(_kind(spark, sf, "purchase"), _kind(spark, sf, "signup"), ["user_id"], "ts", -7200, 14400)
    )


@query(
    "orders_in_rate",
    f"""
    WITH m AS (SELECT epoch_us(ts) // 1000 AS at, 'user-' || user_id AS currency, {sql_cents('value')} AS c, event_type FROM events)
    SELECT a.currency, a.at AS l_ts, b.at AS r_ts, a.c AS l_price, b.c AS r_rate, a.c * b.c AS converted
    FROM m a JOIN m b ON a.currency = b.currency AND a.at // 21600000 = b.at // 21600000
    WHERE a.event_type = 'click' AND b.event_type = 'view'
    """,
)
def _orders_in_rate(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks as order messages, views as rate messages, joined per currency and six-hour window."""
    rows = events(spark, sf)
    at, currency, c = to_millis(F.col("ts")), F.concat(F.lit("user-"), "user_id"), cents(F.col("value"))
    orders = rows.where(F.col("event_type") == "click").select(
        F.concat_ws(",", at, F.lit("D"), F.lit(1), currency, c).alias("value")
    )
    rates = rows.where(F.col("event_type") == "view").select(F.concat_ws(",", at, currency, c).alias("value"))
    joined = orders_in_rate(orders, rates, "21600 seconds")
    return joined.select(
        "currency",
        "l_ts",
        "r_ts",
        F.col("l_price").cast("long").alias("l_price"),
        F.col("r_rate").cast("long").alias("r_rate"),
        (F.col("l_price").cast("long") * F.col("r_rate")).alias("converted"),
    )


# The snapshot of a day holds each user's latest signup of that day, and is in force from the next midnight.
_SNAPSHOTS = """
    SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS valid_from, user_id, max(event_id) AS rule
    FROM events WHERE event_type = 'signup' GROUP BY ALL
"""


def _snapshots(spark: SparkSession, sf: str) -> DataFrame:
    signups = events(spark, sf).where(F.col("event_type") == "signup")
    valid = (F.date_trunc("day", "ts") + F.expr("interval 1 day")).alias("valid_from")
    return signups.groupBy(valid, "user_id").agg(F.max("event_id").alias("rule"))


_CURRENT = f"""
    WITH s AS ({_SNAPSHOTS}),
    v AS (SELECT DISTINCT CAST(valid_from AS TIMESTAMP) AS valid_from FROM s),
    d AS (SELECT e.*, v.valid_from AS version FROM events e ASOF LEFT JOIN v ON e.ts >= v.valid_from)
"""


@query(
    "snapshot_lookup",
    f"{_CURRENT} SELECT d.event_id, d.user_id, s.rule FROM d JOIN s ON d.version = s.valid_from AND d.user_id = s.user_id",
)
def _snapshot_lookup(spark: SparkSession, sf: str) -> DataFrame:
    data = events(spark, sf).select("event_id", "user_id", "ts")
    found = snapshot_lookup(
        data, _snapshots(spark, sf), "ts", "valid_from", [("user_id", "user_id")], {"rule": None}, keep_unknown=False
    )
    return found.select("event_id", "user_id", "rule")


@query(
    "asof_enrich",
    f"""
    {_CURRENT}
    SELECT CAST(epoch_us(d.ts) // 1000000 * 1000 AS VARCHAR) || chr(9) || 'user-' || d.user_id || chr(9) || {sql_cents('d.value')} || chr(9)
           || coalesce(CAST(s.rule AS VARCHAR), '') AS line
    FROM d LEFT JOIN s ON d.version = s.valid_from AND d.user_id = s.user_id WHERE d.event_type = 'error'
    """,
)
def _asof_enrich(spark: SparkSession, sf: str) -> DataFrame:
    """Traffic lines of the business level with the user in force at their time."""
    rows = events(spark, sf)
    domain = F.concat(F.lit("user-"), "user_id")
    level = F.when(F.col("event_type") == "error", "E").otherwise("M")
    lines = traffic_lines(rows, level, second_label(F.col("ts")), domain, cents(F.col("value")))
    maps = _snapshots(spark, sf).select("valid_from", domain.alias("domain"), F.col("rule").cast("string").alias("user"))
    return traffic_with_user(lines, maps)


@query(
    "version_at",
    f"""
    {_CURRENT.replace("date_trunc('day', ts) + INTERVAL 1 DAY AS valid_from, user_id", "ts AS valid_from, user_id")}
    SELECT event_id, {sql_ts_label('version')} AS version FROM d
    """,
)
def _version_at(spark: SparkSession, sf: str) -> DataFrame:
    """The time of the last signup before or at each event."""
    rows = events(spark, sf).select("event_id", "event_type", "ts")
    marks = rows.where(F.col("event_type") == "signup").select(F.col("ts").alias("valid_from"))
    return version_at(rows, marks, "ts", "valid_from", "version").select(
        "event_id", second_label(F.col("version")).alias("version")
    )
