"""Row-wise operators, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.catalog.base import events, query, sql_cents, sql_ts_label, sql_window, table
from tidemill.functions.exact import cents
from tidemill.functions.records import BUSINESS_LEVEL, clean_traffic, must_hold
from tidemill.functions.times import second_label
from tidemill.operators.layout import (
    even_parts,
    hash_parts,
    range_parts,
    rows_by_partition,
    salted_totals,
    sort_in_parts,
    with_partition,
)
from tidemill.operators.running import number_rows
from tidemill.operators.shape import (
    explode_tags,
    keep_members,
    map_both,
    map_partitions,
    one_to_many,
    tag_rows,
    union_all,
    with_tag,
)
from tidemill.plans.jobs import students, timed_words, traffic_documents, traffic_lines, word_count
from tidemill.session import new_dir
from tidemill.sinks.files import BUCKET, compact_buckets, write_buckets, write_csv, write_lines
from tidemill.sinks.keyed import copied_lines, lines_to_cells, merge_by_key, push_batch, push_front, put_cells
from tidemill.sinks.messages import first_of_each, message_id, to_messages
from tidemill.sources.files import number_range, read_lines, read_sequence_file, read_typed_csv
from tidemill.sources.messages import delimited_values, from_offsets, json_values, replay_messages
from tidemill.sources.tables import fold_cells


@query(
    "word_count",
    r"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(lower(text), '[\t, \r\n]+')) AS word FROM documents)
    WHERE length(word) > 0 GROUP BY word
    """,
)
def _word_count(spark: SparkSession, sf: str) -> DataFrame:
    return word_count(table(spark, sf, "documents"), "text")


# Fixed value: what joins a name and what it has.
_HAS = " 有 "


@query(
    "unpivot_three",
    f"""
    SELECT p_partkey, p_name || '{_HAS}' || unnest([p_brand, p_type, CAST(p_size AS VARCHAR)]) AS said FROM part
    """,
)
def _unpivot_three(spark: SparkSession, sf: str) -> DataFrame:
    said = [F.concat_ws(_HAS, "p_name", F.col(c).cast("string")) for c in ("p_brand", "p_type", "p_size")]
    return one_to_many(table(spark, sf, "part"), ["p_partkey"], said, "said")


def traffic_log(rows: DataFrame) -> DataFrame:
    """Events as traffic log lines: errors are of the business level, small values have an unreadable time."""
    level = F.when(F.col("event_type") == "error", F.lit(BUSINESS_LEVEL)).otherwise(F.lit("M"))
    time = F.when(F.col("value") < 5, F.lit("no time")).otherwise(second_label(F.col("ts")))
    domain = F.concat(F.lit("user-"), F.col("user_id"))
    return traffic_lines(rows, level, time, domain, cents(F.col("value")))


def _traffic_lines(spark: SparkSession, sf: str) -> DataFrame:
    return traffic_log(events(spark, sf))


@query(
    "timed_words",
    """
    SELECT word, count(*) AS n, CAST(sum(ms) AS BIGINT) AS ms
    FROM (SELECT event_type AS word, epoch_us(ts) // 1000 AS ms FROM events WHERE event_id % 7 > 1) GROUP BY word
    UNION ALL SELECT 'rejected', count(*), 0 FROM events WHERE event_id % 7 <= 1
    """,
)
def _timed_words(spark: SparkSession, sf: str) -> DataFrame:
    """``ts,word`` lines; empty ones and those with another number of fields are rejected and counted."""
    ms, part = F.unix_millis("ts"), F.col("event_id") % 7
    line = F.when(part == 0, F.lit("")).when(part == 1, F.concat_ws(",", ms, "event_type", "user_id")).otherwise(F.concat_ws(",", ms, "event_type"))
    good, bad = timed_words(events(spark, sf).select(line.alias("line")))
    sums = good.groupBy("word").agg(F.count("*").alias("n"), F.sum(F.unix_millis("ts")).alias("ms"))
    return sums.unionByName(bad.agg(F.lit("rejected").alias("word"), F.count("*").alias("n"), F.lit(0).cast("long").alias("ms")))


@query(
    "parse_clean",
    f"""
    SELECT {sql_ts_label('ts')} AS time, 'user-' || user_id AS domain, {sql_cents('value')} AS traffic
    FROM events WHERE value >= 5 AND event_type = 'error'
    """,
)
def _parse_clean(spark: SparkSession, sf: str) -> DataFrame:
    clean, _ = clean_traffic(_traffic_lines(spark, sf))
    return clean.select(second_label(F.col("ts")).alias("time"), "domain", "traffic")


@query(
    "reject_rows",
    f"""
    SELECT CASE WHEN event_type = 'error' THEN 'E' ELSE 'M' END AS level, 'no time' AS time_text,
           'user-' || user_id AS domain, {sql_cents('value')} AS traffic
    FROM events WHERE value < 5
    """,
)
def _reject_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = clean_traffic(_traffic_lines(spark, sf))
    return rejected.select("level", "time_text", "domain", "traffic")


@query("strict_rows", "SELECT event_id, user_id FROM events")
def _strict_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = events(spark, sf).select("event_id", "user_id")
    return must_hold(df, F.col("user_id").isNotNull(), "event without user")


# The names of the split streams.
_EVEN, _ODD, _ODD_TOO = "even", "odd", "jishu"

_TAGS = f"""
    SELECT event_id, unnest(CASE WHEN {sql_cents('value')} % 2 = 0 THEN ['{_EVEN}'] ELSE ['{_ODD}', '{_ODD_TOO}'] END) AS tag
    FROM events
"""


def _tagged(spark: SparkSession, sf: str) -> DataFrame:
    odd = cents(F.col("value")) % 2 == 1
    return tag_rows(events(spark, sf), {_EVEN: ~odd, _ODD: odd, _ODD_TOO: odd}).select("event_id", "tags")


@query("split_tags", _TAGS)
def _split_tags(spark: SparkSession, sf: str) -> DataFrame:
    return explode_tags(_tagged(spark, sf))


@query("select_tag", f"SELECT event_id FROM ({_TAGS}) WHERE tag = 'jishu'")
def _select_tag(spark: SparkSession, sf: str) -> DataFrame:
    return with_tag(_tagged(spark, sf), "jishu").select("event_id")


@query(
    "co_map_union",
    "SELECT 'map1:' || c_name AS v FROM customer UNION ALL SELECT 'map2:' || s_name FROM supplier",
)
def _co_map_union(spark: SparkSession, sf: str) -> DataFrame:
    return map_both(
        table(spark, sf, "customer"),
        [F.concat(F.lit("map1:"), "c_name").alias("v")],
        table(spark, sf, "supplier"),
        [F.concat(F.lit("map2:"), "s_name").alias("v")],
    )


@query(
    "union_all",
    "SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier",
)
def _union_all(spark: SparkSession, sf: str) -> DataFrame:
    return union_all(
        table(spark, sf, "customer").select(F.col("c_nationkey").alias("nation")),
        table(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation")),
    )


@query(
    "semi_filter",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
    """,
)
def _semi_filter(spark: SparkSession, sf: str) -> DataFrame:
    members = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keep_members(orders, members.select(F.col("c_custkey").alias("o_custkey")), ["o_custkey"])


@query("map_partitions", f"SELECT event_id, {sql_cents('value')} * 2 + 1 AS scaled FROM events")
def _map_partitions(spark: SparkSession, sf: str) -> DataFrame:
    def set_up():
        factor, offset = 2, 1  # stands for what is loaded once per partition

        def scale(batch):
            return batch.assign(scaled=batch["c"] * factor + offset)[["event_id", "scaled"]]

        return scale

    rows = events(spark, sf).select("event_id", cents(F.col("value")).alias("c"))
    return map_partitions(rows, set_up, "event_id long, scaled long")


@query(
    "range_rows",
    "SELECT unnest(range(lo, hi + 1)) AS id FROM (SELECT min(o_orderkey) AS lo, max(o_orderkey) AS hi FROM orders)",
)
def _range_rows(spark: SparkSession, sf: str) -> DataFrame:
    ends = table(spark, sf, "orders").agg(F.min("o_orderkey").alias("lo"), F.max("o_orderkey").alias("hi")).first()
    return number_range(spark, ends["lo"], ends["hi"])


@query("sequence_scan", "SELECT CAST(c_custkey AS INTEGER) AS key, c_name AS value FROM customer")
def _sequence_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "sequence")
    pairs = table(spark, sf, "customer").select(F.col("c_custkey").cast("int"), "c_name")
    pairs.rdd.map(tuple).saveAsSequenceFile(path)
    return read_sequence_file(spark, path)


_CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("csv_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def _csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "csv")
    write_csv(table(spark, sf, "customer"), path, field_delimiter="|", header=True)
    return read_typed_csv(spark, path, _CUSTOMER, field_delimiter="|", skip_first_line=True)


@query("csv_columns", "SELECT c_custkey, c_acctbal FROM customer")
def _csv_columns(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "csv")
    write_csv(table(spark, sf, "customer"), path)
    return read_typed_csv(spark, path, _CUSTOMER, columns=[0, "c_acctbal"])


def _names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(F.col("c_name").alias("line"))


@query("text_roundtrip", "SELECT c_name AS line FROM customer")
def _text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "text")
    write_lines(_names(spark, sf), path)
    return read_lines(spark, path)


@query("gzip_text", "SELECT c_name AS line FROM customer")
def _gzip_text(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "gzip")
    write_lines(_names(spark, sf), path, compression="gzip")
    return read_lines(spark, path)


@query("bzip2_text", "SELECT c_name AS line FROM customer")
def _bzip2_text(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "bzip2")
    write_lines(_names(spark, sf), path, compression="bzip2")
    return read_lines(spark, path)


@query("recursive_scan", "SELECT c_name AS line FROM customer UNION ALL SELECT s_name FROM supplier")
def _recursive_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "tree")
    write_lines(_names(spark, sf), f"{path}/a/b")
    write_lines(table(spark, sf, "supplier").select(F.col("s_name").alias("line")), f"{path}/c")
    return read_lines(spark, path, recursive=True)


@query("charset_text", "SELECT p_name || ' é' AS line FROM part")
def _charset_text(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "latin")
    lines = table(spark, sf, "part").select(F.concat("p_name", F.lit(" é")).alias("line"))
    lines.write.option("encoding", "ISO-8859-1").option("quote", "").csv(path)
    return read_lines(spark, path, charset="ISO-8859-1")


def _messages(spark: SparkSession, sf: str, value) -> DataFrame:
    """Events as a stored message log: a partition per user group, offsets in arrival order."""
    rows = events(spark, sf).select(
        F.pmod("user_id", F.lit(3)).cast("int").alias("partition"), "event_id", "ts", value.alias("text")
    )
    numbered = number_rows(rows, ["partition"], ["event_id"], "offset")
    envelope = numbered.select(
        F.col("event_id").cast("string").cast("binary").alias("key"),
        F.col("text").cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        "partition",
        (F.col("offset") - 1).alias("offset"),
        F.col("ts").alias("timestamp"),
    )
    path = new_dir(spark, "messages")
    envelope.write.parquet(path)
    return replay_messages(spark, path)


_MESSAGE_SQL = """
    SELECT event_id, user_id, ts, value, props, CAST(user_id % 3 AS INTEGER) AS p,
           row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS o
    FROM events
"""


@query(
    "json_payload",
    f"""
    SELECT 'events' AS topic, p AS partition, o AS "offset", CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM ({_MESSAGE_SQL})
    """,
)
def _json_payload(spark: SparkSession, sf: str) -> DataFrame:
    return json_values(_messages(spark, sf, F.col("props")), "k long")


# The next record to read per partition.
_START = {0: 23, 1: 31, 2: 43}


@query(
    "offset_scan",
    f"""
    SELECT p AS partition, o AS "offset", event_id, {sql_cents('value')} AS c FROM ({_MESSAGE_SQL})
    WHERE o >= CASE p WHEN 0 THEN 23 WHEN 1 THEN 31 ELSE 43 END
    """,
)
def _offset_scan(spark: SparkSession, sf: str) -> DataFrame:
    messages = from_offsets(_messages(spark, sf, F.concat_ws(",", "event_id", cents(F.col("value")))), _START)
    return delimited_values(messages, ",", [("event_id", "long"), ("c", "long")]).drop("topic")


@query("message_dedupe", f"SELECT event_id, {sql_cents('value')} AS c FROM events")
def _message_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """Messages delivered twice are read once."""
    rows = events(spark, sf).withColumn("id", message_id("events", "event_id"))
    sent = to_messages(rows, "out", F.concat_ws(",", "event_id", cents(F.col("value"))), F.col("id"), F.col("ts"))
    once = sent.withColumns({"partition": F.lit(0), "offset": F.unix_micros("timestamp")})
    again = once.withColumn("offset", F.col("offset") + 1)
    return delimited_values(
        first_of_each(union_all(once, again)), ",", [("event_id", "long"), ("c", "long")]
    ).select("event_id", "c")


def _customer_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as cells, four qualifiers a row."""
    names = ["c_acctbal", "c_mktsegment", "c_name", "c_nationkey"]
    customer = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("rowkey"),
        cents(F.col("c_acctbal")).cast("string").alias("c_acctbal"),
        "c_mktsegment",
        "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
    )
    long = customer.unpivot("rowkey", names, "qualifier", "value")
    return long.select("rowkey", F.lit("info").alias("family"), "qualifier", "value")


_FOLDED = f"""
    SELECT CAST(c_custkey AS VARCHAR) AS rowkey,
           concat_ws('_', {sql_cents('c_acctbal')}, c_mktsegment, c_name, c_nationkey) AS value
    FROM customer
"""


@query("cells_fold", _FOLDED)
def _cells_fold(spark: SparkSession, sf: str) -> DataFrame:
    return fold_cells(_customer_cells(spark, sf))


@query(
    "cells_copy",
    f"SELECT rowkey || 'test' AS rowkey, 'info' AS family, 'n1' AS qualifier, value FROM ({_FOLDED})",
)
def _cells_copy(spark: SparkSession, sf: str) -> DataFrame:
    return lines_to_cells(copied_lines(_customer_cells(spark, sf)))


@query(
    "cells_put",
    f"""
    SELECT CAST(user_id AS VARCHAR) AS rowkey, 'info' AS family, event_type AS qualifier,
           CAST(arg_max({sql_cents('value')}, event_id) AS VARCHAR) AS value
    FROM events GROUP BY user_id, event_type
    """,
)
def _cells_put(spark: SparkSession, sf: str) -> DataFrame:
    writes = events(spark, sf).withColumn("user", F.col("user_id").cast("string"))
    return put_cells(writes, "user", F.col("event_type"), cents(F.col("value")).cast("string"), "event_id")


@query(
    "list_push",
    """
    SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS pos, event_id AS value
    FROM events
    """,
)
def _list_push(spark: SparkSession, sf: str) -> DataFrame:
    return push_front(events(spark, sf), "event_type", "event_id", "event_id")


@query(
    "list_push_batches",
    """
    SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS pos, event_id AS value
    FROM events
    """,
)
def _list_push_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The same lists when the second half of the month arrives as a later batch."""
    rows = events(spark, sf)
    late = F.coalesce(F.col("ts") >= F.lit("2024-01-15").cast("timestamp"), F.lit(True))
    stored = push_front(rows.where(~late), "user_id", "event_id", "event_id")
    return push_batch(stored, push_front(rows.where(late), "user_id", "event_id", "event_id"), "user_id")


DOCUMENTS = f"""
    SELECT time || '-' || domain AS id, time, domain, traffics FROM (
        SELECT strftime(max(ts), '%Y-%m-%d %H:%M') AS time, 'user-' || user_id AS domain,
               CAST(sum({sql_cents('value')}) AS BIGINT) AS traffics
        FROM events WHERE value >= 5 AND event_type = 'error'
        GROUP BY user_id, {sql_window('ts', 60)})
"""


@query("doc_upsert", f"{DOCUMENTS} UNION ALL SELECT 'old-' || id, time, domain, traffics - 1 FROM ({DOCUMENTS})")
def _doc_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the whole log written over an index with a first, incomplete version of them and with documents of
    an earlier log, which stay."""
    final = traffic_documents(_traffic_lines(spark, sf))
    stale = final.select("id", "time", "domain", (F.col("traffics") - 1).alias("traffics"))
    earlier = stale.withColumn("id", F.concat(F.lit("old-"), "id"))
    return merge_by_key(stale.unionByName(earlier), final, ["id"])


_BUCKETS = "SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%d--%H%M') AS bucket FROM events"


def _bucketed(spark: SparkSession, sf: str) -> str:
    path = new_dir(spark, "buckets")
    rows = events(spark, sf).select("event_id", F.date_trunc("day", "ts").alias("day"))
    write_buckets(rows, path, "day")
    return path


@query("bucket_files", _BUCKETS)
def _bucket_files(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.schema(f"event_id long, day timestamp, {BUCKET} string").parquet(_bucketed(spark, sf)).drop("day")


@query("compact_files", _BUCKETS)
def _compact_files(spark: SparkSession, sf: str) -> DataFrame:
    path = new_dir(spark, "compacted")
    compact_buckets(spark, _bucketed(spark, sf), path)
    return spark.read.schema(f"event_id long, day timestamp, {BUCKET} string").parquet(path).drop("day")


@query("student_rows", "SELECT CAST(c_custkey AS INTEGER) AS id, c_name AS name, c_nationkey AS age FROM customer")
def _student_rows(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "customer").select(F.concat_ws(",", "c_custkey", "c_name", "c_nationkey").alias("line"))
    path = new_dir(spark, "students")
    write_lines(lines, path)
    return students(read_lines(spark, path))


# Layout: the rows stay the same, and the property of the layout is reported beside them.


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@query("sorted_partitions", "SELECT l_orderkey, l_linenumber, l_extendedprice, true AS in_order FROM lineitem")
def _sorted_partitions(spark: SparkSession, sf: str) -> DataFrame:
    """The rows, and for each whether none of the rows before it in its partition sorts after it."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    placed = with_partition(sort_in_parts(hash_parts(rows, _partitions(spark), "l_linenumber"), "l_orderkey", "l_linenumber"))
    before = W.partitionBy("partition").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    here = F.struct("l_orderkey", "l_linenumber")
    checked = placed.withColumn("at", F.monotonically_increasing_id()).withColumn("furthest", F.max(here).over(before))
    return checked.select(*rows.columns, F.coalesce(F.col("furthest") <= here, F.lit(True)).alias("in_order"))


@query(
    "hash_parts",
    "SELECT l_suppkey, count(*) AS n, CAST(1 AS BIGINT) AS partitions FROM lineitem GROUP BY l_suppkey",
)
def _hash_parts(spark: SparkSession, sf: str) -> DataFrame:
    placed = with_partition(hash_parts(table(spark, sf, "lineitem").select("l_suppkey"), _partitions(spark), "l_suppkey"))
    return placed.groupBy("l_suppkey").agg(
        F.count("*").alias("n"), F.count_distinct("partition").alias("partitions")
    )


@query("range_parts", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS overlaps FROM lineitem")
def _range_parts(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    placed = with_partition(range_parts(rows, _partitions(spark), "l_orderkey", "l_linenumber"))
    ends = rows_by_partition(placed, F.min("l_orderkey").alias("lo"), F.max("l_orderkey").alias("hi"))
    # one row per partition
    found = ends.withColumn("lo2", F.lead("lo").over(W.orderBy("partition")))
    return found.agg(F.sum("n").alias("n"), F.count(F.when(F.col("lo2") < F.col("hi"), 1)).alias("overlaps"))


@query("even_parts", "SELECT count(*) AS n, true AS even FROM lineitem WHERE l_quantity > 8")
def _even_parts(spark: SparkSession, sf: str) -> DataFrame:
    kept = table(spark, sf, "lineitem").where(F.col("l_quantity") > 8).select("l_orderkey")
    sizes = rows_by_partition(with_partition(even_parts(kept, _partitions(spark))))
    even = F.max("n") - F.min("n") <= F.sum("n") / 100 + 16
    return sizes.agg(F.sum("n").alias("n"), even.alias("even"))


@query("partition_rows", "SELECT count(*) AS n FROM lineitem")
def _partition_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts per task add up to the table."""
    return rows_by_partition(with_partition(table(spark, sf, "lineitem").select("l_orderkey"))).agg(F.sum("n").alias("n"))


@query(
    "salted_totals",
    f"SELECT l_returnflag, CAST(sum({sql_cents('l_extendedprice')}) AS BIGINT) AS c FROM lineitem GROUP BY l_returnflag",
)
def _salted_totals(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    return salted_totals(rows, ["l_returnflag"], 16, {"c": cents(F.col("l_extendedprice"))})
