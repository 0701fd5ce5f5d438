"""Small cases with known results, one or more per operator family."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemill.functions.records import clean_traffic, has_fields, must_hold, typed_fields
from tidemill.functions.text import field, fields, map_value
from tidemill.operators.aggregates import combine_groups, counted, filtered_max, row_of_extreme
from tidemill.operators.joins import cross_product, full_join, inner_join, left_join, lookup, pair_join, right_join
from tidemill.operators.lateness import classify_arrivals, firing_log, split_arrivals
from tidemill.operators.layout import even_parts, hash_parts, range_parts, rows_by_partition, sort_in_parts, with_partition
from tidemill.operators.shape import keep_members, map_both, one_to_many, split_words, tag_rows, union_all, with_tag
from tidemill.operators.temporal import interval_join, session_join, snapshot_lookup, version_at, window_join
from tidemill.operators.topn import first_n, first_n_per_group, hot_items
from tidemill.operators.windows import count_sliding, count_tumbling, sampling, sliding, sliding_panes, tumbling, window_apply
from tidemill.plans.jobs import distinct_games, orders_in_rate, rack_readings, timed_words, traffic_documents, word_count
from tidemill.sinks.keyed import fold_cells, merge_by_key, push_batch, push_front, put_cells
from tidemill.sources.files import inline_rows, number_range
from tidemill.sources.messages import source_options
from tidemill.sources.tables import jdbc_options


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns or df.columns) for r in df.collect())


def seconds(n):
    return F.make_dt_interval(secs=F.lit(n))


def at(spark, data, schema):
    """Rows whose column ``s`` is a time in seconds."""
    return spark.createDataFrame(data, schema).withColumn("ts", F.timestamp_millis((F.col("s") * 1000).cast("long")))


def epoch(t: dt.datetime) -> float:
    return t.timestamp()


# sources and shape


def test_inline_rows_and_ranges(spark):
    assert rows(inline_rows(spark, [1, 2, 3], "v int")) == [(1,), (2,), (3,)]
    assert rows(inline_rows(spark, [("a", 1)], "k string, v int")) == [("a", 1)]
    numbers = number_range(spark, 1, 10)
    assert [v for (v,) in rows(numbers.select(F.col("id") + 1))] == list(range(2, 12))
    assert [v for (v,) in rows(numbers.where(F.col("id") % 2 == 0))] == [2, 4, 6, 8, 10]


def test_words(spark):
    df = spark.createDataFrame([("Hadoop\tspark, hadoop",), ("",), (None,), (" spark ",)], "line string")
    assert rows(word_count(df)) == [("hadoop", 2), ("spark", 2)]
    kept = split_words(df, "line", pattern="\t", lowercase=False, drop_empty=False)
    assert rows(kept) == [("",), (" spark ",), ("Hadoop",), ("spark, hadoop",)]


def test_one_to_many(spark):
    df = spark.createDataFrame([("a", "b", "c", "d")], "n string, x string, y string, z string")
    said = [F.concat_ws(" 有 ", "n", c) for c in "xyz"]
    assert rows(one_to_many(df, [], said, "said")) == [("a 有 b",), ("a 有 c",), ("a 有 d",)]


def test_tags(spark):
    odd = F.col("id") % 2 == 1
    tagged = tag_rows(number_range(spark, 1, 6), {"even": ~odd, "odd": odd, "jishu": odd})
    assert rows(with_tag(tagged, "even"), "id") == [(2,), (4,), (6,)]
    assert rows(with_tag(tagged, "odd"), "id") == rows(with_tag(tagged, "jishu"), "id") == [(1,), (3,), (5,)]


def test_union_map_both_members(spark):
    a = inline_rows(spark, ["hadoop", "hive", "flume"], "v string")
    b = inline_rows(spark, ["hadoop", "hive", "spark"], "v string")
    assert union_all(a, b).count() == 6
    numbers = inline_rows(spark, [1], "n int")
    both = map_both(a, [F.concat(F.lit("map1:"), "v").alias("o")], numbers, [F.concat(F.lit("map2:"), "n").alias("o")])
    assert rows(both) == [("map1:flume",), ("map1:hadoop",), ("map1:hive",), ("map2:1",)]
    assert rows(keep_members(a, b, ["v"])) == [("hadoop",), ("hive",)]


def test_fields(spark):
    df = spark.createDataFrame([("a|b||",), ("x",)], "l string")
    got = df.select(F.size(fields(F.col("l"), "|")).alias("n"), field(fields(F.col("l"), "|"), 1).alias("f"))
    assert sorted(rows(got), key=str) == [(1, None), (2, "b")]
    strict = typed_fields(df, "l", "|", [("a", "string"), ("b", "int")])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        strict.collect()
    assert {r["b"] for r in typed_fields(df, "l", "|", [("a", "string"), ("b", "int")], strict=False).collect()} == {None}


def test_defaults_for_missing_keys(spark):
    m = F.create_map(F.lit("a"), F.lit(1))
    assert spark.range(1).select(map_value(m, F.lit("a"), 0), map_value(m, F.lit("b"), 0)).first()[:] == (1, 0)


def test_validity_and_strict_mode(spark):
    df = spark.createDataFrame([("1000,a",), ("",), (None,), ("1,2,3",), ("x",)], "line string")
    good, bad = timed_words(df)
    assert rows(good, "word") == [("a",)] and bad.count() == 4
    assert df.where(has_fields(F.col("line"), ",", 3)).count() == 1
    with pytest.raises(Exception, match="poison"):
        must_hold(df, F.col("line").isNotNull(), "poison").collect()


def test_traffic_cleaning(spark):
    lines = [
        "v\tr\tM\t2019-09-09 20:20:00\tip\td.com\t5\t",
        "v\tr\tE\tnever\tip\td.com\t6\t",
        "v\tr\tE\t2019-09-09 20:20:30\tip\td.com\t7\t",
        "v\tr\tE\t2019-09-09 20:20:59\tip\td.com\t1\t",
        "v\tr\tE\t2019-09-09 20:21:00\tip\td.com\t4\t",
    ]
    df = inline_rows(spark, lines, "value string")
    clean, rejected = clean_traffic(df)
    assert [r["traffic"] for r in clean.orderBy("ts").collect()] == [7, 1, 4]
    assert rows(rejected, "time_text", "traffic") == [("never", 6)]
    assert rows(traffic_documents(df)) == [
        ("2019-09-09 20:20-d.com", "2019-09-09 20:20", "d.com", 8),
        ("2019-09-09 20:21-d.com", "2019-09-09 20:21", "d.com", 4),
    ]


# joins


@pytest.fixture(scope="module")
def school(spark):
    students = spark.createDataFrame([(1, "tom"), (2, "jerry"), (3, "jackey")], "id int, name string")
    scores = spark.createDataFrame([(1, 100), (2, 98), (4, 90)], "sid int, score int")
    return students, scores


def test_joins(school):
    students, scores = school
    on = [("id", "sid")]
    name = F.coalesce("name", F.lit("---")).alias("name")
    score = F.coalesce(F.col("score").cast("string"), F.lit("---")).alias("score")
    both = [(1, "tom", "100"), (2, "jerry", "98")]
    left_only, right_only = (3, "jackey", "---"), (4, "---", "90")
    assert rows(inner_join(students, scores, on, [F.col("id"), F.col("name"), score])) == both
    assert rows(left_join(students, scores, on, [F.col("id"), F.col("name"), score])) == [*both, left_only]
    assert rows(right_join(students, scores, on, [F.col("sid").alias("id"), name, score])) == [*both, right_only]
    full = full_join(
        students,
        scores,
        on,
        [F.col("id"), F.col("name"), score],
        [F.col("sid").alias("id"), F.lit("---").alias("name"), F.col("score").cast("string").alias("score")],
    )
    assert rows(full) == [*both, left_only, right_only]
    assert rows(pair_join(students, scores, on).select("left.name", "right.score")) == [("jerry", 98), ("tom", 100)]


def test_full_join_keeps_null_keys(spark):
    a = spark.createDataFrame([(None, "x"), (1, "y")], "id int, name string")
    b = spark.createDataFrame([(None, 5), (2, 6)], "sid int, score int")
    got = full_join(
        a, b, [("id", "sid")],
        [F.col("id"), F.col("name"), F.col("score")],
        [F.col("sid").alias("id"), F.lit(None).cast("string").alias("name"), F.col("score")],
    )
    assert got.count() == 4


@pytest.mark.parametrize("bound", [10_000, 0])
def test_cross(spark, monkeypatch, bound):
    import tidemill.operators.joins as joins

    if not bound:  # force the way for two large sides
        monkeypatch.setattr(joins, "broadcast_if_small", lambda df, n: df)
    people = inline_rows(spark, ["a", "b", "c"], "p string")
    got = cross_product(people, number_range(spark, 1, 5))
    assert len(set(rows(got, "p", "id"))) == got.count() == 15


def test_lookup_with_default(school):
    students, _ = school
    scores = students.sparkSession.createDataFrame([(1, 9), (2, 8), (3, 7), (5, 6), (3, 5)], "sid int, score int")
    got = lookup(scores, students, [("sid", "id")], {"name": F.lit("未知学生姓名")})
    assert rows(got, "sid", "name", "score") == [
        (1, "tom", 9), (2, "jerry", 8), (3, "jackey", 5), (3, "jackey", 7), (5, "未知学生姓名", 6)]


def test_orders_in_rate(spark):
    orders = inline_rows(spark, ["1585099091127,D,1,BEF,688", "1585099094771,A,1,BEF,253"], "value string")
    rates = inline_rows(spark, ["1585099094066,BEF,14", "1585099101000,BEF,15", "1585099094066,EUR,2"], "value string")
    assert rows(orders_in_rate(orders, rates), "converted") == [(3542,), (9632,)]


def brute_pairs(left, right, same):
    return sorted((a, b) for ka, a in left for kb, b in right if ka == kb and same(ka, a, b))


def test_time_joins_match_brute_force(spark):
    import random

    rng = random.Random(2)
    left = list({("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 5)}", rng.randint(0, 600)) for _ in range(150)})
    right = list({("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 5)}", rng.randint(0, 600)) for _ in range(150)})
    a, b = (at(spark, data, "k string, s long") for data in (left, right))

    def pairs(df):
        return sorted((r["l_s"], r["r_s"]) for r in df.collect())

    assert pairs(window_join(a, b, ["k"], "ts", "10 seconds")) == brute_pairs(left, right, lambda k, x, y: x // 10 == y // 10)
    assert pairs(interval_join(a, b, ["k"], "ts", -3, 5)) == brute_pairs(left, right, lambda k, x, y: x - 3 <= y <= x + 5)
    assert pairs(interval_join(a, b, ["k"], "ts", 2, 2)) == brute_pairs(left, right, lambda k, x, y: y == x + 2)
    slid = sorted((x, y) for (x, y) in brute_pairs(left, right, lambda k, x, y: True) for w in range(-5, 605, 5)
                  if w <= x < w + 10 and w <= y < w + 10)
    assert pairs(window_join(a, b, ["k"], "ts", "10 seconds", "5 seconds")) == slid
    session = {}
    for k in {k for k, _ in left + right}:
        no, last = 0, None
        for t in sorted({t for kk, t in left + right if kk == k}):
            no += last is None or t - last >= 4
            session[k, t], last = no, t
    want = brute_pairs(left, right, lambda k, x, y: session[k, x] == session[k, y])
    assert pairs(session_join(a, b, ["k"], "ts", seconds(4))) == want


@pytest.mark.parametrize("many", [False, True])
def test_snapshots(spark, monkeypatch, many):
    import tidemill.operators.temporal as temporal

    if many:  # force the way for more versions than literals
        monkeypatch.setattr(temporal, "MAX_SLICES", 0)
    data = at(spark, [(1, 5.0), (2, 5.0), (1, 15.0), (2, 15.0), (1, 10.0), (2, 20.5)], "id int, s double")
    snaps = at(spark, [(1, "a", 0.0), (2, "b", 0.0), (1, "c", 10.0)], "id int, name string, s double")
    snaps = snaps.where("s < 10 or name = 'c'").withColumnRenamed("ts", "since").drop("s")
    inner = snapshot_lookup(data, snaps, "ts", "since", [("id", "id")], {"name": None}, keep_unknown=False)
    assert rows(inner, "id", "s", "name") == [(1, 5.0, "a"), (1, 10.0, "c"), (1, 15.0, "c"), (2, 5.0, "b")]
    kept = snapshot_lookup(data, snaps, "ts", "since", [("id", "id")], {"name": F.lit("")}, keep_unknown=True)
    assert kept.count() == 6 and kept.where("name = ''").count() == 2
    early = at(spark, [(1, -5.0)], "id int, s double")
    assert rows(version_at(early, snaps, "ts", "since", "v"), "v") == [(None,)]
    none = snaps.where("false")
    assert rows(version_at(early, none, "ts", "since", "v"), "v") == [(None,)]


# aggregates


def test_filtered_max_forms_agree(spark):
    data = [("male", 22), ("female", 16), ("male", 8), ("female", 12), ("male", 20)]
    df = spark.createDataFrame(data, "sex string, age int")
    df.createOrReplaceTempView("pupils")
    sql = spark.sql("select sex, max(age) as m from pupils where age >= 10 group by sex")
    assert rows(filtered_max(df, "age >= 10", "sex", "age", "m")) == rows(sql) == [("female", 16), ("male", 22)]


def test_global_extremes(spark):
    df = spark.createDataFrame([("a", 7, 1), ("b", 1, 2), ("c", 5, 3), ("d", 1, 4), ("e", 7, 5)], "ip string, pv int, seq int")
    assert df.agg(F.max("pv"), F.min("pv")).first()[:] == (7, 1)
    assert rows(row_of_extreme(df, [], "pv", "seq"), "ip") == [("a",)]
    assert rows(row_of_extreme(df, [], "pv", "seq", largest=False), "ip") == [("b",)]
    assert row_of_extreme(df.where("false"), [], "pv", "seq").count() == 0


def test_combine_groups(spark, monkeypatch):
    import tidemill.operators.aggregates as aggregates

    monkeypatch.setattr(aggregates, "_HELD_ROWS", 10)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        data = [("hot" if i % 3 else f"k{i % 20}", i) for i in range(300)] + [(None, 5), (None, 6)]

        def combine(g: pd.DataFrame) -> pd.DataFrame:
            return g.groupby("k", as_index=False, dropna=False)["v"].sum()

        df = spark.createDataFrame(data, "k string, v long").repartition(5)
        want = {}
        for k, v in data:
            want[k] = want.get(k, 0) + v
        assert {r["k"]: r["v"] for r in combine_groups(df, ["k"], combine, "k string, v long").collect()} == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_counter(spark):
    df, seen = counted(inline_rows(spark, ["a", "b", "c", "d", "e"], "w string"))
    df.collect()
    assert seen.get == {"rows": 5}


def test_distinct_games(spark):
    lines = [(1, "x|2020-01-01 10:00:00|u|/a"), (2, "x|2020-01-01 10:00:01|u|/a"), (3, "x|2020-01-01 11:00:00|u|/b"),
             (4, "x|2020-01-02 00:00:00|u|/b"), (5, "x|2020-01-01 09:00:00|v|/b")]
    got = distinct_games(spark.createDataFrame(lines, "seq long, line string"))
    assert rows(got, "seq", "day", "n_distinct") == [
        (1, "2020-01-01", 1), (2, "2020-01-01", 1), (3, "2020-01-01", 2), (4, "2020-01-02", 1), (5, "2020-01-01", 1)]


# windows


def test_window_bounds(spark):
    df = at(spark, [("a", 0.0), ("a", 4.999), ("a", 5.0)], "k string, s double")
    got = tumbling(df, "ts", "5 seconds", ["k"], F.count("*").alias("n"))
    assert [(epoch(r["window_start"]), r["n"]) for r in got.orderBy("window_start").collect()] == [(0, 2), (5, 1)]


def test_sliding_and_panes_agree(spark):
    df = at(spark, [("a", s / 2) for s in range(60)], "k string, s double")
    for size, slide in [(10, 5), (7, 3), (9, 9), (4, 1)]:
        one = sliding(df, "ts", f"{size} seconds", f"{slide} seconds", ["k"], F.count("*").alias("n"))
        two = sliding_panes(df, "ts", size, slide, ["k"], {"n": ("count", F.lit(1))})
        assert rows(one) == rows(two)


def test_sampling_window(spark):
    df = at(spark, [(float(s),) for s in (0, 1, 2, 4, 5, 6, 7)], "s double")
    got = sampling(df, "ts", 2, 5, [], F.sort_array(F.collect_list("s")).alias("v"))
    assert sorted((epoch(r["window_start"]), r["v"]) for r in got.collect()) == [(0, [0.0, 1.0]), (5, [5.0, 6.0])]


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_count_windows(spark, keys):
    df = number_range(spark, 1, 12).withColumn("k", F.lit("x"))
    five = count_tumbling(df, keys, ["id"], 5, F.sum("id").alias("t"))
    assert rows(five, "window_no", "t") == [(0, 15), (1, 40)]
    ten = count_sliding(df, keys, ["id"], 10, 5, {"t": ("sum", "id"), "n": ("count", "id")})
    assert rows(ten, "upto", "t", "n") == [(5, 15, 5), (10, 55, 10)]


@pytest.mark.parametrize("size,slide", [(10, 5), (7, 3), (2, 5), (3, 3), (1, 2)])
def test_count_sliding_matches_brute_force(spark, size, slide):
    df = number_range(spark, 1, 101)
    got = count_sliding(df, [], ["id"], size, slide, {"t": ("sum", "id")})
    want = [(e, sum(range(max(1, e - size + 1), e + 1))) for e in range(slide, 102, slide)]
    assert rows(got, "upto", "t") == want


def test_window_apply_across_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        df = at(spark, [(f"k{i % 7}", float(i)) for i in range(200)], "k string, s double")

        def sizes(g: pd.DataFrame) -> pd.DataFrame:
            return g.groupby(["k", "window_start"], as_index=False).agg(n=("n", "sum"))

        counted_rows = df.withColumn("n", F.lit(1).cast("long"))
        got = window_apply(counted_rows, "ts", "50 seconds", ["k"], sizes, "k string, window_start timestamp, n long")
        want = tumbling(df, "ts", "50 seconds", ["k"], F.count("*").alias("n")).select("k", "window_start", "n")
        assert rows(got) == rows(want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


# top n and layout


def test_first_n(spark):
    data = [(1, "hadoop"), (1, "spark"), (1, "beam"), (2, "java"), (2, "springboot"), (3, "linux"), (4, "vue")]
    df = spark.createDataFrame([(k, w, i) for i, (k, w) in enumerate(data)], "k int, w string, seq int")
    by_word = first_n_per_group(df, ["k"], 2, F.col("w"), F.col("seq"))
    assert rows(by_word, "k", "w") == [(1, "beam"), (1, "hadoop"), (2, "java"), (2, "springboot"), (3, "linux"), (4, "vue")]
    assert rows(first_n_per_group(df, ["k"], 2, F.col("seq")).where("k = 1"), "w") == [("hadoop",), ("spark",)]
    assert [r["w"] for r in first_n(df, 3, F.col("seq")).collect()] == ["hadoop", "spark", "beam"]


def test_hot_items(spark):
    clicks = at(spark, [("a", 1.0), ("a", 2.0), ("b", 3.0), ("c", 12.0), ("b", 14.0), ("b", 15.0)], "item string, s double")
    got = hot_items(clicks, "ts", "item", 2)
    top = {}
    for r in got.orderBy("rank").collect():
        top.setdefault(epoch(r["window_start"]), []).append((r["item"], r["clicks"]))
    assert top[-10] == [("b", 3), ("a", 2)] and top[10] == [("b", 2), ("c", 1)]
    far = hot_items(clicks, "ts", "item", 2, size_s=30, slide_s=1)  # many windows per row: panes
    near = sliding(clicks, "ts", "30 seconds", "1 second", ["item"], F.count("*").alias("clicks"))
    ranked = first_n_per_group(near, ["window_start", "window_end"], 2, F.col("clicks").desc(), F.col("item"))
    assert rows(far, "window_start", "item", "clicks") == rows(ranked, "window_start", "item", "clicks")


def test_layout(spark):
    words = [("hadoop", v) for v in (11, 21, 3, 16)] + [("hive", v) for v in (13, 21, 11, 15, 31, 19)]
    words += [("spark", v) for v in (51, 61, 19, 35, 66, 76)] + [("beam", v) for v in (11, 51, 31)]
    df = spark.createDataFrame(words, "w string, n int")
    placed = with_partition(sort_in_parts(hash_parts(df, 4, "w"), "w", "n")).withColumn("at", F.monotonically_increasing_id())
    found = placed.orderBy("at").collect()
    for w in {w for w, _ in words}:
        mine = [r for r in found if r["w"] == w]
        assert len({r["partition"] for r in mine}) == 1
        assert [r["n"] for r in mine] == sorted(n for x, n in words if x == w)
    sizes = [r["n"] for r in rows_by_partition(with_partition(even_parts(number_range(spark, 0, 100).where("id > 8"), 4))).collect()]
    assert sum(sizes) == 92 and max(sizes) - min(sizes) <= 8
    ends = rows_by_partition(with_partition(range_parts(number_range(spark, 0, 99), 4, "id")), F.min("id").alias("lo"), F.max("id").alias("hi"))
    ends = ends.orderBy("lo").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:]))


# lateness


def late_case(spark):
    """Event times in arrival order; window 5 s, delay 3 s, allowed lateness 2 s."""
    data = [(i, float(t)) for i, t in enumerate([3, 7, 4, 8, 2, 10, 1])]
    df = at(spark, data, "seq long, s double").withColumn("k", F.lit("x"))
    return classify_arrivals(df, "ts", ["seq"], 5, 3, 2)


def test_late_classes(spark):
    got = {r["s"]: r["arrival_class"] for r in late_case(spark).collect()}
    assert got == {3: "on_time", 7: "on_time", 4: "on_time", 8: "on_time", 2: "late_refire", 10: "on_time", 1: "dropped"}
    assert {k: v.count() for k, v in split_arrivals(late_case(spark)).items()} == {"on_time": 5, "late_refire": 1, "dropped": 1}


def test_firing_log(spark):
    log = firing_log(late_case(spark), "ts", ["k"], ["seq"], F.lit(1), 3)
    assert rows(log, "window_start", "firing", "n") == [(0, 0, 2), (0, 1, 3)]


# keyed targets


def test_cells(spark):
    cells = spark.createDataFrame(
        [("r1", "info", "b", "y"), ("r1", "info", "a", "x"), ("r1", "other", "a", "z"), ("r2", "info", "a", "w")],
        "rowkey string, family string, qualifier string, value string",
    )
    assert rows(fold_cells(cells)) == [("r1", "x_y"), ("r2", "w")]
    writes = spark.createDataFrame([("r", "1", 1), ("r", "3", 3), ("r", "2", 2)], "row string, v string, seq int")
    assert rows(put_cells(writes, "row", F.lit("n1"), F.col("v"), "seq")) == [("r", "info", "n1", "3")]


def test_lists(spark):
    df = spark.createDataFrame([("k", 1, 1), ("k", 2, 2), ("k", 3, 3)], "k string, seq int, v int")
    pushed = push_front(df, "k", "seq", "v")
    assert rows(pushed, "pos", "value") == [(1, 3), (2, 2), (3, 1)]
    more = push_front(spark.createDataFrame([("k", 4, 4), ("j", 5, 5)], "k string, seq int, v int"), "k", "seq", "v")
    assert rows(push_batch(pushed, more, "k"), "k", "pos", "value") == [("j", 1, 5), ("k", 1, 4), ("k", 2, 3), ("k", 3, 2), ("k", 4, 1)]


def test_merge_by_key(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string")
    assert rows(merge_by_key(old, new, ["id"])) == [(1, "a"), (2, "c"), (3, "d")]


# option builders


def test_source_options():
    assert source_options("h:1", "t", start={0: 23, 1: 31})["startingOffsets"] == '{"t": {"0": 23, "1": 31}}'
    assert source_options("h:1", pattern="t.*", start="earliest")["subscribePattern"] == "t.*"
    assert source_options("h:1", "t", start=1000)["startingTimestamp"] == "1000"
    with pytest.raises(ValueError):
        source_options("h:1", "t", pattern="t.*")
    with pytest.raises(ValueError):
        source_options("h:1", pattern="t.*", start={0: 1})


def test_jdbc_options():
    options = jdbc_options("jdbc:x", "user", "id", 0, 100, 4)
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "4"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "user", "id")


def test_rack_readings(spark):
    got = rack_readings(inline_rows(spark, ["1,65.5,1000"], "line string"))
    assert rows(got, "rack", "temperature") == [(1, 65.5)]


def test_row_of_extreme_with_a_text_tie(spark):
    df = spark.createDataFrame([("k", 5, "b"), ("k", 5, "a"), ("k", 1, "0"), (None, 2, "z"), ("m", None, "a")], "k string, v int, name string")
    assert rows(row_of_extreme(df, ["k"], "v", "name").where("k is not null"), "k", "v", "name") == [("k", 5, "a")]
    assert row_of_extreme(df, ["k"], "v", "name").count() == 2
    assert rows(row_of_extreme(df, [], "v", "name"), "v", "name") == [(5, "a")]
