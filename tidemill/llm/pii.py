"""Personal data by patterns that bootstrap further patterns, in DataFrame functions only.

Four base kinds (email, ip, card, phone) come from fixed expressions with checks. Their finds are the seeds, and what stands
around a find are its lexical patterns: the two words in front of it, the word in front, the words on both sides, a label
attached to it ("tel:"). Patterns and the things found with them form a graph. Scores go back and forth over it: a
pattern of a kind is as good as the share of its distinct instances known to be of that kind, an instance is of a kind
unless all its patterns err. Identifier-like tokens with a pattern of high score are added as spans of the pattern's kind.

The graph holds one row per distinct pattern and instance, counted before the shuffle, so a very common word pair is one
group of counts. Texts never travel: finds carry their gap to the find before, and running sums give the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.common import BLANK_CLASS, ascii_lower, free_name, table, with_text
from tidemill.session import written

# The kinds in their order and what they look like. Possessive repeats and the look-behinds only save
# backtracking: none of them changes what matches.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){13}", "phone": r"\+[0-9]"}
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"

LEAST_SUPPORT = 3  # known instances (or their confidence in sum) behind a pattern
LEAST_SCORE = 0.8
ONE_WORD_SUPPORT = 8  # the same for a single word in front, which says less
ONE_WORD_SCORE = 0.9
LABEL = r"[A-Za-z][A-Za-z_-]*[:=]"
ROUNDS = 3
LEAST_ALNUM = 6  # letters and digits of an identifier-like token

_ONE, _LONG = "one:", 64


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: Column, found: Column) -> Column:
    n = F.length(_digits(found))
    part = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    return (
        F.when(kind == "ip", F.rlike(found, F.lit(rf"^{part}(?:\.{part}){{3}}$")))
        .when(kind == "card", F.when(n.between(13, 19), _luhn(_digits(found))).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(True)
    )


def _front(text: Column) -> Column:
    """The end of a text: its last two words and what stands between the last blank and its end."""
    word = "[^\\x20\\x09-\\x0D]"
    return F.reverse(F.regexp_extract(F.reverse(text), rf"^{word}*+(?:{BLANK_CLASS}++{word}++){{0,2}}+", 0))


def _contexts(front: Column, behind: Column) -> Column:
    """The patterns of a find as texts: ``front`` as ``_front`` gives it, ``behind`` the word after the find.

    A mark or two between blank and find are not a label. Very long words count by their digest.
    """
    parts = F.split(front, f"{BLANK_CLASS}+")
    label, one, two = (F.try_element_at(parts, F.lit(-i)) for i in (1, 2, 3))
    named = F.rlike(label, F.lit("[A-Za-z]"))
    plain = ~named & (F.length(label) <= 2)
    known = [
        F.when(plain & (F.length(one) > 0) & (F.length(two) > 0), F.concat(F.lit("two:"), two, F.lit(" "), one)),
        F.when(plain & (F.length(one) > 0), F.concat(F.lit(_ONE), one)),
        F.when(plain & (F.length(one) > 0) & (F.length(behind) > 0), F.concat(F.lit("around:"), one, F.lit(" "), behind)),
        F.when(named, F.concat(F.lit("label:"), label)),
    ]
    texts = F.filter(F.array(*(ascii_lower(c) for c in known)), lambda c: c.isNotNull())
    return F.transform(texts, lambda c: F.when(F.length(c) > _LONG, F.concat(F.substring_index(c, ":", 1), F.lit(":#"), F.md5(c))).otherwise(c))


def _finds(docs: DataFrame, patterns: dict[str, tuple[str, str]]) -> DataFrame:
    """``k1, k2, kind, start, end, found, front, behind`` of all matches; ``docs`` has ``k1, k2, text``."""
    kinds = []
    for kind, (pattern, hint) in patterns.items():
        some = F.contains("text", F.lit(hint)) if hint == "@" else F.rlike("text", F.lit(hint))
        one = F.struct(
            F.lit(kind).alias("kind"),
            F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"),
            F.split("text", pattern, -1).alias("gaps"),
        )
        kinds.append(F.when(some, one))
    per_kind = docs.select("k1", "k2", F.explode(F.array(*kinds)).alias("of")).where("size(of.found) > 0")
    # The last gap has no find behind it.
    next_gaps = F.slice("of.gaps", 2, F.size("of.gaps"))
    paired = F.posexplode(F.arrays_zip(F.col("of.found").alias("found"), F.col("of.gaps").alias("gap"), next_gaps.alias("next"))).alias("i", "at")
    each = per_kind.select("k1", "k2", "of.kind", paired).select("k1", "k2", "kind", "i", "at.found", "at.gap", "at.next").where("found IS NOT NULL")
    gap = F.col("gap")
    # What stands in front of the gap is the find before, of which only the kind counts.
    front = _front(F.concat(F.when(F.col("i") > 0, F.concat(F.lit("["), "kind", F.lit("]"))).otherwise(""), gap))
    behind = F.regexp_extract("next", rf"^[^\x20\x09-\x0D]{{0,2}}{BLANK_CLASS}++([^\x20\x09-\x0D]++)", 1)
    # Equal rows of one document count once; the join to the documents gives each of them its spans.
    rows = each.select("k1", "k2", "kind", "i", "found", F.length(gap).alias("gap"), front.alias("front"), behind.alias("behind")).distinct()
    so_far = W.partitionBy("k1", "k2", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    ends = rows.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(so_far))
    return ends.select("k1", "k2", "kind", (F.col("end") - F.length("found")).alias("start"), "end", "found", "front", "behind")


def base_spans(docs: DataFrame) -> DataFrame:
    """Checked finds of the base kinds; a find that fails its check is dropped, nothing inside it is tried again."""
    found = _finds(docs, {k: (PATTERNS[k], HINTS[k]) for k in KINDS})
    return found.where(_valid(F.col("kind"), F.col("found"))).withColumn("contexts", _contexts(F.col("front"), F.col("behind"))).drop("front", "behind")


def _candidates(docs: DataFrame, base: DataFrame) -> DataFrame:
    """Identifier-like tokens that touch no base span: marks at both ends and a label in front do not count."""
    tokens = _finds(docs, {"token": (TOKEN, "[0-9]")})
    lead = F.regexp_extract("found", f"^[^A-Za-z0-9]*+(?:{LABEL}[^A-Za-z0-9]*+)?+", 0)
    core = F.regexp_extract(F.expr("substring(found, length(lead) + 1)"), "^[A-Za-z0-9](?:.*[A-Za-z0-9])?", 0)
    start = F.col("start") + F.length("lead")
    tokens = tokens.withColumn("lead", lead).withColumn("core", core).select(
        "k1", "k2", "kind", start.alias("start"), (start + F.length("core")).alias("end"), F.col("core").alias("found"),
        _contexts(F.concat("front", "lead"), F.col("behind")).alias("contexts"),
    ).where(F.length(F.regexp_replace("found", "[^A-Za-z0-9]", "")) >= LEAST_ALNUM)
    both = tokens.unionByName(base)
    by_start = W.partitionBy("k1", "k2").orderBy("start", "end")
    spans = F.col("kind") != "token"
    before = F.max(F.when(spans, F.col("end"))).over(by_start.rowsBetween(W.unboundedPreceding, -1))
    after = F.min(F.when(spans, F.col("start"))).over(by_start.rowsBetween(1, W.unboundedFollowing))
    marked = both.withColumns({"before": before, "after": after})
    free = (F.coalesce("before", F.lit(-1)) <= F.col("start")) & F.coalesce(F.col("after") >= F.col("end"), F.lit(True))
    return marked.where((F.col("kind") == "token") & free).drop("before", "after", "kind")


def score_patterns(graph: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``context, kind, score`` of the patterns that hold; ``graph``: ``context, instance, kind`` (null if not a seed), distinct."""
    sizes = graph.groupBy("context").agg(F.countDistinct("instance").alias("n"))
    seeds = graph.where("kind IS NOT NULL").groupBy("instance", "kind").agg(F.lit(1.0).alias("confidence"))
    unknown = graph.groupBy("context", "instance").agg(F.max("kind").alias("kind")).where("kind IS NULL").drop("kind")
    pairs = written(graph.select("context", "instance").distinct(), "pii-graph")
    known, patterns = written(seeds, "pii-seeds"), None
    for _ in range(rounds):
        support = pairs.join(known, "instance").groupBy("context", "kind").agg(F.round(F.sum("confidence"), 6).alias("support"))
        scored = support.join(sizes, "context").select("context", "kind", "support", (F.col("support") / F.col("n")).alias("score"))
        one = F.startswith("context", F.lit(_ONE))
        enough = F.col("support") >= F.when(one, ONE_WORD_SUPPORT).otherwise(LEAST_SUPPORT)
        good = F.col("score") >= F.when(one, ONE_WORD_SCORE).otherwise(LEAST_SCORE)
        patterns = written(scored.where(enough & good).drop("support"), "pii-patterns")
        doubt = F.exp(F.sum(F.log(1 - F.least("score", F.lit(0.999)))))
        news = unknown.join(patterns, "context").groupBy("instance", "kind").agg(F.round(1 - doubt, 6).alias("confidence"))
        known = written(news.union(seeds.select(*news.columns)).groupBy("instance", "kind").agg(F.max("confidence").alias("confidence")), "pii-known")
    return patterns


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``k1, k2, kind, start, end, is_base``: all spans, in code points, end exclusive.

    Base spans of different kinds may overlap; added spans touch none of them and take the kind of their best pattern.
    ``k1, k2`` identify id and text of a row: equal rows share their spans. Null and empty texts have none; a row with a
    null id is searched like any other.
    """
    texts = docs.where(F.length(text_col) > 0).select(
        F.xxhash64(id_col, text_col).alias("k1"), F.xxhash64(F.lit(7), text_col, id_col).alias("k2"), F.col(text_col).alias("text")
    )
    base = written(base_spans(texts), "pii-base")
    tokens = written(_candidates(texts, base), "pii-tokens")
    edges = base.select(F.explode("contexts").alias("context"), ascii_lower(F.col("found")).alias("instance"), "kind").unionByName(
        tokens.select(F.explode("contexts").alias("context"), ascii_lower(F.col("found")).alias("instance"), F.lit(None).cast("string").alias("kind"))
    )
    patterns = score_patterns(written(edges.distinct(), "pii-edges"))
    best = patterns.groupBy("context").agg(F.max(F.struct("score", "kind")).alias("best"))
    named = tokens.select("k1", "k2", "start", "end", F.explode("contexts").alias("context")).join(best, "context")
    added = named.groupBy("k1", "k2", "start", "end").agg(F.max("best").alias("best"))
    added = added.select("k1", "k2", F.col("best.kind").alias("kind"), "start", "end", F.lit(False).alias("is_base"))
    return base.select("k1", "k2", "kind", "start", "end", F.lit(True).alias("is_base")).unionByName(added)


def _order(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def _joined(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["place"].cast("int")), s["start"], s["end"])), ","
    )


def spans_per_row(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with one array column of structs ``place, start, end, is_base`` (null without spans), and its name."""
    spans = find_pii(docs, id_col, text_col).groupBy("k1", "k2").agg(
        F.array_sort(F.collect_list(F.struct(_order(F.col("kind")).alias("place"), "start", "end", "is_base"))).alias("spans")
    )
    a, b, a_of, b_of, mine = (free_name(docs, n) for n in ("pii_k1", "pii_k2", "pii_of1", "pii_of2", "pii_spans"))
    spans = written(spans.select(F.col("k1").alias(a_of), F.col("k2").alias(b_of), F.col("spans").alias(mine)), "pii-spans")
    # The keys are columns before the join, so the texts move only for callers that go on to use them.
    keyed = docs.withColumns({a: F.xxhash64(id_col, text_col), b: F.xxhash64(F.lit(7), text_col, id_col)})
    on = (F.col(a) == F.col(a_of)) & (F.col(b) == F.col(b_of))
    return keyed.join(spans.hint("shuffle_hash"), on, "left").select(*docs.columns, mine), mine


def mask_pii(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id``, ``text``, any others) with every span replaced by its kind in brackets.

    Overlapping spans are replaced as one, by the kind of the first. Other text, null and empty texts stay as they are.
    """
    marked, mine = spans_per_row(docs)
    by_start = F.array_sort(F.transform(mine, lambda s: F.struct(s["start"].alias("start"), s["place"].alias("place"), s["end"].alias("end"))))

    def merge(done: Column, s: Column) -> Column:
        last = F.element_at(done, -1)
        joins = (F.size(done) > 0) & (s["start"] < F.try_element_at(done, F.lit(-1))["end"])
        wider = F.struct(last["start"].alias("start"), last["place"].alias("place"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when(joins, F.array_append(F.slice(done, 1, F.size(done) - 1), wider)).otherwise(F.array_append(done, s))

    merged = F.aggregate(by_start, F.slice(by_start, 1, 0), merge)
    names = F.array(*map(F.lit, KINDS))
    cuts = free_name(marked, "pii_cuts")
    marked = marked.withColumn(cuts, F.when(F.col(mine).isNotNull(), merged))

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get(F.col(cuts), i - 1)["end"])
        kept = F.substring(F.col("text"), (begin + 1).cast("int"), (s["start"] - begin).cast("int"))
        return F.concat(kept, F.lit("["), F.element_at(names, s["place"].cast("int")), F.lit("]"))

    tail = F.substring(F.col("text"), (F.element_at(F.col(cuts), -1)["end"] + 1).cast("int"), F.char_length("text"))
    text = F.when(F.col(cuts).isNotNull(), F.concat(F.array_join(F.transform(cuts, piece), ""), tail)).otherwise(F.col("text"))
    return with_text(marked, text).select(*docs.columns)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, mine = spans_per_row(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.coalesce(F.col(mine), F.array().cast("array<struct<place:bigint,start:bigint,end:bigint,is_base:boolean>>"))
    base = F.filter(spans, lambda s: s["is_base"])

    def of(place: int) -> Column:
        return F.size(F.filter(base, lambda s: s["place"] == place)).cast("long")

    counts = [of(i).alias(f"n_{k}") for i, k in enumerate(KINDS, 1)]
    return marked.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))
