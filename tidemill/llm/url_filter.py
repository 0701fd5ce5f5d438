"""URL filter: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

A listed entry is a host and the beginning of a path, written ``host/path`` as in a canonical URL (no scheme, host in lower
case, no query, no fragment). A URL's possible entries are its host's suffixes at label borders, each with its path's
beginnings of the lengths that occur in the list. The Bloom filter is a table of 64-bit blocks: one block holds all bits of
an entry, so a probe is one lookup. What passes it goes to an exact join with the list, which removes false hits. All of it
is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import UPPER, free_name, table
from tidemill.session import written

BITS_PER_ENTRY = 16
BROADCAST_BLOCKS = 500_000  # of 16 bytes: 8 MB; larger filters are joined by block number

# The rules of the query.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def canonical_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.char_length(url)))
    return F.coalesce(F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, UPPER.lower()), F.lit(""))


def canonical_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.char_length(url)))
    return F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _block(entry: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(entry), F.lit(blocks))


def _mask(entry: str) -> Column:
    """Four bits of a 64-bit block, from a hash independent of the block number."""
    h = f"xxhash64(7, {entry})"
    return F.expr(" | ".join(f"shiftleft(1L, cast(shiftright({h}, {i}) & 63 as int))" for i in (0, 6, 12, 18)))


def bloom_blocks(entries: DataFrame, blocks: int) -> DataFrame:
    """``block, word``: the filter of the column ``entry``; blocks without a bit are left out."""
    return entries.groupBy(_block("entry", blocks).alias("block")).agg(F.bit_or(_mask("entry")).alias("word"))


def possible_hits(candidates: DataFrame, entries: DataFrame) -> DataFrame:
    """The rows of ``candidates`` whose ``entry`` the filter lets pass: all listed ones and about one in a hundred others."""
    n = entries.count()
    blocks = max(1, n * BITS_PER_ENTRY // 64)
    words = bloom_blocks(entries, blocks)
    words = F.broadcast(words) if blocks <= BROADCAST_BLOCKS else words
    return (
        candidates.withColumns({"block": _block("entry", blocks), "mask": _mask("entry")})
        .join(words, "block")
        .where(F.col("word").bitwiseAND(F.col("mask")) == F.col("mask"))
        .select(*candidates.columns)
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", unlisted: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (existing columns of these names are replaced).

    ``rules`` has ``host, path, verdict``. An entry fits its host and all subdomains, where the URL's path starts with the
    entry's path. The longest entry wins, of equally long ones that with the longer host. URLs without a fitting entry get
    a null rule and the verdict ``unlisted``, as do null URLs and those without ``://``, whose host and path are empty.
    Repeated rows are judged alike and all stay. Of a rule listed twice, ``block`` counts. The list may be empty.
    """
    entries = written(
        rules.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .select(F.concat("host", "path").alias("entry"), "verdict", F.char_length("host").alias("host_chars"), F.char_length("path").alias("path_chars")),
        "url-list",
    )
    # At most one number per possible path length.
    shape = entries.agg(
        F.array_sort(F.collect_set("path_chars")), F.max(F.regexp_count("entry", F.lit("\\.")) + 1)
    ).first()
    lengths, labels = F.array(*map(F.lit, shape[0])) if shape[0] else F.array().cast("array<int>"), F.lit(shape[1] or 1)
    urls = pages.select(F.col(url_col).alias("url")).distinct()
    urls = urls.select("url", canonical_host(F.col("url")).alias("host"), canonical_path(F.col("url")).alias("path"))
    depth = F.least(F.size(F.split("host", "\\.")), labels)
    suffixes = urls.where("host <> ''").select("url", "host", "path", F.explode(F.sequence(F.lit(1), depth)).alias("taken"))
    hosts = suffixes.select("url", "path", F.expr("substring_index(host, '.', -taken)").alias("suffix"))
    fitting = F.filter(lengths, lambda n: n <= F.char_length("path"))
    candidates = hosts.select("url", "suffix", "path", F.explode(fitting).alias("n")).select(
        "url", F.concat("suffix", F.expr("substring(path, 1, n)")).alias("entry")
    )
    hits = possible_hits(candidates, entries).join(entries, "entry")
    best = F.max_by(F.struct("entry", "verdict"), F.struct(F.char_length("entry"), "host_chars"))
    found = written(hits.groupBy("url").agg(best.alias("best")), "url-verdicts")
    mine, ref = free_name(pages, "url_best"), free_name(pages, "url_of")
    found = found.select(F.col("url").alias(ref), F.col("best").alias(mine))
    url = F.col(url_col)
    return (
        # as large as the pages may be, so never sent to every task; a hot URL's rows can be split
        pages.join(found.hint("merge"), pages[url_col] == F.col(ref), "left")
        .withColumns(
            {
                "host": canonical_host(url),
                "path": canonical_path(url),
                "rule": F.col(f"{mine}.entry"),
                "verdict": F.coalesce(F.col(f"{mine}.verdict"), F.lit(unlisted)),
            }
        )
        .drop(mine, ref)
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP1_SQL = (
    "WITH rules(host, path, verdict) AS (VALUES "
    + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
    + r"""), cut AS (
  SELECT page_id, row_number() OVER () AS n, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages
), parts AS (
  SELECT page_id, n, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM cut
), fits AS (
  SELECT p.n, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.n ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE place = 1) USING (n)
"""
)
