"""Line dedup: lines found in several documents stay only in the first of them.

Every line's key is hashed to 128 bits in the JVM. Keys seen in at least two documents go, by hash, into shards of a minimal
perfect hash whose slots hold a 64-bit fingerprint, the number of texts with the line and the document that keeps it. Documents then
look their keys up in these arrays (hashes travel to the shards, lines never do); a fingerprint that does not match means
the line is not repeated. Keys with very many lookups are spread over copies of their shard. Only texts that lose a line
are taken apart again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import BLANKS, ascii_lower, free_name, table, with_text
from tidemill.llm.perfect_hash import build_shards, open_shard, probe_shards, shard_count, unsigned
from tidemill.session import written

MIN_KEY_CHARS = 10
_BLANK_BYTES = BLANKS.encode()
_SALT = 1
# The second hash starts from the hash of the salt, as F.xxhash64(lit(salt), key) does.
_SECOND_SEED = xxhash.xxh64_intdigest(_SALT.to_bytes(4, "little"), 42)


def _keys(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``id, a, b`` for every different key of a row that is long enough."""
    lines = F.split(F.coalesce(text_col, F.lit("")), "\n")
    keys = F.array_distinct(F.transform(lines, lambda line: ascii_lower(F.btrim(line, F.lit(BLANKS)))))
    return (
        docs.select(F.col(id_col).alias("id"), F.explode(keys).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("id", F.xxhash64("key").alias("a"), F.xxhash64(F.lit(_SALT), "key").alias("b"))
    )


def _answer(shard: pa.Table, rows: pa.Table) -> pa.Table:
    """Of the looked-up keys those whose lines the document loses."""
    if not shard.num_rows or not rows.num_rows:
        return rows.select(["id", "a", "b"]).slice(0, 0)
    check, keeper = (np.frombuffer(shard[c][0].as_py(), kind) for c, kind in (("check", np.uint64), ("keeper", np.int64)))
    a, b = unsigned(rows["a"]), unsigned(rows["b"])
    slot = open_shard(shard).lookup(a, b)
    loses = slot >= 0
    loses[loses] = (check[slot[loses]] == b[loses]) & (keeper[slot[loses]] != rows["id"].to_numpy()[loses])
    return rows.select(["id", "a", "b"]).filter(pa.array(loses))


def lost_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``id, a, b``: the hashed keys whose lines a document loses (once per row that has them)."""
    keys = written(_keys(docs.where(F.col(id_col).isNotNull()), id_col, text_col, min_chars), "line-keys")
    seen = keys.groupBy("a", "b").agg(F.min("id").alias("keeper"), F.max("id").alias("last"), F.count(F.lit(1)).alias("texts"))
    repeated = written(seen.where("keeper < last").drop("last"), "line-repeats")
    n = shard_count(repeated, keys.count())
    shard = F.pmod(F.col("a"), F.lit(n))
    index = build_shards(
        repeated,
        shard,
        lambda rows: (unsigned(rows["a"]), unsigned(rows["b"])),
        {"check": "b", "keeper": "keeper", "texts": "texts"},
    )
    # Rows that repeat an id look the same keys up: they are dealt by their place in the written table.
    looked_up, place = keys.withColumn("shard", shard), F.monotonically_increasing_id()
    return probe_shards(written(index, "line-index"), looked_up, n, _answer, "id long, a long, b long", place)


def _without(text: str, a: np.ndarray, b: np.ndarray, min_chars: int) -> tuple[str, int]:
    lost = set(zip(a.astype(np.int64).view(np.uint64).tolist(), b.astype(np.int64).view(np.uint64).tolist(), strict=True))
    kept = []
    lines = text.split("\n")
    for line in lines:
        key = line.encode("utf-8", "surrogatepass").strip(_BLANK_BYTES).lower()
        # Shorter keys never made it into ``lost``; their hashes are not worth computing.
        if len(key) < min_chars or (
            (xxhash.xxh64_intdigest(key, 42), xxhash.xxh64_intdigest(key, _SECOND_SEED)) not in lost
        ):
            kept.append(line)
    return "\n".join(kept), len(lines) - len(kept)


def _remover(min_chars: int):
    @F.pandas_udf("kept string, dropped long")
    def remove(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, a, b in parts:
            yield pd.DataFrame(
                [(None, 0) if t is None else _without(t, x, y, min_chars) for t, x, y in zip(texts, a, b, strict=True)],
                columns=["kept", "dropped"],
            )

    return remove


def mark_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_KEY_CHARS
) -> tuple[DataFrame, Column, Column]:
    """``docs`` with one more column, and two columns over it: the text that stays, and the number of lines dropped.

    A line's key is the line without white space at both ends, A-Z lower-cased. Keys of at least ``min_chars`` code points
    found in two or more documents lose all their lines except those of the smallest id. A null or empty text is one
    empty line and stays as it is. Rows with the same id are one document: a line they share is not repeated. A row with
    a null id neither keeps nor loses lines. Extra columns stay, whatever their names.
    """
    lost = lost_keys(docs, id_col, text_col, min_chars)
    mine, ref = free_name(docs, "lost_lines"), free_name(docs, "lost_of")
    per_doc = lost.groupBy(F.col("id").alias(ref)).agg(F.collect_set(F.struct("a", "b")).alias(mine))
    joined = docs.join(per_doc.hint("shuffle_hash"), docs[id_col] == F.col(ref), "left").drop(ref)
    changed = F.when(F.col(mine).isNotNull(), F.col(text_col))
    result = free_name(docs, "line_result")
    marked = joined.withColumn(result, _remover(min_chars)(changed, F.col(f"{mine}.a"), F.col(f"{mine}.b")))
    return (
        marked.drop(mine),
        F.coalesce(F.col(f"{result}.kept"), F.col(text_col)),
        F.coalesce(F.col(f"{result}.dropped"), F.lit(0)),
    )


def dedup_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS) -> DataFrame:
    """``docs`` (columns ``doc_id``, ``text`` and any others) without the repeated lines; every document stays."""
    marked, kept, _ = mark_lines(docs, min_chars=min_chars)
    return with_text(marked, kept).select(*docs.columns)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked, kept, dropped = mark_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return marked.select(
        "doc_id",
        (F.char_length(text) - F.char_length(F.replace(text, F.lit("\n"))) + 1).cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
        F.sha2(F.coalesce(kept, F.lit("")), 256).alias("kept_sha256"),
    )


OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
  FROM (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING min(doc_id) < max(doc_id)
), marked AS (
  SELECT k.*, r.key IS NOT NULL AND r.keeper <> k.doc_id AS lost FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
