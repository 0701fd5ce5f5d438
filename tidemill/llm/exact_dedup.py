"""Exact dedup against a history of digests.

The history is a minimal perfect hash over its distinct digests: slots hold the full digest, the document that wins and the
size of the group. Arrivals are combined per digest before they look themselves up; a slot counts only if all its digest
bytes agree. Repeats update the winner and the size in place of the slot, digests that are no members form groups of their
own, and both make the next history. Rows read their group from it by the same lookup, so a group of any size is dealt
over copies of its shard.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import BLANK_CLASS, table
from tidemill.llm.perfect_hash import build_shards, halves, open_shard, probe_shards, shard_count
from tidemill.session import written

DIGEST_BYTES = 32


def normal_text(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{BLANK_CLASS}+", "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_chars, digest``: code points of the text, SHA-256 of the text without white space."""
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.char_length(text).cast("long").alias("n_chars"),
        F.unhex(F.sha2(normal_text(F.col(text_col)), 256)).alias("digest"),
    )


def groups_of(rows: DataFrame) -> DataFrame:
    """One row per digest: the longest text, then the smallest id, then the first row wins; a null id wins only over no one."""
    best = F.max_by(F.struct("n_chars", "id", "row"), F.struct("n_chars", F.col("id").isNotNull(), -F.col("id"), -F.col("row")))
    return (
        rows.groupBy("digest")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("group_size"))
        .select("digest", F.col("best.n_chars").alias("n_chars"), F.col("best.id").alias("keep_id"), F.col("best.row").alias("keep_row"), "group_size")
    )


def _shard(n: int) -> Column:
    return F.pmod(F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long"), F.lit(n))


class History:
    """Groups of all digests seen so far, as shards in the shared folder."""

    def __init__(self, groups: DataFrame, lookups: int):
        """``groups``: a written table of one row per digest; ``lookups``: about how many rows will look themselves up."""
        self.groups, self.n_shards = groups, shard_count(groups, lookups)
        index = build_shards(
            groups.select("digest", "n_chars", F.coalesce("keep_id", F.lit(-1)).alias("keep_id"), F.col("keep_id").isNull().cast("long").alias("no_id"), "keep_row", "group_size"),
            _shard(self.n_shards),
            lambda rows: halves(rows["digest"], DIGEST_BYTES),
            {"digests": "digest", "n_chars": "n_chars", "keep_ids": "keep_id", "no_ids": "no_id", "keep_rows": "keep_row", "sizes": "group_size"},
        )
        self.index = written(index, "digest-index")

    def look_up(self, rows: DataFrame, deal: Column | None = None) -> DataFrame:
        """``rows`` with ``seen_chars, seen_id, seen_row, seen_size`` of their group; null where the digest is no member.

        ``deal`` as in ``probe_shards``.
        """
        columns = rows.columns

        def answer(shard: pa.Table, part: pa.Table) -> pa.Table:
            part = part.select(columns)
            n = part.num_rows
            found, slot = np.zeros(n, bool), np.zeros(n, np.int64)
            if n and shard.num_rows:
                slot = open_shard(shard).lookup(*halves(part["digest"], DIGEST_BYTES))
                held = np.frombuffer(shard["digests"][0].as_py(), np.uint8).reshape(-1, DIGEST_BYTES)
                asked = np.frombuffer(b"".join(part["digest"].to_pylist()), np.uint8).reshape(-1, DIGEST_BYTES)
                found = slot >= 0
                found[found] = (held[slot[found]] == asked[found]).all(axis=1)
            for name, source in (("seen_chars", "n_chars"), ("seen_id", "keep_ids"), ("seen_row", "keep_rows"), ("seen_size", "sizes")):
                value, known = np.zeros(n, np.int64), found.copy()
                if found.any():
                    value[found] = np.frombuffer(shard[source][0].as_py(), np.int64)[slot[found]]
                    if name == "seen_id":
                        known[found] = np.frombuffer(shard["no_ids"][0].as_py(), np.int64)[slot[found]] == 0
                part = part.append_column(name, pa.array(value, mask=~known))
            return part

        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
        schema = f"{types}, seen_chars long, seen_id long, seen_row long, seen_size long"
        return probe_shards(self.index, rows.withColumn("shard", _shard(self.n_shards)), self.n_shards, answer, schema, deal)

    def take_in(self, arrivals: DataFrame, lookups: int) -> History:
        """The history after ``arrivals`` (rows of ``digests``): members' slots are updated, nonmembers are grouped separately."""
        looked = written(self.look_up(groups_of(arrivals)), "digest-arrivals")
        news = looked.where("seen_size IS NULL").select("digest", "n_chars", "keep_id", "keep_row", "group_size")
        behind = F.col("seen_id").isNull() & F.col("keep_id").isNotNull()
        longer = (F.col("n_chars") > F.col("seen_chars")) | (
            (F.col("n_chars") == F.col("seen_chars")) & (behind | (F.col("keep_id") < F.col("seen_id")))
        )
        repeats = looked.where("seen_size IS NOT NULL").select(
            "digest",
            F.greatest("n_chars", "seen_chars").alias("n_chars"),
            F.when(longer, F.col("keep_id")).otherwise(F.col("seen_id")).alias("keep_id"),
            F.when(longer, F.col("keep_row")).otherwise(F.col("seen_row")).alias("keep_row"),
            (F.col("group_size") + F.col("seen_size")).alias("group_size"),
        )
        untouched = self.groups.join(repeats.select("digest"), "digest", "left_anti")
        return History(written(untouched.select(*news.columns).union(repeats).union(news), "digest-groups"), lookups)


def exact_groups(history: DataFrame, arrivals: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of both tables with its group: ``id, digest, keep_id, group_size, kept``.

    Texts are equal when identical without white space; a null text is an empty one. The row with the most code points
    stays, then the smallest id, then the first row, of the history before the arrivals: one row of each group is ``kept``,
    also where rows repeat an id. Such rows count each. A row with a null id stays only in a group without ids, whose
    ``keep_id`` is null. Tables may be empty.
    """
    place = F.monotonically_increasing_id()
    old, new = (
        written(digests(df, id_col, text_col).withColumn("row", place * 2 + side), "digests") for side, df in enumerate((history, arrivals))
    )
    total = old.count() + new.count()
    known = History(written(groups_of(old), "digest-groups"), total).take_in(new, total)
    # The row number is a column of a written table, and different for each row of a group.
    return known.look_up(old.union(new), F.xxhash64("row")).select(
        "id", "digest", F.col("seen_id").alias("keep_id"), F.col("seen_size").alias("group_size"), (F.col("row") == F.col("seen_row")).alias("kept")
    )


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose id has an even checksum are the history, the others arrive."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(True))
    groups = exact_groups(docs.where(even), docs.where(~even))
    return groups.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP7_SQL = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents
), ranked AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM normal
)
SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ranked
"""
