"""Sharding by jump consistent hashing: a row's key and the number of shards decide its shard, without a table of a ring.

The jump hash walks over the shard counts at which a key would move, by a generator seeded with the key; the last count at or
under the given one names the shard. With one more shard a key stays or moves into the new shard, never between old ones.
All of it are column expressions: the generator's wrapping 64-bit product is put together from 32-bit halves, as plain
products beyond a long are errors.

A shard's rows are numbered without gaps though no task holds a shard: rows equal in key, size and checksum are counted
first, the counts are ordered within ranges of a digest, and each range starts where the ranges before it end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tidemill.llm.common import free_name, shuffle_parts, table
from tidemill.session import written

SHARDS = 8
LAW = "key"

# Multiplier and increment of the published generator, and the range of its draws.
MULTIPLIER = 2862933555777941757
INCREMENT = 1
DRAWS = 1 << 31

_LOW = (1 << 32) - 1
_USUAL_STEPS = 40
_FILE_BYTES = 256 << 20


def _times(high: Column, low: Column) -> tuple[Column, Column]:
    """Halves of (high, low) * MULTIPLIER + INCREMENT modulo 2^64; every product stays within a long."""
    m_high, m_low = MULTIPLIER >> 32, MULTIPLIER & _LOW

    def word(x: Column) -> Column:
        return x.bitwiseAND(F.lit(_LOW))

    def half(x: Column) -> Column:
        return x.bitwiseAND(F.lit(0xFFFF))

    def product(x: Column, m: int) -> Column:
        """x * m modulo 2^32."""
        return word(half(x) * m + F.shiftleft(half(F.shiftright(x, 16) * (m & 0xFFFF)), 16))

    lower, upper = half(low) * m_low + INCREMENT, F.shiftright(low, 16) * m_low
    total = lower + F.shiftleft(half(upper), 16)
    carry = F.shiftright(total, 32) + F.shiftright(upper, 16)
    return word(carry + product(high, m_low) + product(low, m_high)), word(total)


def jump_hash(key: Column, n_shards: int) -> Column:
    """The shard of a 64-bit key, from 0 to ``n_shards - 1``."""
    if not 0 < n_shards < 1 << 31:
        raise ValueError("shards are counted from 1 to 2^31 - 1")

    def step(s: Column, _: Column) -> Column:
        high, low = _times(s["high"], s["low"])
        draw = F.shiftright(high, 1) + 1
        onward = F.floor((s["next"] + 1).cast("double") * (F.lit(float(DRAWS)) / draw.cast("double"))).cast("long")
        moved = F.struct(s["next"].alias("shard"), onward.alias("next"), high.alias("high"), low.alias("low"))
        return F.when(s["next"] < n_shards, moved).otherwise(s)

    zero = F.lit(0).cast("long")
    start = F.struct(
        F.lit(-1).cast("long").alias("shard"), zero.alias("next"),
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(F.lit(_LOW)).alias("low"),
    )
    # Shard numbers rise, so n_shards steps are always enough, and about log(n_shards) usual: the few keys that are not
    # through after the usual number start again with all steps.
    usual = F.aggregate(F.sequence(F.lit(1), F.lit(min(n_shards, _USUAL_STEPS))), start, step)
    if n_shards <= _USUAL_STEPS:
        return usual["shard"].cast("int")
    whole = F.aggregate(F.sequence(F.lit(1), F.lit(n_shards)), start, step)
    return F.when(usual["next"] >= n_shards, usual["shard"]).otherwise(whole["shard"]).cast("int")


def stable_key(docs: DataFrame, key_col: str) -> Column:
    """64 bits of a key: whole numbers as they are, other types by their hash. A null counts as 0."""
    kind = docs.schema[key_col].dataType
    value = F.col(key_col)
    return F.coalesce((value if isinstance(kind, IntegralType) else F.xxhash64(value)).cast("long"), F.lit(0).cast("long"))


def text_size(text: Column) -> Column:
    """Bytes of the text in UTF-8 plus 1; a null text has none."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_checksum(text: Column) -> Column:
    """CRC-32 of the text in UTF-8, that of an empty one for a null."""
    return F.crc32(F.coalesce(text, F.lit("")))


def _slots(placed: DataFrame, parts: int) -> DataFrame:
    """``placed`` with ``slot``: 0, 1, 2, ... per shard, in the order of a digest of all columns.

    Equal rows are one row with a count until the end; the digest's ranges are equal in size, whatever the keys.
    """
    columns = placed.columns
    digest = F.md5(F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)))
    counted = placed.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).withColumn("digest", digest)
    lead = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    counted = written(counted.withColumn("range", F.shiftright(lead * parts, 32)), "counted-rows")
    order = [F.col(c) for c in ("digest", *columns)]  # a tie of two digests falls to the columns
    before = F.sum("n").over(W.partitionBy("shard", "range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1))
    ranges = counted.groupBy("shard", "range").agg(F.sum("n").alias("n"))
    earlier = F.sum("n").over(W.partitionBy("shard").orderBy("range").rowsBetween(W.unboundedPreceding, -1))
    starts = ranges.select(F.col("shard").alias("of"), F.col("range").alias("at"), F.coalesce(earlier, F.lit(0)).alias("start"))
    first = F.col("start") + F.coalesce(before, F.lit(0))
    joined = counted.join(starts, (F.col("shard") == F.col("of")) & (F.col("range") == F.col("at")))
    numbered = joined.select(*columns, "n", first.alias("first"))
    return numbered.select(*columns, F.explode(F.sequence(F.col("first"), F.col("first") + F.col("n") - 1)).alias("slot"))


def place_rows(docs: DataFrame, n_shards: int = SHARDS, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``key, size, text_crc32, law, shard, slot, grown_shard``, the last with one more shard.

    Rows with a null key count as key 0, null texts as empty. Rows that repeat a key go to one shard, each to a slot of its
    own; rows equal in all columns share a run of slots. Slots follow a digest of the columns, so the order in a shard is
    mixed, and the same on any cluster. An empty table gives no rows. Other columns of any name are not read.
    """
    key = stable_key(docs, key_col)
    placed = docs.select(
        F.col(key_col).alias("key"),
        text_size(F.col(text_col)).alias("size"),
        text_checksum(F.col(text_col)).alias("text_crc32"),
        jump_hash(key, n_shards).alias("shard"),
        jump_hash(key, n_shards + 1).alias("grown_shard"),
    )
    slots = _slots(placed, shuffle_parts(docs.sparkSession))
    return slots.select("key", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", "grown_shard")


def write_shards(
    docs: DataFrame, path: str, n_shards: int = SHARDS, key_col: str = "doc_id", text_col: str = "text", file_bytes: int = _FILE_BYTES
) -> None:
    """All columns of ``docs`` as parquet under ``path/shard=…``, about ``file_bytes`` of text a file.

    A shard's rows are dealt over as many files as its bytes need, whatever their keys, and each file is a task of its own.
    Rows are dealt by their place in ``docs``, which has to be the same when a task runs again: pass a table read from files.
    ``path`` must not exist, and ``docs`` has no column ``shard``.
    """
    if "shard" in (c.lower() for c in docs.columns):
        raise ValueError("the documents have a column shard, which names the folders")
    deal, files = free_name(docs, "deal"), free_name(docs, "files")
    sharded = docs.withColumn("shard", jump_hash(stable_key(docs, key_col), n_shards))
    sizes = sharded.groupBy("shard").agg(F.sum(text_size(F.col(text_col))).alias("bytes"))
    needed = written(sizes.select("shard", F.ceil(F.col("bytes") / file_bytes).alias(files)), "shard-files")
    total = needed.agg(F.sum(files)).first()[0] or 1
    # At most a row per shard.
    dealt = sharded.join(F.broadcast(needed), "shard").withColumn(deal, F.pmod(F.monotonically_increasing_id(), F.col(files)))
    dealt.repartition(int(total), "shard", deal).select(*docs.columns, "shard").write.partitionBy("shard").parquet(path)


def grow_shards(spark: SparkSession, path: str, target: str, n_shards: int = SHARDS, key_col: str = "doc_id") -> None:
    """The rows that one more shard takes, as the folder ``target/shard=<n_shards>``; rows of other folders are not moved.

    The shards under ``path`` stay as they are: readers of the grown set leave the moved keys out of them (``grown_rows``).
    """
    kept = spark.read.parquet(path)
    moved = kept.where(jump_hash(stable_key(kept, key_col), n_shards + 1) == n_shards).drop("shard")
    moved.write.parquet(f"{target}/shard={n_shards}")


def grown_rows(spark: SparkSession, path: str, target: str, n_shards: int = SHARDS, key_col: str = "doc_id") -> DataFrame:
    """All rows with their shard after ``grow_shards``."""
    kept = spark.read.parquet(path)
    stayed = kept.where(jump_hash(stable_key(kept, key_col), n_shards + 1) != n_shards)
    return stayed.unionByName(spark.read.option("basePath", target).parquet(f"{target}/shard={n_shards}"))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_rows(table(spark, sf_dir, "documents")).withColumnRenamed("key", "doc_id")


def _jump_sql(n_shards: int) -> str:
    """The walk as a fold over at most ``n_shards`` steps; the state is (shard, next, generator)."""
    return f"""list_reduce(
    range({n_shards}), lambda s, i: CASE WHEN s.next < {n_shards} THEN {{
      'shard': s.next, 'k': (s.k * {MULTIPLIER} + {INCREMENT}) % 18446744073709551616,
      'next': CAST(floor((s.next + 1) * (CAST({DRAWS} AS DOUBLE) / CAST(((s.k * {MULTIPLIER} + {INCREMENT}) % 18446744073709551616) // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
    }} ELSE s END, {{'shard': CAST(-1 AS BIGINT), 'k': (CAST(coalesce(doc_id, 0) AS HUGEINT) + 18446744073709551616) % 18446744073709551616, 'next': CAST(0 AS BIGINT)}}
  ).shard"""


OP13_SQL = f"""
WITH crc_table AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b) ORDER BY b) AS t FROM range(256) r(b)
), sized AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, xor(list_reduce(
    list_transform(
      regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
      lambda h: (instr('0123456789ABCDEF', h[1]) - 1) * 16 + instr('0123456789ABCDEF', h[2]) - 1
    ), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), CAST(4294967295 AS BIGINT)
  ), 4294967295) AS text_crc32 FROM documents, crc_table
), placed AS MATERIALIZED (
  SELECT *, CAST({_jump_sql(SHARDS)} AS INTEGER) AS shard, CAST({_jump_sql(SHARDS + 1)} AS INTEGER) AS grown_shard FROM sized
)
SELECT doc_id, size, text_crc32, '{LAW}' AS law, shard, grown_shard, row_number() OVER (
  PARTITION BY shard ORDER BY md5(concat_ws(',', coalesce(CAST(doc_id AS VARCHAR), ''), size, text_crc32, shard, grown_shard)), doc_id, size, text_crc32
) - 1 AS slot FROM placed
"""
