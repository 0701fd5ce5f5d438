"""Minimal perfect hashes over 128-bit keys, one per shard of a table, and lookups that travel to the shards.

A shard is one row: the bit arrays of its hash and the payload arrays in slot order. Shards with very many lookups are
copied, and their lookups dealt over the copies by a column the caller names, so no task holds a hot key's lookups.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import shuffle_parts
from tidemill.session import written

KEYS_PER_SHARD = 65_536
LOOKUPS_PER_SHARD = 500_000
LEAST_LOOKUPS_PER_TASK = 2_000

HASH_SCHEMA = "shard long, level_words array<int>, bits binary"

_GOLD, _M1, _M2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_ROOM_PER_KEY = 2.0
_MAX_LEVELS = 200


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _places(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    return (_mix(_mix(a ^ seed) + b * _GOLD) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Maps n distinct keys to the slots 0..n-1; any other key to some slot or to -1.

    Each level is a bit array with room for twice the keys left: a key alone at its place sets the bit and is done,
    the others go on to the next level. A key's slot is the number of bits set before its own.
    """

    def __init__(self, level_words: list[int], bits: np.ndarray):
        self.level_words, self.bits = list(level_words), bits
        counts = np.bitwise_count(bits).astype(np.int64)
        self._before = np.concatenate(([0], np.cumsum(counts)))

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        level_words, parts = [], []
        level = 0
        while len(a):
            if level == _MAX_LEVELS:
                raise ValueError("keys of a perfect hash must be distinct")
            words = max(1, math.ceil(len(a) * _ROOM_PER_KEY / 64))
            place = _places(a, b, level, words * 64)
            alone = np.bincount(place, minlength=words * 64)[place] == 1
            part = np.zeros(words, np.uint64)
            won = place[alone]
            np.bitwise_or.at(part, won >> 6, np.uint64(1) << (won & 63).astype(np.uint64))
            level_words.append(words)
            parts.append(part)
            a, b = a[~alone], b[~alone]
            level += 1
        return cls(level_words, np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slot = np.full(len(a), -1, np.int64)
        left = np.arange(len(a))
        start = 0
        for level, words in enumerate(self.level_words):
            if not len(left):
                break
            place = _places(a[left], b[left], level, words * 64)
            word, bit = (place >> 6) + start, (place & 63).astype(np.uint64)
            value = self.bits[word]
            found = (value >> bit) & np.uint64(1) == 1
            under = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            slot[left[found]] = (self._before[word] + under)[found]
            left = left[~found]
            start += words
        return slot


def halves(digests: pa.ChunkedArray | pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The first and second 8 bytes of fixed-width digests."""
    raw = np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(-1, width)
    return tuple(np.ascontiguousarray(raw[:, i : i + 8]).view(np.uint64).ravel() for i in (0, 8))


def unsigned(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def shard_count(keys: DataFrame, lookups: int) -> int:
    """Enough shards for the keys, for the lookups and for every task of a shuffle."""
    n = keys.count()
    return max(4 * shuffle_parts(keys.sparkSession), n // KEYS_PER_SHARD + 1, lookups // LOOKUPS_PER_SHARD + 1)


def build_shards(
    keys: DataFrame, shard: Column, order: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], payload: dict[str, str]
) -> DataFrame:
    """One row per shard. ``order`` gives a shard's keys; ``payload`` names binary columns made of a column's values in slot order."""
    types = {c: str(keys.schema[c].dataType.simpleString()) for c in payload.values()}

    def build(rows: pa.Table) -> pa.Table:
        a, b = order(rows)
        mph = PerfectHash.build(a, b)
        back = np.empty(len(a), np.int64)
        back[mph.lookup(a, b)] = np.arange(len(a))
        out = {
            "shard": [rows["shard"][0].as_py()],
            "level_words": pa.array([mph.level_words], pa.list_(pa.int32())),
            "bits": [mph.bits.tobytes()],
        }
        for name, column in payload.items():
            values = rows[column].take(pa.array(back))
            out[name] = [b"".join(values.to_pylist()) if types[column] == "binary" else values.to_numpy().astype(np.int64).tobytes()]
        return pa.table(out)

    schema = HASH_SCHEMA + "".join(f", {name} binary" for name in payload)
    return keys.withColumn("shard", shard).groupBy("shard").applyInArrow(build, schema)


def open_shard(index: pa.Table) -> PerfectHash:
    return PerfectHash(index["level_words"][0].as_py(), np.frombuffer(index["bits"][0].as_py(), np.uint64))


def probe_shards(
    index: DataFrame, lookups: DataFrame, n_shards: int, answer: Callable[[pa.Table, pa.Table], pa.Table], schema: str, deal: Column | None = None
) -> DataFrame:
    """``answer(shard row, its lookups)`` for each shard; ``lookups`` carry the column ``shard``.

    Shards with over four times the mean lookups are copied, and their lookups dealt over the copies. There are fewer
    than ``n_shards / 4`` such shards, so the broadcast list of them stays small. ``deal`` is a whole number that differs
    between lookups that may be equal, by default a hash of all columns. It must be the same when a task runs again: a row
    number in place is, over a written table.
    """
    loads = lookups.groupBy("shard").agg(F.count(F.lit(1)).alias("load"))
    total = loads.agg(F.sum("load")).first()[0] or 0
    most = max(LEAST_LOOKUPS_PER_TASK, 4 * total // n_shards)
    crowded = written(loads.where(F.col("load") > most).select("shard", F.ceil(F.col("load") / most).cast("int").alias("copies")), "crowded")
    columns = lookups.columns
    dealt = lookups.join(F.broadcast(crowded), "shard", "left").select(
        *columns, F.pmod(F.xxhash64(*columns) if deal is None else deal, F.coalesce("copies", F.lit(1))).cast("int").alias("copy")
    )
    copied = index.join(F.broadcast(crowded), "shard", "left").select(
        *index.columns, F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias("copy")
    )

    def look(shard: pa.Table, rows: pa.Table) -> pa.Table:
        return answer(shard, rows)

    return copied.groupBy("shard", "copy").cogroup(dealt.groupBy("shard", "copy")).applyInArrow(look, schema)
