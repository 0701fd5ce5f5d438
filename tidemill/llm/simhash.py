"""SimHash near-dedup over a Gray-order hierarchical index.

Distinct fingerprints are sorted by Gray rank, so neighbours share most bits. Nodes over runs of neighbours hold the bits all
of them share (a pattern under a mask) and children only the bits their parent lacks; a search adds up differing bits on
the way down and drops a whole node once they exceed the limit. A node whose free bits cannot exceed the limit any more is
linked as one, and one that already belongs to the searcher's component is left out, so a dense group is never paired up.

To spread the index over tasks, the 64 bits are cut into one block more than bits may differ: two linked fingerprints agree
in at least one block. Each task indexes the fingerprints of some block values; block values with very many fingerprints are
dealt in chunks, one task per pair of chunks. A task returns a spanning forest, and stars of these are contracted to
components.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import free_name, shuffle_parts, table
from tidemill.session import written

MAX_DIFFERENCES = 4
SHINGLE_WORDS = 4
FINGERPRINTS_PER_INDEX = 2_000  # about; small indexes share more bits near the top
FINGERPRINTS_PER_CHUNK = 20_000  # block values with more are dealt in chunks

_FAN = 8
_SEARCHED_AT_ONCE = 256
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def simhash(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """A bit is set if it is set in over half the hashes of the text's word shingles, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(found) < words:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[: len(found) - words + 1], ends[words - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 65_536):
        spans = zip(starts[at : at + 65_536].tolist(), ends[at : at + 65_536].tolist(), strict=True)
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, words: int = SHINGLE_WORDS) -> Column:
    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, words) for t in texts], dtype="int64")

    return run(text)


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in the Gray sequence."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(shift))
    return x


class GrayIndex:
    """The hierarchy over distinct fingerprints; level 0 holds them, the last level at most ``_FAN`` nodes."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints[np.argsort(gray_rank(prints), kind="stable")]
        patterns, masks = [self.prints], [np.full(len(prints), _ALL)]
        while len(patterns[-1]) > _FAN:
            pattern, mask = patterns[-1], masks[-1]
            runs = np.arange(0, len(pattern), _FAN)
            shared = np.bitwise_and.reduceat(pattern, runs)
            known = np.bitwise_and.reduceat(mask, runs) & ~(np.bitwise_or.reduceat(pattern, runs) ^ shared)
            patterns.append(shared & known)
            masks.append(known)
        self.patterns = patterns
        self.free = [64 - np.bitwise_count(m).astype(np.int64) for m in masks]
        above = [np.repeat(m, _FAN)[: len(masks[i])] for i, m in enumerate(masks[1:])]
        self.own = [m & ~a for m, a in zip(masks, above, strict=False)] + [masks[-1]]

    def components(self, limit: int) -> np.ndarray:
        """For each of ``self.prints`` the place of the first one of its component."""
        n = len(self.prints)
        labels = np.arange(n)
        for level in range(1, len(self.patterns)):
            whole = np.repeat(self.free[level] <= limit, _FAN**level)[:n]
            first = np.arange(n) // _FAN**level * _FAN**level
            labels = _link(labels, np.flatnonzero(whole), first[whole])
        for at in range(0, n, _SEARCHED_AT_ONCE):
            searchers = np.arange(at, min(n, at + _SEARCHED_AT_ONCE))
            labels = _link(labels, *self._search(searchers, limit, labels))
        return labels

    def _search(self, searchers: np.ndarray, limit: int, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = len(self.patterns) - 1
        who = np.repeat(searchers, len(self.patterns[top]))
        node = np.tile(np.arange(len(self.patterns[top])), len(searchers))
        differing = np.zeros(len(who), np.int64)
        links = []
        for level in range(top, -1, -1):
            own, pattern, width = self.own[level], self.patterns[level], _FAN**level
            differing = differing + np.bitwise_count((self.prints[who] ^ pattern[node]) & own[node])
            runs = np.arange(0, len(labels), width)
            low, high = np.minimum.reduceat(labels, runs), np.maximum.reduceat(labels, runs)
            # Only nodes that reach beyond the searcher: each pair is found from its earlier side.
            go = (differing <= limit) & ((node + 1) * width > who) & ~((low[node] == high[node]) & (low[node] == labels[who]))
            who, node, differing = who[go], node[go], differing[go]
            whole = differing + self.free[level][node] <= limit
            # The run's earlier members were linked before; its last one is linked with the rest of the node.
            links.append((who[whole], np.minimum((node[whole] + 1) * width, len(labels)) - 1))
            who, node, differing = who[~whole], node[~whole], differing[~whole]
            if level:
                child = node[:, None] * _FAN + np.arange(_FAN)
                there = child < len(self.patterns[level - 1])
                who, node, differing = np.repeat(who, there.sum(1)), child[there], np.repeat(differing, there.sum(1))
        return tuple(np.concatenate(x) for x in zip(*links, strict=True))


def _link(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the components of each pair; every label ends as the least place of its component."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (labels[labels] != labels).any():
            labels = labels[labels]


def _turn(x: np.ndarray, left: int) -> np.ndarray:
    left %= 64
    return (x << np.uint64(left)) | (x >> np.uint64(64 - left)) if left else x


def _forest(limit: int, cuts: list[int]):
    def find(rows: pa.Table) -> pa.Table:
        # The block's bits come first, so that its values are the top of the Gray order.
        lead = cuts[rows["block"][0].as_py()]
        index = GrayIndex(_turn(np.unique(rows["fp"].to_numpy()).view(np.uint64), 64 - lead))
        labels = index.components(limit)
        prints = _turn(index.prints, lead).view(np.int64)
        linked = labels != np.arange(len(labels))
        return pa.table({"u": prints[linked], "v": prints[labels[linked]]})

    return find


def links(prints: DataFrame, limit: int = MAX_DIFFERENCES) -> DataFrame:
    """``u, v``: enough links between the distinct ``fp`` that linked fingerprints are connected; few per fingerprint."""
    blocks = limit + 1
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    values = F.array(
        *(
            F.struct(F.lit(i).alias("block"), F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False))
        )
    )
    placed = prints.select("fp", F.explode(values).alias("at")).select("fp", "at.*")
    # At most 2^13 values a block, however many fingerprints: small enough to send everywhere.
    crowded = written(
        placed.groupBy("block", "value").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FINGERPRINTS_PER_CHUNK).select(
            "block", "value", F.ceil(F.col("n") / FINGERPRINTS_PER_CHUNK).cast("int").alias("chunks")
        ),
        "crowded-values",
    )
    tasks = max(shuffle_parts(prints.sparkSession), prints.count() // FINGERPRINTS_PER_INDEX + 1)
    dealt = placed.join(F.broadcast(crowded), ["block", "value"], "left")
    alone = dealt.where("chunks IS NULL").select("fp", "block", F.pmod(F.xxhash64("block", "value"), F.lit(tasks)).alias("task"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    paired = (
        dealt.where("chunks IS NOT NULL")
        .select("fp", "block", "value", chunk.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("fp", "block", F.xxhash64("value", F.least("mine", "other"), F.greatest("mine", "other")).alias("task"))
    )
    return alone.union(paired).groupBy("block", "task").applyInArrow(_forest(limit, cuts), "u long, v long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: each node of ``edges`` (u, v) but the roots, with the smallest node it is connected to.

    Alternates large and small stars until nothing changes; each round is a table in the shared folder.
    """

    def stars(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return pairs.join(least, "u")

    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    sign = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stars(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u <> v").distinct(), "large-stars")
        small = stars(large).select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = written(small.select("e.*").where("u <> v").distinct(), "small-stars")
        before, sign = sign, tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())
        if sign == before or not sign[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE_WORDS, limit: int = MAX_DIFFERENCES
) -> DataFrame:
    """Every row with its group: ``id, fp, component_id`` (the smallest id reachable over fingerprints ``limit`` bits apart).

    Words are split at white space, A-Z lower-cased. A text with fewer words than a shingle is one shingle; one without
    words (null, empty) has fingerprint zero and links like any other. Repeated rows each get their row. A row with a
    null id is grouped like the others but names no group; a group of such rows only has a null ``component_id``.
    """
    rows = written(docs.select(F.col(id_col).alias("id"), fingerprint(F.col(text_col), words).alias("fp")), "fingerprints")
    firsts = written(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct-fingerprints")
    stars = components(links(firsts.select("fp"), limit))
    rooted = written(
        firsts.join(stars, firsts["fp"] == stars["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root")), "roots"
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    groups = written(rooted.join(named, "root").select("fp", "component_id"), "fingerprint-groups")
    return rows.join(groups, "fp", "left").select("id", "fp", "component_id")


def keep_firsts(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """One document of each of ``groups`` (that with the smallest ``doc_id``), with all its columns.

    Rows that repeat this id are the same document and all stay, as do rows with a null id, which are in no one's place.
    """
    kept = groups.where("id = component_id").select("id").distinct()
    ref = free_name(docs, "kept_id")
    kept = written(kept.select(F.col("id").alias(ref)), "kept-ids")
    return docs.join(kept.hint("shuffle_hash"), docs["doc_id"] == F.col(ref), "left").where(F.col(ref).isNotNull() | F.col("doc_id").isNull()).drop(ref)


def drop_near_copies(
    docs: DataFrame, words: int = SHINGLE_WORDS, limit: int = MAX_DIFFERENCES
) -> DataFrame:
    """One document of each group of near fingerprints; see ``keep_firsts``."""
    return keep_firsts(docs, near_groups(docs, words=words, limit=limit))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return groups.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
