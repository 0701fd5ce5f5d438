"""Best-fit packing of token sequences into bins of several permitted sizes.

Documents are cut into pieces of at most the largest size. Only the number of pieces of each length decides a packing, and
there are no more lengths than the largest size has tokens, so the plan is made on that histogram: lengths from the largest
down, each piece into the open bin with the least room that holds it, all equal bins at once. Where none is open, the size
with the least cost per token is opened; how full its rest will get is tried at several values over the whole histogram,
and the cheapest plan wins. At the end each bin shrinks to the smallest size that holds its contents. Spark then numbers
the pieces of each length and looks up their places.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.common import free_name, table
from tidemill.session import written

SIZES = (512, 1024, 2048, 4096, 8192)
BIN_COST = 64  # of every bin, besides a cost of one per token of its size
REST_FILLED = (0.0, 0.5, 0.8, 0.95, 1.0)
PIECES_PER_TASK = 5_000


@dataclass
class Bins:
    """So many equal bins: contents as (length, pieces of that length)."""

    number: int
    size: int
    room: int
    contents: list[tuple[int, int]] = field(default_factory=list)

    def filled(self, number: int, length: int, pieces: int) -> Bins:
        return Bins(number, self.size, self.room - length * pieces, [*self.contents, (length, pieces)])


def _cheapest_size(length: int, sizes: tuple[int, ...], costs: dict[int, float], rest_filled: float) -> int:
    def per_token(size: int) -> float:
        used = size // length * length
        return costs[size] / (used + rest_filled * (size - used))

    return min((s for s in sizes if s >= length), key=lambda s: (per_token(s), s))


def _pack(histogram: dict[int, int], sizes: tuple[int, ...], costs: dict[int, float], rest_filled: float) -> list[Bins]:
    open_bins: dict[int, list[Bins]] = {}
    rooms: list[int] = []  # sorted keys of open_bins

    def put(bins: Bins) -> None:
        if bins.number:
            if bins.room not in open_bins:
                bisect.insort(rooms, bins.room)
            open_bins.setdefault(bins.room, []).append(bins)

    def take(room: int) -> Bins:
        """Of bins with equal room those of the largest size."""
        same = open_bins[room]
        bins = same.pop(max(range(len(same)), key=lambda i: same[i].size))
        if not open_bins[room]:
            del open_bins[room]
            rooms.remove(room)
        return bins

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                bins = take(rooms[at])
            else:
                size = _cheapest_size(length, sizes, costs, rest_filled)
                bins = Bins(-(-left // (size // length)), size, size)
            each = bins.room // length
            full = min(bins.number, left // each)
            put(bins.filled(full, length, each))
            left -= full * each
            rest = bins.number - full
            if rest and left:
                put(bins.filled(1, length, left))
                left, rest = 0, rest - 1
            put(Bins(rest, bins.size, bins.room, bins.contents))
    done = [b for same in open_bins.values() for b in same]
    for b in done:
        used = b.size - b.room
        b.size = min(s for s in sizes if s >= used)
        b.room = b.size - used
    return done


def plan_bins(histogram: dict[int, int], sizes: tuple[int, ...] = SIZES, costs: dict[int, float] | None = None) -> list[Bins]:
    """The cheapest of the plans tried. ``histogram``: pieces per length, none longer than the largest size."""
    sizes = tuple(sorted(sizes))
    costs = costs or {s: s + BIN_COST for s in sizes}
    plans = [_pack(histogram, sizes, costs, rest) for rest in REST_FILLED]
    best = min(plans, key=lambda bins: sum(b.number * costs[b.size] for b in bins))
    return sorted(best, key=lambda b: (-b.size, b.contents))


def _places(bins: list[Bins]) -> dict[str, np.ndarray]:
    """Per run of pieces of one length: first rank, pieces per bin, first bin, offset in the bin, bin size."""
    rows, next_rank, first_bin = [], {}, 0
    for b in bins:
        offset = 0
        for length, pieces in b.contents:
            rank = next_rank.get(length, 0)
            rows.append((length, rank, pieces, first_bin, offset, b.size))
            next_rank[length] = rank + pieces * b.number
            offset += length * pieces
        first_bin += b.number
    cols = np.array(sorted(rows), np.int64).reshape(-1, 6).T
    return dict(zip(("length", "rank", "pieces", "bin", "offset", "size"), cols, strict=True))


def count_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def pack(docs: DataFrame, tokens: Column, id_col: str = "doc_id", sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """``id_col, piece, start, n_tokens, bin_id, bin_size, bin_offset``: where each piece of each row goes.

    ``tokens`` is a row's number of tokens (null counts as none). A row with more than the largest size is cut into pieces
    that fill whole bins and a last one. A row without tokens keeps one piece of length 0 without a bin. Repeated rows and
    rows with a null id are packed one by one like any other. An empty table gives no rows.
    """
    most = max(sizes)
    counted = docs.select(F.col(id_col).alias("id"), F.coalesce(tokens, F.lit(0)).cast("long").alias("n"))
    cut = counted.select("id", "n", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / most) - 1, F.lit(0)).cast("int"))).alias("piece"))
    start = F.col("piece").cast("long") * most
    pieces = written(
        cut.select("id", "piece", start.alias("start"), F.least(F.lit(most), F.col("n") - start).alias("n_tokens")), "pieces"
    )
    # At most ``most`` lengths, however many pieces.
    counts = {r["n_tokens"]: r["n"] for r in pieces.where("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = _places(plan_bins(counts, sizes))
    parts = pieces.sparkSession.createDataFrame(
        [(n, -(-c // PIECES_PER_TASK)) for n, c in counts.items()], "n_tokens long, parts long"
    )
    dealt = pieces.where("n_tokens > 0").join(F.broadcast(parts), "n_tokens").withColumn("part", F.pmod(F.xxhash64("id", "piece"), "parts")).drop("parts")
    before = dealt.groupBy("n_tokens", "part").agg(F.count(F.lit(1)).alias("here"))
    before = before.select("n_tokens", "part", (F.sum("here").over(W.partitionBy("n_tokens").orderBy("part")) - F.col("here")).alias("before"))
    inside = F.row_number().over(W.partitionBy("n_tokens", "part").orderBy("id", "piece")) - 1
    ranked = dealt.withColumn("inside", inside).join(before, ["n_tokens", "part"]).select(
        "id", "piece", "start", "n_tokens", (F.col("inside") + F.col("before")).alias("rank")
    )
    stride = int(max(counts.values(), default=0)) + 1  # ranks of a length stay below it
    starts = places["length"] * stride + places["rank"]

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rank = b.pop("rank").to_numpy(np.int64)
            at = np.searchsorted(starts, b["n_tokens"].to_numpy(np.int64) * stride + rank, side="right") - 1
            behind = rank - places["rank"][at]
            b["bin_id"] = places["bin"][at] + behind // places["pieces"][at]
            b["bin_size"] = places["size"][at]
            b["bin_offset"] = places["offset"][at] + behind % places["pieces"][at] * b["n_tokens"]
            yield b

    kind = docs.schema[id_col].dataType.simpleString()
    placed = ranked.mapInPandas(
        place, f"id {kind}, piece int, start long, n_tokens long, bin_id long, bin_size long, bin_offset long"
    )
    none = [F.lit(None).cast("long").alias(c) for c in ("bin_id", "bin_size", "bin_offset")]
    empty = pieces.where("n_tokens = 0").select("id", "piece", "start", "n_tokens", *none)
    return placed.unionByName(empty).withColumnRenamed("id", id_col)


def pack_words(docs: DataFrame, sizes: tuple[int, ...] = SIZES) -> DataFrame:
    """``pack`` with a token per word of ``text``."""
    words = free_name(docs, "words")
    return pack(docs.select("doc_id", count_words(F.col("text")).alias(words)), F.col(words), sizes=sizes)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_words(table(spark, sf_dir, "documents"))
