"""Exact top-k inner products with vector-approximation files.

Vectors are cut into blocks; a block's file holds one byte per component, the number of the cell its value lies in. A scan
of the cells gives each query an upper and a lower bound of every score. Only vectors whose upper bound reaches the k-th
best lower bound can be in the result. Of these the exact vectors are read from the best bound on: first k of them, then
those whose bound still reaches the k-th exact score; after that the result is certain.

Equal vectors have equal scores, so of each distinct vector the k + 1 smallest ids are all a result can need: a vector that
fills a third of the table is a few rows. Queries meet the blocks in tasks of one group of queries and one slice of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.common import shuffle_parts, table
from tidemill.llm.exact_gemm import matrix, quantised
from tidemill.session import written

TOP_K = 10
SCALE = 1024
ROWS_PER_BLOCK = 8_192
SLICE_BYTES = 64 << 20  # of cells, one byte a component
QUERIES_PER_GROUP = 8_192

_AT_ONCE = 256
_CELLS = 256


def _approximate(rows: pa.Table) -> pa.Table:
    """A block's file: ids, per dimension the least value and the width of a cell, and the cell numbers."""
    v = matrix(rows["v"]).astype(np.float64)
    low, high = (v.min(0), v.max(0)) if v.size else (np.zeros(v.shape[1]),) * 2
    width = np.maximum(1.0, np.ceil((high - low + 1) / _CELLS))
    cells = np.minimum((v - low) // width, _CELLS - 1).astype(np.uint8)
    return pa.table(
        {
            "block": [rows["block"][0].as_py()],
            "dims": pa.array([v.shape[1]], pa.int32()),
            "ids": [rows["vec_id"].to_numpy().astype(np.int64).tobytes()],
            "low": [low.tobytes()],
            "width": [width.tobytes()],
            "cells": [cells.tobytes()],
        }
    )


def _scan(k: int):
    def run(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        """For each query the vectors of the slice that may be among its k best, with the bounds of their scores."""
        out = {c: [] for c in ("query_id", "vec_id", "lower", "upper")}
        if blocks.num_rows and queries.num_rows:
            all_queries, ids = matrix(queries["v"]).astype(np.float64), queries["vec_id"].to_numpy().astype(np.int64)
            for at in range(0, len(ids), _AT_ONCE):
                _scan_part(blocks, ids[at : at + _AT_ONCE], all_queries[at : at + _AT_ONCE], k, out)
        kinds = {"query_id": np.int64, "vec_id": np.int64, "lower": np.float64, "upper": np.float64}
        return pa.table({c: np.concatenate(x) if x else np.zeros(0, kinds[c]) for c, x in out.items()})

    return run


def _scan_part(blocks: pa.Table, ids: np.ndarray, queries: np.ndarray, k: int, out: dict[str, list]) -> None:
    n = len(ids)
    floor = np.full(n, -np.inf)  # the k-th best lower bound so far
    best = np.full((n, k), -np.inf)
    found = []
    for i in range(blocks.num_rows):
        dims = blocks["dims"][i].as_py()
        vec_ids = np.frombuffer(blocks["ids"][i].as_py(), np.int64)
        low, width = (np.frombuffer(blocks[c][i].as_py(), np.float64) for c in ("low", "width"))
        cells = np.frombuffer(blocks["cells"][i].as_py(), np.uint8).reshape(len(vec_ids), dims)
        q = queries[:, :dims] if queries.shape[1] >= dims else np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
        corner = low + cells * width
        at_corner = q @ corner.T
        # Rounding of the products must not cut a true bound.
        slack = 1e-12 * (np.abs(q) @ np.maximum(np.abs(low), np.abs(low + _CELLS * width)))[:, None] + 1e-9
        reach = (width - 1) * q
        upper = at_corner + np.maximum(reach, 0).sum(1)[:, None] + slack
        lower = at_corner + np.minimum(reach, 0).sum(1)[:, None] - slack
        own = vec_ids[None, :] == ids[:, None]
        upper[own], lower[own] = -np.inf, -np.inf
        joined = np.hstack([best, np.partition(lower, -k, axis=1)[:, -k:] if lower.shape[1] > k else lower])
        best = np.sort(joined, axis=1)[:, -k:]
        floor = best[:, 0]
        who, which = np.nonzero((upper >= floor[:, None]) & ~own)
        found.append((who, vec_ids[which], lower[who, which], upper[who, which]))
    who, vec, low_bound, up_bound = (np.concatenate(x) for x in zip(*found, strict=True))
    good = up_bound >= floor[who]
    for c, x in (("query_id", ids[who]), ("vec_id", vec), ("lower", low_bound), ("upper", up_bound)):
        out[c].append(x[good])


def _exact(pairs: DataFrame, queries: DataFrame, vectors: DataFrame) -> DataFrame:
    """``query_id, own_id, vec_id, id, score``: exact products of the pairs of rows, shorter vectors filled with zeros."""
    q = queries.select(F.col("vec_id").alias("query_id"), F.col("id").alias("own_id"), F.col("v").alias("q"))
    product = F.aggregate(F.zip_with("q", "v", lambda x, y: F.coalesce(x * y, F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, x: s + x)
    return pairs.join(q, "query_id").join(vectors, "vec_id").select("query_id", "own_id", "vec_id", "id", product.alias("score"))


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP_K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row with ``is_query`` its k rows of largest score, ties to smaller ids.

    The score is the inner product of the components' floor(1024 x). Rows with a null id, a null vector or a null or
    non-finite component take no part; neither does a query's own row among its candidates. Rows that repeat an id are
    candidates and queries of their own, with a run of ranks for each. Vectors of different lengths are compared as if the
    shorter one ended in zeros. A score outside the range of a long is an error. Fewer than k candidates are all returned.
    """
    spark = vectors.sparkSession
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), SCALE).alias("v"), is_query.alias("is_query"))
    # Within the search a row goes by its number, not by its id.
    rows = written(usable.where("id IS NOT NULL AND v IS NOT NULL").withColumn("vec_id", F.monotonically_increasing_id()), "vectors")
    queries = rows.where("is_query").drop("is_query")
    place = F.row_number().over(W.partitionBy("v").orderBy("id", "vec_id"))
    needed = written(rows.select("vec_id", "id", "v", place.alias("place")).where(F.col("place") <= k + 1).drop("place"), "needed-vectors")

    n, n_queries = needed.count(), queries.count()
    dims = needed.agg(F.max(F.size("v"))).first()[0] or 0
    slices = max(shuffle_parts(spark), n * dims // SLICE_BYTES + 1)
    blocks, groups = max(slices, n // ROWS_PER_BLOCK + 1), n_queries // QUERIES_PER_GROUP + 1
    files = written(
        needed.select("vec_id", "v").withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
        .groupBy("block")
        .applyInArrow(_approximate, "block long, dims int, ids binary, low binary, width binary, cells binary"),
        "va-files",
    )
    left = files.withColumns({"slice": F.col("block") % slices, "group": F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))})
    right = queries.withColumns(
        {"group": F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int"), "slice": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long")))}
    )
    bounds = written(
        left.groupBy("group", "slice")
        .cogroup(right.groupBy("group", "slice"))
        .applyInArrow(_scan(k), "query_id long, vec_id long, lower double, upper double"),
        "bounds",
    )
    by_lower = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("lower")))
    floors = bounds.select("query_id", "lower", by_lower.alias("at")).where(F.col("at") <= k).groupBy("query_id").agg(
        F.when(F.count(F.lit(1)) == k, F.min("lower")).alias("floor")
    )
    open_pairs = bounds.join(floors, "query_id").where((F.col("upper") >= F.col("floor")) | F.col("floor").isNull())
    by_upper = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("upper"), "vec_id"))
    ordered = written(open_pairs.select("query_id", "vec_id", "upper", by_upper.alias("at")), "bound-order")
    first = written(_exact(ordered.where(F.col("at") <= k), queries, needed), "first-exact")
    reached = first.groupBy("query_id").agg(F.min("score").alias("kth"))
    rest = ordered.where(F.col("at") > k).join(reached, "query_id").where(F.col("upper") >= F.col("kth"))
    scored = first.union(_exact(rest.select("query_id", "vec_id"), queries, needed))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "id", "vec_id"))
    best = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    return best.select(F.col("own_id").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score")


def op5_vector_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP5_SQL = """
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.row <> c.row WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
