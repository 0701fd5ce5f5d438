"""Hard negatives: per anchor and positive the best-scoring rows of other labels whose score lies in a window below the positive's.

Vectors are dealt to the nearest of a few root points (from a bounded sample) and cut into blocks, each with a multiway
hyperplane tree (``hyperplane_tree``). Probes meet the trees in tasks of one group of probes and one slice of blocks; a task
keeps the best rows per probe, Spark ranks them over all slices. First the positives are searched, then the windows they open.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import fields

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.llm.common import shuffle_parts, table
from tidemill.llm.exact_gemm import matrix, quantised
from tidemill.llm.hyperplane_tree import Best, HyperplaneTree, Probes, build_tree, search
from tidemill.session import written

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # per cent of the positive's score

ROOT_POINTS = 64
ROOT_SAMPLE = 2_048
BLOCK_BYTES = 4 << 20
SLICE_BYTES = 64 << 20
PROBE_BYTES = 8 << 20

_LONGS = np.iinfo(np.int64)
_TREE = tuple(f.name for f in fields(HyperplaneTree))
_FILE = "block long, dims int, ids binary, groups binary, " + ", ".join(f"`{c}` binary" for c in _TREE)


def _nearest_root(points: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = points.astype(np.float64)
        for batch in batches:
            v = matrix(batch.column("v"), points.shape[1]).astype(np.float64)
            cell = ((p * p).sum(1)[None, :] - 2 * (v @ p.T)).argmin(1) if len(v) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(cell.astype(np.int32))], names=["row", "cell"])

    return run


def _blocks(rows: DataFrame, dims: int, n: int) -> tuple[DataFrame, int]:
    """``rows`` with the number of their block, and how many blocks there are; blocks of a cell follow each other."""
    spark = rows.sparkSession
    per_block = max(1, BLOCK_BYTES // (8 * max(1, dims)))
    if n <= per_block:
        return rows.withColumn("block", F.lit(0).cast("long")), 1
    sample = rows.select("v").orderBy(F.xxhash64("row"), "row").limit(ROOT_SAMPLE).collect()
    vectors = np.unique(matrix(pa.array([r["v"] for r in sample], pa.list_(pa.int64())), dims), axis=0)
    chosen = np.linspace(0, len(vectors) - 1, min(len(vectors), ROOT_POINTS, n // per_block + 1)).astype(np.int64)
    cells = written(rows.select("row", "v").mapInArrow(_nearest_root(vectors[chosen]), "row long, cell int"), "root-cells")
    first, places = 0, []
    for r in cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).orderBy("cell").collect():  # at most ROOT_POINTS rows
        chunks = r["n"] // per_block + 1
        places.append((r["cell"], first, chunks))
        first += chunks
    known = spark.createDataFrame(places, "cell int, first long, chunks long")
    of = cells.join(F.broadcast(known), "cell").select(
        F.col("row").alias("of"), (F.col("first") + F.pmod(F.xxhash64("row"), F.col("chunks"))).alias("block")
    )
    return rows.join(of, F.col("row") == F.col("of")).drop("of"), first


def _build(dims: int) -> Callable[[pa.Table], pa.Table]:
    def run(rows: pa.Table) -> pa.Table:
        order = np.argsort(rows["row"].to_numpy())  # rows come in any order, the tree is the same
        rows = rows.take(pa.array(order))
        n = np.arange(rows.num_rows)
        tree = build_tree(matrix(rows["v"], dims), n)
        at = tree.rows
        tree.rows = rows["row"].to_numpy()[at]
        out = {"block": [rows["block"][0].as_py()], "dims": pa.array([dims], pa.int32())}
        out |= {"ids": [rows["vec_id"].to_numpy()[at].tobytes()], "groups": [rows["label"].to_numpy()[at].tobytes()]}
        return pa.table(out | {c: [b] for c, b in tree.to_bytes().items()})

    return run


def tree_files(rows: DataFrame, dims: int) -> tuple[DataFrame, int]:
    """One row per block with its tree, and the number of slices; ``rows`` has ``row, vec_id, label, v``."""
    n = rows.count()
    dealt, blocks = _blocks(rows, dims, n)
    slices = max(1, -(-n * dims * 8 // SLICE_BYTES))
    files = dealt.select("row", "vec_id", "label", "v", "block").groupBy("block").applyInArrow(_build(dims), _FILE)
    placed = files.withColumn("slice", F.floor(F.col("block") * F.lit(min(slices, blocks)) / F.lit(blocks)).cast("int"))
    return written(placed, "tree-files"), min(slices, blocks)


def _search(k: int, same: bool, dims: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(files: pa.Table, probes: pa.Table) -> pa.Table:
        columns = ("anchor", "mark", "low", "high", "label")
        anchor, mark, low, high, label = (probes[c].to_numpy().astype(np.int64) for c in columns)
        best = Best(len(anchor), k)
        asked = Probes(matrix(probes["v"], dims), anchor, low, high, label, same)
        for i in range(files.num_rows if len(anchor) else 0):
            tree = HyperplaneTree.from_bytes({c: files[c][i].as_py() for c in _TREE}, dims)
            ids, groups = (np.frombuffer(files[c][i].as_py(), np.int64) for c in ("ids", "groups"))
            search(tree, ids, groups, asked, best)
        who, which = np.nonzero(best.row >= 0)
        out = {"anchor": anchor[who], "mark": mark[who], "row": best.row[who, which], "vec_id": best.id[who, which], "score": best.score[who, which]}
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    return run


def best_in_windows(files: DataFrame, slices: int, probes: DataFrame, dims: int, k: int, same: bool) -> DataFrame:
    """``anchor, mark, rank, row, vec_id, score``: per probe the ``k`` best rows of its window, ties to smaller ids, then rows.

    ``probes`` has ``anchor`` (a row number, never its own result), ``mark`` (tells an anchor's probes apart), ``low``,
    ``high`` (scores, both included), ``label`` and ``v``; found are rows of the same label, or with ``same`` false of others.
    """
    spark = files.sparkSession
    groups = max(probes.count() * dims * 8 // PROBE_BYTES + 1, -(-shuffle_parts(spark) // slices))
    left = files.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = probes.withColumns(
        {"group": F.pmod(F.xxhash64("anchor", "mark"), F.lit(groups)).cast("int"), "slice": F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))}
    )
    found = left.groupBy("group", "slice").cogroup(right.groupBy("group", "slice")).applyInArrow(
        _search(k, same, dims), "anchor long, mark long, row long, vec_id long, score long"
    )
    rank = F.row_number().over(W.partitionBy("anchor", "mark").orderBy(F.desc("score"), "vec_id", "row"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("anchor", "mark", "rank", "row", "vec_id", "score")


def _floor_percent(score: str, percent: int) -> str:
    """``percent`` / 100 of a whole score, rounded down."""
    return f"(({score} * {percent} - pmod({score} * {percent}, 100)) div 100)"


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``, at most ``negatives`` per positive.

    Scores are inner products of the components' floor(``SCALE`` x). An anchor's positives are its ``positives`` best other
    rows of the same label; a negative's label differs and its score is from ``lowest`` to ``highest`` per cent of the
    positive's, both included (nothing fits under a negative one). Ties go to the smaller id. Rows with a null id, a null
    label, a null vector or a null or non-finite component take no part. Rows that repeat an id are rows of their own, as
    anchors, positives and negatives. Shorter vectors are compared as if they ended in zeros. Scores beyond 2^62, or 100 times
    a long, are an error. ``label`` is a column of whole numbers (by default ``label``); other columns are not read.
    """
    of = label if label is not None else F.col("label")
    usable = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"),
        of.cast("long").alias("label"),
        quantised(F.col(vector_col), SCALE).alias("v"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"),
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = written(usable.withColumn("row", F.monotonically_increasing_id()), "labelled-vectors")
    dims = max(1, rows.agg(F.max(F.size("v"))).first()[0] or 0)
    files, slices = tree_files(rows, dims)

    anchors = rows.where("is_anchor").select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "v")
    whole = {"mark": F.lit(0).cast("long"), "low": F.lit(int(_LONGS.min)), "high": F.lit(int(_LONGS.max))}
    near = best_in_windows(files, slices, anchors.withColumns(whole), dims, positives, same=True)
    near = written(near.select("anchor", "row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    window = near.select("anchor", F.col("positive_score").alias("mark")).distinct().withColumns(
        {"low": F.expr(f"-{_floor_percent('mark', -lowest)}"), "high": F.expr(_floor_percent("mark", highest))}
    )
    windows = written(anchors.join(window.where("low <= high"), "anchor"), "windows")
    hard = best_in_windows(files, slices, windows, dims, negatives, same=False).select(
        "anchor", "mark", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    paired = near.withColumn("mark", F.col("positive_score")).join(hard, ["anchor", "mark"])
    return paired.join(anchors.select("anchor", "anchor_id"), "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)


OP11_SQL = f"""
WITH usable AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, r.row, CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
  FROM usable a JOIN usable r ON a.row <> r.row WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, row) AS place FROM scored WHERE same) WHERE place <= {POSITIVES}
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id, n.row) AS rank
  FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
  WHERE {LOWEST} * p.score <= 100 * n.score AND 100 * n.score <= {HIGHEST} * p.score
) WHERE rank <= {NEGATIVES}
"""
