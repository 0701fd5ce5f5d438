"""Product quantisation in whole numbers: vectors as short codes over codebooks learned by rounds of exact means.

A vector is cut into equal consecutive parts, each with a codebook of its own. Every round assigns each part to the nearest
entry and replaces the entries by the floors of their parts' means. Distances come from exact integer products (limb-split
matrix products), so codes, ties and errors are the same on any cluster. A task reads its vectors in batches and sends on one
sum per entry it met; the codebooks, ``ENTRIES`` x dimensions numbers, are all that passes through the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import table
from tidemill.llm.exact_gemm import matrix, products, quantised, squares
from tidemill.session import written

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4

_CELLS_AT_ONCE = 4_000_000  # distances a task holds at once
_FEW_LABELS = 200_000
_SALTS = 32


@dataclass(frozen=True)
class Codebooks:
    """Entries per part, as whole numbers: ``PARTS`` arrays of (entries, width)."""

    parts: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.parts[0].shape[1]

    @property
    def dims(self) -> int:
        return self.width * len(self.parts)

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for p in self.parts for x in p.ravel().tolist()).encode()).hexdigest()


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row (the first of equally near ones), and the squared distance."""
    index, error = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    lengths = squares(entries)
    step = max(1, _CELLS_AT_ONCE // max(1, len(entries)))
    for at in range(0, len(x), step):
        part = x[at : at + step]
        far = lengths[None, :] - 2 * products(part, entries)
        index[at : at + step] = far.argmin(axis=1)
        error[at : at + step] = far.min(axis=1) + squares(part)
    return index, error


def _parts(batch: pa.RecordBatch, books: Codebooks) -> Iterator[tuple[int, np.ndarray]]:
    v = matrix(batch.column("v"), books.dims)
    for p in range(len(books.parts)):
        yield p, np.ascontiguousarray(v[:, p * books.width : (p + 1) * books.width])


def _task_sums(books: Codebooks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Count and sum of the parts assigned to each entry, over all of a task's rows."""
        counts = [np.zeros(len(p), np.int64) for p in books.parts]
        sums = [np.zeros_like(p) for p in books.parts]
        for batch in batches:
            for p, x in _parts(batch, books):
                index, _ = nearest(x, books.parts[p])
                order = np.argsort(index, kind="stable")
                met, first = np.unique(index[order], return_index=True)
                counts[p] += np.bincount(index, minlength=len(counts[p]))
                if len(met):
                    sums[p][met] += np.add.reduceat(x[order], first, axis=0)
        for p, n in enumerate(counts):
            used = np.flatnonzero(n)
            out = {"part": np.full(len(used), p), "entry": used, "n": n[used]}
            out |= {f"s{i}": sums[p][used, i] for i in range(books.width)}
            yield pa.RecordBatch.from_pydict({c: pa.array(x, pa.int64()) for c, x in out.items()})

    return run


def _next(rows: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry with parts becomes the floor of their mean, the others stay."""
    names = [f"s{i}" for i in range(books.width)]
    schema = ", ".join(f"{c} long" for c in ("part", "entry", "n", *names))
    sums = rows.select("v").mapInArrow(_task_sums(books), schema)
    parts = [p.copy() for p in books.parts]
    # At most ENTRIES rows per part.
    for r in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *(F.sum(c).alias(c) for c in names)).collect():
        parts[r["part"]][r["entry"]] = [r[c] // r["n"] for c in names]
    return Codebooks(parts)


def _first_books(rows: DataFrame, parts: int, entries: int) -> Codebooks:
    """The parts of the rows with the smallest ids; rows that share an id are ordered by their components."""
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(1, -(-longest // parts))
    firsts = [r["v"] for r in rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    v = matrix(pa.array(firsts, pa.list_(pa.int64())), width * parts)
    return Codebooks([np.ascontiguousarray(v[:, p * width : (p + 1) * width]) for p in range(parts)])


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks learned from all ``rows`` (``vec_id``, ``v`` of whole numbers); without rows they have no entries."""
    books = _first_books(rows, parts, entries)
    for _ in range(rounds if len(books.parts[0]) else 0):
        books = _next(rows, books)
    return books


def _encode(books: Codebooks) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, total = np.zeros((batch.num_rows, len(books.parts)), np.uint8), np.zeros(batch.num_rows, np.int64)
            for p, x in _parts(batch, books):
                codes[:, p], error = nearest(x, books.parts[p])
                total += error
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(total)],
                names=["vec_id", "label", "code", "error"],
            )

    return run


def decode(code: bytes, books: Codebooks) -> np.ndarray:
    """The vector a code stands for."""
    return np.concatenate([p[i] for p, i in zip(books.parts, code, strict=True)])


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with the ``error`` summed over equal labels; rows without a label count as one label.

    Few labels are joined by broadcast; beyond that the sums are copied and the rows dealt over the copies, so no task holds
    the rows of a common label.
    """
    sums = written(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = sums.withColumnRenamed("label", "of")
    if sums.count() <= _FEW_LABELS:
        joined = coded.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")))
    else:
        copies = sums.select("*", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("copy"))
        dealt = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(_SALTS)).cast("int"))
        joined = dealt.join(copies, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("copy"))).drop("salt", "copy")
    return joined.drop("of")


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, Codebooks]:
    """``vec_id, label, code, error`` of every usable row, and the codebooks that ``decode`` reads the codes with.

    ``code`` is one byte per part (so at most 256 entries), ``error`` the squared distance to what the code stands for, in
    units of 1 / ``SCALE``. Rows with a null vector or a null or non-finite component are left out; empty vectors count as
    zeros. Vectors are compared as if the shorter ones, and the longest up to a multiple of ``parts``, ended in zeros. Rows
    that repeat an id or a whole row each get their code; a null id comes last among the starting entries. Components and
    sums beyond a long are an error. Extra columns are not read. Without rows the codebooks have no entries.
    """
    if entries > ENTRIES:
        raise ValueError(f"a code byte knows {ENTRIES} entries")
    named = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), quantised(F.col(vector_col), SCALE).alias("v")
    )
    rows = written(named.where("v IS NOT NULL"), "whole-vectors")
    books = fit_codebooks(rows, parts, entries, rounds)
    types = dict(rows.dtypes)
    coded = rows.mapInArrow(_encode(books), f"vec_id {types['vec_id']}, label {types['label']}, code binary, error long")
    return written(coded, "vector-codes"), books


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(table(spark, sf_dir, "embeddings"))
    return with_label_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256")
    )


def _sql() -> str:
    """The rounds as a chain of tables: distances of every part to every entry, then floors of means."""
    steps = [
        """usable AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT row, part, list_slice(v, part * (len(v) // 4) + 1, (part + 1) * (len(v) // 4)) AS p FROM usable, range(4) t(part)
), book0 AS MATERIALIZED (
  SELECT part, entry, p AS e FROM parts
  JOIN (SELECT row, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM usable) USING (row) WHERE entry < 256
)"""
    ]
    for i in range(ROUNDS + 1):
        steps.append(
            f"""best{i} AS MATERIALIZED (
  SELECT row, part, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT row, parts.part, entry, CAST(list_sum(list_transform(list_zip(p, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts JOIN book{i} ON parts.part = book{i}.part
  ) GROUP BY row, part
)"""
        )
        if i < ROUNDS:
            steps.append(
                f"""book{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM book{i} b LEFT JOIN (
    SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS e FROM (
      SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM (
        SELECT part, best{i}.entry, unnest(p) AS x, unnest(range(len(p))) AS pos FROM best{i} JOIN parts USING (row, part)
      ) GROUP BY part, entry, pos
    ) GROUP BY part, entry
  ) m ON b.part = m.part AND b.entry = m.entry
)"""
            )
    last = ROUNDS
    return f"""
WITH {", ".join(steps)}, coded AS (
  SELECT row, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM best{last} GROUP BY row
), books AS (
  SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{last}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN usable USING (row), books
"""


OP12_SQL = _sql()
