"""What the classifiers see of a word, and the labelled rows they may learn from."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
PIECE_CHARS = 48



class _Kinds(dict):
    """Characters to their kinds, worked out when first met."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        kind = self[code] = "X" if c.isupper() else "x" if c.isalpha() else "9" if c.isdigit() else c
        return kind


_KINDS = _Kinds()
_ASCII_KINDS = bytes(ord(_KINDS[c]) for c in range(128)) + bytes(range(128, 256))
_KIND_RUNS, _MARK_RUNS = re.compile(r"([Xx9])\1+"), re.compile(r"([^Xx9])\1{2,}")
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def core(token: str) -> str:
    """The word without ASCII marks around it, in lower case."""
    return token.strip(_MARKS).lower()


def outline(token: str) -> str | bytes:
    """Letters as X or x, digits as 9, marks as they are: all that the shape depends on."""
    raw = token.encode("utf-8", "surrogatepass")
    return raw.translate(_ASCII_KINDS) if len(raw) == len(token) else token.translate(_KINDS)


def shape(token: str) -> str:
    """The outline with one of a kind in a row, and at most two equal marks."""
    out = outline(token)
    out = _KIND_RUNS.sub(r"\1", out.decode() if isinstance(out, bytes) else out)
    return _MARK_RUNS.sub(r"\1\1", out)


def words(text: str) -> list[str]:
    """What stands between white space. Longer stretches are cut into pieces, so that a text without spaces counts as a whole."""
    found = text.split()
    if max(map(len, found), default=0) <= PIECE_CHARS:
        return found
    return [w[i : i + PIECE_CHARS] for w in found for i in range(0, len(w), PIECE_CHARS)]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows no classifier learns from: crc32 of the id as text divisible by 5, and rows without an id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(True))


def training_labels(labels: DataFrame, columns: list[str], rows: int) -> DataFrame:
    """Labels to learn from: not held out, all ``columns`` known, one row per document (least values), and of these the
    ``rows`` with the smallest hashed ids."""
    known = labels.where(~held_out())
    for c in columns:
        known = known.where(F.col(c).isNotNull())
    one = known.groupBy("doc_id").agg(*(F.min(c).alias(c) for c in columns))
    return one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def training_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """``sample`` (rows of ``training_labels``) with the ``text`` of each document; of several rows with its id that with the
    least text hash, so there are never more rows than labels."""
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least")
    # At most a label per chosen id: a few hundred kilobytes.
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy(*sample.columns).agg(one)
    return found.select(*sample.columns, F.col("least.text").alias("text"))
