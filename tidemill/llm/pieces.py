"""SentencePiece encoding and decoding with a given model.

All pieces form one Aho-Corasick automaton. A single pass over the text follows its output links: at each position every
piece that ends there, the longest first, relaxes the best score of the text up to it. A character that no piece covers
alone may be unknown, at ten less than the worst score, and is spelt in bytes where the model has byte pieces.

No piece has a word-start mark behind another character (checked when a model is opened; otherwise texts are one stretch),
so the best path never crosses the start of a run of marks, nor a character that is in no piece: stretches between these are
encoded on their own, and the automaton runs once for stretches that a task meets again and again.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed values of the format: the mark that stands for a space, the penalty of an unknown character, its sign in decoded text.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
UNKNOWN_TEXT = " ⁇ "

_CACHED_STRETCHES = 200_000
_DOCUMENTS_AT_ONCE = 128
_CACHED_CHARS = 64


class _Paths(dict):
    """The pieces of stretches met lately, as 4-byte numbers. When half of the room is used, the half filled before is given up."""

    def __init__(self, best_path: Callable[[str], tuple[int, ...]]):
        super().__init__()
        self._best_path, self._before = best_path, {}

    def __missing__(self, stretch: str) -> bytes:
        found = self._before.get(stretch)
        if found is None:
            found = array("i", self._best_path(stretch)).tobytes()
        if len(stretch) <= _CACHED_CHARS:
            if len(self) >= _CACHED_STRETCHES // 2:
                self._before = dict(self)
                self.clear()
            self[stretch] = found
        return found


class PieceModel:
    """A model's pieces and scores; ``model`` is the content of a model file."""

    def __init__(self, model: bytes):
        self.processor = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        self.unknown = sp.unk_id()
        self.texts, self.bytes_of, self.byte_ids = [], {}, {}
        self.automaton = ahocorasick.Automaton()
        self._alone: set[str] = set()  # the characters that a piece covers alone
        worst, whole = 0.0, True
        for i in range(n):
            piece = sp.id_to_piece(i)
            self.texts.append("" if sp.is_control(i) else UNKNOWN_TEXT if sp.is_unknown(i) else piece)
            if sp.is_byte(i):
                self.bytes_of[i] = int(piece[1:-1], 16)
                self.byte_ids[self.bytes_of[i]] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.automaton.add_word(piece, (len(piece), i, sp.get_score(i)))
                if len(piece) == 1:
                    self._alone.add(piece)
                worst = min(worst, sp.get_score(i))
                whole = whole and MARK not in piece.lstrip(MARK)
        self.automaton.make_automaton()
        self.unknown_score = worst - UNKNOWN_PENALTY
        self.prefix = sp.normalize("a").startswith(MARK)
        # Characters in no piece, where they are spelt in bytes one by one: the ASCII ones, as line ends, are common.
        known = {c for _, i, _ in self.automaton.values() for c in self.texts[i]}
        foreign = "".join(re.escape(c) for c in map(chr, range(128)) if c not in known) if len(self.byte_ids) == 256 else ""
        stretch = re.compile(f"{MARK}*[^{MARK}{foreign}]+|{MARK}+" + (f"|[{foreign}]+" if foreign else ""))
        self._stretches = stretch.findall if whole else lambda text: [text] if text else []
        self._paths = _Paths(self._best_path)
        # A byte below 128 is a character whatever stands beside it; only other bytes must be put together.
        self._plain = [chr(self.bytes_of[i]) if self.bytes_of.get(i, 128) < 128 else t for i, t in enumerate(self.texts)]
        self._joined = {i for i, byte in self.bytes_of.items() if byte >= 128}

    def encode(self, text: str) -> np.ndarray:
        found = map(self._paths.__getitem__, self._stretches(self.processor.normalize(text)))
        return np.frombuffer(b"".join(found), np.int32).copy()

    def _best_path(self, text: str) -> tuple[int, ...]:
        return self._covered_path(text) if self._alone.issuperset(text) else self._path_with_unknown(text)

    def _covered_path(self, text: str) -> tuple[int, ...]:
        """The best path of a text without unknown characters."""
        n = len(text)
        best = [float("-inf")] * n
        best.append(0.0)  # the score before the first character, at place -1
        last: list[tuple[int, int, float]] = [(0, 0, 0.0)] * n  # the last piece of the best path
        for end, step in self.automaton.iter(text):
            score = best[end - step[0]] + step[2]
            if score > best[end]:
                best[end], last[end] = score, step
        ids: list[int] = []
        end = n - 1
        while end >= 0:
            length, piece, _ = last[end]
            ids.append(piece)
            end -= length
        ids.reverse()
        return tuple(ids)

    def _path_with_unknown(self, text: str) -> tuple[int, ...]:
        n = len(text)
        best = [float("-inf")] * (n + 1)
        best[0] = 0.0
        back: list[tuple[int, int]] = [(0, self.unknown)] * (n + 1)  # start and piece of the best last step
        at, covered = 0, False  # the character whose ends are being relaxed, and whether a piece covers it alone

        def close() -> None:
            if not covered and best[at] + self.unknown_score > best[at + 1]:
                best[at + 1], back[at + 1] = best[at] + self.unknown_score, (at, self.unknown)

        for end, (length, piece, score) in self.automaton.iter(text):
            while at < end:
                close()
                at, covered = at + 1, False
            start = end + 1 - length
            if best[start] + score > best[end + 1]:
                best[end + 1], back[end + 1] = best[start] + score, (start, piece)
            covered = covered or length == 1
        while at < n:
            close()
            at, covered = at + 1, False
        ids: list[int] = []
        end, run = n, False  # a run of unknown characters without byte pieces is one unknown
        while end:
            start, piece = back[end]
            if piece != self.unknown:
                ids.append(piece)
            elif self.byte_ids:
                ids.extend(self.byte_ids[b] for b in reversed(text[start:end].encode("utf-8", "surrogatepass")))
            elif not run:
                ids.append(piece)
            end, run = start, piece == self.unknown
        return tuple(reversed(ids))

    def decode(self, ids: np.ndarray) -> str:
        numbers = ids.tolist()
        if self._joined.isdisjoint(numbers):
            return self._spaced("".join(map(self._plain.__getitem__, numbers)))
        parts: list[str] = []
        held = bytearray()
        for i in numbers:
            byte = self.bytes_of.get(i)
            if byte is not None:
                held.append(byte)
                continue
            if held:
                parts.append(_utf8(bytes(held)))
                held.clear()
            parts.append(self.texts[i])
        if held:
            parts.append(_utf8(bytes(held)))
        return self._spaced("".join(parts))

    def _spaced(self, text: str) -> str:
        text = text.replace(MARK, " ")
        return text[1:] if self.prefix and text.startswith(" ") else text


def _utf8(raw: bytes) -> str:
    """Valid characters as they are, and a replacement sign for each byte that belongs to none."""
    parts = []
    while raw:
        try:
            parts.append(raw.decode("utf-8"))
            break
        except UnicodeDecodeError as bad:
            parts.append(raw[: bad.start].decode("utf-8") + "�")
            raw = raw[bad.start + 1 :]
    return "".join(parts)


_open: dict[int, PieceModel] = {}


def _opened(model: bytes) -> PieceModel:
    """One model a worker process, opened once."""
    key = hash(model)
    if key not in _open:
        _open[key] = PieceModel(model)
    return _open[key]


def read_model(path: str = MODEL_PATH) -> bytes:
    """The model file, read where the job is planned and sent along with it."""
    with open(path, "rb") as f:
        return f.read()


def encode(text: Column, model: bytes) -> Column:
    """Piece numbers of a text, as the model's best-scored path. Null for null, an empty array for an empty text."""

    @F.pandas_udf("array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _opened(model)
        for texts in parts:
            yield pd.Series([None if t is None else pieces.encode(t) for t in texts], dtype=object)

    return run(text)


def decode(ids: Column, model: bytes) -> Column:
    """The text of piece numbers: marks are spaces, one leading space is dropped where the model adds one, control pieces
    are nothing. Null for null. An encoded text comes back as it was where the model's normal form keeps it; only the
    mark character itself comes back as a space. A number the model does not have is an error."""

    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        pieces = _opened(model)
        for series in parts:
            yield pd.Series([None if x is None else pieces.decode(np.asarray(x)) for x in series], dtype=object)

    return run(ids)


def code_documents(docs: DataFrame, model: bytes, ids_col: str = "pieces", back_col: str | None = None) -> DataFrame:
    """``docs`` with the piece numbers of ``text`` in ``ids_col``, and in ``back_col`` the text decoded from them again.

    As ``encode`` and ``decode``, but a task holds the pieces of few documents at a time, whatever the batches it gets.
    Columns of these names must not exist yet.
    """
    fields = [*docs.schema.fields, T.StructField(ids_col, T.ArrayType(T.IntegerType()))]
    if back_col:
        fields.append(T.StructField(back_col, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _opened(model)
        for batch in batches:
            for at in range(0, batch.num_rows, _DOCUMENTS_AT_ONCE):
                part = batch.slice(at, _DOCUMENTS_AT_ONCE)
                ids = [None if t is None else pieces.encode(t) for t in part.column("text").to_pylist()]
                columns = {**dict(zip(part.schema.names, part.columns, strict=True)), ids_col: pa.array(ids, pa.list_(pa.int32()))}
                if back_col:
                    columns[back_col] = pa.array([None if x is None else pieces.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(run, T.StructType(fields))


def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: number and digest of its pieces, digest of the text that comes back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = code_documents(docs, read_model(), "ids", "back")
    return coded.select(
        "doc_id",
        F.size(F.coalesce("ids", F.array().cast("array<int>"))).cast("long").alias("n_pieces"),
        F.sha2(F.coalesce(F.array_join("ids", ","), F.lit("")), 256).alias("ids_sha256"),
        F.sha2(F.coalesce("back", F.lit("")), 256).alias("decoded_sha256"),
        F.coalesce(F.col("back") == F.col("text"), F.lit(True)).alias("same"),
    )
