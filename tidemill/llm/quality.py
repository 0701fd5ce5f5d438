"""Quality classifier: random-indexing vectors pooled per document, a two-layer network, temperature-calibrated.

Random indexing: every document has a sparse random index vector drawn from a hash of its text, and a word's vector is the
sum of the index vectors of the documents it occurs in. Words and word shapes share a fixed number of hashed slots, so the
vectors are a matrix of fixed size however large the corpus; each task adds its documents into one of its own, Spark sums
the rows per slot in whole numbers, and the result is the same in any order. A document is pooled as the mean vector of
its words, the mean vector of its shapes, its length and its share of distinct words. The network learns from a bounded
number of labelled documents; its temperature is set on labelled documents it has not seen.
"""

from __future__ import annotations

import itertools
import math
import operator
from collections import Counter
from collections.abc import Collection, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import bounded_batches, table
from tidemill.llm.tokens import core, held_out, outline, shape, training_labels, training_texts, words
from tidemill.session import written

SLOTS = 16_384  # words share slots by hash; with DIMS it bounds the matrix to 8 MB
DIMS = 64
INDEX_ONES = 8
TRAINING_ROWS = 20_000
THRESHOLD = 0.3

_HIDDEN, _EPOCHS, _BATCH = 32, 40, 256
_CACHED_TOKENS = 150_000
_VALIDATION = 5  # every fifth training row sets the temperature

_slots: dict[str, int] = {}
_kinds: dict[str | bytes, int] = {}


def _slot(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode("utf-8", "surrogatepass")) % SLOTS


def _token_slots(token: str) -> int:
    """The slots of the word and of its shape, as one number."""
    sketch = outline(token)
    kind = _kinds.get(sketch)
    if kind is None:
        if len(_kinds) >= _CACHED_TOKENS:
            _kinds.clear()
        kind = _kinds[sketch] = _slot("s" + shape(token))
    return _slot("w" + core(token)) * SLOTS + kind


def _slots_of(tokens: Collection[str]) -> list[int]:
    got = list(map(_slots.get, tokens))
    if None in got:
        if len(_slots) > _CACHED_TOKENS:
            _slots.clear()
        for i, token in enumerate(tokens):
            if got[i] is None:
                got[i] = _slots[token] = _token_slots(token)
    return got


_REPEAT = xxhash.xxh32_intdigest(b"repeat") % SLOTS


def _bag(text: str) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Slot pairs (word, shape) of the distinct tokens, their counts, the number of tokens equal to the one before, all tokens."""
    tokens = words(text)
    counts = Counter(tokens)
    again = sum(map(operator.eq, tokens, itertools.islice(tokens, 1, None)))
    both = np.array(_slots_of(counts), np.int64)
    slots = np.stack((both // SLOTS, both % SLOTS), axis=1)
    return slots, np.fromiter(counts.values(), np.int64, len(counts)), again, len(tokens)


def _index_vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")))
    return rng.choice(DIMS, INDEX_ONES, replace=False), np.where(np.arange(INDEX_ONES) % 2, 1, -1)


def _task_matrix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros((SLOTS, DIMS), np.int64)
    for batch in batches:
        for text in batch["text"]:
            if text:
                slots, counts, again, _ = _bag(text)
                weight = 1 + np.log2(counts).astype(np.int64)
                per_slot = np.bincount(np.append(slots.ravel(), _REPEAT), np.append(np.repeat(weight, 2), again), SLOTS)
                used = np.flatnonzero(per_slot)
                dims, signs = _index_vector(text)
                total[np.ix_(used, dims)] += per_slot[used].astype(np.int64)[:, None] * signs
    used = np.flatnonzero(total.any(axis=1))
    out = pd.DataFrame(total[used], columns=[f"d{i}" for i in range(DIMS)])
    out.insert(0, "slot", used)
    yield out


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vectors of all slots, learned from every text: ``SLOTS`` x ``DIMS`` numbers, the same size for any corpus."""
    dims = [f"d{i}" for i in range(DIMS)]
    parts = docs.select(F.col(text_col).alias("text")).mapInPandas(_task_matrix, "slot long, " + ", ".join(f"{d} long" for d in dims))
    sums = parts.groupBy("slot").agg(*(F.sum(d).alias(d) for d in dims)).toPandas()
    vectors = np.zeros((SLOTS, DIMS))
    vectors[sums["slot"].to_numpy(np.int64)] = sums[dims].to_numpy(np.float64)
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return (vectors / np.where(norms > 0, norms, 1)).astype(np.float32)


def pooled(text: str | None, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector, mean shape vector, share of repeats, log length, share of distinct tokens; zeros without a token."""
    out = np.zeros(2 * DIMS + 3, np.float32)
    if text:
        slots, counts, again, n = _bag(text)
        if n:
            for i in (0, 1):
                out[i * DIMS : (i + 1) * DIMS] = counts @ vectors[slots[:, i]] / n
            out[-3:] = again / n, math.log1p(n), len(counts) / n
    return out


@dataclass
class Network:
    """Standardised inputs, a hidden layer of tanh units, a logistic output with a temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 0) -> Network:
    """Adam on the log loss. Without rows of both classes the score is the share of ones (one half without rows)."""
    check = np.arange(len(y)) % _VALIDATION == 0
    if len(set(y[~check].tolist())) < 2:
        p = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
        d = x.shape[1]
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), math.log(p / (1 - p)), 1.0)
    rng = np.random.default_rng(seed)
    fit_x, fit_y = x[~check].astype(np.float64), y[~check].astype(np.float64)
    mean, scale = fit_x.mean(0), fit_x.std(0) + 1e-6
    z = (fit_x - mean) / scale
    params = [rng.normal(0, 1 / math.sqrt(z.shape[1]), (z.shape[1], _HIDDEN)), np.zeros(_HIDDEN), rng.normal(0, 0.1, _HIDDEN), np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(_EPOCHS):
        order = rng.permutation(len(z))
        for at in range(0, len(z), _BATCH):
            part = order[at : at + _BATCH]
            w1, b1, w2, b2 = params
            hidden = np.tanh(z[part] @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2, -500, 500))) - fit_y[part]) / len(part)
            back = np.outer(error, w2) * (1 - hidden**2)
            step += 1
            for i, grad in enumerate((z[part].T @ back + 1e-4 * w1, back.sum(0), hidden.T @ error + 1e-4 * w2, error.sum(keepdims=True))):
                first[i] = 0.9 * first[i] + 0.1 * grad
                second[i] = 0.999 * second[i] + 0.001 * grad**2
                params[i] = params[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(mean, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    net.temperature = _best_temperature(net.logits(x[check]), y[check])
    return net


def _best_temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss, by golden section over its logarithm."""

    def loss(log_t: float) -> float:
        z = logits / math.exp(log_t)
        return float(np.mean(np.logaddexp(0, z) - y * z))

    low, high, ratio = math.log(0.25), math.log(16), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all of ``docs``; a network from at most ``rows`` labelled documents that are not held out."""
    bounded_batches(docs.sparkSession)
    vectors = word_vectors(docs)
    sample = written(training_labels(labels, ["quality"], rows), "quality-labels")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            x = [pooled(t, vectors).tolist() for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "quality": b["quality"], "x": x})

    got = training_texts(docs, sample).mapInPandas(features, "doc_id long, quality int, x array<float>").toPandas()
    x = np.array(got["x"].tolist(), np.float32).reshape(len(got), 2 * DIMS + 3)
    # An order by content makes the fit the same every time.
    order = np.lexsort((*x.T[:4], got["doc_id"].to_numpy()))
    mixed = order[np.random.default_rng(7).permutation(len(order))]
    return vectors, train(x[mixed], got["quality"].to_numpy(np.int64)[mixed])


def quality_score(text: Column, model: tuple[np.ndarray, Network]) -> Column:
    vectors, net = model

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            x = np.array([pooled(t, vectors) for t in texts], np.float32).reshape(-1, 2 * DIMS + 3)
            yield pd.Series(net.scores(x), dtype="float64")

    return run(text)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those scored under ``threshold``.

    Every text gets a score: null and empty ones that of a document without words. Labels for unknown documents, null
    labels and held-out rows are not learned from; with no usable label at all every score is one half. Repeated rows get
    equal scores. Only the text is an input.
    """
    model = fit_quality(docs, labels)
    return docs.where(quality_score(F.col("text"), model) >= threshold)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", held_out().alias("held_out"), quality_score(F.col("text"), model).alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
