"""Toxicity: a chain of linear classifiers, each fed the earlier categories' probabilities.

A category is a 0/1 label column. Its classifier sees which selected word features a text has (words, word beginnings,
word shapes) and the probabilities of the categories before it. While training, those probabilities are out of fold: they
come from models that have not seen the row, as they will be when the chain meets new texts. The chain learns on a bounded
number of labelled documents; the selected features and weights are a small table that every task gets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm.common import free_name, table
from tidemill.llm.tokens import core, held_out, shape, training_labels, training_texts, words
from tidemill.session import written

TRAINING_ROWS = 12_000
FEATURES = 512  # selected per category
FOLDS = 5
THRESHOLD = 0.5
HASHES = 1 << 24

_LEAST_ROWS = 3  # a selected feature occurs in so many training rows
_STEPS = 150
_CACHED_TOKENS = 200_000


@lru_cache(_CACHED_TOKENS)
def token_features(token: str) -> tuple[int, ...]:
    word = core(token)
    names = ["w" + word, "s" + shape(token)] + [f"p{word[:n]}" for n in (4, 5) if len(word) > n]
    return tuple(xxhash.xxh32_intdigest(n.encode("utf-8", "surrogatepass")) % HASHES for n in names)


def text_features(text: str | None) -> np.ndarray:
    """The distinct features of a whole text."""
    found: set[int] = set()
    for token in set(words(text or "")):
        found.update(token_features(token))
    return np.array(sorted(found), np.int64)


@dataclass
class Link:
    """One category's classifier: weights by feature number, weights of the earlier probabilities, and a bias."""

    weights: dict[int, float]
    earlier: np.ndarray
    bias: float


class Chain:
    def __init__(self, categories: list[str], links: list[Link]):
        self.categories, self.links = categories, links
        self._table = {f: tuple(link.weights.get(f, 0.0) for link in links) for f in set().union(*(link.weights for link in links))}
        self._cache: dict[str, tuple[int, ...]] = {}

    def __getstate__(self):
        return {"categories": self.categories, "links": self.links}

    def __setstate__(self, state):
        self.__init__(**state)

    def _known(self, token: str) -> tuple[int, ...]:
        got = self._cache.get(token)
        if got is None:
            if len(self._cache) >= _CACHED_TOKENS:
                self._cache.clear()
            got = tuple(f for f in token_features(token) if f in self._table)
            self._cache[token] = got
        return got

    def predict(self, texts: Iterator[str | None]) -> np.ndarray:
        """A row per text, a column per category."""
        sums = []
        for text in texts:
            found: set[int] = set()
            for token in set(words(text or "")):
                found.update(self._known(token))
            sums.append(np.sum([self._table[f] for f in sorted(found)], axis=0) if found else np.zeros(len(self.links)))
        out = np.array(sums, np.float64).reshape(-1, len(self.links))
        for i, link in enumerate(self.links):
            out[:, i] = _logistic(out[:, i] + out[:, :i] @ link.earlier + link.bias)
        return out


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _fit_linear(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights and a bias (last) of a logistic regression, by accelerated gradient steps."""
    if len(set(y.tolist())) < 2:
        p = min(max(y.mean() if len(y) else 0.5, 1e-3), 1 - 1e-3)
        return np.append(np.zeros(x.shape[1]), np.log(p / (1 - p)))
    ones = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    vector = np.ones(ones.shape[1], x.dtype)
    for _ in range(10):  # the largest curvature, by power iteration
        vector = ones.T @ (ones @ vector)
        vector /= np.linalg.norm(vector)
    rate = 1 / (0.25 * float(vector @ (ones.T @ (ones @ vector))) / len(x) + 1e-3)
    w = np.zeros(ones.shape[1], np.float64)
    ahead = w
    for step in range(_STEPS * 2):
        error = _logistic(ones @ ahead.astype(x.dtype)) - y
        new = ahead - rate * (ones.T @ error.astype(x.dtype) / len(x) + 1e-5 * ahead)
        ahead = new + step / (step + 3) * (new - w)
        w = new
    return w


def select_features(rows: DataFrame, categories: list[str], n: int = FEATURES) -> list[np.ndarray]:
    """Per category the ``n`` features whose presence says most about it (largest chi-square), in order of their numbers.

    ``rows`` has the distinct features ``x`` of each text and a 0/1 column per category; they are counted in Spark.
    """
    sums = [F.sum(F.col(f"`{c}`")).cast("double").alias(f"hit{i}") for i, c in enumerate(categories)]
    totals = rows.agg(F.count(F.lit(1)).alias("n"), *sums).first()
    total = max(totals["n"], 1)
    seen = rows.select(F.explode("x").alias("f"), *(F.col(f"`{c}`") for c in categories)).groupBy("f")
    counted = written(seen.agg(F.count(F.lit(1)).cast("double").alias("seen"), *sums).where(F.col("seen") >= _LEAST_ROWS), "features")
    chosen = []
    for i, _ in enumerate(categories):
        share = (totals[f"hit{i}"] or 0) / total
        expected = F.col("seen") * share
        spread = expected * (1 - share) * (1 - F.col("seen") / total)
        chi = counted.select("f", ((F.col(f"hit{i}") - expected) ** 2 / F.nullif(spread, F.lit(0.0))).alias("chi"))
        best = chi.where("chi > 0").orderBy(F.desc("chi"), "f").limit(n).collect()
        chosen.append(np.sort(np.array([r["f"] for r in best], np.int64)))
    return chosen


def train_chain(rows: list[np.ndarray], labels: np.ndarray, categories: list[str], selected: list[np.ndarray]) -> Chain:
    """``rows``: feature numbers of each text; ``labels``: a column per category; ``selected``: features per category."""
    earlier = np.zeros((len(rows), 0), np.float32)
    fold = np.arange(len(rows)) % FOLDS
    links = []
    for i, _ in enumerate(categories):
        y = labels[:, i].astype(np.float64)
        chosen = selected[i]
        x = np.zeros((len(rows), len(chosen)), np.float32)
        for r, found in enumerate(rows):
            x[r, np.searchsorted(chosen, np.intersect1d(found, chosen, assume_unique=True))] = 1
        x = np.hstack([x, earlier])
        outside = np.zeros(len(rows), np.float32)
        for k in range(FOLDS):
            w = _fit_linear(x[fold != k], y[fold != k])
            outside[fold == k] = _logistic(x[fold == k] @ w[:-1] + w[-1])
        w = _fit_linear(x, y)
        links.append(Link(dict(zip(chosen.tolist(), w[: len(chosen)].tolist(), strict=True)), w[len(chosen) : -1], float(w[-1])))
        earlier = np.hstack([earlier, outside[:, None]])
    return Chain(categories, links)


def fit_toxicity(docs: DataFrame, labels: DataFrame, categories: list[str], rows: int = TRAINING_ROWS) -> Chain:
    """A chain over the label columns ``categories``, in that order, from at most ``rows`` documents that are not held out."""
    sample = written(training_labels(labels, categories, rows), "toxicity-labels")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"x": [text_features(t) for t in b["text"]], **{c: b[c] for c in ["doc_id", *categories]}})

    schema = "x array<int>, doc_id long, " + ", ".join(f"`{c}` int" for c in categories)
    found = written(training_texts(docs, sample).mapInPandas(features, schema), "toxicity-features")
    selected = select_features(found, categories)
    known = F.array(*map(F.lit, sorted({int(f) for chosen in selected for f in chosen}))).cast("array<int>")
    # At most ``rows`` rows of the few selected features each.
    got = found.withColumn("x", F.array_sort(F.array_intersect("x", known))).toPandas()
    order = np.lexsort((got["x"].map(len).to_numpy(), got["doc_id"].to_numpy()))
    mixed = order[np.random.default_rng(5).permutation(len(order))]
    rows_in = [np.asarray(got["x"][i], np.int64) for i in mixed]
    return train_chain(rows_in, got[categories].to_numpy(np.int64)[mixed], categories, selected)


def probabilities(text: Column, chain: Chain) -> Column:
    """An array of one probability per category."""

    @F.pandas_udf("array<double>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            yield pd.Series(chain.predict(texts).tolist())

    return run(text)


def judge_toxicity(docs: DataFrame, labels: DataFrame, categories: list[str]) -> DataFrame:
    """``docs`` with ``p_<category>`` for each category (existing columns of these names are replaced).

    Null and empty texts get the probability of a text without words. Labels that are null, held out or of unknown
    documents are not learned from; a category without both values gets its share of ones (one half without labels).
    Repeated rows get equal probabilities. Only the text is an input.
    """
    chain = fit_toxicity(docs, labels, categories)
    p = free_name(docs, "chain_probabilities")
    judged = docs.withColumn(p, probabilities(F.col("text"), chain))
    return judged.withColumns({f"p_{c}": F.col(p)[i] for i, c in enumerate(categories)}).drop(p)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chain over the annotated categories: unreadable text first, which is never toxic, then toxic text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("junk"), "toxic")
    judged = judge_toxicity(docs, labels, ["junk", "toxic"])
    return judged.select(
        "doc_id", held_out().alias("held_out"), "p_junk", F.col("p_toxic").alias("score"), (F.col("p_toxic") >= THRESHOLD).cast("int").alias("predicted")
    )
