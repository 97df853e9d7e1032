"""Quality classifier: a factorisation machine over hashed words and structure."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import (
    code_points,
    hashed_sample,
    small_batches,
    text_of,
    text_runs,
    third_fold,
    without,
)
from tripflow.llm.words import counted_runs, word_hashes

WORD_BUCKETS = 2048
BINS = 8
RANK = 8
SAMPLE_ROWS = 6_000
THRESHOLD = 0.7
OUTPUTS = ("score", "predicted")
STATS = ("log_words", "word_length", "distinct", "most_frequent", "repeated_neighbour", "lower",
         "upper", "digit", "space", "stop", "symbol", "log_lines", "repeated_lines",
         "log_n_chars")
_STOPS = ".,;:!?'\"()-"
LOWER, UPPER, DIGIT, SPACE, STOP, SYMBOL = range(6)


def _kinds() -> np.ndarray:
    def kind(c: str) -> int:
        if c.isspace():
            return SPACE
        if c.isalpha():
            return UPPER if c.isupper() else LOWER
        return DIGIT if c.isnumeric() else STOP if c in _STOPS else SYMBOL

    return np.array([kind(chr(i)) for i in range(1 << 16)], dtype=np.int64)


KIND = _kinds()


def features(texts: Sequence[str], n_chars: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """Structure statistics and hashed word weights of each whole text, as two matrices.

    ``n_chars`` is the length the table states. Word weights are logarithms of
    counts, scaled to length one.
    """
    rows = len(texts)
    stats = np.zeros((rows, len(STATS)))
    sizes = np.array([len(t) for t in texts])
    text_at = np.repeat(np.arange(rows), sizes)
    points = np.minimum(code_points("".join(texts)), (1 << 16) - 1)
    kinds = np.bincount(text_at * 6 + KIND[points], minlength=rows * 6).reshape(rows, 6)
    hashes, counts = word_hashes([t.lower() for t in texts])
    some = np.maximum(counts, 1)
    text_of_word = np.repeat(np.arange(rows), counts)
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (text_of_word[1:] == text_of_word[:-1])
    at, word, often = counted_runs(hashes, counts)
    most = np.zeros(rows)
    np.maximum.at(most, at, often)
    lines = [t.split("\n") for t in texts]
    stats[:, 0] = np.log1p(counts)
    stats[:, 1] = (sizes - kinds[:, SPACE]) / some
    stats[:, 2] = np.bincount(at, minlength=rows) / some
    stats[:, 3] = most / some
    stats[:, 4] = np.bincount(text_of_word[same], minlength=rows) / some
    stats[:, 5:11] = kinds / np.maximum(sizes, 1)[:, None]
    stats[:, 11] = np.log1p([len(x) for x in lines])
    stats[:, 12] = [1 - len(set(x)) / len(x) for x in lines]
    stats[:, 13] = np.log1p(np.maximum(np.nan_to_num(np.asarray(n_chars, dtype=float)), 0))
    words = np.zeros((rows, WORD_BUCKETS), dtype=np.float32)
    np.add.at(words, (at, (word % np.uint64(WORD_BUCKETS)).astype(np.int64)), often)
    words = np.log1p(words)
    words /= np.maximum(np.sqrt((words ** 2).sum(axis=1, keepdims=True)), 1e-6)
    return stats, words


@dataclass(frozen=True)
class Model:
    """Weights of a size fixed by the constants above."""

    edges: np.ndarray  # statistics x inner bin edges
    mean: np.ndarray
    scale: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def inputs(self, stats: np.ndarray, words: np.ndarray) -> np.ndarray:
        """One row of features per text: bins and scaled values of statistics, then words."""
        rows = len(stats)
        bins = np.zeros((rows, len(STATS), BINS), dtype=np.float32)
        for s in range(len(STATS)):
            bins[np.arange(rows), s, np.searchsorted(self.edges[s], stats[:, s], "right")] = 1
        scaled = np.clip((stats - self.mean) / self.scale, -4, 4).astype(np.float32)
        return np.concatenate([bins.reshape(rows, -1), scaled, words], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.bias + x @ self.linear + pairwise(x, self.factors))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pairwise(x: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Sum over i < j of <v_i, v_j> x_i x_j, as half of (sum v x)^2 - sum (v x)^2."""
    return 0.5 * (((x @ factors) ** 2) - (x ** 2) @ (factors ** 2)).sum(axis=1)


def train(stats: np.ndarray, words: np.ndarray, label: np.ndarray, *, epochs: int = 25,
          batch: int = 256, rate: float = 0.02, decay: float = 1e-4) -> Model:
    """Fit the machine to log loss by Adam in a fixed order."""
    quantiles = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(stats, quantiles, axis=0).T
    blank = Model(edges, stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6), 0.0,
                  np.zeros(0), np.zeros((0, RANK)))
    x_all = blank.inputs(stats, words)
    width = x_all.shape[1]
    rng = np.random.default_rng(10)
    share = np.clip(label.mean(), 0.01, 0.99)
    weights = [np.array([np.log(share / (1 - share))], dtype=np.float32),
               np.zeros(width, dtype=np.float32),
               rng.normal(0, 0.01, (width, RANK)).astype(np.float32)]
    first = [np.zeros_like(w) for w in weights]
    second = [np.zeros_like(w) for w in weights]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            x, y = x_all[rows], label[rows]
            b, w, v = weights
            sums = x @ v
            z = b[0] + x @ w + 0.5 * (sums ** 2 - (x ** 2) @ (v ** 2)).sum(axis=1)
            error = ((sigmoid(z) - y) / len(rows)).astype(np.float32)
            slopes = [error.sum(keepdims=True), x.T @ error + decay * w,
                      x.T @ (error[:, None] * sums) - (error @ x ** 2)[:, None] * v + decay * v]
            step += 1
            for p, g, m, s in zip(weights, slopes, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g ** 2 - s)
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    b, w, v = weights
    return Model(edges, blank.mean, blank.scale, float(b[0]), w, v)


def _featured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = batch["text"].fillna("").tolist()
        n_chars = batch["n_chars"].to_numpy(dtype=float)
        for a, b in text_runs(texts):
            stats, words = features(texts[a:b], n_chars[a:b])
            yield pd.DataFrame({
                "quality": batch["quality"].to_numpy()[a:b],
                "stats": [s.tobytes() for s in stats],
                "at": [np.flatnonzero(w).astype(np.int16).tobytes() for w in words],
                "weight": [w[w != 0].tobytes() for w in words],
            })


def fit(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Learn ``labels.quality`` from about ``sample_rows`` labelled rows, or all if fewer.

    The sample is bounded because its use is to learn a model of fixed size; its rows
    follow from a hash. Labels are joined by ``doc_id``; rows with a null id or label
    are not used. None if nothing is labelled.
    """
    marks = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(
        F.max("quality").alias("quality"))
    ids = hashed_sample(
        marks.select("doc_id", "quality", F.lit("").alias("text")), sample_rows)
    chosen = docs.select("doc_id", text_of().alias("text"),
                         F.col("n_chars").cast("double").alias("n_chars")).join(
        ids.select("doc_id", "quality"), "doc_id")
    table = chosen.select("quality", "text", "n_chars").mapInPandas(
        _featured, "quality int, stats binary, at binary, weight binary").toPandas()
    if table.empty:
        return None
    # Rows come in any order; training must not depend on it.
    table = table.sort_values(["stats", "at", "weight", "quality"], ignore_index=True)
    stats = np.array([np.frombuffer(s) for s in table["stats"]])
    words = np.zeros((len(table), WORD_BUCKETS), dtype=np.float32)
    for i, (at, weight) in enumerate(zip(table["at"], table["weight"])):
        words[i, np.frombuffer(at, dtype=np.int16)] = np.frombuffer(weight, dtype=np.float32)
    return train(stats, words, (table["quality"] > 0).to_numpy().astype(np.float32))


def scorer(docs: DataFrame, model: Model | None):
    """A function from a text and its ``n_chars`` to a score, for frames of the session."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for text, n_chars in batches:
            texts, known = text.fillna("").tolist(), n_chars.to_numpy(dtype=float)
            out = np.full(len(texts), 0.5)
            for a, b in text_runs(texts) if held.value is not None else ():
                out[a:b] = held.value.score(held.value.inputs(*features(texts[a:b], known[a:b])))
            yield pd.Series(out)

    return score


def score_quality(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """Add ``score`` and ``predicted`` (1 from ``threshold`` on) from ``text`` and ``n_chars``.

    Null texts count as empty, a null ``n_chars`` as 0; both are scored like any other.
    Without a model every score is 0.5. Equal inputs get equal scores. Input columns
    named like the two new ones are replaced.
    """
    kept = without(docs, OUTPUTS)
    scored = kept.withColumn("score", scorer(docs, model)("text", F.col("n_chars").cast("double")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def learnable(docs: DataFrame, labels: DataFrame) -> Model | None:
    return fit(docs, labels.where(~third_fold()))


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from labels that are not held out, then score every row.

    Returns ``doc_id``, ``held_out``, ``score`` and ``predicted``.
    """
    scored = score_quality(docs.select("doc_id", "text", "n_chars"), learnable(docs, labels))
    return scored.select("doc_id", third_fold().alias("held_out"), "score", "predicted")


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The rows scored ``threshold`` or more, unchanged."""
    score = scorer(docs, learnable(docs, labels))(text_of(), F.col("n_chars").cast("double"))
    return docs.withColumn("_score", score).where(F.col("_score") >= threshold).select(
        *[F.col(f"`{c}`") for c in docs.columns])
