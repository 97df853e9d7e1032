"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import (
    code_points,
    hashed_sample,
    mixed,
    small_batches,
    text_of,
    text_runs,
    third_fold,
    without,
)

BUCKETS = 1 << 16
LONGEST = 3  # characters of an n-gram
SAMPLE_ROWS = 20_000
SLICE = 1 << 18  # n-grams whose log-probabilities are held at a time
UNDETERMINED = "und"
OUTPUTS = ("lang_pred", "score")
NOT_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class Model:
    """Log-probabilities by bucket and language, of a size fixed by both."""

    langs: tuple[str, ...]
    log_prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages


def gram_buckets(joined: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each n, the bucket of the n-gram that starts at each code point."""
    hashed = np.zeros(len(joined), dtype=np.uint64)
    wide = joined.astype(np.uint64)
    for n in range(1, LONGEST + 1):
        if len(joined) < n:
            return
        last = len(joined) - n + 1
        hashed = hashed[:last] * np.uint64(0x100000001B3) + wide[n - 1:]
        yield n, (mixed(hashed + np.uint64(n)) >> np.uint64(48)).astype(np.int32)


def spaced(text: str) -> str:
    """Lower-cased, every run of other characters than letters one space."""
    kept = NOT_LETTERS.sub(" ", text.lower())
    return f" {kept.strip()} " if any(map(str.isalpha, kept)) else ""


def count_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often each language shows each bucket, summed within a task."""
    counts: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"]):
            into = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            rows[lang] = rows.get(lang, 0) + 1
            for _, found in gram_buckets(code_points(spaced(text))):
                into += np.bincount(found, minlength=BUCKETS)
    for lang, into in counts.items():
        seen = np.flatnonzero(into)
        yield pd.DataFrame({"lang": lang, "bucket": seen.astype(np.int32), "n": into[seen]})
        yield pd.DataFrame({"lang": [lang], "bucket": np.array([-1], np.int32),
                            "n": np.array([rows[lang]], np.int64)})


def fit(docs: DataFrame, *, sample_rows: int = SAMPLE_ROWS, smoothing: float = 0.1) -> Model | None:
    """Learn from about ``sample_rows`` rows with a text and a language, or all if fewer.

    The sample is bounded because its use is to learn a model of fixed size; which
    rows it holds follows from their hash. Columns: ``doc_id``, ``text``, ``lang``.
    None if no row can be learnt from.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sample = hashed_sample(usable, sample_rows)
    counted = sample.select("lang", "text").mapInPandas(
        count_grams, "lang string, bucket int, n long")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    if table.empty:
        return None
    langs = tuple(sorted(table["lang"].unique()))
    column = table["lang"].map({lang: i for i, lang in enumerate(langs)}).to_numpy()
    is_row = (table["bucket"] < 0).to_numpy()
    prior = np.zeros(len(langs))
    prior[column[is_row]] = table["n"].to_numpy()[is_row]
    counts = np.zeros((BUCKETS, len(langs)))
    counts[table["bucket"].to_numpy()[~is_row], column[~is_row]] = table["n"].to_numpy()[~is_row]
    prob = (counts + smoothing) / (counts.sum(axis=0) + smoothing * BUCKETS)
    return Model(langs, np.log(prior / prior.sum()), np.log(prob).astype(np.float32))


def score_texts(model: Model | None, texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Language and probability of each whole text."""
    langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
    if model is None:
        return langs, scores
    for first, last in text_runs(texts):
        letters = [spaced(t) for t in texts[first:last]]
        sizes = np.array([len(t) for t in letters])
        joined = code_points("".join(letters))
        starts = np.concatenate([[0], np.cumsum(sizes)])
        total = np.tile(model.log_prior, (len(letters), 1))
        for n, found in gram_buckets(joined):
            # An n-gram counts for the text in which it starts and ends.
            for i in np.flatnonzero(sizes >= n):
                own = found[starts[i]:starts[i + 1] - n + 1]
                # Some at a time, as a text of a run of its own may be of any length.
                for a in range(0, len(own), SLICE):
                    total[i] += model.log_prob[own[a:a + SLICE]].sum(axis=0, dtype=np.float64)
        best = total.argmax(axis=1)
        sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
        for i in np.flatnonzero(sizes > 0):
            langs[first + i], scores[first + i] = model.langs[best[i]], sure[i]
    return langs, scores


def predictor(docs: DataFrame, model: Model | None):
    """A function from a text column to ``lang_pred`` and ``score``, for frames of the session."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            langs, scores = score_texts(held.value, texts.fillna("").tolist())
            yield pd.DataFrame({"lang_pred": langs, "score": scores})

    return predict


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (its probability) to every row, from ``text`` alone.

    Null texts, texts without a letter, and all texts if there was nothing to learn
    from, are ``und`` with score 0. Equal texts get equal answers. Input columns
    named like the two new ones are replaced.
    """
    kept = without(docs, OUTPUTS)
    return kept.withColumn("_found", predictor(docs, model)("text")).select(
        *[F.col(f"`{c}`") for c in kept.columns], "_found.lang_pred", "_found.score")


def identify_held_out(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, then judge every row.

    Returns ``doc_id``, ``held_out``, ``lang_pred`` and ``score``.
    """
    model = fit(docs.where(~third_fold()))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", third_fold().alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, *, least: float = 0.5) -> DataFrame:
    """The rows whose language can be told with a probability of ``least``, unchanged."""
    found = predictor(docs, fit(docs.where(~third_fold())))(text_of())
    marked = docs.withColumn("_found", found)
    return marked.where((F.col("_found.lang_pred") != UNDETERMINED) & (F.col("_found.score") >= least)).select(
        *[F.col(f"`{c}`") for c in docs.columns])
