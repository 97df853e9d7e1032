from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from tripflow.llm import queries
from tripflow.llm.repeats import least_places, merged_runs, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(texts: list[str | None], window: int = 35) -> list[tuple[int, int, str]]:
    """All windows of all texts in one dictionary."""
    split = [WORD.findall(t or "") for t in texts]
    places = defaultdict(list)
    for i, words in enumerate(split):
        for start in range(len(words) - window + 1):
            places[tuple(words[start:start + window])].append((i, start))
    gone = [set() for _ in texts]
    for found in places.values():
        if len(found) > 1:
            for i, start in found:
                gone[i].update(range(start, start + window))
    results = []
    for words, out in zip(split, gone):
        kept = " ".join(w for k, w in enumerate(words) if k not in out)
        results.append((len(words), len(out), hashlib.sha256(kept.encode()).hexdigest()))
    return results


def found(df) -> list[tuple]:
    return sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"], r["n_removed"], r["kept_sha256"])
                  for r in df.collect())


def wanted(df, window: int = 35) -> list[tuple]:
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    return sorted((i is None, i or 0, *judged)
                  for (i, _), judged in zip(rows, brute([t for _, t in rows], window)))


def test_query_against_brute_force(spark, documents):
    rows = queries.QUERIES["op13_seed_extend_repeats"](spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert found(rows) == wanted(documents)
    assert sum(r["n_removed"] for r in rows.collect()) > 0


@pytest.mark.parametrize("seed", range(4))
def test_overlapping_passages(spark, seed):
    """Few words, periods, shared and cut passages, copies, windows at the ends of texts."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(2 if seed == 0 else 40)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(20, 90))] for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [[rng.choice(words) for _ in range(rng.randrange(0, 30))]]
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            cut = rng.randrange(len(passage) // 2)
            parts += [passage[cut:] if rng.random() < 0.5 else passage,
                      [rng.choice(words) for _ in range(rng.randrange(0, 8))]]
        texts.append(rng.choice([" ", "\n", "\t \r"]).join(w for p in parts for w in p))
    texts += [texts[0]] * 3 + ["same " * 80, "a b " * 50, " ".join(passages[0][:35])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for window, size in ((35, 8), (6, 3), (5, 5), (1, 1)):
        assert found(without_repeats(df, window=window, seed=size)) == wanted(df, window)


def test_awkward_rows(awkward, nothing):
    rows = without_repeats(awkward)
    assert set(rows.columns) == set(awkward.columns) | {"n_words", "n_removed", "kept_sha256", "repeats"}
    assert found(rows) == wanted(awkward)
    assert without_repeats(nothing).count() == 0


def test_a_third_in_one_passage(spark):
    """One passage in a third of all rows, each time between other words."""
    line = " ".join(f"p{i}" for i in range(50))
    rows = [(i, f"{i} x{i} {line} y{i}" if i % 3 == 0 else " ".join(f"{i}-{k}" for k in range(60)))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in without_repeats(df).collect():
        assert [tuple(x) for x in r["repeats"]] == ([(2, 52)] if r["doc_id"] % 3 == 0 else [])


def test_least_places_and_runs():
    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 28, 31):
        values = rng.integers(0, 9, 200)
        plain = [i + int(np.argmin(values[i:i + width])) for i in range(200 - width + 1)]
        assert least_places(values, width).tolist() == plain
    assert list(merged_runs([], 5)) == []
    assert list(merged_runs([(0, 2), (3, 3), (8, 8), (14, 20)], 5)) == [(0, 13), (14, 25)]
