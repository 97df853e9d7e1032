from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import functions as F

from tripflow.llm import language, quality
from tripflow.llm.common import third_fold


def held_out(i) -> bool:
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_fold_is_crc32_of_the_id(awkward):
    for r in awkward.select("doc_id", third_fold().alias("h")).collect():
        assert r.h == held_out(r.doc_id)


def test_language_on_held_out_rows(documents):
    rows = language.identify_held_out(documents).join(
        documents.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_model_is_naive_bayes(spark):
    """The scores are those of counts taken by hand."""
    docs = spark.createDataFrame([(0, "aa b", "x"), (1, "bb", "y")],
                                 "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert model.langs == ("x", "y")
    grams = {lang: [t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)]
             for lang, t in (("x", " aa b "), ("y", " bb "))}
    bucket = {g: int(next(b for n, b in language.gram_buckets(language.code_points(g))
                          if n == len(g))[0]) for gs in grams.values() for g in gs}
    text = " b "
    wanted = []
    for lang in model.langs:
        total = len(grams[lang])
        wanted.append(np.log(0.5) + sum(
            np.log((sum(bucket[h] == bucket[g] for h in grams[lang]) + 0.1)
                   / (total + 0.1 * language.BUCKETS))
            for g in (text[i:i + n] for n in (1, 2, 3) for i in range(len(text) - n + 1))
            if g in bucket or bucket.setdefault(g, -1) != -1))
    found, score = language.score_texts(model, ["b"])
    assert found == [model.langs[int(np.argmax(wanted))]]
    assert 0.5 < score[0] <= 1


def test_language_of_awkward_rows(awkward, nothing):
    found = language.identify(awkward, language.fit(awkward))
    assert found.columns.count("score") == 1
    rows = found.select("doc_id", "text", "lang_pred", "score").collect()
    for r in rows:
        empty = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == empty
        assert r.score == 0 if empty else 0 < r.score <= 1
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2)}) == 1
    kept = language.keep_identified(awkward)
    assert kept.columns == awkward.columns
    assert language.identify_held_out(nothing).count() == 0
    assert language.keep_identified(nothing).count() == 0
    unlabelled = awkward.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify_held_out(unlabelled).collect()} == {"und"}


def test_pairwise_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    x, v = rng.normal(size=(3, 6)), rng.normal(size=(6, 4))
    slow = [sum(v[i] @ v[j] * r[i] * r[j] for i in range(6) for j in range(i)) for r in x]
    assert np.allclose(quality.pairwise(x, v), slow)


def test_machine_learns_an_interaction():
    """Two words that are bad only together cannot be told by a linear model."""
    rng = np.random.default_rng(2)
    words = np.zeros((2000, quality.WORD_BUCKETS), dtype=np.float32)
    a, b = rng.random(2000) < 0.5, rng.random(2000) < 0.5
    words[a, 3] = words[b, 9] = 1
    label = (a ^ b).astype(np.float32)
    model = quality.train(np.zeros((2000, len(quality.STATS))), words, label, epochs=60)
    score = model.score(model.inputs(np.zeros((2000, len(quality.STATS))), words))
    assert ((score > 0.5) == (label > 0)).mean() > 0.95


def test_quality_on_held_out_rows(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    scored = quality.score_held_out(documents, labels)
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    good = [r.score for r in rows if r.quality == 1]
    bad = [r.score for r in rows if r.quality == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert all(r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (6, 0), (9, 0), (9, None), (None, 1), (77, 1)], "doc_id long, quality int")
    rows = quality.score_held_out(awkward, labels).collect()
    assert len(rows) == awkward.count() and all(0 <= r.score <= 1 for r in rows)
    none = labels.where("false")
    assert {r.score for r in quality.score_held_out(awkward, none).collect()} == {0.5}
    assert quality.score_held_out(nothing, none).count() == 0
    assert quality.keep_good(awkward, labels, threshold=0.0).columns == awkward.columns
    assert quality.keep_good(awkward, labels, threshold=0.0).count() == awkward.count()
