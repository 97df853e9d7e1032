from __future__ import annotations

import pytest

DOCS = ("doc_id long, text string, lang string, source string, n_chars long, "
        "size string, score string, rank int, copies int, _part int, lang_pred string, "
        "predicted string, shard string, slot string, verdict int")


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    words = " ".join(f"word{i} and more" for i in range(3000))
    rows = [
        (1, "a plain text of a few words that goes on", "en", "a"),
        (1, "a plain text of a few words that goes on", "en", "a"),
        (2, "a plain text of a few words that goes on", "en", "a"),
        (3, "", "en", "b"), (4, None, "en", None), (5, " \n\t ", None, "b"),
        (None, "no id here but some words", "fr", "b"), (None, None, None, None),
        (6, words, "de", "a"), (7, words + " end", "de", None),
        (8, "Ünïcödé ñandú 漢字 Ωmega 🙂 zero​width", "es", "z"),
        (9, "12345 67890 !!!", None, ""), (10, "x" * 50_000, "en", "a"),
        (-5, "one", "en", "a"), ((1 << 63) - 1, "one two", "en", "b"),
    ]
    extra = (None, "s", 1, 2, 3, "p", "q", "r", "t", 5)
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), *extra[:10]) for i, t, lang, s in rows], DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
