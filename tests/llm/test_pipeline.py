"""The stages of the pipeline, one after another, on awkward, empty and provided tables."""

from __future__ import annotations

from tripflow.llm import language, quality


def labels_of(spark, docs):
    return spark.createDataFrame([(r["doc_id"], i % 2, 0) for i, r in enumerate(docs.collect())],
                                 "doc_id long, quality int, toxic int")


def test_filters_keep_rows_as_they_are(spark, awkward, nothing):
    """Columns that are named like the stages' own stay, and rows are not changed."""
    rows = sorted(map(repr, awkward.collect()))
    for keep in (lambda d: language.keep_identified(d),
                 lambda d: quality.keep_good(d, labels_of(spark, awkward), threshold=0.0),
                 lambda d: quality.keep_good(d, labels_of(spark, nothing))):
        kept = keep(awkward)
        assert kept.schema == awkward.schema
        left = sorted(map(repr, kept.collect()))
        assert set(left) <= set(rows)
        assert keep(nothing).count() == 0
    assert len(quality.keep_good(awkward, labels_of(spark, awkward), threshold=0.0).collect()) == len(rows)


def test_stages_on_awkward_and_empty_tables(spark, awkward, nothing, tmp_path):
    import corpus_pipeline

    names = ["doc_id", "text", "lang", "source", "n_chars"]
    for number, docs in enumerate((awkward.select(*names), nothing.select(*names))):
        folder = tmp_path / str(number)
        docs.write.parquet(str(folder / "documents.parquet"))
        labels_of(spark, docs).write.parquet(str(folder / "labels.parquet"))
        current = spark.read.parquet(str(folder / "documents.parquet"))
        for name, stage in corpus_pipeline.STAGES:
            stage(spark, current, str(folder)).write.parquet(str(folder / name))
            before, current = current, spark.read.parquet(str(folder / name))
            if name != "packing":
                assert current.columns == names
            if name in ("language", "quality", "near_duplicates"):
                assert current.exceptAll(before).count() == 0
        if not number:
            assert spark.read.parquet(str(folder / "language")).where("text IS NULL").count() == 0


def test_the_provided_documents(spark, documents):
    import corpus_pipeline

    packed = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert 0 < len({r["doc_id"] for r in packed}) < documents.count()
    used = {}
    for r in packed:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in used.values():
        ends = [0]
        for offset, length in sorted(own):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 2048
