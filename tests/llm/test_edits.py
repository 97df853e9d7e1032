from __future__ import annotations

import hashlib

import numpy as np

from tripflow.llm import edits


def plain_walk(text: str) -> str:
    """The fingerprint by walking one step at a time."""
    if not text:
        return ""
    classes, symbol = edits.symbols(edits.code_points(text))
    on = []
    for c, s in zip(classes, symbol):
        on += [s] * edits.stays()[c * edits.PERIOD + len(on) % edits.PERIOD]
    return edits.to_hex(np.array([on[i] for i in edits.sampled_steps(len(on))], dtype=np.uint8))


def test_walks_equal_single_steps():
    rng = np.random.default_rng(4)
    texts = ["", "a", "ab", "漢字🙂"] + [
        "".join(rng.choice(list("etaoin shrdlu"), n)) for n in (5, 64, 65, 900, 900, 3000, 40)]
    assert [edits.to_hex(f) for f in edits.fingerprints(texts)] == [plain_walk(t) for t in texts]


def test_few_edits_change_few_symbols():
    rng = np.random.default_rng(5)
    letters = list("etaoin shrdlucmf")
    near, far = [], []
    for _ in range(20):
        text = list(rng.choice(letters, 4000))
        changed = [*text]
        for _ in range(8):
            at = rng.integers(len(changed))
            changed[at:at + rng.integers(0, 2)] = rng.choice(letters, rng.integers(0, 2)).tolist()
        a, b, c = edits.fingerprints(["".join(text), "".join(changed),
                                      "".join(rng.choice(letters, 4000))])
        near.append(edits.likeness(a, b))
        far.append(edits.likeness(a, c))
    assert np.mean(near) > 0.8 > 0.35 > np.mean(far)


def brute(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        third = len(text) // 3
        changed = text[:len(text) - third] + following[:third]
        prints = [edits.fingerprints([t])[0] for t in (text, changed, following)]
        out[i] = (len(text), hashlib.sha256(changed.encode()).hexdigest(), edits.to_hex(prints[0]),
                  edits.to_hex(prints[1]), edits.likeness(prints[0], prints[1]),
                  edits.likeness(prints[0], prints[2]))
    return out


def test_rows_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text or "") for r in documents.collect()]
    for some in (rows, rows[:1], rows[:2], rows[:3]):
        df = spark.createDataFrame(some, "doc_id long, text string")
        got = {r.doc_id: tuple(r)[1:] for r in edits.fingerprint_rows(df).collect()}
        assert got == brute(some)


def test_awkward_rows(awkward, nothing):
    rows = edits.fingerprint_rows(awkward).collect()
    assert len(rows) == awkward.count()
    assert sum(r.doc_id is None for r in rows) == 2
    assert len({r.fingerprint for r in rows if r.doc_id in (1, 2)}) == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert edits.fingerprint_rows(nothing).count() == 0
    assert edits.edit_classes(nothing).count() == 0


def test_classes_of_edited_texts(spark):
    rng = np.random.default_rng(6)
    rows = []
    for g in range(12):
        text = "".join(rng.choice(list("etaoin shrdlucmf"), 600))
        for k in range(4):
            changed = list(text)
            for _ in range(3 * k):
                changed[rng.integers(600)] = "z"
            rows.append((g * 10 + k, "".join(changed)))
    rows += [(500, ""), (501, None), (502, "short"), (None, "short")]
    found = edits.edit_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        if r.doc_id is not None and r.doc_id < 500:
            assert r.class_id == r.doc_id // 10 * 10
    assert {r.class_id for r in found if r.doc_id in (500, 501)} == {500}
    assert {r.class_id for r in found if r.doc_id in (None, 502)} == {502}


def test_crowded_buckets_are_compared_whole(spark, monkeypatch):
    """All texts in one bucket, most of them unlike each other, and pivots that find nothing."""
    monkeypatch.setattr(edits, "bands", lambda found: edits.F.array(edits.F.lit(7).cast("long")))
    monkeypatch.setattr(edits, "pivot_pairs", lambda bands, orders, *others, where: bands.selectExpr(
        "node as a", "node as b").where("false"))
    rng = np.random.default_rng(11)
    texts = ["".join(rng.choice(list("etaoin shrdlucmf"), 200)) for _ in range(36)]
    rows = [*enumerate(texts), (100, "z" * 20 + texts[17][20:]), (101, texts[30][:-30])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for small in (32, 100):
        monkeypatch.setattr(edits, "SMALL_BUCKET", small)
        found = {r.doc_id: r.class_id for r in edits.edit_classes(df).collect()}
        assert found == {i: {100: 17, 101: 30}.get(i, i) for i, _ in rows}
