from __future__ import annotations

import numpy as np
import pytest

from tripflow.llm.neighbours import Index, products, scan, search

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, x, asked, nearest):
    out = {}
    for i in asked:
        scores = (x * x[ids == i][0]).sum(axis=1)
        other = ids != i
        order = np.lexsort((ids[other], -scores[other]))[:nearest]
        out[i] = list(zip(ids[other][order].tolist(), scores[other][order].tolist()))
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def test_small_tables_are_searched_exactly(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 12)).astype(np.float32).astype(float)
    x[30:45] = x[30]  # ties
    ids = np.arange(60)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    got = found(search(df, df.where("vec_id % 20 = 0 or vec_id = 31"), nearest=7))
    want = brute(ids, x, [0, 20, 31, 40], 7)
    assert got.keys() == want.keys()
    for i in want:
        assert [v for v, _ in got[i]] == [v for v, _ in want[i]]
        assert np.allclose([s for _, s in got[i]], [s for _, s in want[i]], rtol=1e-14)
    few = df.where("vec_id < 5")
    assert all(len(v) == 4 for v in found(search(few, few)).values())


@pytest.mark.parametrize("spread", [0.2, 3.0])
def test_recall_with_lists_parts_and_blocks(spark, spread):
    """A small sample, parts and blocks, so that all of the machinery runs."""
    rng = np.random.default_rng(2)
    x = (rng.normal(size=(12, 24))[rng.integers(0, 12, 4000)] + spread * rng.normal(size=(4000, 24)))
    x *= rng.uniform(0.5, 2, size=(4000, 1))
    x[:1300] = x[0]  # one vector in a third of the rows
    x = x.astype(np.float32).astype(float)
    ids = rng.permutation(4000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], SCHEMA)
    got = found(search(df, df.where("vec_id % 50 = 0"), sample_rows=600, chunk_rows=200, query_rows=30))
    want = brute(ids, x, [i for i in range(0, 4000, 50)], 20)
    hits = [len({v for v, _ in got[i]} & {v for v, _ in want[i]}) / 20 for i in want]
    assert np.mean(hits) > 0.9
    for i, rows in got.items():
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0])) and len(rows) == 20
        assert i not in {v for v, _ in rows}


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 2), (1, [0.5, 0.5], 2), (2, None, 3), (3, [nan, 1.0], 4),
            (4, [0.0, 0.0], 5), (5, [inf, 1.0], 6), (6, [None, 1.0], 7), (7, [1.0, 2.0, 3.0], 8),
            (None, [1.0, 1.0], 9), (20, [], 1), (40, [-1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA + ", rank int")
    got = found(search(df, df))
    assert got.keys() == {0, 1, 40}
    assert [v for v, _ in got[0]] == [1, 40] and [v for v, _ in got[1]] == [0, 40]
    assert search(df.where("false"), df.where("false")).count() == 0
    assert search(df, df.where("false")).count() == 0


@pytest.mark.parametrize("longest", [1, 50, 3_000, 10_000, 1_000_000])
def test_one_long_vector_costs_no_neighbours(longest):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(20_000, 64))
    x /= np.sqrt((x ** 2).sum(axis=1))[:, None]
    x[7] *= longest
    ids = np.arange(len(x))
    rotation = np.linalg.qr(rng.normal(size=(65, 65)))[0]
    index = Index(rotation, np.zeros((1, 65)), longest ** 2 * (1 + 1e-12), 1, ids[8:2008], x[8:2008])
    asked = ids[3000:3030]
    scores = np.stack([products(x, x[[i]]) for i in asked])
    scores[np.arange(30), asked] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    bounds = np.sort(scores[:, 8:2008], axis=1)[:, -20]
    got = scan(index, asked, x[asked], bounds, ids, x, 20)
    hits = [len(set(w) & set(got.loc[got["query_id"] == i, "vec_id"])) / 20 for i, w in zip(asked, want)]
    assert np.mean(hits) > 0.97
