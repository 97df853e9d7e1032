from __future__ import annotations

import random
from bisect import bisect_left, bisect_right
from collections import Counter

import pytest

from tripflow.llm.sharding import histogram_shards, refined


def placed(df):
    rows = df.collect()
    shards: dict[int, list] = {}
    for r in rows:
        shards.setdefault(r["shard"], []).append(r)
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return shards


@pytest.mark.parametrize("shards, blocks", [(8, None), (3, 1), (1, None), (5, 4)])
def test_bytes_are_near_equal(documents, shards, blocks):
    found = placed(histogram_shards(documents, shards, blocks=blocks))
    sizes = {s: sum(len((r.text or "").encode()) + 1 for r in own) for s, own in found.items()}
    largest = max(len(r.text or "") for own in found.values() for r in own) * 2
    mean = sum(sizes.values()) / shards
    assert len(found) == shards
    assert all(abs(v - mean) <= 0.001 * mean + largest for v in sizes.values())


def test_a_third_of_one_text_is_cut_among_shards(spark):
    rows = [(i, "copy" * 50 if i % 3 == 0 else f"text {i} " * 25) for i in range(6000)]
    found = placed(histogram_shards(spark.createDataFrame(rows, "doc_id long, text string")))
    sizes = [sum(r["size"] for r in own) for own in found.values()]
    assert max(sizes) < 1.01 * sum(sizes) / 8
    texts = {}
    for s, own in found.items():
        for r in own:
            texts.setdefault(r.text, set()).add(s)
    assert sum(len(s) > 1 for s in texts.values()) <= 2


def test_awkward_rows(awkward, nothing):
    found = histogram_shards(awkward)
    assert sorted(found.columns) == sorted(set(awkward.columns) | {"size", "shard", "slot"})
    shards = placed(found)
    assert sum(map(len, shards.values())) == awkward.count()
    for own in shards.values():
        for r in own:
            assert r["size"] == len((r.text or "").encode()) + 1
    same = histogram_shards(awkward.repartition(5)).select("doc_id", "text", "shard")
    assert sorted(map(repr, same.collect())) == sorted(
        map(repr, found.select("doc_id", "text", "shard").collect()))
    assert histogram_shards(nothing).count() == 0


def counted(keys: list[int], sizes: list[int]):
    """The histogram between bounds, by sorting."""
    def count(bounds):
        rows = {}
        for key, size in sorted(zip(keys, sizes)):
            at = bisect_right(bounds, key)
            held, n, first, _ = rows.get(at, (0, 0, key, key))
            rows[at] = (held + size, n + 1, first, key)
        return [(at, *row) for at, row in sorted(rows.items())]
    return count


@pytest.mark.parametrize("rows", [0, 1, 7, 200, 1000, 20_000])
@pytest.mark.parametrize("kind", ["random", "few keys", "one huge", "dense", "low"])
def test_splitters_against_sorted_sums(rows, kind):
    for seed in range(3 if rows < 20_000 else 1):
        rng = random.Random(f"{rows}{kind}{seed}")
        keys = [rng.randrange(1 << 128) for _ in range(rows)]
        sizes = [rng.randrange(1, 5000) for _ in range(rows)]
        if kind == "few keys":
            keys = [rng.choice([5, 1 << 90, (1 << 128) - 1]) for _ in range(rows)]
        elif kind == "one huge" and rows:
            sizes[rows // 2] = 10 ** 9
        elif kind == "dense":
            keys = [(1 << 127) + rng.randrange(rows * 2) for _ in range(rows)]
        elif kind == "low":
            keys = [rng.randrange(1 << rng.randrange(1, 129)) for _ in range(rows)]
        shards, blocks = 8, 1 + 6 * (seed % 2)
        bounds, below = refined(counted(keys, sizes), shards * blocks, shards, 0.001, 16)
        assert bounds == sorted(bounds) and len(bounds) == shards * blocks - 1
        order = sorted(keys)
        assert below == [bisect_left(order, b) for b in bounds]
        total, weight = sum(sizes), Counter()
        for key, size in zip(keys, sizes):
            weight[key] += size
        heaviest = max(weight.values(), default=0)
        for shard in range(1, shards):
            bound = bounds[shard * blocks - 1]
            got = sum(w for key, w in weight.items() if key < bound)
            assert abs(got - total * shard / shards) <= max(0.001 * total / shards, heaviest)
