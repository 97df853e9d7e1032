"""Sharding by histogram sort: near-equal bytes, found by exact counts, then one exchange."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import tasks, text_of, without, written

SHARDS = 8
# Of a shard's bytes, and of a block's, by how much a boundary may be off.
TOLERANCE = 0.001
BLOCK_TOLERANCE = 0.1
PROBES = 16
OUTPUTS = ("size", "shard", "slot")
# Sort keys are pairs of signed 64-bit numbers, handled on the driver as one integer.
HALF = 1 << 63
LEAST = 0


def joined_key(high: int, low: int) -> int:
    return ((high + HALF) << 64) | (low + HALF)


def parted_key(key: int) -> tuple[int, int]:
    return (key >> 64) - HALF, (key & ((1 << 64) - 1)) - HALF


def intervals(bounds: list[int]):
    """A column function of the key pair: how many bounds are at or below it."""
    pairs = [parted_key(b) for b in bounds]
    highs = np.array([p[0] for p in pairs], dtype=np.int64)
    lows = np.array([p[1] for p in pairs], dtype=np.int64)

    @F.pandas_udf("int")
    def interval(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for high, low in columns:
            h, t = high.to_numpy(), low.to_numpy()
            left, right = np.searchsorted(highs, h, "left"), np.searchsorted(highs, h, "right")
            # Only rows that share their first half with a bound look at the second.
            for start in np.unique(left[left < right]):
                rows = np.flatnonzero((left == start) & (left < right))
                end = right[rows[0]]
                left[rows] = start + np.searchsorted(lows[start:end], t[rows], "right")
            yield pd.Series(left.astype(np.int32))

    return interval("_high", "_low")


def histogram(keys: DataFrame, bounds: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Bytes, rows, first and last key of every interval that has rows, by its number."""
    first = F.min(F.struct("_high", "_low")).alias("first")
    last = F.max(F.struct("_high", "_low")).alias("last")
    found = keys.groupBy(intervals(bounds).alias("at")).agg(
        F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), first, last).collect()
    return sorted((r["at"], r["bytes"], r["rows"], joined_key(*r["first"]), joined_key(*r["last"]))
                  for r in found)


def splitters(keys: DataFrame, parts: int, shards: int, tolerance: float = TOLERANCE,
              probes: int = PROBES) -> tuple[list[int], list[int]]:
    """``parts - 1`` sort keys that cut the bytes evenly, and the rows below each.

    ``keys`` has ``_high``, ``_low`` and ``size`` and should be stored: each round counts,
    exactly and over all rows, the bytes below every probe, and puts new probes into the
    intervals in which a boundary is still open, both ends of their keys included, so that
    an interval only shrinks. A boundary is settled when its bytes are within the
    tolerance, or when its interval holds a single key, which cannot be cut. Only counts
    by interval reach the driver, at most ``probes + 2`` per boundary.
    """
    return refined(lambda bounds: histogram(keys, bounds), parts, shards, tolerance, probes)


def refined(count: Callable[[list[int]], list[tuple[int, int, int, int, int]]], parts: int,
            shards: int, tolerance: float, probes: int) -> tuple[list[int], list[int]]:
    """The rounds of :func:`splitters`; ``count`` gives the histogram between bounds."""
    top = 1 << 128
    bounds = [top * i // (parts * probes) for i in range(1, parts * probes)]
    each = parts // shards
    settled: dict[int, tuple[int, int]] = {}
    widths: dict[int, int] = {}
    while True:
        rows = count(bounds)
        total = sum(r[1] for r in rows)
        ends = list(accumulate(r[1] for r in rows))
        counts = list(accumulate(r[2] for r in rows))
        fresh: set[int] = set()
        for part in range(1, parts):
            if part in settled:
                continue
            if not rows:
                settled[part] = (LEAST, 0)
                continue
            goal = total * part / parts
            near = (tolerance * total / shards if part % each == 0
                    else BLOCK_TOLERANCE * total / parts)
            i = min(bisect_right(ends, goal), len(rows) - 1)
            below, below_rows = ends[i] - rows[i][1], counts[i] - rows[i][2]
            first, last = rows[i][3], rows[i][4]
            lower, upper = goal - below, ends[i] - goal
            if min(lower, upper) <= near or first == last:
                settled[part] = (first, below_rows) if lower <= upper else (last + 1, counts[i])
            elif last - first >= widths.get(part, top):
                raise RuntimeError(f"boundary {part} stays between {first} and {last}")
            else:
                widths[part] = last - first
                # Keys beyond the last one belong to other boundaries.
                fresh.update(first + -(-(last - first) * k // probes) for k in range(probes + 1))
                fresh.add(last + 1)
        if not fresh:
            break
        # Counting anew below these needs no memory of earlier rounds.
        bounds = sorted(fresh)
    order = [settled[part] for part in range(1, parts)]
    return [k for k, _ in order], [n for _, n in order]


def histogram_shards(docs: DataFrame, shards: int = SHARDS, *, text: str = "text",
                     key: str = "doc_id", tolerance: float = TOLERANCE,
                     blocks: int | None = None) -> DataFrame:
    """Sort rows into shards of near-equal bytes; adds ``size``, ``shard`` and ``slot``.

    ``size`` is the text's UTF-8 bytes plus 1, a null text having none. Rows are ordered
    by the hash of their text and then of their id, so equal texts are neighbours
    and share a shard unless a boundary falls among them. A shard's bytes differ from
    the mean by at most ``tolerance`` of it and one row. Rows equal in text and id
    cannot be told apart and stay in one shard. ``slot`` counts from 0 in each shard.
    Input columns named like the new ones are replaced; no rows give no rows.

    A shard is cut into ``blocks`` tasks, by default such that all shards together have
    at least the session's shuffle partitions. Whole rows are exchanged once.
    """
    kept = without(docs, OUTPUTS)
    blocks = blocks or -(-tasks(docs.sparkSession) // shards)
    parts = shards * blocks
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + 1
    keyed = kept.select(F.struct("*").alias("_row"), F.xxhash64(text_of(text)).alias("_high"),
                        F.xxhash64(F.col(key)).alias("_low"), size.alias("size"))
    keys = written(keyed.select("_high", "_low", "size"), "sort-keys")
    bounds, rows_below = splitters(keys, parts, shards, tolerance)
    below = [0, *rows_below]
    in_shard = [below[p] - below[p - p % blocks] for p in range(parts)]
    placed = keyed.withColumn("_block", intervals(bounds) if bounds else F.lit(0))
    exchanged = placed.repartitionById(parts, F.col("_block")).sortWithinPartitions("_high", "_low")
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = exchanged.withColumn("_within", within)
    start = F.element_at(F.array(*[F.lit(n).cast("long") for n in in_shard]), F.col("_block") + 1)
    return numbered.select(
        "_row.*", "size", F.expr(f"_block div {blocks}").cast("int").alias("shard"),
        (start + F.col("_within")).alias("slot"))
