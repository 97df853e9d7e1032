"""Document fingerprints by randomised edit embedding.

A shared random walk goes over the characters of a text: it stands on a character for a
random number of steps that depends on the character and the step alone, then goes on.
Texts that differ by few edits fall back into step soon after each, so their walks
differ at few steps. A fingerprint holds what the walk stands on at fixed steps: all
of the first 64, and 64 random ones of each following octave, so that texts of any length
share them, and whole texts are covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.bagminhash import (
    SMALL_BUCKET,
    all_pairs,
    cross_pairs,
    field,
    first_orders,
    joined,
    later_orders,
    pivot_pairs,
    unsettled,
)
from tripflow.llm.common import code_points, mixed, tasks, text_of, written

CLASSES = 256
PERIOD = 1024
SAMPLES = 64
SEED = 8
RUN_CHARS = 1 << 23
BANDS = 32
BAND_SYMBOLS = 5
WALKS = 3
THRESHOLD = 0.8
HEX = np.frombuffer(b"0123456789abcdef", dtype=np.uint8)


@lru_cache
def stays(walk: int = 0) -> np.ndarray:
    """Steps a walk stands on a character of a class that it reaches at a step, flattened."""
    go = np.random.default_rng(SEED + walk).random((CLASSES, PERIOD)) < 0.5
    go[:, -1] = True
    found = np.empty((CLASSES, PERIOD), dtype=np.int32)
    ahead = np.zeros(CLASSES, dtype=np.int32)
    for step in range(PERIOD - 1, -1, -1):
        ahead = np.where(go[:, step], 1, ahead + 1)
        found[:, step] = ahead
    return found.ravel()


def sampled_steps(most: int) -> np.ndarray:
    """The steps that fingerprints hold, below ``most``."""
    steps = [np.arange(SAMPLES)]
    start = SAMPLES
    while start < most:
        rng = np.random.default_rng([SEED, start])
        steps.append(start + np.sort(rng.choice(start, SAMPLES, replace=False)))
        start *= 2
    joined = np.concatenate(steps)
    return joined[joined < most]


def step_weights(number: int) -> np.ndarray:
    """How many steps each of the first sampled steps stands for."""
    octave = np.arange(number) // SAMPLES
    return np.where(octave == 0, 1.0, 2.0 ** (octave - 1))


def symbols(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class (0-255) and symbol (0-15) of each character."""
    spread = mixed(points.astype(np.uint64))
    return (spread & np.uint64(CLASSES - 1)).astype(np.int64), (
        (spread >> np.uint64(40)) & np.uint64(15)).astype(np.uint8)


def fingerprints(texts: Sequence[str], walk: int = 0) -> list[np.ndarray]:
    """Symbols at the sampled steps of each whole text's walk; none for an empty text.

    Different values of ``walk`` are independent walks.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint8)] * len(texts)
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    at = 0
    while at < len(order):
        # Texts of similar length walk together, about so many characters at once.
        ends = np.cumsum(sizes[order[at:]])
        n = max(1, int(np.searchsorted(ends, RUN_CHARS, "right")))
        for i, found in zip(order[at:at + n], _walks([texts[i] for i in order[at:at + n]], stays(walk))):
            out[i] = found
        at += n
    return out


def _walks(texts: list[str], stays: np.ndarray) -> list[np.ndarray]:
    """Fingerprints of texts in order of falling length, none empty."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    classes, symbol = symbols(code_points("".join(texts)))
    rows = classes * PERIOD
    first = np.cumsum(sizes) - sizes
    reached = np.empty(len(rows), dtype=np.int64)
    step = np.zeros(len(texts), dtype=np.int64)
    # Texts still walking at each character are the first so many.
    walking = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
    for i in range(int(sizes[0])):
        n = walking[i]
        if n == 1:
            _walk_alone(rows, reached, int(first[0]), i, int(sizes[0]), int(step[0]), stays)
            end = first[0] + sizes[0] - 1
            step[0] = reached[end] + stays[rows[end] + reached[end] % PERIOD]
            break
        here = first[:n] + i
        now = step[:n]
        reached[here] = now
        step[:n] = now + stays[rows[here] + now % PERIOD]
    steps = sampled_steps(int(step.max()))
    out = []
    for a, size, last in zip(first, sizes, step):
        wanted = steps[:np.searchsorted(steps, last)]
        on = np.searchsorted(reached[a:a + size], wanted, "right") - 1
        out.append(symbol[a:a + size][on])
    return out


def _walk_alone(rows: np.ndarray, reached: np.ndarray, first: int, at: int, size: int,
                step: int, stays: np.ndarray) -> None:
    """The rest of one walk, when no other text is as long."""
    known = memoryview(stays)
    found = []
    for row in rows[first + at:first + size].tolist():
        found.append(step)
        step += known[row + step % PERIOD]
    reached[first + at:first + size] = found


def to_hex(found: np.ndarray) -> str:
    return HEX[found].tobytes().decode()


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Share of the longer walk's steps at which both stand on the same symbol; 1 if both empty."""
    most, both = max(len(left), len(right)), min(len(left), len(right))
    if not most:
        return 1.0
    weights = step_weights(most)
    return float(weights[:both][left[:both] == right[:both]].sum() / weights.sum())


def ordered_parts(docs: DataFrame) -> DataFrame:
    """Rows in about even ranges of falling ``doc_id``, each with its successor's copy.

    Adds ``_part`` (the range, one task each), ``_halo`` (whether the row only lends its
    text to the range before it). Within a part rows are sorted by falling id, rows
    without an id last, then the lent row. Ranges are cut at approximate quantiles; one
    id per range, its first, reaches the driver.
    """
    spark = docs.sparkSession
    parts = tasks(spark)
    least = -(1 << 63)
    keyed = docs.withColumn("_id", F.coalesce(F.col("doc_id"), F.lit(least)))
    shares = [i / parts for i in range(1, parts)]
    bounds = keyed.agg(F.percentile_approx("_id", shares or [0.5], 10000)).first()[0]
    cuts = np.unique(np.array(bounds or [], dtype=np.int64)) if parts > 1 else np.zeros(0, np.int64)

    @F.pandas_udf(T.IntegerType())
    def part(ids: pd.Series) -> pd.Series:
        # Larger ids come first.
        return pd.Series((len(cuts) - np.searchsorted(cuts, ids.to_numpy(), "left")).astype("int32"))

    placed = keyed.withColumn("_part", part("_id"))
    firsts = sorted((r["_part"], r["m"]) for r in
                    placed.groupBy("_part").agg(F.max("_id").alias("m")).collect())
    lent = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    goes = F.array(F.struct(F.col("_part").alias("to"), F.lit(False).alias("halo")))
    if lent:
        to = F.element_at(F.create_map(*[F.lit(x) for kv in lent.items() for x in kv]), F.col("_id"))
        is_first = F.col("_id").isin(list(lent))
        goes = F.when(is_first, F.concat(goes, F.array(F.struct(to.alias("to"), F.lit(True).alias("halo")))
                                         )).otherwise(goes)
    sent = placed.withColumn("_to", F.explode(goes)).withColumn("_part", F.col("_to.to")).withColumn(
        "_halo", F.col("_to.halo")).drop("_to")
    return sent.repartitionById(len(cuts) + 1, F.col("_part")).sortWithinPartitions(
        "_halo", F.desc("_id"), F.xxhash64("text"), "text")


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following text's beginning."""
    third = len(text) // 3
    return text[:len(text) - third] + following[:third]


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: pd.DataFrame | None = None
    for batch in batches:
        own = batch[~batch["_halo"]]
        lent = batch[batch["_halo"]]
        rows = own if held is None else pd.concat([held, own])
        # The last row waits for its successor.
        if len(rows) > 1:
            yield from _results(rows.iloc[:-1], rows["text"].iloc[1:].tolist())
        held = rows.iloc[-1:] if len(rows) else None
        if len(lent) and held is not None:
            yield from _results(held, [lent["text"].iloc[0]])
            return
    if held is not None:
        yield from _results(held, held["text"].tolist())


def _results(rows: pd.DataFrame, following: list[str]) -> Iterator[pd.DataFrame]:
    texts, ids = rows["text"].tolist(), rows["doc_id"].tolist()
    first = 0
    while first < len(texts):
        last, held = first, 0
        while last < len(texts) and (last == first or held + len(texts[last]) <= RUN_CHARS):
            held += len(texts[last])
            last += 1
        changed = [edited(t, f) for t, f in zip(texts[first:last], following[first:last])]
        own = fingerprints([*texts[first:last], following[last - 1]])
        other = fingerprints(changed)
        yield pd.DataFrame({
            "doc_id": pd.array([None if i != i or i is None else int(i) for i in ids[first:last]],
                               dtype="Int64"),
            "n_chars": [len(t) for t in texts[first:last]],
            "edited_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in changed],
            "fingerprint": [to_hex(f) for f in own[:-1]],
            "edited_fingerprint": [to_hex(f) for f in other],
            "near_edited": [likeness(a, b) for a, b in zip(own, other)],
            "near_next": [likeness(a, b) for a, b in zip(own, own[1:])],
        })
        first = last


def fingerprint_rows(docs: DataFrame) -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness.

    From ``doc_id`` and ``text``; a null text counts as empty. The next document of the
    smallest id is the one of the largest; of a single row, itself. Rows without an id
    follow the others. Rows of one id follow each other in the order of their text's
    hash. Equal texts have equal fingerprints. Texts are shuffled once, and a task holds
    one batch of them at a time. Other columns are not looked at. No rows give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return ordered_parts(rows).select("doc_id", "text", "_halo").mapInPandas(
        _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                  "edited_fingerprint string, near_edited double, near_next double")


@F.pandas_udf(T.ArrayType(T.StringType()))
def walk_fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Fingerprints of several independent walks: one may lose step for long, hardly all."""
    for texts in batches:
        each = [[to_hex(f) for f in fingerprints(texts.tolist(), walk)] for walk in range(WALKS)]
        yield pd.Series([list(f) for f in zip(*each)], dtype=object)


@lru_cache(maxsize=1 << 14)
def band_steps(top: int, band: int, within: int) -> list[int]:
    rng = np.random.default_rng([SEED, top, band])
    return np.sort(rng.choice(within, min(BAND_SYMBOLS, within), replace=False)).tolist()


@F.pandas_udf(T.ArrayType(T.LongType()))
def bands(found: pd.Series) -> pd.Series:
    """Hashes of bit samples of a walk, drawn from its whole octaves.

    A walk is sampled in its own octave and the one below, so that texts whose lengths
    fall on two sides of a power of two share bands.
    """
    def keys(text: str, walk: int) -> set[int]:
        octaves = len(text) // SAMPLES
        out = set()
        for top in {octaves, max(octaves - 1, 0)}:
            within = max(1, min(len(text), top * SAMPLES))
            for b in range(BANDS):
                steps = band_steps(top, b, within)
                key = f"{walk}.{top}.{b}." + "".join(text[s] for s in steps)
                out.add(int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(),
                                       "little", signed=True))
        return out

    return found.map(lambda walks: sorted(set().union(
        *(keys(text, w) for w, text in enumerate(walks) if text))))


def close_lengths(threshold: float, classes: bool = True):
    """Whether two texts' lengths do not rule the pair out, and whether their classes differ."""
    def where(left: str | Column, right: str | Column) -> Column:
        a, b = field(left, "n_chars"), field(right, "n_chars")
        near = F.abs(a - b) <= F.floor(F.greatest(a, b) * (1 - threshold))
        return near & (field(left, "label") != field(right, "label")) if classes else near

    return where


def edited_pairs(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Those of the pairs, stored, whose whole texts are alike by edit distance."""
    left = nodes.select(F.col("node").alias("a"), F.col("text").alias("_left"))
    right = nodes.select(F.col("node").alias("b"), F.col("text").alias("_right"))
    most = F.floor(F.greatest(F.length("_left"), F.length("_right")) * (1 - threshold))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return written(both.where(F.levenshtein("_left", "_right") <= most).select("a", "b"), "edit-alike")


def edit_classes(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id`` and ``class_id`` (the class's smallest id): texts alike by edit distance.

    Fingerprints of distinct texts meet in bands of bit samples. Members of a bucket meet
    pivots of it; then small buckets compare all members of different classes, and large
    ones go on with new pivots until a round finds nothing and then compare all members
    of different classes in blocks. Pairs are verified by the edit distance of the whole
    texts, which must be at most ``1 - threshold`` of the longer one, each pair once. Equal
    texts are one node; empty and null texts are alike. Rows without an id get their class's
    smallest id, if any.
    """
    rows = written(docs.select("doc_id", text_of().alias("text")).withColumn("digest", F.md5("text")),
                   "edit-rows")
    nodes = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.first("text").alias("text"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id())
                    .withColumn("n_chars", F.length("text")), "edit-nodes")
    met = written(nodes.select("node", F.explode(bands(walk_fingerprints("text"))).alias("bucket")),
                  "edit-bands")
    several = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    left = written(met.join(several, "bucket").join(nodes.select("node", "n_chars"), "node"),
                   "edit-crowded")
    labels = nodes.select("node", F.col("node").alias("label"))
    apart = close_lengths(threshold)
    pairs = checked = written(pivot_pairs(
        left, first_orders(), "n_chars", where=close_lengths(threshold, False)).distinct(), "edit-pairs")
    turn = 0
    while True:
        found = edited_pairs(pairs, nodes, threshold)
        dry = not found.take(1)
        if not dry:
            labels = joined(labels, found)
        if dry and turn:
            break
        left = unsettled(left, labels)
        turn += 1
        large = left.where(F.col("members") > SMALL_BUCKET)
        pairs = pivot_pairs(large, later_orders(turn), "label", "n_chars", where=apart)
        if turn == 1:
            pairs = pairs.union(all_pairs(left.where(F.col("members") <= SMALL_BUCKET), apart))
            left = large
        pairs = written(pairs.distinct().join(checked, ["a", "b"], "left_anti"), "edit-pairs")
        checked = checked.unionByName(pairs)
    if left.take(1):
        pairs = cross_pairs(left.select("node", "bucket", "label"), nodes, "n_chars", where=apart)
        pairs = written(pairs.distinct().join(checked, ["a", "b"], "left_anti"), "edit-pairs")
        labels = joined(labels, edited_pairs(pairs, nodes, threshold))
    known = nodes.select("digest", "first_id", "node").join(labels, "node")
    heads = known.groupBy("label").agg(F.min("first_id").alias("class_id"))
    classes = written(known.join(heads, "label").select("digest", "class_id"), "edit-classes")
    return rows.select("doc_id", "digest").join(classes, "digest").select("doc_id", "class_id")
