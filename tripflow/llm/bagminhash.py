"""Near-duplicates by weighted Jaccard similarity of word shingles, with BagMinHash.

A document is a multiset of five-word shingles. For each shingle the weight axis is
divided into octaves [0,1), [1,2), [2,4), ... each with its own Poisson process whose
rate is the octave's width; every point has a random place in the octave, a random
signature component and a time. A document sees the points placed below its weight,
and each component keeps the earliest. Two documents agree in a component with a
probability of exactly their weighted Jaccard similarity. Points later than what all
components hold already are never drawn, and an octave costs the same however often
a shingle occurs.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow.llm.common import FEW, gathered, mixed, text_of, text_runs, written
from tripflow.llm.components import components, relabelled
from tripflow.llm.words import counted_runs, shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 20
ROWS = 4
COMPONENTS = BANDS * ROWS
# Of 80 components, how many may disagree in four bits; see ``likely``.
MOST_DIFFERENT = 36
# Bits that tell whether shingles occur an odd number of times; see ``possible``.
PARITY_BITS = 1024
# Rounds of pivots go on while a round joins a class for so many rows of large buckets.
WORTH = 100
SKETCH = [f"s{k}" for k in range(5)]
PARITY = [f"p{k}" for k in range(PARITY_BITS // 64)]
# The fields of ``known``, what is known of a node without its text; ``size`` is its number of shingles.
KNOWN = [*SKETCH, *PARITY, "size"]
# Buckets of up to so many members compare all of them at once; larger ones after pivots.
SMALL_BUCKET = 32
# Members of a group that one task compares with as many others at a time.
BLOCK = 512
# Slots of the table that tells frequent shingles from rare ones.
SLOTS = 1 << 18
# Blocks of slots; a task sends a row for each, whatever the number of its shingles.
SLOT_BLOCKS = 128
# So many of the orders that give a large bucket new pivots take classes evenly.
CLASS_ORDERS = 10
NEVER = np.uint64(np.iinfo(np.uint64).max)


def bag_min_hash(at: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int,
                 size: int = COMPONENTS) -> np.ndarray:
    """Signatures (rows x size, 32 bits) of multisets given as (row, element, weight).

    Every row must have an element. Weights are whole numbers from 1.
    """
    octaves = 1 + np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64)
    of = np.repeat(np.arange(len(at)), octaves)
    octave = np.arange(len(of)) - np.repeat(np.cumsum(octaves) - octaves, octaves)
    lower = np.where(octave == 0, 0, 1 << np.maximum(octave - 1, 0))
    width = np.maximum(lower, 1).astype(np.uint64)
    row, most = at[of], weight[of]
    with np.errstate(over="ignore"):
        seed = mixed(element[of] ^ mixed(octave.astype(np.uint64)))
        time = np.zeros(len(of))
        best = np.full(rows * size, NEVER, dtype=np.uint64)
        draw = np.uint64(0)
        while len(row):
            x = mixed(seed + draw)
            time = time - np.log(((x >> np.uint64(11)).astype(float) + 1) * 2.0 ** -53) / width
            y = mixed(x)
            place = lower + (((y & np.uint64(0xFFFFFFFF)) * width) >> np.uint64(32)).astype(np.int64)
            component = ((y >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
            # Non-negative floats sort like their bits.
            stamp = time.astype(np.float32).view(np.uint32).astype(np.uint64)
            point = (stamp << np.uint64(32)) | (mixed(y) >> np.uint64(32))
            seen = place < most
            np.minimum.at(best, (row * size + component)[seen], point[seen])
            last = best.reshape(rows, size).max(axis=1) >> np.uint64(32)
            alive = stamp < last[row]
            row, most, seed, time = row[alive], most[alive], seed[alive], time[alive]
            lower, width = lower[alive], width[alive]
            draw += np.uint64(0x9E3779B97F4A7C15)
    return (best & np.uint64(0xFFFFFFFF)).astype(np.uint32).reshape(rows, size)


def parities(hashes: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Of each text's shingles, ``PARITY_BITS`` bits as longs: whether an odd number falls on a bit."""
    slot = (mixed(hashes) % np.uint64(PARITY_BITS)).astype(np.int64)
    found, often = np.unique(np.repeat(np.arange(len(each)), each) * PARITY_BITS + slot, return_counts=True)
    odd = np.zeros(len(each) * PARITY_BITS, dtype=np.uint8)
    odd[found[often % 2 == 1]] = 1
    return np.packbits(odd.reshape(len(each), PARITY_BITS), axis=1).view(np.int64)


def sign(texts: Sequence[str]) -> tuple[list[bytes | None], np.ndarray]:
    """Signature bytes of each whole text, None for texts without words, and its parities and
    number of shingles as a row of longs."""
    out: list[bytes | None] = [None] * len(texts)
    known = np.zeros((len(texts), len(PARITY) + 1), dtype=np.int64)
    for a, b in text_runs(texts):
        hashes, each = shingle_hashes(*word_hashes(texts[a:b]), SHINGLE)
        with np.errstate(over="ignore"):
            known[a:b, :-1] = parities(hashes, each)
        known[a:b, -1] = each
        at, element, often = counted_runs(hashes, each)
        some = np.flatnonzero(each > 0)
        place = np.cumsum(each > 0) - 1
        signed = bag_min_hash(place[at], element, often, len(some))
        for i, s in zip(some, signed):
            out[a + i] = s.tobytes()
    return out, known


def bags(texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct 64-bit shingle hashes and their counts, of each text."""
    out = []
    for a, b in text_runs(texts):
        hashes, each = shingle_hashes(*word_hashes(texts[a:b]), SHINGLE)
        for part in np.split(hashes, np.cumsum(each)[:-1]):
            out.append(np.unique(part, return_counts=True))
    return out


def likeness(left: tuple, right: tuple) -> float:
    """Weighted Jaccard similarity of two counted bags; 1 for two empty ones."""
    _, i, j = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(left[1][i], right[1][j]).sum())
    total = int(left[1].sum() + right[1].sum()) - shared
    return shared / total if total else 1.0


def band_keys(signed: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of the signatures."""
    rows = signed.reshape(len(signed), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(mixed(np.arange(BANDS, dtype=np.uint64)), rows.shape[:2])
    for k in range(ROWS):
        key = mixed(key ^ rows[:, :, k])
    return key.view(np.int64)


def sketches(signed: np.ndarray) -> np.ndarray:
    """Four bits of each component in five longs: four bit planes of the first 64
    components, and all four planes of the last 16 side by side."""
    planes = [(signed >> k & 1).astype(np.uint8) for k in range(4)]
    rest = np.concatenate([p[:, 64:] for p in planes], axis=1)
    return np.stack([np.packbits(p, axis=1).view(np.int64)[:, 0]
                     for p in [*(np.ascontiguousarray(q[:, :64]) for q in planes), rest]], axis=1)


@F.pandas_udf(T.StructType([T.StructField("buckets", T.ArrayType(T.LongType())),
                            *[T.StructField(c, T.LongType()) for c in KNOWN]]))
def banded(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Band keys, sketch, parities and size of each text; the keys are null for texts without words."""
    for texts in batches:
        found, known = sign(texts.tolist())
        signed = np.frombuffer(b"".join(f or bytes(4 * COMPONENTS) for f in found),
                               dtype=np.uint32).reshape(-1, COMPONENTS)
        with np.errstate(over="ignore"):
            keys = band_keys(signed)
        short = sketches(signed) if len(signed) else np.zeros((0, len(SKETCH)), np.int64)
        out = pd.DataFrame(np.concatenate([short, known], axis=1), columns=KNOWN)
        out.insert(0, "buckets", pd.Series([k if f else None for f, k in zip(found, keys)],
                                           dtype=object))
        yield out


@F.pandas_udf(T.DoubleType())
def overlap(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for left, right in batches:
        found = np.zeros(len(left))
        lefts, rights = left.tolist(), right.tolist()
        for a, b in text_runs([x + y for x, y in zip(lefts, rights)]):
            distinct = list(dict.fromkeys(lefts[a:b] + rights[a:b]))
            bag = dict(zip(distinct, bags(distinct)))
            found[a:b] = [likeness(bag[x], bag[y]) for x, y in zip(lefts[a:b], rights[a:b])]
        yield pd.Series(found)


def crowded(nodes: DataFrame) -> DataFrame:
    """Stored rows ``node``, ``bucket``, ``members`` and ``known`` of buckets with several members.

    Most buckets have one member; theirs are dropped by key alone, before sketches are joined.
    """
    bands = written(nodes.select("node", F.explode("buckets").alias("bucket")), "bands")
    several = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return written(bands.join(several, "bucket").join(nodes.select("node", "known"), "node"),
                   "crowded")


def field(of: str | Column, name: str) -> Column:
    """A column by prefix and name, or a field of a struct."""
    return F.col(f"{of}{name}") if isinstance(of, str) else of[name]


def likely(left: str | Column, right: str | Column) -> Column:
    """Whether two sketches do not speak against the threshold.

    Four bits of a component agree with a probability of 0.8125 or more if the similarity is
    0.8; more than 36 of 80 disagree in two of a hundred million cases.
    """
    one, two = field(left, "known"), field(right, "known")
    *planes, rest = [one[c].bitwiseXOR(two[c]) for c in SKETCH]
    differ = planes[0].bitwiseOR(planes[1]).bitwiseOR(planes[2]).bitwiseOR(planes[3])
    for far in (32, 16):
        rest = rest.bitwiseOR(F.shiftright(rest, far))
    return F.bit_count(differ) + F.bit_count(rest.bitwiseAND(F.lit(0xFFFF))) <= MOST_DIFFERENT


def possible(left: str | Column, right: str | Column, threshold: float) -> Column:
    """Whether two multisets can be alike by ``threshold``; false only if they are not.

    Each shingle that one has more often than the other changes one parity bit or none, so
    they differ in at least as many shingles as bits, and in at least the difference of
    their sizes. At a likeness of t they differ in (1 - t) / (1 + t) of both sizes' sum. Bits
    are enough to tell 0.75 from 0.8 up to some 700 words; of longer texts sketches decide.
    """
    one, two = field(left, "known"), field(right, "known")
    bits = [F.bit_count(one[c].bitwiseXOR(two[c])) for c in PARITY]
    most = (one["size"] + two["size"]) * F.lit((1 - threshold) / (1 + threshold)) + F.lit(1e-6)
    return (F.abs(one["size"] - two["size"]) <= most) & (functools.reduce(operator.add, bits) <= most)


def pivot_pairs(bands: DataFrame, orders: Sequence[Column], *others: str,
                where: Callable[[str | Column, str | Column], Column]) -> DataFrame:
    """Pairs ``a`` < ``b`` of each bucket's members with pivots of it; they may repeat.

    Pivots are the first and last of the bucket in each order. A large bucket compares two
    pivots per member and order, not all pairs, and a bucket of up to three members makes
    all its pairs. ``where`` takes the prefix of a member's columns ``others`` and a pivot
    with such fields, and may rule pairs out; a row is made only of what it leaves.
    """
    ends = []
    for order in orders:
        whole = F.struct(order.alias("order"), "node", *others)
        ends += [F.struct(*[end[c].alias(c) for c in ("node", *others)])
                 for end in (F.min(whole), F.max(whole))]
    pivots = written(
        bands.groupBy("bucket").agg(F.array_distinct(F.array(*ends)).alias("pivots"))
        .where(F.size("pivots") > 1), "pivots")
    near = F.filter("pivots", lambda p: (p["node"] != F.col("node")) & where("", p))
    met = bands.join(pivots, "bucket").select("node", F.explode(near["node"]).alias("p"))
    return met.select(F.least("node", "p").alias("a"), F.greatest("node", "p").alias("b"))


def first_orders() -> list[Column]:
    """Orders that are the same for all buckets, so that those of a large group of copies
    have most pivots in common: one for small buckets, three more for large ones."""
    one = F.xxhash64("node")
    return [one, *[F.when(F.col("members") > SMALL_BUCKET, F.xxhash64("node", F.lit(k)))
                   .otherwise(one) for k in range(3)]]


def later_orders(turn: int) -> list[Column]:
    """Orders of a bucket's members, new in each turn and bucket.

    Two take members evenly. The others take classes evenly, then a member: the two
    ends are of different classes, and a text that stands alone soon meets every
    member of a large class.
    """
    members = [F.xxhash64("node", "bucket", F.lit(turn), F.lit(k)) for k in range(2)]
    return members + [
        F.struct(F.xxhash64("label", "bucket", F.lit(turn), F.lit(k)).alias("of"),
                 members[0].alias("member")) for k in range(CLASS_ORDERS)]


def all_pairs(bands: DataFrame, where: Callable[[str, str], Column]) -> DataFrame:
    """Pairs of all members of small buckets; they may repeat."""
    left, right = bands.alias("l"), bands.alias("r")
    met = left.join(right, (F.col("l.bucket") == F.col("r.bucket"))
                    & (F.col("l.node") < F.col("r.node")) & where("l.", "r."))
    return met.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))


def cross_pairs(rows: DataFrame, details: DataFrame, *others: str,
                where: Callable[[str, str], Column]) -> DataFrame:
    """Pairs of all members of different classes of each bucket; they may repeat.

    ``rows`` has ``node``, ``bucket`` and ``label``; ``details`` has columns ``others`` of
    each node, for ``where``. A bucket's largest class is not compared with itself, and
    large buckets are cut into blocks, so that no task gets a whole one.
    """
    sizes = rows.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy("bucket").agg(
        F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("members"),
        F.count(F.lit(1)).alias("classes")).where("classes > 1")
    placed = rows.join(split.select(
        "bucket", F.col("top.label").alias("most"),
        F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "bucket")
    placed = written(placed.join(details.select("node", *others), "node")
                     .withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "placed")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = placed.where("label != most").withColumn("i", F.col("own")).withColumn("j", every).alias("l")
    right = placed.withColumn("j", F.col("own")).withColumn("i", every).alias("r")
    once = (F.col("r.label") == F.col("r.most")) | (F.col("l.node") < F.col("r.node"))
    met = left.join(right, (F.col("l.bucket") == F.col("r.bucket")) & (F.col("l.i") == F.col("r.i"))
                    & (F.col("l.j") == F.col("r.j")) & once & (F.col("l.label") != F.col("r.label"))
                    & where("l.", "r."))
    return met.select(F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b"))


def tokens(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A bag as a set: the k-th copy of a shingle is an element of its own."""
    values, counts = bag
    copy = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        return np.where(copy > 0, mixed(np.repeat(values, counts) ^ mixed(copy.astype(np.uint64))),
                        np.repeat(values, counts))


def rarest(found: np.ndarray, often: np.ndarray, threshold: float) -> np.ndarray:
    """So many of the tokens, rarest first, that two sets alike by ``threshold`` share one.

    Any order that is the same for all sets will do; this one keeps groups small.
    """
    shared = int(np.ceil(threshold * len(found) - 1e-9))
    order = np.lexsort((found, often[found % np.uint64(len(often))]))
    return found[order[:len(found) - shared + 1]]


def several(found: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The tokens without those whose slot counts no other token: they are in one set alone."""
    return found[often[found % np.uint64(len(often))] > 1]


def block_counts(texts: DataFrame) -> DataFrame:
    """How many tokens of a task's texts fall on each slot, as a row per task and ``block`` of slots."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        often = np.zeros(SLOTS, dtype=np.int64)
        for batch in batches:
            for bag in bags(batch["text"].tolist()):
                often += np.bincount((tokens(bag) % np.uint64(SLOTS)).astype(np.int64), minlength=SLOTS)
        found = [(i, some, part[some]) for i, part in enumerate(often.reshape(SLOT_BLOCKS, -1))
                 if len(some := np.flatnonzero(part))]
        yield pd.DataFrame(found, columns=["block", "slots", "n"])

    return texts.select("text").mapInPandas(count, "block int, slots array<int>, n array<long>")


def slot_counts(texts: DataFrame) -> np.ndarray:
    """How many tokens of all texts fall on each slot; blocks are added up on Spark."""
    def total(part: pd.DataFrame) -> pd.DataFrame:
        often = np.zeros(SLOTS // SLOT_BLOCKS, dtype=np.int64)
        for slots, n in zip(part["slots"], part["n"]):
            often[slots] += n
        return pd.DataFrame({"block": part["block"].iloc[:1], "n": [often]})

    often = np.zeros((SLOT_BLOCKS, SLOTS // SLOT_BLOCKS), dtype=np.int64)
    blocks = block_counts(texts).groupBy("block").applyInPandas(total, "block int, n array<long>")
    for r in blocks.collect():
        often[r["block"]] = r["n"]
    return often.ravel()


def prefix_rows(texts: DataFrame, threshold: float) -> DataFrame:
    """``node``, ``label`` and ``bucket``, the rarest shingles of each text that another may have."""
    held = texts.sparkSession.sparkContext.broadcast(slot_counts(texts))

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def prefix(column: pd.Series) -> pd.Series:
        often = held.value
        return pd.Series([several(rarest(tokens(bag), often, threshold), often).view(np.int64)
                          for bag in bags(column.tolist())], dtype=object)

    return written(texts.select("node", "label", F.explode(prefix("text")).alias("bucket")), "prefixes")


def rest_pairs(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """All pairs of different classes, among the stored ``members`` with ``node``, ``label`` and ``known``, that can be links.

    Two multisets alike by ``threshold`` have one of their rarest shingles in common (prefix
    filter), so members are grouped anew by these: what a large bucket has in common is
    frequent and comes last. All that meet in a group are compared, by ``likely`` and ``possible``.
    """
    own = texts.join(members.select("node", "label"), "node")
    return cross_pairs(prefix_rows(own, threshold), members, "known",
                       where=lambda left, right: likely(left, right) & possible(left, right, threshold))


def candidate_texts(docs: DataFrame, bands: DataFrame, reps: DataFrame) -> DataFrame:
    """``node`` and ``text`` of all nodes that share a bucket, stored."""
    needed = reps.join(bands.select("node").distinct(), "node")
    own = docs.select("doc_id", text_of().alias("text")).withColumn("rep_digest", F.md5("text"))
    return written(own.join(needed.hint("merge"), (own["rep_digest"] == needed["rep_digest"])
                            & own["doc_id"].eqNullSafe(needed["rep_id"]))
                   .select("node", "text").dropDuplicates(["node"]), "texts")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Those of the distinct, stored pairs of which the whole texts' multisets overlap by
    ``threshold`` or more. Only texts of the pairs are moved; few pairs go to the left texts."""
    left, right = [texts.select(F.col("node").alias(n), F.col("text").alias(t)).join(
        pairs.select(n), n, "left_semi") for n, t in (("a", "_left"), ("b", "_right"))]
    if pairs.count() <= FEW:
        met = texts.select(F.col("node").alias("a"), F.col("text").alias("_left")).join(F.broadcast(pairs), "a")
    else:
        met = pairs.join(left.hint("merge"), "a")
    both = met.join(right.hint("merge"), "b")
    return both.where(overlap("_left", "_right") >= threshold).select("a", "b")


def near_classes(docs: DataFrame, *, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Classes of near-duplicates: documents joined by chains of pairs alike by ``threshold``.

    Returns two stored frames. Of every row: ``doc_id``, ``digest`` of its text,
    ``class_id`` (the class's smallest doc_id), ``class_size`` in rows, and ``kept``,
    true for one row of each class, one with that doc_id. Of every distinct text:
    ``digest`` and ``class_id``.

    Rows of equal text are one node from the start, null texts counting as empty, so
    groups of copies cost nothing further. Texts without words equal only texts that
    are equal to them; texts of one to four words make one shingle. Rows without an
    id belong to classes like others; an id counts if the class has one. Rows that
    repeat each other, id and all, are one class of which one is kept. Other columns
    are not looked at. No rows give no rows.

    Large buckets are not expanded into pairs: members meet two pivots in each of 20
    bands, those of large buckets up to eight. Of buckets that then still hold different classes,
    small ones compare all members of different classes, and large ones go on with new
    pivots while these join enough classes: each round moves all rows of large buckets. What large buckets then still hold apart is
    grouped by its rarest shingles and compared whole. Pairs are ruled out by four bits of each
    signature component and by parities first and decided by the whole texts, each pair at most
    once. What pairs found before have joined is not compared again.
    """
    def near(left: str | Column, right: str | Column) -> Column:
        return likely(left, right) & possible(left, right, threshold)

    def apart(left: str | Column, right: str | Column) -> Column:
        return (field(left, "label") != field(right, "label")) & near(left, right)

    signed = written(
        docs.select("doc_id", text_of().alias("text"))
        .select("doc_id", F.md5("text").alias("digest"),
                F.monotonically_increasing_id().alias("uid"),
                banded("text").alias("b"))
        .select("doc_id", "digest", "uid", "b.*"), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "uid")).alias("first")
    groups = written(signed.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")), "groups")
    reps = groups.select(F.col("first.uid").alias("node"), F.col("first.doc_id").alias("rep_id"),
                         F.col("digest").alias("rep_digest"))
    nodes = reps.select("node").join(
        signed.where(F.col("buckets").isNotNull()).select(
            F.col("uid").alias("node"), "buckets", F.struct(*KNOWN).alias("known")), "node")
    bands = crowded(nodes)
    texts = candidate_texts(docs, bands, reps)
    labels = texts.select("node", F.col("node").alias("label"))
    left = bands
    pairs = checked = gathered(
        pivot_pairs(bands, first_orders(), "known", where=near).distinct(), "pairs")
    # What one pair of every node has joined needs no further pairs.
    chosen = written(one_of_each(pairs).coalesce(1 + pairs.count() // FEW), "chosen")
    labels, _ = merged(chosen, labels, texts, threshold)
    pairs = gathered(between(pairs.join(chosen, ["a", "b"], "left_anti"), labels).select("a", "b"), "open")
    turn = 0
    while True:
        labels, joins = merged(pairs, labels, texts, threshold)
        if turn and (not (rows := left.count()) or joins * WORTH <= rows):
            break
        left = unsettled(left, labels)
        turn += 1
        large = left.where(F.col("members") > SMALL_BUCKET)
        pairs = pivot_pairs(large, later_orders(turn), "label", "known", where=apart)
        if turn == 1:
            # Whether or not the first pivots found anything.
            pairs = pairs.union(all_pairs(left.where(F.col("members") <= SMALL_BUCKET), apart))
            left = large
        pairs = gathered(pairs.distinct().join(checked, ["a", "b"], "left_anti"), "pairs")
        checked = checked.unionByName(pairs)
    members = written(unsettled_rows(left, labels).select("node", "label", "known").dropDuplicates(["node"]), "members")
    if members.take(1):
        pairs = rest_pairs(members, texts, threshold).distinct().join(checked, ["a", "b"], "left_anti")
        labels, _ = merged(gathered(pairs, "pairs"), labels, texts, threshold)
    known = groups.select("digest", "first", "n", F.col("first.uid").alias("node")).join(
        labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    known = written(known, "known")
    heads = written(known.groupBy("label").agg(F.min("first").alias("head"),
                                               F.sum("n").alias("class_size")), "heads")
    classes = written(known.join(heads, "label").select(
        "digest", F.col("head.doc_id").alias("class_id"), "class_size",
        F.col("head.uid").alias("head_uid")), "classes")
    rows = signed.select("doc_id", "digest", "uid").join(classes, "digest").select(
        "doc_id", "digest", "class_id", "class_size",
        (F.col("uid") == F.col("head_uid")).alias("kept"))
    return rows, classes.select("digest", "class_id")


def joined(labels: DataFrame, found: DataFrame) -> DataFrame:
    """The stored labels of all nodes after further pairs, joining whole classes."""
    return contracted(labels, gathered(relabelled(found, labels).distinct(), "edges"))


def contracted(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """The stored labels of all nodes after joining classes by stored edges between them."""
    roots = components(edges).select(F.col("node").alias("label"), F.col("label").alias("root"))
    return gathered(labels.join(roots, "label", "left").select(
        "node", F.coalesce("root", "label").alias("label")), "classes")


def one_of_each(pairs: DataFrame) -> DataFrame:
    """One pair of every node, with the partner that comes first in an order of all nodes.

    Copies that have met the same pivots so choose the same one.
    """
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    first = ends.groupBy("a").agg(F.min(F.struct(F.xxhash64("b"), "b"))["b"].alias("b"))
    return first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def between(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs of different classes, with these."""
    of = [labels.select(F.col("node").alias(n), F.col("label").alias(f"of_{n}")) for n in "ab"]
    return pairs.join(of[0], "a").join(of[1], "b").where("of_a != of_b")


def merged(pairs: DataFrame, labels: DataFrame, texts: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """The stored labels after all of the stored pairs, and between how many pairs of classes these found links."""
    found = relabelled(verified(pairs, texts, threshold), labels).distinct()
    edges = written(found.coalesce(1 + pairs.count() // FEW), "edges")
    joins = edges.count()
    return (contracted(labels, edges) if joins else labels), joins


def unsettled(bands: DataFrame, labels: DataFrame) -> DataFrame:
    """As :func:`unsettled_rows`, stored."""
    return written(unsettled_rows(bands, labels), "unsettled")


def unsettled_rows(bands: DataFrame, labels: DataFrame) -> DataFrame:
    """Band rows, with labels, of buckets that hold different classes."""
    placed = bands.drop("label").join(labels, "node")
    split = placed.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("bucket")
    return placed.join(split, "bucket")


def keep_one(docs: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class, unchanged."""
    rows, _ = near_classes(docs, threshold=threshold)
    rows = written(rows, "classed")
    gone = rows.where("not kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
    repeated = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    marked = docs.withColumn("_md5", F.md5(text_of()))
    if repeated.take(1):
        # An id that repeats with its text is kept once.
        marked = marked.dropDuplicates(["doc_id", "_md5"])
        kept = rows.where("kept").select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"))
        gone = gone.join(kept, gone["_id"].eqNullSafe(kept["_id"])
                         & (gone["_digest"] == kept["_digest"]), "left_anti").distinct()
    return marked.join(gone, (marked["_md5"] == gone["_digest"])
                       & marked["doc_id"].eqNullSafe(gone["_id"]), "left_anti").drop("_md5")
