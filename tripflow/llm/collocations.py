"""Phrase collocations from count streams in prefix and suffix order.

Every word occurrence gives the run of up to three words that starts there and ends with
its piece at the latest. Tasks sort and count such runs locally, ranges of the sorted order
gather them, and each range adds them up in one pass; counts of shorter phrases are sums
over neighbours in that order. What a phrase's score needs is then found by merge joins of
the count streams: in the order of first words, of last words, and of longer phrases.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.llm.common import tasks, text_of, upper_part, written

LEAST = 10
TOP = 2000
SHARE = 50
SCALE = 1_000_000
UNKNOWN = "und"
# Characters that end pieces, and those that part words.
ENDS = b".,;:!?\n\x0b\x0c\r"
PARTS = b" \t"
# Characters of texts, and words, sorted and counted at a time; word numbers take 21 bits.
CHARS = 1 << 22
SLICE = (1 << 21) - 4
# Texts, and runs of each, from which the ranges are planned.
SAMPLE, EACH = 1024, 64
# Into how many parts a language's phrases are split while ranking.
BUCKETS = 64

_PLAIN = bytes(
    b"\n"[0] if c in ENDS else b" "[0] if c in PARTS else c + 32 if 65 <= c <= 90 else c
    for c in range(256))
_END = re.compile("[%s]" % re.escape(ENDS.decode()))
_RUNS = ("lang string, range int, words string, w1 array<int>, w2 array<int>, w3 array<int>, "
         "times array<int>")
_COUNTS = "lang string, size int, phrase string, times long"
Bound = tuple[str, bytes, bytes, bytes]


def parts_of(text: str) -> Iterator[str]:
    """The text, cut after ends of pieces if it is very long."""
    begin = 0
    while len(text) - begin > CHARS:
        end = _END.search(text, begin + CHARS)
        if end is None:
            break
        yield text[begin:end.end()]
        begin = end.end()
    yield text[begin:]


def tokens_of(texts: list[str]) -> list[bytes]:
    """Lower-cased words of texts, with a line feed wherever a piece ends."""
    data = "\n".join(texts).encode("utf-8").translate(_PLAIN)
    return [w for w in data.replace(b"\n", b" \n ").split(b" ") if w]


def counted_runs(tokens: list[bytes], places: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Of the runs at the first ``places`` tokens the distinct words, runs and their counts.

    Words are sorted and numbered from 1; 0 stands where the piece has ended. A run is one
    integer of three times 21 bits, so runs sort as their words do.
    """
    words = sorted(set(tokens) - {b"\n"})
    number = dict(zip(words, range(1, len(words) + 1))) | {b"\n": 0}
    ids = np.zeros(len(tokens) + 2, dtype=np.int64)
    ids[:-2] = np.fromiter(map(number.__getitem__, tokens), dtype=np.int64, count=len(tokens))
    first, second, third = ids[:places], ids[1:places + 1], ids[2:places + 2]
    runs = (first << 42) | (second << 21) | np.where(second > 0, third, 0)
    runs, times = np.unique(runs[first > 0], return_counts=True)
    return words, runs, times


def local_key(bound: Bound, words: list[bytes]) -> int:
    """Where a bound falls among runs numbered by these words: none below it is at or after it."""
    key = 0
    for k, word in enumerate(bound[1:]):
        place = bisect_left(words, word) if word else -1
        key = (key << 21) | (place + 1)
        if word and (place == len(words) or words[place] != word):
            return key << 21 * (2 - k)
    return key


def planned_bounds(rows: DataFrame, ranges: int) -> list[Bound]:
    """Bounds of ranges of about equal work, from a bounded sample that decides nothing else."""
    total = rows.count()
    if not total or ranges < 2:
        return []

    def sampled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for lang, text in zip(batch["lang"], batch["text"]):
                for part in parts_of(text):
                    tokens = [*tokens_of([part]), b"\n", b"\n"]
                    places = [i for i in range(len(tokens) - 2) if tokens[i] != b"\n"]
                    step = max(1, len(places) // EACH)
                    for i in places[step // 2::step]:
                        run = tokens[i:i + 3]
                        end = run.index(b"\n") if b"\n" in run else 3
                        found.append((lang, *run[:end], *[b""] * (3 - end), step))
            yield pd.DataFrame(found, columns=["lang", "w1", "w2", "w3", "weight"])

    sample = rows.sample(min(1.0, SAMPLE / total), seed=11).mapInPandas(
        sampled, "lang string, w1 binary, w2 binary, w3 binary, weight long").collect()
    runs = sorted((r["lang"], bytes(r["w1"]), bytes(r["w2"]), bytes(r["w3"]), r["weight"]) for r in sample)
    if not runs:
        return []
    below = np.cumsum([r[4] for r in runs])
    goals = below[-1] * np.arange(1, ranges) / ranges
    places = np.minimum(np.searchsorted(below, goals, "right"), len(runs) - 1)
    return sorted({runs[p][:4] for p in places})


def sorted_runs(rows: DataFrame, bounds: list[Bound]) -> DataFrame:
    """Locally counted runs in sorted order, cut at the bounds; about one row per task and range."""
    def cut(lang: str, texts: list[str]) -> Iterator[dict]:
        start = bisect_left(bounds, (lang,))
        end = bisect_left(bounds, (lang + "\0",))
        tokens = tokens_of(texts)
        for at in range(0, len(tokens), SLICE):
            own = tokens[at:at + SLICE + 2]
            words, runs, times = counted_runs(own, min(SLICE, len(tokens) - at))
            keys = [local_key(b, words) for b in bounds[start:end]]
            edges = [0, *np.searchsorted(runs, np.array(keys, dtype=np.int64)).tolist(), len(runs)]
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                if a < b:
                    mask = (1 << 21) - 1
                    split = [runs[a:b] >> 42, (runs[a:b] >> 21) & mask, runs[a:b] & mask]
                    used = np.unique(np.concatenate([[0], *split]))
                    narrow = [np.searchsorted(used, s).astype(np.int32) for s in split]
                    yield {"lang": lang, "range": start + i,
                           "words": b" ".join(words[u - 1] for u in used[1:].tolist()).decode("utf-8"),
                           "w1": narrow[0], "w2": narrow[1], "w3": narrow[2],
                           "times": times[a:b].astype(np.int32)}

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[str]] = {}
        chars: dict[str, int] = {}
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                for part in parts_of(text):
                    held.setdefault(lang, []).append(part)
                    chars[lang] = chars.get(lang, 0) + len(part)
                    # Languages are counted apart, the fullest first.
                    if sum(chars.values()) >= CHARS:
                        full = max(chars, key=chars.get)
                        del chars[full]
                        yield pd.DataFrame(list(cut(full, held.pop(full))))
        for lang, texts in held.items():
            yield pd.DataFrame(list(cut(lang, texts)))

    return rows.mapInPandas(lambda batches: (f for f in counted(batches) if len(f)), _RUNS)


def added_up(runs: list[tuple[pa.Array, list[np.ndarray]]], least: int) -> Iterator[tuple[int, list, np.ndarray]]:
    """Size, phrases and counts of a language's phrases in a range of sorted runs.

    Phrases below ``least`` are left out, except for shorter ones at the ends of the range, which
    neighbouring ranges may continue. Size 0 counts all words.
    """
    told = pa.chunked_array([w for w, _ in runs]).combine_chunks().dictionary_encode()
    words = told.dictionary
    # Arrow compares strings by their bytes.
    order = pc.sort_indices(words).to_numpy()
    words = words.take(pa.array(order))
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    number, at, columns = rank[told.indices.to_numpy()], 0, ([], [], [])
    for own, split in runs:
        to = np.concatenate([[0], number[at:at + len(own)]])
        at += len(own)
        for column, ids in zip(columns, split):
            column.append(to[ids])
    first, second, third = map(np.concatenate, columns)
    times = np.concatenate([split[3] for _, split in runs]).astype(np.int64)
    # Numbers take 31 bits, so two of them fit one integer.
    head = (first << 31) | second
    order = np.lexsort((third, head))
    head, third, times = head[order], third[order], times[order]
    yield 0, [None], np.array([times.sum()])
    for size in (3, 2, 1):
        key = head if size > 1 else head >> 31
        new = np.concatenate([[True], key[1:] != key[:-1]])
        if size == 3:
            new[1:] |= third[1:] != third[:-1]
        begin = np.flatnonzero(new)
        sums = np.add.reduceat(times, begin)
        keep = sums >= least
        if size == 3:
            keep &= third[begin] > 0
        else:
            keep[[0, -1]] = True
        if size == 2:
            keep &= (head[begin] & ((1 << 31) - 1)) > 0
        begin = begin[keep]
        ids = [head[begin] >> 31, head[begin] & ((1 << 31) - 1), third[begin]][:size]
        parts = [words.take(pa.array(i - 1)) for i in ids]
        yield size, pc.binary_join_element_wise(*parts, " ").to_pylist(), sums[keep]


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """Per ``lang`` and ``size`` the phrases of 1 to 3 words that come ``least`` times or more.

    Words are lower-cased (A-Z) runs of anything but space and tab within pieces, which end at
    ``.,;:!?`` and line ends; a phrase is joined by spaces and lies in one piece. Rows of size 0 have
    no phrase and count all words. Null texts are empty, a null language is ``und``. Exact: a
    run is known by its words.
    """
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"),
                       text_of(text).alias("text"))
    ranges = tasks(docs.sparkSession)
    bounds = planned_bounds(rows, ranges)

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[pa.Array, list[np.ndarray]]]] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                words = pc.split_pattern(batch.column("words").slice(row, 1), " ").flatten()
                split = [batch.column(c)[row].values.to_numpy() for c in ("w1", "w2", "w3", "times")]
                held.setdefault(batch.column("lang")[row].as_py(), []).append((words, split))
        for name in list(held):
            for size, phrases, times in added_up(held[name], least):
                if len(times):
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([name] * len(times), pa.string()),
                        "size": pa.array([size] * len(times), pa.int32()),
                        "phrase": pa.array(phrases, pa.string()),
                        "times": pa.array(times, pa.int64())})
            del held[name]

    streams = sorted_runs(rows, bounds).repartitionById(len(bounds) + 1, F.col("range"))
    return (
        streams.mapInArrow(gathered, _COUNTS)
        .groupBy("lang", "size", "phrase").agg(F.sum("times").alias("times"))
        .where((F.col("times") >= least) | (F.col("size") == 0))
    )


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST,
                 top: int = TOP, share: int = SHARE) -> DataFrame:
    """Each language's best phrases of 2 to 3 words, see :func:`phrase_counts`.

    Columns: ``lang``, ``rank`` from 1, ``phrase``, its count ``a``, ``l`` and ``r``, the counts of its
    parts before and after the cut that scores lowest (ties: the earliest), ``n``, all words of the
    language, and ``score``, 1000000 a a / (l r) rounded down, exactly. Phrases inside a longer
    one that comes at least ``share`` percent as often are left out. The order is by score and
    count descending, then by the phrase's bytes. Languages without such phrases, and empty
    tables, give no rows; other columns of ``docs`` are not looked at.
    """
    counts = written(phrase_counts(docs, text, lang, least), "phrases")
    words = F.split("phrase", " ")
    phrases = counts.where("size > 1").select("lang", "size", "phrase", F.col("times").alias("a"),
                                             words.alias("words"))

    def joined(begin, length):
        return F.array_join(F.slice("words", begin, length), " ")

    # Counts in the order of first parts, then of last parts, meet the phrases in lockstep.
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"first": joined(F.lit(1), F.col("k")),
                             "last": joined(F.col("k") + 1, F.col("size") - F.col("k"))})
    heads = counts.where("size > 0").select("lang", F.col("phrase").alias("first"), F.col("times").alias("l"))
    tails = counts.where("size > 0").select("lang", F.col("phrase").alias("last"), F.col("times").alias("r"))
    # Up to 10^15 occurrences the products fit 38 digits.
    score = F.expr(
        f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) "
        "div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    scored = (
        cuts.join(heads.hint("merge"), ["lang", "first"]).join(tails.hint("merge"), ["lang", "last"])
        .groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    # What stands right of a phrase or left of it, by its longer phrases.
    inner = F.array(*[F.struct(joined(F.lit(at), F.lit(2)).alias("phrase")) for at in (1, 2)])
    longest = (
        phrases.where("size = 3").select("lang", F.col("a").alias("longer"), F.inline(inner))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    left = scored.join(longest.hint("merge"), ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < share * F.col("a"))).drop("longer")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # Ranked within parts first, so that no task gets a whole language.
    bucket = upper_part(F.xxhash64("phrase"), BUCKETS)
    some = left.withColumn("_bucket", bucket).withColumn(
        "_row", F.row_number().over(Window.partitionBy("lang", "_bucket").orderBy(*best))
    ).where(F.col("_row") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long"))
    totals = counts.where("size = 0").select("lang", F.col("times").alias("n"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
