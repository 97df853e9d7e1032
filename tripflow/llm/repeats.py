"""Substring dedup by seed and extend: passages whose words stand elsewhere too.

Seeds are winnowed anchors: of every run of ``window`` words the least hash of its runs
of ``SEED`` words. Equal windows choose the same anchor at the same place, so a
repeat of ``window`` words always meets in an anchor. Seeds met more than once are
extended both ways, first as far as all windows of the anchor reach, then, where
contexts differ, by every split of the window's words to the left and right.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import discard, mixed, text_of, text_runs, without, written
from tripflow.llm.words import word_hashes

WINDOW = 35
SEED = 8
OUTPUTS = ("n_words", "n_removed", "kept_sha256")
# Texts are known by 95 bits of hashes.
KEY = ("_t1", "_t2")
# An anchor and all the words its windows reach, by 128 bits.
REACH = ("_seed", "_reach", "_ends")
_FIRST = np.uint64(0xD1B54A32D192ED03)
_SECOND = np.uint64(0x8CB92BA72F3D8DD7)
# Places of an anchor: the window's start is this many words to its left, at most.
_MOST_LEFT = 1 << 15


class Rolling:
    """Hashes of any run of words by differences of polynomial prefix sums."""

    def __init__(self, words: np.ndarray, base: np.uint64) -> None:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        with np.errstate(over="ignore"):
            powers = np.ones(len(words), dtype=np.uint64)
            powers[1:] = base
            powers = np.cumprod(powers)
            self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
            np.cumsum(words * powers, out=self.sums[1:])
            self.back = np.ones(len(words) + 1, dtype=np.uint64)
            self.back[1:] = inverse
            self.back = np.cumprod(self.back)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


def least_places(values: np.ndarray, width: int) -> np.ndarray:
    """Where the least of each ``width`` consecutive values is; the leftmost of equal ones."""
    places = np.arange(len(values))
    done = 1
    while done < width:
        step = min(done, width - done)
        left, right = places[: len(places) - step], places[step:]
        places = np.where(values[right] < values[left], right, left)
        done += step
    return places


def anchors_of(words: np.ndarray, counts: np.ndarray, window: int, seed: int) -> pd.DataFrame:
    """Anchors of texts given as word hashes: text number, place, hash, reach and its hash.

    ``left`` and ``right`` are the most and the fewest words by which a window of the
    anchor starts before it.
    """
    ends = np.cumsum(counts)
    if len(words) < window:
        starts = places = np.zeros(0, dtype=np.int64)
    else:
        first = Rolling(words, _FIRST)
        at = np.arange(len(words) - seed + 1)
        seeds = first.runs(at, at + seed)
        text_end = np.repeat(ends, counts)
        starts = np.arange(len(words) - window + 1)
        places = least_places(seeds, window - seed + 1)
        inside = starts + window <= text_end[starts]
        starts, places = starts[inside], places[inside]
    if not len(starts):
        empty = np.zeros(0, dtype=np.int64)
        return pd.DataFrame({c: empty for c in ("text", "place", "seed", "reach", "left", "right")})
    # Windows of one anchor are neighbours.
    new = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    final = np.append(new[1:], len(starts)) - 1
    anchor, low, high = places[new], starts[new], starts[final]
    second = Rolling(words, _SECOND)
    text = np.searchsorted(ends, anchor, "right")
    return pd.DataFrame({
        "text": text, "place": anchor - (ends - counts)[text],
        "seed": seeds[anchor].view(np.int64),
        "reach": second.runs(low, high + window).view(np.int64),
        "left": anchor - low, "right": anchor - high,
    })


def keyed_texts(docs: DataFrame, text: str) -> DataFrame:
    """Rows with their text's key, which rows of equal text share."""
    whole = text_of(text)
    check = F.crc32(whole.cast("binary")).bitwiseAND(F.lit((1 << 31) - 1))
    return docs.withColumns({"_t1": F.xxhash64(whole), "_t2": check.cast("int")})


def whole_texts(docs: DataFrame, text: str) -> DataFrame:
    """Keys and texts alone, alike wherever they are shuffled by key, so that this is done once."""
    return keyed_texts(docs.select(text_of(text).alias("text")), "text")


def anchors(docs: DataFrame, text: str, window: int, seed: int) -> DataFrame:
    """Anchors of all rows' texts: the text's key, the place, and what is reached."""
    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            keys = [batch[k].to_numpy() for k in KEY]
            for begin, end in text_runs(texts):
                rows = anchors_of(*word_hashes(texts[begin:end]), window, seed)
                number = rows["text"].to_numpy() + begin
                yield pd.DataFrame({
                    "_t1": keys[0][number], "_t2": keys[1][number], "_place": rows["place"],
                    "_seed": rows["seed"], "_reach": rows["reach"],
                    "_ends": rows["left"] * _MOST_LEFT + rows["right"]})

    return whole_texts(docs, text).mapInPandas(
        found, "_t1 long, _t2 int, _place int, _seed long, _reach long, _ends int")


def dealt_anew(names: list[str]) -> list[Column]:
    """Columns of the same numbers that Spark takes for new ones.

    A join by them shuffles both its sides by itself, which lets adaptive execution split hot
    keys; sums that lie as the join needs them would keep it from that.
    """
    return [F.coalesce(F.col(n), F.lit(0)).bitwiseOR(F.lit(0)).alias(n) for n in names]


def repeated_windows(docs: DataFrame, asked: DataFrame, text: str, window: int) -> DataFrame:
    """Of asked anchors, by how many words to the left their repeated windows start.

    ``asked`` has a text's key, a place, and what the anchor there reaches, one row per
    reach. The windows are hashed from the words themselves, by 128 bits; one that comes
    from two of the asked anchors, whose reaches differ, is repeated.
    """
    by_text = asked.groupBy(*KEY).agg(F.collect_set(F.struct("_place", *REACH)).alias("_asked"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Copies of a text would answer alike.
            batch = batch.drop_duplicates(list(KEY))
            texts = batch["text"].tolist()
            for begin, end in text_runs(texts):
                words, counts = word_hashes(texts[begin:end])
                second = Rolling(words, _SECOND)
                starts = np.cumsum(counts) - counts
                places, rows = [], []
                for number, own in enumerate(batch["_asked"].iloc[begin:end]):
                    for r in own:
                        places.append(starts[number] + r["_place"])
                        rows.append((r["_seed"], r["_reach"], r["_ends"]))
                reach = np.array(rows, dtype=np.int64).reshape(-1, 3)
                most, least = reach[:, 2] // _MOST_LEFT, reach[:, 2] % _MOST_LEFT
                each = most - least + 1
                number = np.repeat(np.arange(len(each)), each)
                left = most[number] - (np.arange(len(number)) - np.repeat(np.cumsum(each) - each, each))
                at = np.array(places, dtype=np.int64)[number] - left
                yield pd.DataFrame({
                    "_seed": reach[number, 0], "_reach": reach[number, 1], "_ends": reach[number, 2],
                    "_left": left, "_words": second.runs(at, at + window).view(np.int64)})

    answers = (
        whole_texts(docs, text).join(by_text, list(KEY))
        .mapInPandas(hashed, "_seed long, _reach long, _ends int, _left int, _words long")
    )
    # Equal windows have their anchor at the same place, which makes up for half of the bits.
    same = ["_seed", "_left", "_words"]
    reach = F.xxhash64("_reach", "_ends")
    met = answers.groupBy(*same).agg(F.min(reach).alias("_low"), F.max(reach).alias("_high")).where(
        "_low != _high").select(*dealt_anew(same))
    one = F.col("_left") * _MOST_LEFT + F.col("_left")
    return answers.join(met, same, "left_semi").groupBy(*REACH).agg(
        F.collect_set(one).alias("_spans"))


def covered(docs: DataFrame, text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Where repeated windows start, per text that has any.

    Columns: the text's key and ``_runs``, a sorted array of (first, last) window starts,
    counted in words.
    """
    found = written(anchors(docs, text, window, seed), "anchors")
    # Counts are stored before they are joined, so that adaptive execution can split a hot seed.
    often = written(
        found.groupBy("_seed").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_seed"), "often")
    met = written(found.join(often, "_seed", "left_semi"), "seeds")
    discard(found)
    discard(often)
    # What reaches equally far around equal words, copies of whole texts included, needs one answer.
    reaches = written(
        met.groupBy(*REACH).agg(F.count(F.lit(1)).alias("_n"),
                                F.min(F.struct(*KEY, "_place")).alias("_one")), "reaches")
    several = written(
        reaches.groupBy("_seed").agg(F.count(F.lit(1)).alias("_kinds")).where("_kinds > 1").select("_seed"),
        "several")
    asked = reaches.join(several, "_seed", "left_semi").select("_one.*", *REACH)
    wholly = reaches.where("_n > 1").select(*REACH, F.array("_ends").alias("_spans"))
    partly = repeated_windows(docs, asked, text, window)
    either = wholly.unionByName(partly.join(wholly.select(*REACH), list(REACH), "left_anti"))
    run = F.struct((F.col("_place") - F.expr(f"_span div {_MOST_LEFT}")).alias("first"),
                   (F.col("_place") - F.col("_span") % _MOST_LEFT).alias("last"))
    return (
        met.join(either, list(REACH))
        .select(*KEY, "_place", F.explode("_spans").alias("_span")).distinct()
        .groupBy(*KEY).agg(F.array_sort(F.collect_list(run)).alias("_runs"))
    )


def merged_runs(runs: Iterable[tuple[int, int]], window: int) -> Iterator[tuple[int, int]]:
    """Sorted runs of window starts as runs of words, from the first to one past the last."""
    begin = end = None
    for first, last in runs:
        if end is None or first > end:
            if end is not None:
                yield begin, end
            begin, end = first, last + window
        end = max(end, last + window)
    if end is not None:
        yield begin, end


def repeats_of_texts(docs: DataFrame, text: str, window: int, seed: int) -> DataFrame:
    """Per distinct text its key, ``n_words``, ``n_removed``, ``kept_sha256`` and ``repeats``."""
    if not 1 <= seed <= window < _MOST_LEFT:
        raise ValueError("a seed has one to as many words as a window")

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch.drop_duplicates(list(KEY))
            rows = []
            for value, own in zip(batch["text"], batch["_runs"]):
                # Bytes split at ASCII white space only.
                words = value.encode("utf-8").split()
                total, end, kept = len(words), 0, []
                own = [] if own is None else [(r["first"], r["last"]) for r in own]
                runs = list(merged_runs(own, window))
                for begin, after in runs:
                    kept += words[end:begin]
                    end = after
                kept += words[end:]
                rows.append((total, total - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(),
                             [{"from": a, "to": b} for a, b in runs]))
            found = pd.DataFrame(rows, columns=[*OUTPUTS, "repeats"], index=batch.index)
            yield pd.concat([batch[list(KEY)], found], axis=1)

    runs = covered(docs, text, window, seed)
    return whole_texts(docs, text).join(runs, list(KEY), "left").mapInPandas(
        judged, "_t1 long, _t2 int, n_words long, n_removed long, kept_sha256 string, "
        "repeats array<struct<from:long,to:long>>").dropDuplicates(list(KEY))


def without_repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Add ``n_words``, ``n_removed``, ``kept_sha256`` and ``repeats`` of each text.

    ``repeats`` are runs of words (from, to) that stand elsewhere too, each the union of
    overlapping or adjoining windows of ``window`` words whose words, in order, also start at
    another place of the same or another row. The hash is of the words in none, joined
    by single spaces, in lowercase hex.

    Words are runs of anything but ASCII white space. Null, empty and short texts have no
    repeats; rows that come more than once repeat each other. Input columns named like the new
    ones are replaced. Work and memory go by words, never by pairs: seeds, reaches and
    windows are counted, and copies of a text or passage collapse while counting.
    """
    names = [*OUTPUTS, "repeats"]
    kept = without(docs, [*names, *KEY])
    found = repeats_of_texts(kept, text, window, seed)
    return keyed_texts(kept, text).join(found, list(KEY)).select(*kept.columns, *names)
