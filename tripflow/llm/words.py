"""Hashes of words and of runs of words, for many texts at once."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

from tripflow.llm.common import mixed

_BASE = np.uint64(0x9E3779B97F4A7C55)
_BYTE = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1 << 20))
# Words end at ASCII white space.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_hashes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts, in order, and each text's word count."""
    encoded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b" ".join([b"", *encoded]), dtype=np.uint8)
    sizes = np.array([len(e) for e in encoded], dtype=np.int64)
    black = ~_SPACE[data]
    begins = black.copy()
    begins[1:] &= ~black[:-1]
    starts = np.flatnonzero(begins)
    ends = np.cumsum(sizes + 1)
    counts = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    places = np.flatnonzero(black)
    word = np.cumsum(begins)[places] - 1
    within = places - starts[word]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(within.max()) + 1, _BASE, dtype=np.uint64))
        values = _BYTE[data[places]] * powers[within]
        first = np.flatnonzero(within == 0)
        return mixed(np.add.reduceat(values, first)), counts


def shingle_hashes(words: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words within each text, and how many each text has.

    A shorter text that has words makes one shingle of them all.
    """
    total = len(words)
    ends = np.cumsum(counts)
    each = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    with np.errstate(over="ignore"):
        run = np.zeros(total, dtype=np.uint64)
        for k in range(min(size, total)):
            factor = mixed(np.array([k + 77], dtype=np.uint64)) | np.uint64(1)
            run[: total - k] += words[k:] * factor
        # Runs that would reach into the next text are not taken below, except in
        # short texts, whose one run is summed anew.
        taken = np.zeros(total, dtype=bool)
        for_text = np.repeat(np.arange(len(counts)), counts)
        left = ends[for_text] - np.arange(total)
        taken[left >= size] = True
        for i in np.flatnonzero((counts > 0) & (counts < size)):
            first = ends[i] - counts[i]
            run[first] = sum(
                (words[first + k] * (mixed(np.array([k + 77], dtype=np.uint64))[0] | np.uint64(1))
                 for k in range(counts[i])), np.uint64(counts[i]))
            taken[first] = True
        return mixed(run[taken]), each


def counted_runs(hashes: np.ndarray, each: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes of each text, as (text number, hash, how often).

    Hashes keep their upper 44 bits here, so at most 2^20 texts can be handled at once.
    """
    text = np.repeat(np.arange(len(each), dtype=np.uint64), each)
    keyed = np.sort((text << np.uint64(44)) | (hashes >> np.uint64(20)))
    if not len(keyed):
        return np.zeros(0, np.int64), keyed, np.zeros(0, np.int64)
    new = np.concatenate([[True], keyed[1:] != keyed[:-1]])
    first = np.flatnonzero(new)
    often = np.diff(np.append(first, len(keyed)))
    only = keyed[first]
    return (only >> np.uint64(44)).astype(np.int64), only & np.uint64((1 << 44) - 1), often
