"""Packing documents into sequences: best-fit decreasing over a segment tree.

All pieces of one length are alike to the packer, so it works on how many pieces of
each length there are: at most ``window`` numbers, whatever the data. It goes from the
longest length to the shortest and asks the tree for the tightest open sequences. Its
plan says where the n-th piece of a length goes; ranks of pieces are found on Spark.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import ranked, small_batches, text_of, written
from tripflow.llm.tokens import ID_BYTES, word_tokens

WINDOW = 2048
END = 1
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "text_hash long")


class CapacityTree:
    """Which remaining capacities open sequences have, as a segment tree of counts."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.count[at] += by
            at //= 2

    def tightest(self, need: int) -> int | None:
        """The smallest capacity of at least ``need`` that some sequence has."""
        at = self.leaves + need
        if self.count[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


@dataclass(frozen=True)
class Plan:
    """Where pieces go: runs of pieces of one length, in order of (length, first rank)."""

    length: np.ndarray
    first_rank: np.ndarray
    first_sequence: np.ndarray
    per_sequence: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the rank-th piece of a length."""
        # Ranks stay below 2^48 and lengths below 2^15.
        run = np.searchsorted((self.length << 48) + self.first_rank,
                              (length << 48) + rank, side="right") - 1
        beyond = rank - self.first_rank[run]
        per = self.per_sequence[run]
        return self.first_sequence[run] + beyond // per, self.offset[run] + beyond % per * length


def best_fit(counts: dict[int, int], window: int = WINDOW) -> Plan:
    """Best-fit decreasing for so many pieces of each length.

    Sequences of the same remaining capacity are kept as runs of neighbouring numbers.
    The tightest fit of a piece is a sequence in which equal pieces go on fitting until
    it is full, so a run is filled at once and at most splits in three: the plan's size
    depends on the window, not on the number of pieces.
    """
    tree = CapacityTree(window)
    runs: dict[int, list[tuple[int, int]]] = {}
    out: list[tuple[int, int, int, int, int]] = []
    opened = 0

    def put(capacity: int, first: int, number: int) -> None:
        if number:
            runs.setdefault(capacity, []).append((first, number))
            tree.add(capacity, 1)

    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                capacity = window
                fits = window // length
                first, number = opened, -(-left // fits)
                opened += number
            else:
                first, number = runs[capacity].pop()
                tree.add(capacity, -1)
                fits = capacity // length
            full = min(number, left // fits)
            for filled, each in ((full, fits), (1 if full < number else 0, left - full * fits)):
                each = min(each, fits)
                if filled and each > 0:
                    out.append((length, rank, first, each, window - capacity))
                    put(capacity - each * length, first, filled)
                    rank += filled * each
                    left -= filled * each
                    first += filled
                    number -= filled
                if not left:
                    break
            put(capacity, first, number)
    out.sort()
    table = np.array(out, dtype=np.int64).reshape(-1, 5)
    return Plan(*table.T)


def _pieces(path: str, window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = word_tokens(path)
        end = END.to_bytes(ID_BYTES, "little")
        step = window * ID_BYTES
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                whole = text.as_buffer().to_pybytes()
                ids = tokens.ids(whole) + end
                mark = zlib.crc32(whole)
                for at in range(0, len(ids), step):
                    part = ids[at:at + step]
                    rows.append((doc, at // ID_BYTES, len(part) // ID_BYTES, zlib.crc32(part),
                                 len(ids) // ID_BYTES, mark))
            columns = list(zip(*rows)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in columns],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "text_hash"])

    return cut


def pack(docs: DataFrame, *, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents and their places in sequences of ``window`` tokens.

    Columns: ``doc_id``, ``start`` (tokens of the document before the piece),
    ``length``, ``ids_crc32`` of its ids, ``doc_tokens``, ``sequence_id`` and
    ``offset`` there. A document's tokens are its ids and one end token, so an empty
    or null text is one token. A document beyond the window is first cut into full
    windows; what is left of it is packed with the others. Rows that repeat each
    other are packed each. Other columns are not looked at. No rows give no rows.

    Counts by length, at most ``window``, are all that reaches the driver.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    pieces = written(texts.mapInArrow(_pieces(tokenizer, window), PIECES), "pieces")
    counts = {r["length"]: r["n"] for r in
              pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = docs.sparkSession.sparkContext.broadcast(best_fit(counts, window))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.value.place(length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    order = F.xxhash64("doc_id", "start", "text_hash")
    numbered = ranked(pieces.withColumn("_order", order), ["length"], "_order",
                      ["doc_id", "start", "ids_crc32"])
    return numbered.withColumn("_place", place("length", "rank")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "_place.sequence_id",
        "_place.offset")


def sequence_ids(docs: DataFrame, packed: DataFrame, *, tokenizer: str, window: int = WINDOW,
                 padding: int = 0) -> DataFrame:
    """``sequence_id`` and its ``ids``, padded to the window, for training.

    Documents are tokenized again and meet their pieces by ``doc_id``, which must be
    unique here. A sequence holds at most ``window`` tokens, so its pieces come
    together in one group safely.
    """
    tokens = F.udf(lambda text: word_tokens(tokenizer).ids(text or "") +
                   END.to_bytes(ID_BYTES, "little"), "binary")
    cut = F.expr(f"substring(_ids, int(start * {ID_BYTES} + 1), int(length * {ID_BYTES}))")
    own = docs.select("doc_id", tokens("text").alias("_ids"))
    parts = packed.join(own, "doc_id").select("sequence_id", "offset", cut.alias("part"))

    @F.pandas_udf("array<int>")
    def whole(column: pd.Series) -> pd.Series:
        def one(parts) -> np.ndarray:
            ids = np.frombuffer(b"".join(p["part"] for p in parts), dtype=np.int32)
            return np.pad(ids, (0, window - len(ids)), constant_values=padding)

        return column.map(one)

    together = parts.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "part"))).alias("parts"))
    return together.select("sequence_id", whole("parts").alias("ids"))
