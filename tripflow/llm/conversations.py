"""Conversation structure repair by weighted interval parsing.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. The repair grammar has
one nonterminal ``[p,q]`` for each pair of reading states: the rows of a span, edited, lead from
``p`` to ``q``. Its rules are in Chomsky normal form, ``[p,q] -> [p,r] [r,q]``, and one row derives
``[p,q]`` by being kept, given another role or deleted, after any insertions: the closure of
insertion is part of the row. A cell holds the cheapest derivation of a span as (cost,
audit), and spans are combined bottom-up by length. The states make the rules associative, so
that any split of a span gives the same cell: one split each is enough, spans double in
length, and work grows with the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tripflow.llm.common import written

# Costs of the edits, and what an unfinished row adds unless it is deleted.
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
# Reading states: nothing read, after system, after user, after assistant.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
# Rows parsed as one span; longer conversations are made of several.
CHUNK = 2048
OUTPUTS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
KINDS = ("ok", "blank", "duplicate", "truncated")

Cell = tuple[int, str]
Cells = dict[tuple[int, int], Cell]


def inserted() -> dict[tuple[int, int], int]:
    """How many insertions lead from state to state at least, where any do."""
    steps = {(p, p): 0 for p in STATES}
    ways = [(p, q) for (p, role), q in STEP.items() if role in ROLES]
    while True:
        more = {(p, r): n + 1 for (p, q), n in steps.items() for o, r in ways if o == q
                if n + 1 < steps.get((p, r), 99)}
        if not more:
            return steps
        steps |= more


INSERTED = inserted()


def better(cells: Cells, at: tuple[int, int], cell: Cell) -> None:
    if at not in cells or cell < cells[at]:
        cells[at] = cell


@lru_cache(maxsize=None)
def one_row(initial: str, kind: str) -> Cells:
    """Cells of a span of one row: insertions, then the row's own edit.

    Insertions after the last row belong to the end, so audits of a span all end with a
    row's letter, none starts with another, and the least of joined audits joins the least.
    """
    extra = UNFINISHED if kind == "truncated" else 0
    cells: Cells = {}
    for (p, q), n in INSERTED.items():
        before, cost = "I" * n, INSERT * n
        better(cells, (p, q), (cost + DELETE, before + "D"))
        if kind in ("blank", "duplicate"):
            continue
        if (q, initial) in STEP:
            better(cells, (p, STEP[q, initial]), (cost + extra, before + "K"))
        for role in ROLES:
            if (q, role) in STEP:
                better(cells, (p, STEP[q, role]), (cost + extra + REROLE, before + "R"))
    return cells


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of two neighbouring spans together."""
    cells: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            if (r, q) in right:
                more, rest = right[r, q]
                best = cells.get((p, q))
                if best is None or cost + more <= best[0]:
                    better(cells, (p, q), (cost + more, audit + rest))
    return cells


def parsed(rows: list[Cells]) -> Cells:
    """Cells of a whole run of rows, from spans of one, two, four and so on."""
    while len(rows) > 1:
        pairs = [joined(a, b) for a, b in zip(rows[::2], rows[1::2])]
        rows = pairs + rows[len(pairs) * 2:]
    return rows[0] if rows else {(p, p): (0, "") for p in STATES}


def ended(cells: Cells) -> Cell:
    """The cheapest whole derivation, with insertions at the end."""
    best = None
    for q in STATES:
        for end in ACCEPTED:
            if (0, q) in cells and (q, end) in INSERTED:
                cost, audit = cells[0, q]
                n = INSERTED[q, end]
                cell = (cost + INSERT * n, audit + "I" * n)
                best = cell if best is None or cell < best else best
    return best


def code_of(role: Column, kind: Column) -> Column:
    """One letter for a row's role initial (s, u, a or another) and its fault."""
    initial = F.instr(F.lit("sua"), F.substring(role, 1, 1)) % 4
    initial = F.when(role == "", 0).otherwise(initial)
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), kind) - 1
    return F.char(F.lit(ord("A")) + place * 4 + initial)


@lru_cache(maxsize=None)
def row_of(code: str) -> Cells:
    number = ord(code) - ord("A")
    return one_row(" sua"[number % 4], KINDS[number // 4])


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` with nulls as one space, damaged by a hash.

    crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 removes ``.!?``
    from it, 3 repeats the row, 4 makes it a user's. Ids and turns stay null where they are.
    """
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    key = F.concat(plain("conv_id"), F.lit(":"), plain("turn"))
    rows = conversations.select(
        "conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("_hash")).where("_hash != 0")
    h = F.col("_hash")
    text = F.when(h == 1, "").when(h == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(h == 4, "user").otherwise(F.col("role"))
    return rows.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(h == 3, 2).otherwise(1))).alias("_copy")).drop("_copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """Add ``kind``, the row's first fault: blank, duplicate, truncated, or ok.

    Of rows of equal role and text in a conversation the one of the least turn, nulls first, is
    no duplicate.
    """
    # Fixed value: ASCII white space.
    trimmed = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    return rows.withColumn("_again", F.row_number().over(earlier) > 1).withColumn(
        "kind", F.when(trimmed == "", "blank").when(F.col("_again"), "duplicate")
        .when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated").otherwise("ok")).drop("_again")


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``chunk`` and ``pos``: the order of a conversation's rows by turn, nulls first.

    Rows of one turn follow role, text and fault. Rows are sorted across tasks, so a long
    conversation lies in several; a chunk has at most ``CHUNK`` rows of one conversation.
    """
    # A row that is no duplicate stands before its copies.
    first = F.when(F.col("kind") == "duplicate", 1).otherwise(0)
    ordered = rows.withColumn("_late", first).repartitionByRange(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"))
    ordered = ordered.sortWithinPartitions(
        F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "_late").drop("_late")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, pos, last = TaskContext.get().partitionId() << 32, -1, None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("conv_id")
            before = pa.concat_arrays([ids.slice(0, 1) if last is None else last, ids.slice(0, len(ids) - 1)])
            other = pc.or_(pc.fill_null(pc.not_equal(ids, before), False),
                           pc.xor(pc.is_null(ids), pc.is_null(before))).to_numpy(zero_copy_only=False)
            index = np.arange(len(ids))
            start = np.maximum.accumulate(np.where(other, index, -1))
            within = np.where(start < 0, index + pos + 1, index - start)
            new = (within % CHUNK == 0)
            chunks = chunk + np.cumsum(new)
            chunk, pos, last = int(chunks[-1]), int(within[-1]), ids.slice(len(ids) - 1, 1)
            yield batch.append_column("chunk", pa.array(chunks, pa.int64())).append_column(
                "pos", pa.array(within, pa.int64()))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return ordered.mapInArrow(count, f"{kinds}, chunk long, pos long")


def illegal_pairs(codes: str) -> int:
    initials = [" sua"[(ord(c) - ord("A")) % 4] for c in codes]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


def parsed_chunk(codes: str) -> Column:
    """Cells, illegal pairs and both end letters of chunks given by their rows' letters."""
    @F.pandas_udf("cells array<struct<p:int,q:int,cost:long,audit:string>>, illegal long, "
                  "first string, last string")
    def parse(column: pd.Series) -> pd.DataFrame:
        rows = []
        for own in column:
            cells = parsed([row_of(c) for c in own])
            rows.append(([{"p": p, "q": q, "cost": cost, "audit": audit}
                          for (p, q), (cost, audit) in cells.items()], illegal_pairs(own), own[0], own[-1]))
        return pd.DataFrame(rows, columns=["cells", "illegal", "first", "last"])

    return parse(codes)


def parsed_whole(chunks: Column) -> Column:
    """Illegal pairs, cost and audit of conversations given by their chunks' cells."""
    @F.pandas_udf("illegal long, cost long, audit string")
    def parse(column: pd.Series) -> pd.DataFrame:
        rows = []
        for own in column:
            cells = [{(c["p"], c["q"]): (c["cost"], c["audit"]) for c in chunk["cells"]} for chunk in own]
            between = sum(illegal_pairs(a["last"] + b["first"]) for a, b in zip(own, own[1:]))
            rows.append((sum(c["illegal"] for c in own) + between, *ended(parsed(cells))))
        return pd.DataFrame(rows, columns=["illegal", "cost", "audit"])

    return parse(chunks)


def cheapest_edits(rows: DataFrame) -> DataFrame:
    """Per conversation of numbered rows ``illegal`` pairs, and the least ``cost`` and ``audit``.

    Chunks are parsed apart; a conversation's chunks, sixteen cells each, meet in one row.
    """
    codes = F.transform(F.array_sort(F.collect_list(F.struct("pos", "code"))), lambda r: r["code"])
    chunks = (
        rows.select("conv_id", "chunk", "pos", code_of(F.col("role"), F.col("kind")).alias("code"))
        .groupBy("conv_id", "chunk").agg(F.array_join(codes, "").alias("codes"))
        .select("conv_id", "chunk", parsed_chunk("codes").alias("_parsed"))
        .select("conv_id", F.struct("chunk", "_parsed.*").alias("_chunk"))
    )
    return (
        chunks.groupBy("conv_id").agg(F.collect_list("_chunk").alias("_chunks"))
        .select("conv_id", parsed_whole(
            F.array_sort("_chunks", lambda a, b: (a["chunk"] > b["chunk"]).cast("int")
                         - (a["chunk"] < b["chunk"]).cast("int"))).alias("_best"))
        .select("conv_id", "_best.*")
    )


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[bytes]:
    """The repaired rows as ``role:text``, by the letters of an audit."""
    state = 0
    letters = iter(audit)
    for role, text in rows:
        for letter in letters:
            if letter == "D":
                break
            initial = role[:1] if letter == "K" else "a" if state == 2 else "u"
            state = STEP[state, initial]
            name = role if letter == "K" else ROLES[initial]
            yield f"{name}:{'' if letter == 'I' else text}".encode("utf-8")
            if letter != "I":
                break
    for _ in letters:
        initial = "a" if state == 2 else "u"
        state = STEP[state, initial]
        yield f"{ROLES[initial]}:".encode("utf-8")


def with_hashes(heads: DataFrame, rows: DataFrame) -> DataFrame:
    """Add ``repaired_sha256`` to one row per conversation, from its numbered rows.

    The hash reads a conversation's rows one after the other, as it must, and holds none.
    """
    names = [c for c in OUTPUTS if c != "repaired_sha256"]
    both = heads.withColumns({"chunk": F.lit(-1).cast("long"), "pos": F.lit(-1).cast("long")}).unionByName(
        rows.select("conv_id", "chunk", "pos", "role", "text"), allowMissingColumns=True)
    ordered = both.repartition("conv_id").sortWithinPartitions(
        F.asc_nulls_first("conv_id"), "chunk", "pos")
    kind = heads.schema["conv_id"].dataType.simpleString()
    numbers = ", ".join(f"{c} long" for c in names[1:-1])

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            yield from batch.to_pylist()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source = rows_of(batches)
        head = next(source, None)
        done: list[dict] = []
        while head is not None:
            after: list[dict] = []

            def own() -> Iterator[tuple[str, str]]:
                for row in source:
                    if row["chunk"] < 0:
                        after.append(row)
                        return
                    yield row["role"], row["text"]

            digest, joint = hashlib.sha256(), b""
            for line in edited(head["audit"], own()):
                digest.update(joint + line)
                joint = b"\n"
            done.append({c: head[c] for c in names} | {"repaired_sha256": digest.hexdigest()})
            head = after[0] if after else None
            if len(done) == 1000 or head is None:
                yield pa.RecordBatch.from_pylist(done, schema=layout)
                done = []

    result = f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string"
    layout = to_arrow_schema(heads.sparkSession.createDataFrame([], result).schema)
    return ordered.mapInArrow(hashed, result)


def repaired(conversations: DataFrame) -> DataFrame:
    """Damage conversations, find their faults, and repair them by the cheapest edits.

    One row per ``conv_id`` of the input, a null id among them: ``gaps`` in the turns, rows by first
    fault, ``illegal`` neighbours, and the ``cost``, ``audit`` and hash of the repair. Edits are
    Keep, Rerole, Delete and Insert; the audit is their letters in order, the least in ASCII order
    of the cheapest. Conversations that lost all rows, and those repaired to none, have an empty
    text's hash. Rows of one turn are ordered by role and text. Other columns are not looked at,
    and no rows give no rows.

    Rows are parsed in chunks of ``CHUNK``, so that a conversation with a third of all rows spreads
    over tasks; only its letters and its hash, which has to read the rows in order, meet in one.
    """
    rows = written(with_faults(damaged(conversations)), "damaged")
    ordered = written(numbered(rows), "numbered")
    turns = F.col("turn").cast("decimal(20,0)")
    gaps = F.max(turns) - F.min(turns) + 1 - F.count_distinct("turn")
    counts = rows.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in KINDS[1:]])
    # Null ids are a group like others, which joins would not make them.
    known = conversations.select("conv_id").distinct().unionByName(
        counts, allowMissingColumns=True).unionByName(cheapest_edits(ordered), allowMissingColumns=True)
    numbers = ("gaps", *KINDS[1:], "illegal", "cost")
    heads = known.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"))
    return with_hashes(heads, ordered).select(*OUTPUTS)
