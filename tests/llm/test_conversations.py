from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from heapq import heappop, heappush

import pytest

from tests.conftest import SMALL
from tripflow.llm import conversations as module
from tripflow.llm import queries
from tripflow.llm.conversations import edited, ended, one_row, parsed, repaired

INK = re.compile(r"[^\x20\x09-\x0D]")


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str, list[str]]:
    """Dijkstra over (rows read, roles so far as a state), least audit first among the cheapest."""
    nexts, go = {0: "su", 1: "u", 2: "a", 3: "u"}, {"s": 1, "u": 2, "a": 3}
    names = {"u": "user", "a": "assistant"}
    queue, done = [(0, "", 0, 0, ())], set()
    while True:
        cost, audit, read, state, out = heappop(queue)
        if read > len(rows):
            return cost, audit, list(out)
        if (read, state) in done:
            continue
        done.add((read, state))
        others = [c for c in nexts[state] if c != "s"]
        for c in others:
            heappush(queue, (cost + 5, audit + "I", read, go[c], (*out, f"{names[c]}:")))
        if read == len(rows):
            if state in (0, 3):
                heappush(queue, (cost, audit, read + 1, state, out))
            continue
        role, text, kind = rows[read]
        extra = 5 * (kind == "truncated")
        heappush(queue, (cost + 2, audit + "D", read + 1, state, out))
        if kind not in ("blank", "duplicate"):
            if role and role[0] in nexts[state]:
                heappush(queue, (cost + extra, audit + "K", read + 1, go[role[0]], (*out, f"{role}:{text}")))
            for c in others:
                line = f"{names[c]}:{text}"
                heappush(queue, (cost + extra + 1, audit + "R", read + 1, go[c], (*out, line)))


def brute(table: list[tuple]) -> list[tuple]:
    groups = defaultdict(list)
    for conv, turn, role, text in table:
        own = groups[conv]
        show = lambda v: " " if v is None else str(v)
        h = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        own += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    results = []
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, rows = set(), []
        for _, role, text in own:
            ink = INK.findall(text)
            kind = ("blank" if not ink else "duplicate" if (role, text) in seen
                    else "truncated" if ink[-1] not in ".!?" else "ok")
            seen.add((role, text))
            rows.append((role, text, kind))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        kinds = [k for _, _, k in rows]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, lines = cheapest(rows)
        results.append((conv, gaps, kinds.count("blank"), kinds.count("duplicate"), kinds.count("truncated"),
                        illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(results, key=repr)


def rows_of(df) -> list[tuple]:
    assert tuple(df.columns) == module.OUTPUTS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_query_against_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    found = rows_of(queries.QUERIES["op12_weighted_cyk_repair"](spark, SMALL))
    assert found == brute(table)
    assert len(found) == len({r[0] for r in table})


def test_cells_against_search():
    """All short runs of rows, and random longer ones."""
    letters = [(r, k) for r in ("system", "user", "assistant", "", "xenon") for k in module.KINDS]
    runs = [list(p) for n in range(3) for p in itertools.product(letters, repeat=n)]
    rng = random.Random(3)
    runs += [[rng.choice(letters) for _ in range(rng.randrange(3, 14))] for _ in range(300)]
    for run in runs:
        rows = [(role, f"t{i}", kind) for i, (role, kind) in enumerate(run)]
        cost, audit = ended(parsed([one_row(role[:1] or " ", kind) for role, kind in run]))
        wanted = cheapest(rows)
        assert (cost, audit) == wanted[:2]
        lines = [line.decode() for line in edited(audit, ((r, t) for r, t, _ in rows))]
        assert lines == wanted[2]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines))


@pytest.mark.parametrize("chunk", [3, 2048])
def test_awkward_rows(spark, monkeypatch, chunk):
    """Nulls in every column, ties, repeated rows, long conversations cut into chunks."""
    monkeypatch.setattr(module, "CHUNK", chunk)
    rng = random.Random(chunk)
    roles = ["system", "user", "assistant", "", "tool", "unsaid", "User", None]
    texts = ["Well.", "Yes!", "and then", "", " \t\n", None, "No?  \n", "été。", "3.", "x ", "a." * 50_000]
    table = [(None, None, None, None), (1, None, "user", "Hi."), (1, None, "user", "Hi."),
             (2, 5, "user", "Hi."), (2, 5, "user", "Hi."), (2, -(1 << 40), "assistant", "Ok."),
             ((1 << 62) + 1, 1 << 50, "user", "Hi."), ((1 << 62) + 2, 0, "assistant", "Oh.")]
    for _ in range(250):
        table.append((rng.choice([None, 3, 4, 4, 5, *range(6, 40)]), rng.choice([None, *range(12)]),
                      rng.choice(roles[:3] if rng.random() < 0.8 else roles), rng.choice(texts)))
    df = spark.createDataFrame([(*r, "x", 7) for r in table],
                               "conv_id long, turn long, role string, text string, chunk string, cost int")
    assert rows_of(repaired(df)) == brute(table)
    assert rows_of(repaired(df.limit(0))) == []


def test_a_third_in_one_conversation(spark):
    rows = [(0 if i % 3 == 0 else i, i, ("user", "assistant")[i // 3 % 2], f"Text {i}.") for i in range(9000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in repaired(df).collect()}
    assert len(found) == 6001
    letters = found[0]["audit"].replace("I", "")
    kept = sum(1 + (h == 3) for i in range(0, 9000, 3)
               if (h := zlib.crc32(f"0:{i}".encode()) % 20))
    assert len(letters) == kept
    assert re.fullmatch("[KRDI]+", found[0]["audit"])
