from __future__ import annotations

import bisect
import random
import zlib

import numpy as np
import pytest

from tripflow.llm import packing
from tripflow.llm.tokens import WordTokens

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")


def plain_best_fit(lengths: list[int], window: int) -> list[int]:
    """Remaining capacities after placing each piece alone, longest first."""
    open_: list[int] = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(open_, n)
        rest = open_.pop(i) - n if i < len(open_) else window - n
        bisect.insort(open_, rest)
    return open_


@pytest.mark.parametrize("seed", range(12))
def test_plan_equals_placing_one_by_one(seed):
    rng = random.Random(seed)
    window = rng.choice([10, 64, 2048])
    lengths = [rng.randint(1, window) for _ in range(rng.choice([1, 30, 2000]))]
    counts = {n: lengths.count(n) for n in set(lengths)}
    plan = packing.best_fit(counts, window)
    used: dict[int, list] = {}
    for n, c in counts.items():
        sequence, offset = plan.place(np.full(c, n), np.arange(c))
        for s, o in zip(sequence, offset):
            used.setdefault(int(s), []).append((int(o), n))
    for pieces in used.values():
        at = 0
        for o, n in sorted(pieces):
            assert o == at
            at += n
        assert at <= window
    rest = sorted(window - sum(n for _, n in p) for p in used.values())
    assert rest == plain_best_fit(lengths, window)


def test_tree_finds_the_tightest():
    tree = packing.CapacityTree(100)
    held = set()
    rng = random.Random(1)
    for _ in range(500):
        c = rng.randint(0, 100)
        if c in held:
            held.discard(c)
            tree.add(c, -1)
        else:
            held.add(c)
            tree.add(c, 1)
        need = rng.randint(0, 100)
        assert tree.tightest(need) == min((h for h in held if h >= need), default=None)


def whole_ids(text: str) -> list[int]:
    tokenizer = tokenizers.Tokenizer.from_file(public.path("word_bpe_49k.json"))
    return [*tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_remembered_words_give_the_same_ids():
    own = WordTokens(public.path("word_bpe_49k.json"))
    texts = ["Hello, World! it's we'LL 12345 ... ---", "Straße ÉCOLE ñandú Ça", "漢字 かな ΣΑΣ ÎŞIK İ",
             "a b c \x1c d\x85e", "<|endoftext|> x<|startoftext|>y", "é ́ ﬁ Ǆ",
             "🙂🙃 👩‍👩‍👧", "", "  ", "x" * 500, "don't 'S can't've", "tab\tnew\r\nline\x0bfeed\x0c"]
    for text in texts * 2:
        assert np.frombuffer(own.ids(text), np.uint32).tolist() == whole_ids(text)[:-1], text


def test_pieces_are_merged_once():
    own = WordTokens(public.path("word_bpe_49k.json"))
    model, merged = own.model, []

    class Counting:
        def tokenize(self, piece):
            merged.append(piece)
            return model.tokenize(piece)

    own.model = Counting()
    for text in ["packing", "Packing PACKING, packing. (packing)", "Ñandú ñandú."]:
        assert np.frombuffer(own.ids(text), np.uint32).tolist() == whole_ids(text)[:-1]
        assert own.ids(text.encode()) == own.ids(text)
    assert len(merged) == len(set(merged)) and "packing" in merged


def check(docs, packed):
    texts: dict = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    by_doc, by_sequence = {}, {}
    for r in packed.collect():
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert by_doc.keys() == texts.keys()
    for i, pieces in by_doc.items():
        wanted = []
        for text in texts[i]:
            ids = np.array(whole_ids(text), dtype="<u4")
            wanted += [(s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()), len(ids))
                       for s in range(0, len(ids), 2048)]
        assert sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in pieces) == sorted(wanted)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return by_sequence


def test_every_token_lies_in_one_piece(documents):
    sequences = check(documents, packing.pack(documents))
    held = sum(n for p in sequences.values() for _, n in p)
    assert held > 0.98 * 2048 * len(sequences)


def test_awkward_rows(awkward, nothing):
    check(awkward, packing.pack(awkward))
    assert packing.pack(nothing).count() == 0


def test_sequences_hold_the_ids(documents):
    path = public.path("word_bpe_49k.json")
    packed = packing.pack(documents)
    ids = {r.sequence_id: r.ids for r in packing.sequence_ids(documents, packed, tokenizer=path).collect()}
    text = {r.doc_id: r.text for r in documents.collect()}
    for r in packed.limit(40).collect():
        wanted = whole_ids(text[r.doc_id])[r.start:r.start + r.length]
        assert ids[r.sequence_id][r.offset:r.offset + r.length] == wanted
    assert {len(v) for v in ids.values()} == {2048}
