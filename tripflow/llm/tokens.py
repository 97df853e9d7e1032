"""Token ids of whole texts by a public word-level BPE file, remembering words."""

from __future__ import annotations

import os
import re

import regex

# Runs the tokenizer file splits a text into before merging; a fixed value of it.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
# The same for lower-case words of ASCII characters, which most are.
ASCII_PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
# Letters whose lower case and composition depend on nothing around them.
PLAIN = re.compile(r"[!-~\xa1-\u012f\u0131-\u024f]*")
# Words, and pieces of words, each some 60 MB per worker process.
REMEMBERED = 400_000
LONGEST_REMEMBERED = 32
ID_BYTES = 4


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    stands = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [stands[b] for b in range(256)]


class WordTokens(dict):
    """Little-endian 32-bit ids of words, which are UTF-8 bytes, looked up once per word.

    White space never joins what stands on its two sides, so the ids of a text are
    those of its words in turn. Words in Latin letters are merged piece by piece;
    others, and such as hold special tokens, go through the whole tokenizer. What
    is met first is remembered, frequent words among it, until the memory is full; so are
    pieces, which words in capitals or before a full stop share with others.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = _byte_letters()
        self.pieces: dict[str, bytes] = {}

    def __missing__(self, raw: bytes) -> bytes:
        word = raw.decode("utf-8", "surrogatepass")
        if "<|" in word or not PLAIN.fullmatch(word):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            found = b"".join(i.to_bytes(ID_BYTES, "little") for i in ids)
        else:
            cut = ASCII_PIECE if raw.isascii() else PIECE
            found = b"".join([self.pieces.get(p) or self.piece(p) for p in cut.findall(word.lower())])
        if len(self) < REMEMBERED and len(word) <= LONGEST_REMEMBERED:
            self[raw] = found
        return found

    def piece(self, piece: str) -> bytes:
        raw = piece if piece.isascii() else "".join(self.letters[b] for b in piece.encode())
        found = b"".join([t.id.to_bytes(ID_BYTES, "little") for t in self.model.tokenize(raw)])
        if len(self.pieces) < REMEMBERED and len(piece) <= LONGEST_REMEMBERED:
            self.pieces[piece] = found
        return found

    def ids(self, text: str | bytes) -> bytes:
        """Ids of the whole text, or its UTF-8 bytes, without special tokens around it."""
        raw = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text
        # Bytes are split at ASCII white space alone.
        return b"".join(map(self.__getitem__, raw.split()))


_loaded: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """One memory per worker process and file."""
    if path not in _loaded:
        _loaded[path] = WordTokens(path)
    return _loaded[path]
