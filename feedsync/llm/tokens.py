"""Token ids of whole texts.

The word vocabulary's tokenizer is slow on new words, so its ids are put together
chunk by chunk: white space ends every token, so the ids of a text are the ids of its
runs without white space, in order.  Runs repeat, and so do the pieces that the
vocabulary's pattern cuts them into; both are cached per worker, within bounds.  A new
piece goes straight to the BPE model.  A run with characters outside the Latin blocks,
or with a special token, goes through the whole tokenizer; a text with white space on
which Python and the tokenizer might disagree is cut at plain ASCII white space only.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from functools import cache

import numpy as np
import public_tokenizers
import regex
import tiktoken
from tokenizers import Tokenizer

from feedsync.llm.common import BoundedCache

WORD_BPE = "word_bpe_49k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"

# The vocabulary's own split pattern.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Characters that str.split() takes for white space and a tokenizer may not.
_ODD = "\x1c\x1d\x1e\x1f"
_ASCII = re.compile("[^ \t\n\r\x0b\x0c]+")
# Chunks that the short way handles, but for those with a special token.
_LATIN = re.compile("[!-~\xa1-\u012f\u0131-\u024f]+")


def _byte_letters() -> dict[int, str]:
    """Byte-level BPE spells a byte as itself if it prints, else as the next free
    character from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(256 + i) for i, b in enumerate(others)}


_SPELL = _byte_letters()


class WordTokenizer:
    """Lower-casing BPE with word ends; white space is dropped."""

    def __init__(self, path: str | None = None):
        self.tokenizer = Tokenizer.from_file(path or public_tokenizers.path(WORD_BPE))
        self.model = self.tokenizer.model
        self.pieces = regex.compile(WORD_PATTERN).findall
        self.of_chunk = BoundedCache(self._chunk, 500_000)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit values."""
        chunks = _ASCII.findall(text) if any(c in text for c in _ODD) else text.split()
        return b"".join(map(self.of_chunk.__getitem__, chunks))

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a run without white space; its pieces are runs too, so one cache
        holds both."""
        ascii_ = chunk.isascii()
        if ascii_ and chunk.isalpha() and chunk.islower():
            return self._piece(chunk)
        if "<|" in chunk or not (chunk.isprintable() if ascii_ else _LATIN.fullmatch(chunk)):
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            return np.asarray(ids, dtype="<u4").tobytes()
        folded = chunk.lower() if ascii_ else unicodedata.normalize("NFC", chunk).lower()
        core = folded.rstrip(".,;:!?")
        if core.isalpha():  # a word, perhaps with punctuation
            if core == chunk:
                return self._piece(chunk)
            word, tail = self.of_chunk[core], folded[len(core) :]
            return word + self.of_chunk[tail] if tail else word
        pieces = self.pieces(folded)
        if pieces == [chunk]:
            return self._piece(chunk)
        return b"".join(map(self.of_chunk.__getitem__, pieces))

    def _piece(self, piece: str) -> bytes:
        if not (piece.isascii() and piece.isalpha()):
            piece = piece.encode().decode("latin-1").translate(_SPELL)
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()


class ByteTokenizer:
    """Byte-level BPE: decoding gives the very text back.  Special tokens' strings are
    ordinary text."""

    def __init__(self, path: str | None = None):
        with open(path or public_tokenizers.path(BYTE_RANKS), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding(
            "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit values."""
        return np.asarray(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()

    def decode(self, ids) -> str:
        return self.encoding.decode(list(ids))


@cache
def word_tokenizer(path: str | None = None) -> WordTokenizer:
    """One for each worker process, so that its caches serve all its tasks."""
    return WordTokenizer(path)


@cache
def byte_tokenizer(path: str | None = None) -> ByteTokenizer:
    return ByteTokenizer(path)
