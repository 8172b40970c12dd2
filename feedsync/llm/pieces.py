"""SentencePiece encoding and decoding with a shared-prefix Viterbi search (operator 2).

Text is marked as SentencePiece marks it (a space becomes the mark, one mark goes in
front) and cut where a mark begins: no piece of the vocabulary crosses that place, so
marked words are encoded on their own.  The distinct new words of a block of texts are
sorted, which is a depth-first walk of their trie: the search keeps the forward
values of the previous word's characters and reuses those of the common prefix.

Forward values depend on the model's kind:

* a unigram model keeps the best sum of piece scores up to each character;
* a BPE model has one valid segmentation of each prefix.  A piece extends it if
  merging the last piece and the new one from scratch gives the same two pieces
  back; a path that merging would not produce scores minus infinity.  So one value,
  the last piece, is kept for each character, and the result is the model's own.

A prefix keeps its last piece only, whose length points back; a complete word's pieces
are had by walking back once, so memory and time are linear in a word's length.

Characters that no piece covers become byte pieces (or the unknown id).  Decoding joins
pieces and bytes and takes the first mark away.

Words are cached within bounds across the blocks of a task, but for those of more than
``LONG`` characters, which last for their block; nothing is shuffled.

Defined results: null decodes and encodes to null, an empty text to no ids; marks
(U+2581) in a text are kept as spaces, as SentencePiece does; repeated rows get equal
ids; an empty table gives an empty result; other columns pass through, but for those
named like an output column, which it replaces.
"""

from __future__ import annotations

import re
from functools import cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsync.llm.common import slices

MODEL = "piece_bpe_32k.model"
MARK = chr(0x2581)
_WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHE = 400_000
LONG = 256  # characters of the longest word that is cached
BLOCK_BYTES = 1 << 20
END_MARKS = frozenset(".,;:!?")
NEVER = -1e8  # pieces that merging never makes score below this


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


class PieceModel:
    def __init__(self, path: str | None = None, unigram: bool = False):
        sp = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(MODEL))
        self.unigram = unigram
        n = sp.vocab_size()
        self.names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) for i in range(n)]
        self.score = {self.names[i]: (sp.get_score(i), i) for i in range(n) if not special[i]}
        self.bytes = {int(self.names[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.spelled = [
            bytes([int(self.names[i][1:-1], 16)]) if sp.is_byte(i) else b"" if special[i] else self.names[i].replace(MARK, " ").encode()
            for i in range(n)
        ]
        self.unknown = sp.unk_id()
        if any(MARK in p.lstrip(MARK) for p in self.score):
            raise ValueError("a piece crosses the start of a word; words can't be encoded on their own")
        self.packed = {p: i.to_bytes(4, "little") for p, (_, i) in self.score.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        # pieces that merging makes of their own characters, and the lengths of
        # pieces by their last two characters, longest first
        self.whole = set(self.score) if unigram else {p for p in self.score if self.merged(p) == [p]}
        sizes: dict[str, set[int]] = {}
        for p in self.whole:
            sizes.setdefault(p[-2:], {1}).add(len(p))
        self.sizes = {ending: sorted(found, reverse=True) for ending, found in sizes.items()}
        self.floor = min((s for s, _ in self.score.values() if s > NEVER), default=0.0) - 10

    # -------------------------------------------------------- one word's search

    def merged(self, text: str) -> list[str]:
        """Byte-pair merging from scratch: the best-scored pair first, the leftmost of equals."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = self.score.get(parts[i] + parts[i + 1])
                if found and (best is None or found[0] > best):
                    best, at = found[0], i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives these two pieces."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            known = self.pairs[key] = self.merged(left + right) == [left, right]
        return known

    def _best(self, word: str, end: int, values: list[float]) -> tuple[float, int]:
        """Of a unigram model, the best score up to ``end`` and its last piece's start."""
        best = None
        for size in self.sizes.get(word[max(end - 2, 0) : end], (1,)):
            start = end - size
            known = self.score.get(word[start:end]) if start >= 0 else None
            if known or size == 1:
                value = values[start] + (known[0] if known else self.floor)
                if best is None or value > best[0]:
                    best = (value, start)
        return best

    def segment(self, words: list[str], start=None, extend=None):
        """(word, its pieces) of sorted words; common prefixes are searched once.

        ``extend``, if given, folds the pieces of each prefix, from ``start`` on, into
        what is returned; it keeps a value for each prefix of the word."""
        values, lasts, paths, before = [0.0], [""], [start], ""
        unigram, sizes, whole, pairs, one = self.unigram, self.sizes, self.whole, self.pairs, (1,)
        for word in words:
            known = _common(before, word) + 1
            del values[known:], lasts[known:], paths[known:]
            for end in range(len(lasts), len(word) + 1):
                if unigram:
                    value, first = self._best(word, end, values)
                    piece = word[first:end]
                    values.append(value)
                else:  # the last piece of this prefix, tried longest first
                    for size in sizes.get(word[end - 2 : end] if end > 1 else word[:1], one):
                        first = end - size
                        if first < 0:
                            continue
                        piece = word[first:end]
                        if size == 1 or piece in whole:
                            if not first:
                                break
                            valid = pairs.get((lasts[first], piece))
                            if valid or valid is None and self.follows(lasts[first], piece):
                                break
                    else:
                        raise ValueError(f"no segmentation of {word!r}")
                lasts.append(piece)
                if extend:
                    paths.append(extend(paths[first], piece))
            before = word
            if extend:
                yield word, paths[len(word)]
                continue
            found, end = [], len(word)
            while end:
                piece = lasts[end]
                found.append(piece)
                end -= len(piece)
            found.reverse()
            yield word, found

    def _ids(self, pieces: list[str]) -> bytes:
        """The ids of ``pieces``, laid end to end."""
        out, unknown = [], self.unknown.to_bytes(4, "little")
        for piece in pieces:
            known = self.packed.get(piece)
            if known is None:
                if self.bytes:
                    known = b"".join(self.bytes[b].to_bytes(4, "little") for b in piece.encode())
                else:
                    known = unknown
                    if out and out[-1] == known:  # a run of unknown characters is one id
                        continue
            out.append(known)
        return b"".join(out)

    # ------------------------------------------------------------- whole texts

    def _cut(self, text: str) -> list[str]:
        """The marked words of ``text``, each without its first mark."""
        if not text:
            return []
        if "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
            return [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each text."""
        cut = [self._cut(t) for t in texts]
        if len(self.words) > CACHE:
            self.old, self.words = self.words, {}
        wanted = set(chain.from_iterable(cut)).difference(self.words)
        for w in wanted & self.old.keys():
            self.words[w] = self.old[w]
        fresh = wanted.difference(self.old)
        ended = {w for w in fresh if w[-1:] in END_MARKS and (w[:-1] in fresh or w[:-1] in self.words or w[:-1] in self.old)}
        self._learn(fresh - ended)
        self._learn({w for w in ended if not self._extended(w)})
        found = [b"".join(map(self.words.__getitem__, words)) for words in cut]
        for w in fresh:
            if len(w) > LONG:
                del self.words[w]
        return found

    def _learn(self, words: set[str]) -> None:
        packed = self.packed.__getitem__
        for word, pieces in self.segment([MARK + w for w in sorted(words)]):
            try:
                self.words[word[1:]] = b"".join(map(packed, pieces))
            except KeyError:  # characters that no piece covers
                self.words[word[1:]] = self._ids(pieces)

    def _extended(self, word: str) -> bool:
        """Whether ``word`` could be had from its longest proper prefix, whose forward
        value is known: no longer piece ends with the last two characters, so the last
        character is a piece, which has to follow the prefix's last one."""
        ids = self.words.get(word[:-1]) or self.old.get(word[:-1])
        end = word[-1]
        if not ids or self.unigram or end not in self.score or word[-2:] in self.sizes:
            return False
        before = self.names[int.from_bytes(ids[-4:], "little")]
        if before not in self.score or not self.follows(before, end):
            return False
        self.words[word] = ids + self.packed[end]
        return True

    def decode(self, ids) -> str:
        text = b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text[:1] == " " else text

    def decoded(self, ids: bytes | None) -> str | None:
        return None if ids is None else self.decode(np.frombuffer(ids, "<u4").tolist())


@cache
def piece_model(path: str | None = None, unigram: bool = False) -> PieceModel:
    return PieceModel(path, unigram)


def _input(df: DataFrame, column: str, added: dict[str, T.DataType]) -> tuple[DataFrame, T.StructType]:
    """(``df`` without the columns that ``added`` replaces, ``column`` last; the result's schema)."""
    gone = {c.lower() for c in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in gone]
    names = [F.col("`" + f.name.replace("`", "``") + "`") for f in kept]
    schema = T.StructType([*kept, *(T.StructField(c, t) for c, t in added.items())])
    return df.select(*names, F.col(column).alias("__from")), schema


def encode_pieces(
    df: DataFrame,
    text_col: str = "text",
    out_col: str = "ids",
    path: str | None = None,
    unigram: bool = False,
    decoded_col: str | None = None,
) -> DataFrame:
    """``df`` with the ids of ``text_col`` (binary, little-endian unsigned 32-bit) and, on
    request, the text that the ids decode to, in the same pass.  A column of such a name
    is replaced; the others pass through."""

    def run(batches):
        model = piece_model(path, unigram)
        for b in (part for whole in batches for part in slices(whole, "__from", BLOCK_BYTES)):
            block = b.column("__from").to_pylist()
            found = model.encode([t or "" for t in block])
            ids = [None if t is None else i for t, i in zip(block, found, strict=True)]
            columns = [*b.columns[:-1], pa.array(ids, pa.binary())]
            if decoded_col:
                columns.append(pa.array(map(model.decoded, ids), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    added = {out_col: T.BinaryType()} | ({decoded_col: T.StringType()} if decoded_col else {})
    source, schema = _input(df, text_col, added)
    return source.mapInArrow(run, schema)


def decode_pieces(df: DataFrame, ids_col: str = "ids", out_col: str = "decoded", path: str | None = None) -> DataFrame:
    """``df`` with the text of ``ids_col``; a column named ``out_col`` is replaced."""

    def run(batches):
        model = piece_model(path)
        for b in (part for whole in batches for part in slices(whole, "__from")):
            text = list(map(model.decoded, b.column("__from").to_pylist()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(text, pa.string())], names=schema.names)

    source, schema = _input(df, ids_col, {out_col: T.StringType()})
    return source.mapInArrow(run, schema)


def piece_digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_ids, ids_crc32, and the length and SHA-256 of the decoded text."""
    plain = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return encode_pieces(plain, decoded_col="text").select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("text").cast("long").alias("decoded_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
