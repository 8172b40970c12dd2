"""Removal of repeated passages by fixed-block anchors (operator 10).

A window is ``WINDOW`` consecutive words.  A word goes when a window covers it whose
words also start in a document with a smaller id.

1. *Index and probe.*  The reference blocks are the runs of ``BLOCK`` words at every
   ``BLOCK``-th word of a document, non-overlapping; the probes are all rolling runs
   of ``BLOCK`` words.  ``2 * BLOCK - 1 <= WINDOW``, so a window that repeats anywhere
   holds a whole reference block of the other document.  An anchor is a block that
   is probed from another document.
2. *Extend.*  Around the anchors every window that holds one is compared by its whole
   word sequence (an 80-bit hash) with all others, which finds the smallest
   document of each.  Windows that repeat are joined to maximal repeats.

Documents are dealt to chunks by a hash of their id and text, so null and repeated ids
spread and only rows alike in both share a chunk for certain; their texts are
compressed and cross the network once.  A chunk sends each partition of the hash
space one packed row of distinct values, and gets back the values that count; a
passage that fills a third of the corpus is one value for each chunk.

Defined results: a null text has no words; a null id is larger than every other; rows
that repeat an id never remove each other's words; a text of any length is taken
whole; an empty table gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from feedsync.llm.common import shuffle_partitions, slices
from feedsync.llm.shingles import run_hashes, word_hashes

WINDOW, BLOCK = 13, 7
CHUNK_BYTES = 2 << 20
CHUNKS_A_TASK = 8
PARTITION_ROWS = 4_000_000  # hashes that one task sorts, about
NO_ID = np.iinfo(np.int64).max

_FP = 5  # bytes of a block's fingerprint; the partition adds to it
_MASK = np.uint64((1 << 8 * _FP) - 4)  # its lowest two bits are flags


def _pack(values: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpack(data: bytes, width: int) -> np.ndarray:
    raw = np.zeros((len(data) // width, 8), np.uint8)
    raw[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return raw.view(np.uint64).ravel()


class _Chunk:
    """The documents of one chunk and the hashes of their words."""

    def __init__(self, table: pa.Table):
        unzip = zstandard.ZstdDecompressor()
        self.ids = table.column("__id").fill_null(NO_ID).to_numpy()
        self.texts = [unzip.decompress(z) for z in table.column("__zip").to_pylist()]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.words, self.counts = word_hashes(b"".join(self.texts), lengths)
        self.first = np.cumsum(self.counts) - self.counts
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)

    def blocks(self) -> tuple[np.ndarray, np.ndarray]:
        return run_hashes(self.words, self.counts, BLOCK)

    def windows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hash, second hash of 16 bits, complete) of the window from each word on."""
        h, whole = run_hashes(self.words, self.counts, WINDOW)
        second, _ = run_hashes(self.words, self.counts, WINDOW, seed=0x5DEECE66D)
        return h, (second >> np.uint64(48)).astype(np.uint16), whole


def _partition_of(hashes: np.ndarray, partitions: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(partitions)).astype(np.int64)


def _by_partition(partitions: np.ndarray) -> list[tuple[int, slice]]:
    """Slices of equal values of a sorted array."""
    if not len(partitions):
        return []
    cuts = np.flatnonzero(np.diff(partitions, prepend=-1))
    return [(int(partitions[i]), slice(i, j)) for i, j in zip(cuts, [*cuts[1:], len(partitions)], strict=True)]


def _probes(table: pa.Table, partitions: int) -> pa.Table:
    """A chunk's distinct rolling runs, with two flags: a reference block, in several documents."""
    chunk = _Chunk(table)
    h, whole = chunk.blocks()
    at = np.flatnonzero(whole)
    block = ((at - chunk.first[chunk.doc[at]]) % BLOCK == 0).astype(np.uint64)
    order = np.argsort(h[at], kind="stable")
    h, at, block = h[at][order], at[order], block[order]
    cuts = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    if len(cuts):
        ids = chunk.ids[chunk.doc[at]]
        several = np.minimum.reduceat(ids, cuts) != np.maximum.reduceat(ids, cuts)
        block = np.maximum.reduceat(block, cuts)
        h = h[cuts]
    else:
        several = np.zeros(0, bool)
    part = _partition_of(h, partitions)
    value = ((h << np.uint64(2)) & _MASK) | (block << np.uint64(1)) | several.astype(np.uint64)
    order = np.argsort(part, kind="stable")
    part, value = part[order], value[order]
    rows = [(p, _pack(value[s], _FP)) for p, s in _by_partition(part)]
    return _requests(table, rows)


def _requests(table: pa.Table, rows: list[tuple[int, bytes]]) -> pa.Table:
    k = table.column("__k")[0].as_py()
    return pa.table(
        {
            "part": pa.array([p for p, _ in rows], pa.int32()),
            "__k": pa.array([k] * len(rows), pa.int64()),
            "data": pa.array([d for _, d in rows], pa.binary()),
        }
    )


def _gathered(batches) -> tuple[np.ndarray, list[bytes]]:
    ks, data = [], []
    for b in batches:
        ks.append(b.column(1).to_numpy())
        data += b.column(2).to_pylist()
    return np.concatenate(ks) if ks else np.zeros(0, np.int64), data


def _replies(ks: np.ndarray, owner: np.ndarray, packed: np.ndarray, width: int):
    """Rows (k, data): the chosen values of each chunk."""
    order = np.argsort(owner, kind="stable")
    owner, packed = owner[order], packed[order]
    out = [(int(ks[o]), packed[s].tobytes()) for o, s in _by_partition(owner)]
    for i in range(0, len(out), 1000):
        part = out[i : i + 1000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in part], pa.int64()), pa.array([d for _, d in part], pa.binary())],
            names=["__k", "data"],
        )


def _anchors(batches):
    """Of one partition's probes, those that are an anchor, back to their chunks."""
    ks, data = _gathered(batches)
    if not len(ks):
        return
    sizes = np.array([len(d) // _FP for d in data])
    value = _unpack(b"".join(data), _FP)
    owner = np.repeat(np.arange(len(ks)), sizes)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    cuts = np.flatnonzero(np.r_[True, (value[1:] ^ value[:-1]) > 3])
    n = np.diff(cuts, append=len(value))
    block = np.maximum.reduceat((value >> np.uint64(1)) & np.uint64(1), cuts) > 0
    several = np.maximum.reduceat(value & np.uint64(1), cuts) > 0
    chosen = np.repeat(block & (several | (n > 1)), n)
    value = value[chosen] & _MASK
    packed = np.ascontiguousarray(value.view(np.uint8).reshape(-1, 8)[:, :_FP])
    yield from _replies(ks, owner[chosen], packed, _FP)


def _candidates(table: pa.Table, replies: pa.Table, partitions: int) -> pa.Table:
    """A chunk's distinct windows that hold an anchor, each with its smallest document."""
    if not table.num_rows or not replies.num_rows:
        return _requests(table, []) if table.num_rows else _EMPTY
    anchors = np.sort(_unpack(b"".join(replies.column("data").to_pylist()), _FP))
    chunk = _Chunk(table)
    h, whole = chunk.blocks()
    key = (h << np.uint64(2)) & _MASK
    at = np.minimum(np.searchsorted(anchors, key), len(anchors) - 1)
    hit = whole & (anchors[at] == key)
    # a window from word i holds the runs from i to i + WINDOW - BLOCK
    sums = np.concatenate([[0], np.cumsum(hit)])
    ends = np.minimum(np.arange(len(hit)) + WINDOW - BLOCK + 1, len(hit))
    h, second, complete = chunk.windows()
    at = np.flatnonzero(complete & (sums[ends] > sums[:-1]))
    h, second, ids = h[at], second[at], chunk.ids[chunk.doc[at]]
    order = np.lexsort((ids, second, h))
    h, second, ids = h[order], second[order], ids[order]
    first = np.r_[True, (h[1:] != h[:-1]) | (second[1:] != second[:-1])] if len(h) else np.zeros(0, bool)
    h, second, ids = h[first], second[first], ids[first]
    part = _partition_of(h, partitions)
    order = np.lexsort((ids, part))
    part, h, second, ids = part[order], h[order], second[order], ids[order]
    rows = []
    for p, s in _by_partition(part):
        docs, n = np.unique(ids[s], return_counts=True)
        head = np.array([len(docs)], "<i8").tobytes() + docs.astype("<i8").tobytes() + n.astype("<u4").tobytes()
        rows.append((p, head + h[s].astype("<u8").tobytes() + second[s].astype("<u2").tobytes()))
    return _requests(table, rows)


_EMPTY = pa.table(
    {"part": pa.array([], pa.int32()), "__k": pa.array([], pa.int64()), "data": pa.array([], pa.binary())}
)


def _repeats(batches):
    """Of one partition's windows, those of which a smaller document elsewhere has a
    copy, back to their chunks."""
    ks, data = _gathered(batches)
    if not len(ks):
        return
    hs, seconds, ids, sizes = [], [], [], []
    for d in data:
        n_docs = int(np.frombuffer(d, "<i8", 1)[0])
        docs = np.frombuffer(d, "<i8", n_docs, 8)
        n = np.frombuffer(d, "<u4", n_docs, 8 + 8 * n_docs)
        at, total = 8 + 12 * n_docs, int(n.sum())
        ids.append(np.repeat(docs, n))
        hs.append(np.frombuffer(d, "<u8", total, at))
        seconds.append(np.frombuffer(d, "<u2", total, at + 8 * total))
        sizes.append(total)
    h, second, ids = np.concatenate(hs), np.concatenate(seconds), np.concatenate(ids)
    owner = np.repeat(np.arange(len(ks)), sizes)
    order = np.lexsort((ids, second, h))
    h, second, ids, owner = h[order], second[order], ids[order], owner[order]
    cuts = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (second[1:] != second[:-1])])
    smallest = np.repeat(ids[cuts], np.diff(cuts, append=len(h)))
    chosen = ids > smallest
    packed = np.empty((int(chosen.sum()), 10), np.uint8)
    packed[:, :8] = h[chosen].astype("<u8").view(np.uint8).reshape(-1, 8)
    packed[:, 8:] = second[chosen].astype("<u2").view(np.uint8).reshape(-1, 2)
    yield from _replies(ks, owner[chosen], packed, 10)


def _covered(chunk: _Chunk, replies: list[bytes]) -> np.ndarray:
    """Whether each word lies in a window that repeats a smaller document's."""
    h, second, complete = chunk.windows()
    at = np.flatnonzero(complete)
    key, ids = h[at] ^ (second[at].astype(np.uint64) << np.uint64(48)), chunk.ids[chunk.doc[at]]
    order = np.lexsort((ids, second[at], h[at]))
    hs, ss = h[at][order], second[at][order]
    flagged = np.zeros(len(at), bool)
    if len(at):
        cuts = np.flatnonzero(np.r_[True, (hs[1:] != hs[:-1]) | (ss[1:] != ss[:-1])])
        smallest = np.repeat(ids[order][cuts], np.diff(cuts, append=len(at)))
        flagged[order] = ids[order] > smallest
    raw = np.frombuffer(b"".join(replies), np.uint8).reshape(-1, 10)
    if len(raw):
        there = np.ascontiguousarray(raw[:, :8]).view("<u8").ravel()
        there_second = np.ascontiguousarray(raw[:, 8:]).view("<u2").ravel()
        known = np.sort(there ^ (there_second.astype(np.uint64) << np.uint64(48)))
        found = np.minimum(np.searchsorted(known, key), len(known) - 1)
        flagged |= known[found] == key
    edge = np.zeros(len(chunk.words) + 1, np.int32)
    edge[at[flagged]] += 1
    edge[at[flagged] + WINDOW] -= 1
    return np.cumsum(edge[:-1]) > 0


def _rewritten(table: pa.Table, replies: pa.Table, want_text: bool) -> pa.Table:
    """The chunk's rows with their counts and what is left of their texts."""
    if not table.num_rows:
        return None
    chunk = _Chunk(table)
    gone = _covered(chunk, replies.column("data").to_pylist())
    n_removed, left, digest, spans = [], [], [], []
    for text, first, n in zip(chunk.texts, chunk.first.tolist(), chunk.counts.tolist(), strict=True):
        mask = gone[first : first + n]
        removed = int(mask.sum())
        n_removed.append(removed)
        words = text.split()
        kept = b" ".join(compress(words, (~mask).tolist()) if removed else words)
        if want_text:
            left.append((kept if removed else text).decode())
            edges = np.flatnonzero(np.diff(mask, prepend=False, append=False))
            spans.append([{"start": int(i), "end": int(j)} for i, j in zip(edges[::2], edges[1::2], strict=True)])
        else:
            digest.append(hashlib.sha256(kept).hexdigest())
    out = {"n_words": pa.array(chunk.counts.astype(np.int64)), "n_removed": pa.array(n_removed, pa.int64())}
    if want_text:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        out |= {"kept_text": pa.array(left, pa.string()), "spans": pa.array(spans, span)}
    else:
        out |= {"kept_sha256": pa.array(digest, pa.string())}
    return pa.table({"row": table.column("__doc"), **out})


def _compressed(batches):
    zip_ = zstandard.ZstdCompressor(level=1)
    for b in (part for whole in batches for part in slices(whole, "__text")):
        raw = b.column("__text").to_pylist()
        packed = pa.array([zip_.compress(t or b"") for t in raw], pa.binary())
        yield pa.RecordBatch.from_arrays([*b.columns[:-1], packed], names=[*b.schema.names[:-1], "__zip"])


def _processed(docs: DataFrame, id_col: str, text_col: str, want_text: bool) -> DataFrame:
    """Columns row (struct of the other columns and whether the text is null),
    n_words, n_removed and either kept_text and spans or kept_sha256."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    chunks = max(1, -(-int(total) // CHUNK_BYTES))
    partitions = max(shuffle_partitions(spark), -(-int(total) // 6 // PARTITION_ROWS))
    quoted = lambda c: "`" + c.replace("`", "``") + "`"
    others = [F.col(quoted(c)) for c in docs.columns if c != text_col] if want_text else [F.col(id_col)]
    rows = docs.select(
        F.struct(*others, F.col(text_col).isNull().alias("__null")).alias("__doc"),
        F.col(id_col).cast("long").alias("__id"),
        F.pmod(F.xxhash64(F.col(id_col).cast("long"), F.col(text_col)), F.lit(chunks)).cast("long").alias("__k"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("__text"),
    )
    kind = rows.schema["__doc"].dataType
    packed = T.StructType(
        [T.StructField("__doc", kind), T.StructField("__id", T.LongType())]
        + [T.StructField("__k", T.LongType()), T.StructField("__zip", T.BinaryType())]
    )
    # as many tasks as the bytes need, whatever the session's count
    tasks = max(spark.sparkContext.defaultParallelism, -(-chunks // CHUNKS_A_TASK))
    dealt = rows.mapInArrow(_compressed, packed).repartition(tasks, "__k")
    request, reply = "part int, __k long, data binary", "__k long, data binary"

    def probes(table: pa.Table) -> pa.Table:
        return _probes(table, partitions)

    def candidates(table: pa.Table, replies: pa.Table) -> pa.Table:
        return _candidates(table, replies, partitions)

    def rewritten(table: pa.Table, replies: pa.Table) -> pa.Table:
        found = _rewritten(table, replies, want_text)
        return empty if found is None else found

    ends = "kept_text string, spans array<struct<start:bigint,end:bigint>>" if want_text else "kept_sha256 string"
    schema = T.StructType([T.StructField("row", kind), *T.StructType.fromDDL(f"n_words long, n_removed long, {ends}")])
    empty = to_arrow_schema(schema).empty_table()
    by_k = dealt.groupBy("__k")
    anchors = by_k.applyInArrow(probes, request).repartitionById(partitions, F.col("part")).mapInArrow(_anchors, reply)
    repeats = (
        by_k.cogroup(anchors.groupBy("__k"))
        .applyInArrow(candidates, request)
        .repartitionById(partitions, F.col("part"))
        .mapInArrow(_repeats, reply)
    )
    return by_k.cogroup(repeats.groupBy("__k")).applyInArrow(rewritten, schema)


def removal_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the words that stay."""
    return _processed(docs, id_col, text_col, False).select(
        F.col("row").getField(id_col).alias(id_col), "n_words", "n_removed", "kept_sha256"
    )


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text`` cut: a row that loses words keeps the others joined by one
    space; a row that loses none keeps its text as it was."""
    done = _processed(docs, id_col, text_col, True)
    row = F.col("row")
    text = F.when(~row.getField("__null"), F.col("kept_text"))
    return done.select(*[text.alias(c) if c == text_col else row.getField(c).alias(c) for c in docs.columns])


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the maximal repeats in it, as spans of word numbers."""
    return _processed(docs, id_col, text_col, True).select(
        F.col("row").getField(id_col).alias(id_col), "n_words", "n_removed", "spans"
    )
