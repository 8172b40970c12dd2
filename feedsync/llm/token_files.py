"""Packed token-id files by best-fit decreasing (operator 6).

A task reads its documents as they come, encodes them with a byte-level vocabulary
(so ids decode to the very text), appends an end id and cuts what is longer than a
sequence into pieces, losslessly.  When it holds ``SHARD_TOKENS`` ids it packs them,
longest piece first, each into the fullest sequence that still takes it; a segment
tree over free capacities finds that sequence.  Nothing is shuffled, and memory is
bounded by the shard.

A shard is one set of files, committed through temporary names and a manifest
(:mod:`feedsync.llm.sharded_files`): ``ids.npy`` (sequences x capacity, padded with
``pad_id``), ``cu_seqlens.npy`` (running segment lengths of all sequences laid end to
end, padding being a segment of its own), ``resets.npy`` (flat places where position
ids start at 0 again) and ``segments.parquet`` (doc_id, piece, start, sequence,
offset, length).

Defined results: a null text is empty and holds its end id alone; documents that
share an id are separate; an empty table gives no shards and an empty result; other
columns are ignored; ids must be integers.
"""

from __future__ import annotations

import hashlib
import io
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.llm.common import slices, texts, work_path
from feedsync.llm.sharded_files import MANIFEST, Attempt, commit, file_system, manifest_batch
from feedsync.llm.tokens import byte_tokenizer

CAPACITY = 4096
END_ID = 50_256  # the vocabulary's end-of-text id
SHARD_TOKENS = 8_000_000


class CapacityTree:
    """How many open sequences have each free capacity; finds the smallest that is
    large enough in one descent."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _change(self, free: int, by: int) -> None:
        i = self.leaves + free
        while i:
            self.count[i] += by
            i >>= 1

    def add(self, free: int, sequence: int) -> None:
        self.open[free].append(sequence)
        self._change(free, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(free, sequence) of the fullest open sequence with ``need`` free places."""
        i = self.leaves + need
        while not self.count[i]:  # climb to the next subtree on the right that is not empty
            while i & 1:
                i >>= 1
            if not i:
                return None
            i += 1
        while i < self.leaves:
            i = 2 * i + (not self.count[2 * i])
        free = i - self.leaves
        self._change(free, -1)
        return free, self.open[free].pop()


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each piece, and the number of sequences."""
    tree, sequences = CapacityTree(capacity), 0
    where, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        found = tree.take(n)
        if found is None:
            found, sequences = (capacity, sequences), sequences + 1
        free, where[i] = found
        offset[i] = capacity - free
        if free > n:
            tree.add(free - n, int(where[i]))
    return where, offset, sequences


def packed(pieces: list[bytes], capacity: int, pad_id: int) -> dict[str, np.ndarray]:
    """The arrays of one shard; ``order`` lists the pieces as they lie in it."""
    lengths = np.array([len(p) // 4 for p in pieces], np.int64)
    where, offset, n = best_fit_decreasing(lengths, capacity)
    ids = np.full((n, capacity), pad_id, np.uint16)
    for p, s, o, k in zip(pieces, where.tolist(), offset.tolist(), lengths.tolist(), strict=True):
        ids[s, o : o + k] = np.frombuffer(p, "<u4")
    order = np.lexsort((offset, where))
    flat = where[order] * capacity + offset[order]
    used = np.bincount(where, lengths, minlength=n).astype(np.int64)
    padding = np.flatnonzero(used < capacity) * capacity + used[used < capacity]
    resets = np.sort(np.concatenate([flat, padding]))
    return {
        "ids": ids,
        "cu_seqlens": np.append(resets, n * capacity),
        "resets": resets,
        "order": order,
        "where": where,
        "offset": offset,
        "length": lengths,
    }


def position_ids(resets: np.ndarray, sequences: int, capacity: int) -> np.ndarray:
    """The position of every id within its segment, as a matrix like ``ids``."""
    marks = np.zeros(sequences * capacity, np.int64)
    marks[resets] = resets
    return (np.arange(sequences * capacity) - np.maximum.accumulate(marks)).reshape(sequences, capacity)


def _npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, array, allow_pickle=False)
    return out.getvalue()


def write_token_files(
    docs: DataFrame,
    out: str | None = None,
    capacity: int = CAPACITY,
    shard_tokens: int = SHARD_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> tuple[str, DataFrame]:
    """Write the files of ``docs`` below ``out``; returns the folder and the manifest."""
    out = out or work_path(docs.sparkSession, "tokens")
    end = np.asarray([END_ID], "<u4").tobytes()

    def write(batches):
        tokenizer, attempt = byte_tokenizer(), Attempt(out)
        partition, seq = TaskContext.get().partitionId(), 0
        pieces, rows, size = [], [], 0

        def flush():
            p = packed(pieces, capacity, END_ID)
            order = p["order"]
            table = pa.table(
                {
                    "doc_id": pa.array([rows[i][0] for i in order], pa.int64()),
                    "piece": pa.array([rows[i][1] for i in order], pa.int64()),
                    "start": pa.array([rows[i][2] for i in order], pa.int64()),
                    "sequence": pa.array(p["where"][order]),
                    "offset": pa.array(p["offset"][order]),
                    "length": pa.array(p["length"][order]),
                }
            )
            segments = io.BytesIO()
            pq.write_table(table, segments, compression="zstd")
            written = []
            for name, data in [
                ("ids.npy", _npy(p["ids"])),
                ("cu_seqlens.npy", _npy(p["cu_seqlens"])),
                ("resets.npy", _npy(p["resets"])),
                ("segments.parquet", segments.getvalue()),
            ]:
                final = f"shard-{partition:06d}-{seq:04d}/{name}"
                temporary, f = attempt.open(final.replace("/", "-"))
                with f:
                    f.write(data)
                digest = hashlib.sha256(data).hexdigest()
                written.append((partition, seq, final, temporary, len(data), len(rows), digest))
            return manifest_batch(written)

        for b in (part for whole in batches for part in slices(whole, "text")):
            for i, text in zip(b.column(0).to_pylist(), texts(b.column(1)), strict=True):
                ids = tokenizer.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    pieces.append(part)
                    rows.append((i, piece, at // 4))
                    size += len(part) // 4
                    if size >= shard_tokens:
                        yield flush()
                        pieces, rows, size, seq = [], [], 0, seq + 1
        if pieces:
            yield flush()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return out, commit(chosen.mapInArrow(write, MANIFEST), out)


def read_token_files(manifest: DataFrame, out: str, with_ids: bool = False) -> DataFrame:
    """One row per segment, read back from the files: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset and, on request, the ids.  Segment lengths, running
    lengths and resets are checked against each other."""

    def load(batches):
        system, root = file_system(out)

        def fetch(name: str) -> bytes:
            with system.open_input_stream(f"{root}/{name}", compression=None) as f:
                return f.read()

        for b in batches:
            for name, shard, seq in zip(*(b.column(c).to_pylist() for c in ("name", "shard", "seq")), strict=True):
                folder = name.rpartition("/")[0]
                ids, cu, resets = (np.load(io.BytesIO(fetch(f"{folder}/{n}.npy"))) for n in ("ids", "cu_seqlens", "resets"))
                table = pq.read_table(io.BytesIO(fetch(name)))
                where, offset, length = (table.column(c).to_numpy() for c in ("sequence", "offset", "length"))
                at = np.searchsorted(cu, where * ids.shape[1] + offset)
                if not (np.array_equal(np.diff(cu)[at], length) and np.array_equal(resets[at], cu[at])):
                    raise ValueError(f"{folder}: segments and running lengths differ")
                parts = [
                    ids[s, o : o + n].astype("<u4").tobytes()
                    for s, o, n in zip(where.tolist(), offset.tolist(), length.tolist(), strict=True)
                ]
                out_ = {
                    "doc_id": table.column("doc_id"),
                    "piece": table.column("piece"),
                    "start": table.column("start"),
                    "length": table.column("length"),
                    "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    "sequence_id": pa.array((np.int64(shard) << 40) + (np.int64(seq) << 28) + where),
                    "offset": table.column("offset"),
                } | ({"ids": pa.array(parts, pa.binary())} if with_ids else {})
                yield from pa.table(out_).combine_chunks().to_batches(max_chunksize=10_000)

    files = manifest.filter(F.col("name").endswith("segments.parquet")).select("name", "shard", "seq")
    schema = (
        "doc_id long, piece long, start long, length long, ids_crc32 long, sequence_id long, offset long"
        + ", ids binary" * with_ids
    )
    return files.repartition(max(1, files.count())).mapInArrow(load, schema)
