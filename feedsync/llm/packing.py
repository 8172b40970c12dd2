"""Best-fit packing after Martello-Toth dominance reduction (operator 3).

The instance is the histogram of piece lengths: at most ``capacity`` numbers,
whatever the corpus holds.  On it the driver fixes the sets that provably
dominate every alternative (:func:`reduce_dominated`), then packs what is left
best-fit, longest first (:func:`best_fit`).  Both work on whole multiplicities,
so the plan is a list of *runs* ("the items of length L ranked r0.. go, q to a
sequence, into sequences s0..").  Each touch of a run at least halves its
sequences' free space, so there are at most ``12 * 2 * capacity`` or so runs and
their broadcast is bounded for every corpus.  The cluster ranks the pieces
within their length and looks their run up.

Defined results: a null text counts as empty and still holds its end id, so it
is packed; documents that share an id are packed separately; an empty table
gives an empty result; a text of any length is cut losslessly.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedsync.llm.common import shuffle_partitions, slices, staged, texts
from feedsync.llm.tokens import word_tokenizer

CAPACITY = 4096
END_ID = 1


# ---------------------------------------------------------------- the plan


class _Runs:
    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64).copy()
        self.next_rank = np.zeros(len(counts), np.int64)
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int, int]] = []

    def place(self, length: int, n: int, first_sequence: int, per_sequence: int, offset: int) -> None:
        """The next ``n`` items of ``length``: ``per_sequence`` to a sequence."""
        self.rows.append((length, int(self.next_rank[length]), n, first_sequence, per_sequence, offset))
        self.next_rank[length] += n
        self.left[length] -= n

    def open(self, n: int) -> int:
        first = self.sequences
        self.sequences += n
        return first

    def fix(self, lengths: list[int], n: int) -> None:
        """``n`` closed sequences, each with one item of every given length."""
        first, offset = self.open(n), 0
        for length in sorted(set(lengths), reverse=True):
            k = lengths.count(length)
            self.place(length, n * k, first, k, offset)
            offset += k * length


def _smallest(left: np.ndarray, taken: int, n: int) -> list[int]:
    """The ``n`` smallest items left, without one item of length ``taken``."""
    out: list[int] = []
    for length in np.flatnonzero(left):
        k = int(left[length]) - (length == taken)
        out += [int(length)] * min(k, n - len(out))
        if len(out) == n:
            break
    return out


def _best_pair(left: np.ndarray, taken: int, room: int, above: int = 0) -> int:
    """The largest sum within ``room`` of two items longer than ``above``; 0 if none."""
    have = left.copy()
    have[taken] -= 1
    lengths = np.flatnonzero(have[: room + 1] > 0)
    lengths = lengths[lengths > above]
    if not len(lengths):
        return 0
    at = np.searchsorted(lengths, room - lengths, side="right") - 1
    partner = np.where(at >= 0, lengths[np.maximum(at, 0)], 0)
    # an item is its own partner only if there are two of it
    own = (partner == lengths) & (have[lengths] < 2)
    below = lengths[np.maximum(at - 1, 0)]
    partner = np.where(own, np.where(at >= 1, below, 0), partner)
    sums = np.where(partner > 0, lengths + partner, 0)
    return int(sums.max())


def reduce_dominated(runs: _Runs, capacity: int) -> None:
    """Fix sets of at most three items that dominate every other set with their
    longest item: alone when nothing fits beside it; with the item that fills the
    sequence; with the largest fitting item when no two others fit, or when any two
    that fit could stand in that item's place; with the largest fitting item and
    the largest that still fits, when every pair that fits is no better."""
    changed = True
    while changed:
        changed = False
        for a in range(capacity, 0, -1):
            while runs.left[a] > 0:
                left, room = runs.left, capacity - a
                fits = np.flatnonzero(left[1 : room + 1]) + 1
                if a <= room and left[a] == 1:
                    fits = fits[fits != a]
                if not len(fits):
                    runs.fix([a], int(left[a]))
                    changed = True
                    break
                k = int(fits[-1])
                n = int(left[a]) // 2 if k == a else int(min(left[a], left[k]))
                small = _smallest(left, a, 3)
                only = k == room or len(small) < 2 or small[0] + small[1] > room
                if not only and (len(small) < 3 or sum(small) > room):
                    if _best_pair(left, a, room) <= k:
                        only = True
                    else:
                        after = fits[fits <= room - k]
                        after = after[left[after] > (after == k).astype(int) + (after == a).astype(int)]
                        if len(after):
                            s = int(after[-1])
                            if len({a, k, s}) == 3 and _best_pair(left, a, room, above=s) <= k:
                                runs.fix([a, k, s], int(min(n, left[s])))
                                changed = True
                                continue
                if not only:
                    break
                runs.fix([a, k], n)
                changed = True


def best_fit(runs: _Runs, capacity: int) -> None:
    """Pack what is left best-fit, longest first.  ``groups[r]`` holds intervals of
    open sequences with ``r`` free places."""
    groups: dict[int, list[tuple[int, int]]] = {}
    for length in range(capacity, 0, -1):
        while runs.left[length] > 0:
            n = int(runs.left[length])
            room = min((r for r in groups if r >= length), default=None)
            if room is None:
                per = capacity // length
                first, count, room = runs.open(-(-n // per)), -(-n // per), capacity
            else:
                first, count = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                per = room // length
            full = min(count, n // per)
            if full:
                runs.place(length, full * per, first, per, capacity - room)
                groups.setdefault(room - per * length, []).append((first, full))
            rest = n - full * per
            if full < count and 0 < rest < per:
                runs.place(length, rest, first + full, rest, capacity - room)
                groups.setdefault(room - rest * length, []).append((first + full, 1))
                full += 1
            if full < count:
                groups.setdefault(room, []).append((first + full, count - full))


def plan_runs(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, items, first sequence, per sequence, offset)."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    runs = _Runs(counts)
    reduce_dominated(runs, capacity)
    best_fit(runs, capacity)
    out = np.array(runs.rows, np.int64).reshape(-1, 6)
    return out[np.lexsort((out[:, 1], out[:, 0]))]


# ------------------------------------------------------------- on the cluster


def pack(items: DataFrame, keys: list[str], length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``.  ``keys`` identify an item; a
    length is in 1..capacity.  ``items`` is read twice, so pass a staged table.

    Ranks within a length come from a salted window plus the sums of the salts
    before, so a length that holds a third of all rows is ranked by many tasks."""
    spark = items.sparkSession
    salts = shuffle_partitions(spark)
    n_len, n_salt, n_off, n_rank = "__len", "__salt", "__before", "__rank"
    tagged = items.withColumns(
        {n_len: F.col(length).cast("int"), n_salt: F.pmod(F.xxhash64(*keys), F.lit(salts)).cast("int")}
    )
    sizes = tagged.groupBy(n_len, n_salt).agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(n_len).orderBy(n_salt).rowsBetween(W.unboundedPreceding, -1)
    offsets = staged(
        sizes.withColumn(n_off, F.coalesce(F.sum("__n").over(before), F.lit(0).cast("long"))), "pack-sizes"
    )
    histogram = {r[n_len]: r["n"] for r in offsets.groupBy(n_len).agg(F.sum("__n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(plan_runs(histogram, capacity))

    own = W.partitionBy(n_len, n_salt).orderBy(*keys)
    ranked = (
        tagged.withColumn(n_rank, F.row_number().over(own).cast("long") - 1)
        .join(offsets.select(n_len, n_salt, n_off), [n_len, n_salt])
        .withColumn(n_rank, F.col(n_rank) + F.col(n_off))
        .select(*items.columns, n_len, n_rank)
    )

    def place(batches):
        table = runs.value
        key = table[:, 0] * np.int64(1 << 48) + table[:, 1]
        for b in batches:
            lens = b.column(n_len).to_numpy().astype(np.int64)
            rank = b.column(n_rank).to_numpy()
            run = table[np.searchsorted(key, lens * np.int64(1 << 48) + rank, side="right") - 1]
            t = rank - run[:, 1]
            seq = run[:, 3] + t // run[:, 4]
            off = run[:, 5] + (t % run[:, 4]) * lens
            cols = b.columns[: b.num_columns - 2] + [pa.array(seq), pa.array(off)]
            yield pa.RecordBatch.from_arrays(cols, names=[*b.schema.names[:-2], "sequence_id", "offset"])

    from pyspark.sql import types as T

    schema = T.StructType(
        [*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return ranked.mapInArrow(place, schema)


def token_pieces(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 and, on request,
    the ids themselves (little-endian unsigned 32-bit)."""
    end = np.asarray([END_ID], "<u4").tobytes()

    def cut(batches):
        tokenizer = word_tokenizer()
        for b in (part for whole in batches for part in slices(whole, "text")):
            rows = []
            for i, text in zip(b.column(0), texts(b.column(1)), strict=True):
                ids = tokenizer.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((i.as_py(), piece, at // 4, len(part) // 4, zlib.crc32(part), part))
            ids_, piece_, start_, length_, crc_, part_ = zip(*rows, strict=True) if rows else [()] * 6
            cols = [
                pa.array(ids_, b.schema.field(0).type),
                pa.array(piece_, pa.int32()),
                pa.array(start_, pa.int64()),
                pa.array(length_, pa.int64()),
                pa.array(crc_, pa.int64()),
            ]
            if with_ids:
                cols.append(pa.array(part_, pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, schema)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack ``docs`` (columns doc_id, text; others are ignored)."""
    pieces = staged(token_pieces(docs, capacity=capacity, with_ids=with_ids), "pack-pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], "length", capacity)
