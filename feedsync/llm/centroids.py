"""Centroid clustering over subvector dictionaries (operator 11).

The components of a vector become integers, ``floor(scale * x)``.  Vectors are kept
in pages of up to ``PAGE_ROWS``.  In a page each block of ``BLOCK_DIMS`` dimensions
is dictionary-encoded without loss: its distinct subvectors once, and a code for each
vector.  The pages are written once; a round reads them back and computes, for each
dictionary entry, its exact squared distance to that block of every centroid.  A
vector's distances are then sums of table entries, picked by its codes.

A dictionary belongs to a page, as in columnar files, so it is bounded by the page,
whatever the values are.  One dictionary for all data has no size bound, so it could
not be sent to the tasks, and a join with it would shuffle every vector in each round.

A task sums the vectors and counts of each cluster over its pages; what crosses the
network is ``k * dims`` numbers of each task, and the driver sees ``k * dims`` sums.
The centroid of a cluster is the exact ``floor(sum / count)`` of each component.

Initial centroids are the ``k`` rows whose lower-case hex SHA-256 of ``2:<id>`` is
smallest (a running top-k).  Ties in distance go to the smaller centroid number.

Defined results: vectors that are null, have another number of components, or hold
null or non-finite ones take no part.  Nor do vectors with a component of which
``scale * x`` is below ``-LIMIT`` or not below ``LIMIT``: beyond, a squared distance
need not fit 64 bits.  A row without an id takes part with a null id and is an initial
centroid only when no row with one is left; rows that repeat an id each count (among
equal hashes the smaller vector comes first).  With fewer rows than ``k`` there are
fewer centroids; an empty table gives an empty result.  A sum of distances beyond 64
bits is null.  Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsync.llm.common import staged

K = 40
DIMS = 64
ROUNDS = 5
SCALE = 256
BLOCK_DIMS = 2
PAGE_ROWS = 65_536
LIMIT = 1 << 27
STRIPE = 2_048  # vectors whose distances are summed at a time

RESULT = "vec_id long, cluster int, distance long"


def quantised(vectors: DataFrame, vec_col: str, id_col: str, dims: int, scale: int) -> DataFrame:
    """(vec_id, q): the vectors that take part, as integers."""
    x = F.col(vec_col)
    scaled = F.transform(x, lambda v: v.cast("double") * scale)
    # a comparison with NaN or an infinity is false here
    fits = F.forall(scaled, lambda v: v.isNotNull() & ~F.isnan(v) & (v >= -LIMIT) & (v < LIMIT))
    return vectors.filter(x.isNotNull() & (F.size(x) == dims) & fits).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(scaled, lambda v: F.floor(v).cast("int")).alias("q"),
    )


def initial_centroids(rows: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The vectors of the ``k`` smallest hashes of ``seed:id``, in order."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(key.alias("h"), "q").orderBy(F.col("h").asc_nulls_last(), F.col("q")).limit(k)
    return [list(r["q"]) for r in first.collect()]  # k rows


# ------------------------------------------------------------------ pages


def encode_block(sub: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows of ``sub``, code of each row): columns are folded into one rank
    at a time, so any width works in 64 bits."""
    _, code = np.unique(sub[:, 0], return_inverse=True)
    for j in range(1, sub.shape[1]):
        values, rank = np.unique(sub[:, j], return_inverse=True)
        _, code = np.unique(code.astype(np.int64) * len(values) + rank, return_inverse=True)
    entries = np.empty((int(code.max()) + 1, sub.shape[1]), np.int32)
    entries[code] = sub
    return entries, code.astype(np.int32)


def _page(ids: list[pa.Array], rows: list[np.ndarray], width: int) -> pa.RecordBatch:
    x = np.concatenate(rows)
    sizes, entries, codes = [], [], []
    for at in range(0, x.shape[1], width):
        e, c = encode_block(x[:, at : at + width])
        sizes.append(len(e))
        entries.append(e.tobytes())
        codes.append(c.astype("<u2").tobytes() if len(e) <= 1 << 16 else c.tobytes())
    ids = pa.concat_arrays(ids)
    return pa.RecordBatch.from_arrays(
        [
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
            pa.array([sizes], pa.list_(pa.int32())),
            pa.array([entries], pa.list_(pa.binary())),
            pa.array([codes], pa.list_(pa.binary())),
        ],
        names=["ids", "sizes", "entries", "codes"],
    )


PAGE = "ids array<long>, sizes array<int>, entries array<binary>, codes array<binary>"


def pages(rows: DataFrame, dims: int, width: int = BLOCK_DIMS, page_rows: int = PAGE_ROWS) -> DataFrame:
    """The vectors in dictionary-encoded pages."""

    def build(batches):
        ids, held, n = [], [], 0
        for b in batches:
            flat = b.column("q").flatten().to_numpy(zero_copy_only=False)
            x = flat.reshape(-1, dims).astype(np.int32)
            at = 0
            while at < len(x):
                take = min(len(x) - at, page_rows - n)
                ids.append(b.column("vec_id").slice(at, take))
                held.append(x[at : at + take])
                at, n = at + take, n + take
                if n == page_rows:
                    yield _page(ids, held, width)
                    ids, held, n = [], [], 0
        if n:
            yield _page(ids, held, width)

    return rows.mapInArrow(build, PAGE)


class Page:
    """A page as read back."""

    def __init__(self, ids, sizes, entries, codes, dims: int, width: int):
        self.ids, self.dims, self.width = ids, dims, width
        self.codes = [np.frombuffer(c, "<u2" if n <= 1 << 16 else np.int32) for c, n in zip(codes, sizes, strict=True)]
        self.entries = [
            np.frombuffer(e, np.int32).reshape(n, -1).astype(np.int64) for e, n in zip(entries, sizes, strict=True)
        ]

    def assign(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest centroid, squared distance) of each vector."""
        tables, at = [], 0
        for e in self.entries:  # the distances of each distinct subvector, once
            part = centroids[:, at : at + e.shape[1]]
            at += e.shape[1]
            table = np.zeros((len(e), len(centroids)), np.int64)
            for j in range(e.shape[1]):
                gap = e[:, j, None] - part[None, :, j]
                table += gap * gap
            tables.append(table)
        n = len(self.ids)
        nearest, distance = np.empty(n, np.int32), np.empty(n, np.int64)
        for s in range(0, n, STRIPE):
            total = tables[0][self.codes[0][s : s + STRIPE]]
            for table, code in zip(tables[1:], self.codes[1:], strict=True):
                total += table[code[s : s + STRIPE]]
            best = total.argmin(1)  # the first of equals
            nearest[s : s + STRIPE] = best
            distance[s : s + STRIPE] = total[np.arange(len(best)), best]
        return nearest, distance

    def sums(self, nearest: np.ndarray, k: int) -> np.ndarray:
        """Componentwise sums of each cluster: entries times how often the cluster has them."""
        out, at = np.zeros((k, self.dims), np.int64), 0
        for e, code in zip(self.entries, self.codes, strict=True):
            for c in range(k):
                often = np.bincount(code[nearest == c], minlength=len(e))
                out[c, at : at + e.shape[1]] = often @ e
            at += e.shape[1]
        return out


def _read(batch: pa.RecordBatch, dims: int, width: int):
    for r in range(batch.num_rows):
        ids, sizes, entries, codes = (batch.column(c)[r] for c in range(4))
        yield Page(ids.values, sizes.as_py(), entries.as_py(), codes.as_py(), dims, width)


def _totals(paged: DataFrame, centroids: np.ndarray, width: int) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (count, sums)} of one assignment, for the clusters that have rows."""
    k, dims = centroids.shape

    def task(batches):
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            for page in _read(b, dims, width):
                nearest, _ = page.assign(centroids)
                counts += np.bincount(nearest, minlength=k)
                sums += page.sums(nearest, k)
        has = np.flatnonzero(counts)
        flat = np.column_stack([counts[has], sums[has]])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(has, dims + 1), pa.int32()),
                pa.array(np.tile(np.arange(dims + 1), len(has)), pa.int32()),
                pa.array(flat.ravel(), pa.int64()),
            ],
            names=["cluster", "place", "value"],
        )

    parts = paged.mapInArrow(task, "cluster int, place int, value long")
    found: dict[int, list[int]] = {}
    # at most k * (dims + 1) rows
    for r in parts.groupBy("cluster", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():
        found.setdefault(r["cluster"], [0] * (dims + 1))[r["place"]] = int(r["value"])
    return {c: (v[0], v[1:]) for c, v in found.items()}


def _assigned(paged: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    dims = centroids.shape[1]

    def task(batches):
        for b in batches:
            for page in _read(b, dims, width):
                nearest, distance = page.assign(centroids)
                yield pa.RecordBatch.from_arrays(
                    [page.ids, pa.array(nearest, pa.int32()), pa.array(distance, pa.int64())],
                    names=["vec_id", "cluster", "distance"],
                )

    return paged.mapInArrow(task, RESULT)


def cluster(
    vectors: DataFrame,
    vec_col: str = "embedding",
    id_col: str = "vec_id",
    k: int = K,
    dims: int = DIMS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    seed: str = "2",
    width: int = BLOCK_DIMS,
    page_rows: int = PAGE_ROWS,
) -> tuple[DataFrame, list[list[int]]]:
    """((vec_id, cluster, distance) of every vector that takes part, the centroids)."""
    spark = vectors.sparkSession
    rows = quantised(vectors, vec_col, id_col, dims, scale)
    start = initial_centroids(rows, k, seed)
    if not start:
        return spark.createDataFrame([], RESULT), []
    paged = staged(pages(rows, dims, width, page_rows), "vector-pages")
    centroids = [[int(v) for v in c] for c in start]
    for _ in range(rounds):
        totals = _totals(paged, np.array(centroids, np.int64), width)
        moved = [[s // totals[c][0] for s in totals[c][1]] if c in totals else old for c, old in enumerate(centroids)]
        if moved == centroids:  # later rounds would repeat this one
            break
        centroids = moved
    return staged(_assigned(paged, np.array(centroids, np.int64), width), "vector-clusters"), centroids


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_report(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    spark: SparkSession = vectors.sparkSession
    found, centroids = cluster(vectors, **options)
    columns = "cluster int, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string"
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    by_cluster = {r["cluster"]: r["s"] for r in sums.collect()}  # k rows at most
    total = sum(by_cluster.values())
    summary = spark.createDataFrame(
        [(c, s, total, centroid_digest(centroids[c])) for c, s in by_cluster.items()], columns
    )
    return found.join(F.broadcast(summary), "cluster").select(  # k rows at most
        "vec_id",
        "cluster",
        "distance",
        *(F.expr(f"try_cast({c} AS bigint)").alias(c) for c in ("cluster_inertia", "inertia")),
        "centroid_sha256",
    )
