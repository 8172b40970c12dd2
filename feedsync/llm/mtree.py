"""Exact top-k inner-product search with M-trees (operator 1).

Inner products become distances: with ``M`` the largest norm, the vector ``x`` is
given one more coordinate ``sqrt(M^2 - |x|^2)`` and a query a zero there, so
``d^2 = |q|^2 + M^2 - 2 q.x`` and the nearest vectors are those of the highest
score.  Vectors are small integers, so scores are exact.

The index is a table of subtrees.  Up to ``MAX_PIVOTS`` routing vectors (a bounded
sample) split the data into metric regions; a region with more than ``shard_rows``
rows, such as one vector repeated very often, is cut by a hash into several
subtrees.  A subtree is an M-tree of paged nodes: each node has a routing vector, a
covering radius, its distance to its parent's routing vector, and in a leaf the
entries' distances to the routing vector, sorted.

A query first searches the subtree of its nearest routing vector, best-first.  The
k-th distance found bounds the rest: only regions that the bound reaches are
searched, in blocks of queries joined with the subtrees.  Inside, nodes are taken
from a heap by lower bound; a child whose stored parent distance proves it too far
is skipped without computing its distance, and a leaf computes only the entries
whose stored distances leave them possible.

Defined results: vectors that are null or hold null or non-finite components, or one
whose integer reaches ``LIMIT`` (a component of 65,536 at scale 64; scores would not be
exact), and rows without id, take no part; shorter vectors count as padded with zeros; rows
that repeat an id count once, with the smallest vector; ties go to the smaller id;
a query gets all candidates if there are fewer than k; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedsync.llm.common import staged

MAX_PIVOTS = 1024
SHARD_ROWS = 8192
PAGE = 1024
FAN_OUT = 16
QUERY_BLOCK = 1024
# Integer components stay below this, so every score of up to 512 dimensions is exact.
LIMIT = 1 << 22
# Below this squared norm every product and partial sum is an integer that a
# 32-bit float holds exactly.
EXACT32 = float(1 << 24)


def _slack(top: float) -> float:
    """Bounds never cut what equals the k-th distance: a squared distance is off by some
    rounding errors of ``top``, the largest squared norm, a distance by their root."""
    return 1e-6 * max(1.0, top**0.5)


def quantised(vectors: DataFrame, vec_col: str, scale: int = 64, id_col: str = "vec_id") -> DataFrame:
    """(vec_id, q): ``floor(scale * x)`` of each component, bad vectors left out."""
    x = F.col(vec_col)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) * scale < LIMIT))
    q = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    return (
        vectors.filter(x.isNotNull() & fine & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("vec_id"))
        .agg(F.min(q).alias("q"))
    )


def _norm2(q: Column) -> Column:
    return F.aggregate(q, F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims).astype(np.float64)
    out = np.zeros((len(lengths), dims))
    at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), at] = flat
    return out


# ------------------------------------------------------------------ one subtree


@dataclass
class Node:
    routing: int  # row of the routing vector
    radius: float
    parent: float  # distance to the parent's routing vector
    start: int = 0  # rows of a leaf
    end: int = 0
    children: list["Node"] = field(default_factory=list)


class MTree:
    """An M-tree over integer vectors, built in bulk."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, top: float):
        self.top = top  # M^2
        self.ids, self.x = ids, x
        self.lift = np.sqrt(np.maximum(top - (x * x).sum(1), 0))
        self.order: list[np.ndarray] = []
        self.stored: list[np.ndarray] = []
        self.filled = 0
        rows = np.arange(len(ids))
        self.root = self._build(rows, int(rows[0]), 0.0) if len(rows) else None
        if len(rows):
            order = np.concatenate(self.order)
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            self._renumber(self.root, place)
            self.ids, self.x, self.lift = ids[order], x[order], self.lift[order]
            self.to_routing = np.concatenate(self.stored)
        del self.order, self.stored
        # what best-first search needs of a node's children, as arrays
        self._pack(self.root)

    def _between(self, rows: np.ndarray, row: int) -> np.ndarray:
        dot = self.x[rows] @ self.x[row] + self.lift[rows] * self.lift[row]
        return np.sqrt(np.maximum(2 * self.top - 2 * dot, 0))

    def _build(self, rows: np.ndarray, routing: int, parent: float) -> Node:
        d = self._between(rows, routing)
        node = Node(routing, float(d.max()), parent)
        if len(rows) <= PAGE:
            order = np.argsort(d, kind="stable")
            node.start, node.end = self.filled, self.filled + len(rows)
            self.filled = node.end
            self.order.append(rows[order])
            self.stored.append(d[order])
            return node
        picks = rows[np.linspace(0, len(rows) - 1, FAN_OUT).astype(int)]
        near = np.argmin(np.stack([self._between(rows, int(p)) for p in picks]), axis=0)
        parts = [rows[near == i] for i in range(FAN_OUT)]
        if max(map(len, parts)) == len(rows):  # equal vectors: pages of one routing vector
            parts = [rows[i : i + PAGE] for i in range(0, len(rows), PAGE)]
            picks = [int(p[0]) for p in parts]
        for pick, part in zip(picks, parts, strict=True):
            if len(part):
                up = float(self._between(np.asarray([pick]), routing)[0])
                node.children.append(self._build(part, int(pick), up))
        return node

    def _renumber(self, node: Node, place: np.ndarray) -> None:
        node.routing = int(place[node.routing])
        for c in node.children:
            self._renumber(c, place)

    def _pack(self, node: Node | None) -> None:
        if node is not None and node.children:
            node.radii = np.array([c.radius for c in node.children])
            node.ups = np.array([c.parent for c in node.children])
            node.at = np.array([c.routing for c in node.children])
            for c in node.children:
                self._pack(c)

    def search(self, query: np.ndarray, own: int | None, k: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` within distance ``bound``; ``own`` is left out."""
        best_ids, best = np.zeros(0, np.int64), np.zeros(0)
        if self.root is None:
            return best_ids, best
        base = float(query @ query) + self.top
        if self.x.dtype == np.float32:
            query = query.astype(np.float32)

        def distance(rows):
            return np.sqrt(np.maximum(base - 2 * (self.x[rows] @ query).astype(np.float64), 0))

        d_root = float(distance(np.asarray([self.root.routing]))[0])
        heap = [(max(d_root - self.root.radius, 0.0), 0, d_root, self.root)]
        pushed, reach = 1, bound + _slack(self.top)
        while heap:
            low, _, d, node = heapq.heappop(heap)
            if low > reach:
                break
            if node.children:
                able = np.flatnonzero(np.abs(d - node.ups) - node.radii <= reach)
                if not len(able):
                    continue
                dc = distance(node.at[able])
                lows = np.maximum(dc - node.radii[able], 0)
                for i in np.flatnonzero(lows <= reach):
                    heapq.heappush(heap, (float(lows[i]), pushed, float(dc[i]), node.children[able[i]]))
                    pushed += 1
                continue
            stored = self.to_routing[node.start : node.end]
            i = node.start + int(np.searchsorted(stored, d - reach))
            j = node.start + int(np.searchsorted(stored, d + reach, side="right"))
            if i >= j:
                continue
            scores = self.x[i:j] @ query
            ids = self.ids[i:j]
            if len(best) == k:
                keep = scores >= best[-1]
                scores, ids = scores[keep], ids[keep]
            if own is not None:
                other = ids != own
                scores, ids = scores[other], ids[other]
            if not len(ids):
                continue
            best_ids, best = np.concatenate([best_ids, ids]), np.concatenate([best, scores.astype(np.float64)])
            order = np.lexsort((best_ids, -best))[:k]
            best_ids, best = best_ids[order], best[order]
            if len(best) == k:
                reach = min(reach, float(np.sqrt(max(base - 2 * best[-1], 0))) + _slack(self.top))
        return best_ids, best


# ------------------------------------------------------------------ the index


@dataclass
class Index:
    subtrees: DataFrame  # shard, tree
    pivots: np.ndarray  # routing vectors of the regions
    radii: np.ndarray
    first: np.ndarray  # first shard of each region
    subs: np.ndarray  # shards of each region
    dims: int
    top: float  # M^2


def _to_pivots(x: np.ndarray, pivots: np.ndarray, top: float, lifted: bool) -> np.ndarray:
    """Distances of rows (vectors, or queries if not ``lifted``) to the pivots."""
    norms = (x * x).sum(1)
    dot = x @ pivots.T
    if not lifted:
        return np.sqrt(np.maximum(norms[:, None] + top - 2 * dot, 0))
    up = np.sqrt(np.maximum(top - norms, 0))
    pivot_up = np.sqrt(np.maximum(top - (pivots * pivots).sum(1), 0))
    return np.sqrt(np.maximum(2 * top - 2 * (dot + up[:, None] * pivot_up[None]), 0))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> Index:
    """Index ``vectors`` (vec_id, q).  They are read three times: pass a staged table."""
    n, dims, top = vectors.agg(F.count(F.lit(1)), F.max(F.size("q")), F.max(_norm2(F.col("q")))).first()
    dims, top = max(int(dims or 0), 1), float(top or 0)
    want = min(MAX_PIVOTS, max(1, -(-n // shard_rows)))
    sample = [r["q"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * want).collect()]
    distinct = list(dict.fromkeys(tuple(q) for q in sample))[:want] or [()]
    pivots = np.zeros((len(distinct), dims))
    for i, q in enumerate(distinct):
        pivots[i, : len(q)] = q

    def assign(batches):
        for b in batches:
            d = _to_pivots(_matrix(b.column(1), dims), pivots, top, True)
            near = np.argmin(d, axis=1) if len(d) else np.zeros(0, int)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(near.astype(np.int32)), pa.array(d[np.arange(len(d)), near])],
                names=["vec_id", "q", "pivot", "d"],
            )

    assigned = staged(vectors.mapInArrow(assign, "vec_id long, q array<long>, pivot int, d double"), "mtree-regions")
    radii, subs = np.zeros(len(pivots)), np.ones(len(pivots), np.int64)
    for r in assigned.groupBy("pivot").agg(F.max("d").alias("r"), F.count(F.lit(1)).alias("n")).collect():
        radii[r["pivot"]], subs[r["pivot"]] = r["r"], max(1, -(-r["n"] // shard_rows))
    first = np.cumsum(subs) - subs
    spark = vectors.sparkSession
    regions = spark.createDataFrame(
        [(i, int(first[i]), int(subs[i])) for i in range(len(pivots))], "pivot int, first long, subs long"
    )

    def build(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
        x = _matrix(table.column("q"), dims)[order]
        tree = MTree(table.column("vec_id").to_numpy()[order], x, top)
        tree.x = tree.x.astype(np.int32) if np.abs(tree.x).max(initial=0) < 2**31 else tree.x
        return pa.table(
            {"shard": table.column("shard").slice(0, 1), "tree": pa.array([pickle.dumps(tree)], pa.binary())}
        )

    subtrees = (
        assigned.join(F.broadcast(regions), "pivot")
        .select((F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("subs"))).alias("shard"), "vec_id", "q")
        .groupBy("shard")
        .applyInArrow(build, "shard long, tree binary")
    )
    return Index(staged(subtrees, "mtree-subtrees"), pivots, radii, first, subs, dims, top)


def _search_blocks(index: Index, routed: DataFrame, blocks: int, k: int, exclude_self: bool) -> DataFrame:
    """Search each routed row (query_id, q, shard, bound) in its shard."""
    packed = (
        routed.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
        .groupBy("shard", "block")
        .agg(F.collect_list(F.struct("query_id", "q", "bound")).alias("queries"))
    )
    dims = index.dims

    def search(batches):
        for b in batches:
            for trees, queries in zip(b.column("tree").to_pylist(), b.column("queries"), strict=True):
                tree = pickle.loads(trees)
                rows = queries.values
                ids = rows.field("query_id").to_numpy()
                x = _matrix(rows.field("q"), dims)
                largest = max(tree.top, float((x * x).sum(1).max(initial=0)))
                tree.x = tree.x.astype(np.float32 if largest < EXACT32 else np.float64)
                bounds = rows.field("bound").to_numpy()
                found = [
                    tree.search(x[i], int(ids[i]) if exclude_self else None, k, float(bounds[i]))
                    for i in range(len(ids))
                ]
                sizes = [len(f[0]) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(ids, sizes)),
                        pa.array(np.concatenate([f[0] for f in found]).astype(np.int64)),
                        pa.array(np.rint(np.concatenate([f[1] for f in found])).astype(np.int64)),
                    ],
                    names=["query_id", "vec_id", "score"],
                )

    return (
        packed.join(index.subtrees, "shard")
        .select("tree", "queries")
        .mapInArrow(search, "query_id long, vec_id long, score long")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    w = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def search(index: Index, queries: DataFrame, k: int = 20, exclude_self: bool = True) -> DataFrame:
    """The ``k`` best vectors of each query (vec_id, q): query_id, rank, vec_id, score.
    ``queries`` is read twice: pass a staged table."""
    pivots, radii, first, subs, dims, top = (
        index.pivots,
        index.radii,
        index.first,
        index.subs,
        index.dims,
        index.top,
    )
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    queries = queries.select(F.col("vec_id").alias("query_id"), "q")

    def home(x: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        d = _to_pivots(x, pivots, top, False)
        near = np.argmin(d, axis=1) if len(d) else np.zeros(0, int)
        return d, first[near] + ids % subs[near]

    def nearest(batches):
        for b in batches:
            _, shard = home(_matrix(b.column(1), dims), b.column(0).to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(shard.astype(np.int64)), pa.array(np.full(len(shard), np.inf))],
                names=["query_id", "q", "shard", "bound"],
            )

    routed_schema = "query_id long, q array<long>, shard long, bound double"
    seed = staged(
        _best(_search_blocks(index, queries.mapInArrow(nearest, routed_schema), blocks, k, exclude_self), k),
        "mtree-seed",
    )
    # the k-th score so far; without k rows nothing is bounded
    kth = seed.groupBy("query_id").agg(F.min("score").alias("kth"), F.count(F.lit(1)).alias("n"))
    bounded = queries.join(kth, "query_id", "left").select(
        "query_id", "q", F.when(F.col("n") >= k, F.col("kth")).cast("double").alias("kth")
    )

    def reached(batches):
        region = np.repeat(np.arange(len(subs)), subs)  # of each shard
        for b in batches:
            x, ids = _matrix(b.column(1), dims), b.column(0).to_numpy()
            d, own = home(x, ids)
            kths = b.column(2).to_numpy(zero_copy_only=False)
            bound = np.sqrt(np.maximum((x * x).sum(1) + top - 2 * kths, 0))
            bound = np.where(np.isnan(bound), np.inf, bound)
            able = (d - radii[None] <= bound[:, None] + _slack(top))[:, region]
            able[np.arange(len(ids)), own] = False
            row, shard = np.nonzero(able)
            for i in range(0, len(row), 10_000):
                r = pa.array(row[i : i + 10_000])
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(r),
                        b.column(1).take(r),
                        pa.array(shard[i : i + 10_000].astype(np.int64)),
                        pa.array(bound[row[i : i + 10_000]]),
                    ],
                    names=["query_id", "q", "shard", "bound"],
                )

    rest = _search_blocks(index, bounded.mapInArrow(reached, routed_schema), blocks, k, exclude_self)
    return _best(seed.drop("rank").unionByName(rest), k).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, vec_col: str = "embedding") -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``; candidates all others."""
    table = staged(quantised(vectors, vec_col), "mtree-vectors")
    return search(build_index(table), table.filter(F.col("vec_id") % every == 0), k)
