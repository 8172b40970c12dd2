"""Near-duplicate groups by ProbMinHash, banding and verification (operator 9).

Texts are sets of five-word shingles; how often a shingle repeats inside a text does
not count.

1. *Sketch.*  Each shingle is a Poisson process of arrivals with its weight as rate
   (1 for every shingle of a set), driven by its hash; an arrival picks one of ``K``
   components at random, and a component keeps the shingle that arrives first.
   Arrivals are drawn round by round and a shingle stops as soon as its next arrival
   comes after every component's first.  Two texts agree in a component with the
   probability Jaccard similarity of their weighted shingles; with equal weights that
   is the Jaccard similarity of the sets, which step 4 verifies.
2. *Copies.*  Texts with the same shingles collapse to the one with the smallest id
   by a pre-aggregated minimum, so groups of copies never meet in a bucket.
3. *Bands.*  ``BANDS`` groups of ``ROWS`` components make bucket keys.  Of a bucket only
   pairs with its pivot, the smallest member, are formed.
4. *Verify.*  Exact Jaccard similarity of the shingle sets; pairs of ``SIMILARITY`` or
   more are links, whose components are found by star contraction.
5. *The rest, exactly.*  Members of a bucket that are not in its pivot's component
   are compared with the members of other components, unless the triangle
   inequality of the Jaccard distance to the pivot already excludes a link.  This
   happens in blocks of bounded size through an inverted index of the block, which
   gives back one link for each component reached, never pairs.  No link between
   bucket members of different components is lost, and a group of near copies costs
   one comparison for each member.

Defined results: a null text or one without words is alone in its class; a text of
one to four words has one shingle of all its words; a row without id is not
compared (class null, kept); rows that repeat an id share its class; an empty table
gives an empty result; other columns pass through untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.llm.common import mix64, slices, staged
from feedsync.llm.components import components
from feedsync.llm.shingles import run_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 25, 5
K = BANDS * ROWS
BLOCK = 256  # rows of either side that one task compares

# Odd constants of the arrival and component streams.
_ARRIVAL, _CHOICE = 0x9E3779B97F4A7C15, np.uint64(0xC2B2AE3D27D4EB4F)


def shingle_sets(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, shingles of each text): distinct and sorted within a text."""
    lengths = np.array([len(t) for t in texts], np.int64)
    words, counts = word_hashes(b"".join(texts), lengths)
    h, whole = run_hashes(words, counts, SHINGLE)
    doc = np.repeat(np.arange(len(texts)), counts)
    first = np.cumsum(counts) - counts
    h, doc = h[whole], doc[whole]
    for n in range(1, SHINGLE):  # short texts
        short = np.flatnonzero(counts == n)
        if len(short):
            h = np.concatenate([h, run_hashes(words, counts, n, seed=n)[0][first[short]]])
            doc = np.concatenate([doc, short])
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])] if len(h) else np.zeros(0, bool)
    return h[new], np.bincount(doc[new], minlength=len(texts))


def prob_minhash(shingles: np.ndarray, weights: np.ndarray, sizes: np.ndarray, k: int = K) -> np.ndarray:
    """Sketches of ``k`` components, one row for each text (zero if it has no shingles)."""
    n = len(sizes)
    first = np.full(n * k, np.inf)
    sketch = np.zeros(n * k, np.uint64)
    latest = np.full(n, np.inf)  # of each text, the last component's first arrival
    doc = np.repeat(np.arange(n), sizes)
    d, rate, time = shingles, weights, np.zeros(len(shingles))
    round_ = 0
    while len(d):
        round_ += 1
        draw = mix64(d + np.uint64(round_ * _ARRIVAL % (1 << 64)))
        uniform = (draw >> np.uint64(11)) * 2.0**-53
        time = time - np.log1p(-uniform) / rate
        live = time < latest[doc]
        d, rate, time, doc, draw = d[live], rate[live], time[live], doc[live], draw[live]
        if not len(d):
            break
        at = doc * k + ((mix64(draw ^ _CHOICE) >> np.uint64(32)) * np.uint64(k) >> np.uint64(32)).astype(np.int64)
        np.minimum.at(first, at, time)
        won = time == first[at]
        sketch[at[won]] = d[won]
        active = doc[np.r_[True, doc[1:] != doc[:-1]]]
        latest[active] = first.reshape(n, k)[active].max(axis=1)
    return sketch.reshape(n, k)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """A bucket key for each text and band."""
    parts = sketch.reshape(len(sketch), BANDS, ROWS)
    keys = np.zeros((len(sketch), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mix64(keys ^ parts[:, :, r])
    return mix64(keys + np.arange(1, BANDS + 1, dtype=np.uint64)[None]).view(np.int64)


def _blocks(batches):
    """(ids, texts as bytes) a few MB at a time."""
    for b in (part for whole in batches for part in slices(whole, "raw", rows=2048)):
        yield b.column("id"), [t or b"" for t in b.column("raw").to_pylist()]


def _sketches(batches):
    for ids, raw in _blocks(batches):
        shingles, sizes = shingle_sets(raw)
        keys = band_keys(prob_minhash(shingles, np.ones(len(shingles)), sizes))
        sums = []
        for seed in (1, 2):  # equal sets have equal sums of mixed hashes
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(shingles ^ np.uint64(seed)), dtype=np.uint64)])
            ends = np.cumsum(sizes)
            sums.append((total[ends] - total[ends - sizes]).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [
                ids,
                pa.array(sizes.astype(np.int64)),
                pa.array(sums[0]),
                pa.array(sums[1]),
                pa.ListArray.from_arrays(np.arange(len(raw) + 1) * BANDS, pa.array(keys.ravel())),
            ],
            names=["id", "n", "k1", "k2", "bands"],
        )


def _sets(batches):
    for ids, raw in _blocks(batches):
        shingles, sizes = shingle_sets(raw)
        ends = np.cumsum(sizes)
        packed = [shingles[e - n : e].tobytes() for e, n in zip(ends, sizes, strict=True)]
        yield pa.RecordBatch.from_arrays([ids, pa.array(packed, pa.binary())], names=["id", "shingles"])


def _distances(batches):
    for b in batches:
        distance = []
        for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            distance.append(1 - both / max(len(x) + len(y) - both, 1))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(distance, pa.float64())], names=["a", "b", "d"]
        )


def _pair_distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, d): the exact Jaccard distance of each pair's shingle sets."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(
        _distances, "a long, b long, d double"
    )


def _block_links(table: pa.Table, similarity: float) -> pa.Table:
    """Of one block: for each text set apart, a link to each other component it reaches."""
    apart = np.array(table.column("apart").to_pylist(), bool)
    ids, own = table.column("rep").to_numpy(), table.column("own").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in table.column("shingles").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    others = np.flatnonzero(~apart)
    found = []
    if len(others):
        shingles = np.concatenate([sets[i] for i in others])
        owner = np.repeat(np.arange(len(others)), sizes[others])
        order = np.argsort(shingles, kind="stable")
        shingles, owner = shingles[order], owner[order]
        for i in np.flatnonzero(apart):
            first = np.searchsorted(shingles, sets[i])
            n = np.searchsorted(shingles, sets[i], side="right") - first
            at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            both = np.bincount(owner[at], minlength=len(others))
            close = both >= similarity * (sizes[i] + sizes[others] - both) - 1e-9
            close &= own[others] != own[i]
            reached = others[close]
            _, one = np.unique(own[reached], return_index=True)
            found += [(int(ids[i]), int(ids[r])) for r in reached[one]]
    return pa.table(
        {"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())}
    )


def _remaining_links(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between bucket members of different components that the pivots did not
    show.  ``placed``: bucket, rep, own, main, d (distance to the pivot), no pivots."""
    reach = 1 - similarity + 1e-9
    farthest = placed.groupBy("bucket").agg(
        F.max(F.struct("d", "rep")).alias("far"), F.max(F.col("own") != F.col("main")).alias("open")
    )
    rows = placed.join(farthest.filter("open"), "bucket")
    second = rows.filter("rep <> far.rep").groupBy("bucket").agg(F.max("d").alias("second"))
    # a text apart is compared if some other member is far enough from the pivot, a
    # member if it is far enough for the nearest of those
    rows = rows.join(second, "bucket").withColumn(
        "apart",
        (F.col("own") != F.col("main"))
        & (F.col("d") - reach <= F.when(F.col("rep") == F.col("far.rep"), F.col("second")).otherwise(F.col("far.d"))),
    )
    rows = staged(rows.select("bucket", "rep", "own", "d", "apart"), "neardup-open")
    sizes = rows.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("apart").alias("n_apart"), F.min(F.when(F.col("apart"), F.col("d"))).alias("least")
    )
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    sizes = sizes.filter("n_apart > 0").select(
        "bucket", "least", blocks("n").alias("other_blocks"), blocks("n_apart").alias("apart_blocks")
    )
    rows = rows.join(sizes, "bucket").filter(F.col("d") >= F.col("least") - reach)
    mine = lambda n: F.pmod(F.xxhash64("rep"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    apart = rows.filter("apart").select(
        "bucket", "rep", "own", F.lit(True).alias("apart"), mine("apart_blocks").alias("i"), every("other_blocks").alias("j")
    )
    others = rows.select(
        "bucket", "rep", "own", F.lit(False).alias("apart"), mine("other_blocks").alias("j"), every("apart_blocks").alias("i")
    )

    def compare(table: pa.Table) -> pa.Table:
        return _block_links(table, similarity)

    named = sets.withColumnRenamed("id", "rep")
    return (
        apart.unionByName(others).join(named, "rep").groupBy("bucket", "i", "j").applyInArrow(compare, "a long, b long")
    )


def near_duplicate_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY
) -> DataFrame:
    """One row per row of ``docs`` with an id: the id, ``class_id`` (the smallest id that
    its links reach) and ``kept`` (whether it is that one)."""
    reach = 1 - similarity + 1e-12
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), raw.alias("raw")).filter("id IS NOT NULL")
    sketches = staged(
        texts.mapInArrow(_sketches, "id long, n long, k1 long, k2 long, bands array<long>"), "neardup-sketches"
    )
    some = sketches.filter("n > 0")
    reps = some.groupBy("k1", "k2").agg(F.min("id").alias("rep"), F.min_by("bands", "id").alias("bands"))
    reps = staged(reps, "neardup-reps")
    members = reps.select("rep", F.explode("bands").alias("bucket"))
    pivots = (
        members.groupBy("bucket")
        .agg(F.min("rep").alias("pivot"), F.count(F.lit(1)).alias("size"))
        .filter("size > 1")
        .select("bucket", "pivot")
    )
    in_bucket = staged(members.join(pivots, "bucket").distinct(), "neardup-buckets")

    pairs = in_bucket.filter("rep <> pivot").select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    pairs = staged(pairs, "neardup-candidates")
    named = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct()
    # the texts are shuffled whatever the number of candidates, so cost follows the input
    sets = staged(
        texts.join(named.hint("merge"), "id", "left_semi")
        .select("id", "raw")
        .mapInArrow(_sets, "id long, shingles binary"),
        "neardup-sets",
    )
    first = staged(_pair_distances(pairs, sets), "neardup-pairs")
    links = first.filter(F.col("d") <= reach).select("a", "b")
    found = staged(components(links, "a", "b"), "neardup-components")

    def component(df: DataFrame, node: str, name: str) -> DataFrame:
        known = found.select(F.col("node").alias(node), F.col("component").alias(name))
        return df.join(known, node, "left").withColumn(name, F.coalesce(name, node))

    placed = component(component(in_bucket.filter("rep <> pivot"), "rep", "own"), "pivot", "main")
    placed = placed.join(first.select(F.col("a").alias("pivot"), F.col("b").alias("rep"), "d"), ["pivot", "rep"])
    more = staged(_remaining_links(placed, sets, similarity), "neardup-rest")
    if not more.isEmpty():
        found = staged(components(links.unionByName(more), "a", "b"), "neardup-components")

    classes = component(reps.select("k1", "k2", "rep"), "rep", "class_id").select("k1", "k2", "class_id")
    return (
        sketches.select("id", "n", "k1", "k2")
        .join(classes, ["k1", "k2"], "left")
        .withColumn("class_id", F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("id")))
        .select(F.col("id").alias(id_col), "class_id", (F.col("id") == F.col("class_id")).alias("kept"))
    )


def _row_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, bool]:
    """(``docs`` with ``__row``, whether ids repeat): the id, or, where several rows share
    it, a number from the id and the text, above every ordinary id.  Unique ids cost one
    count of ids."""
    own = F.col(id_col).cast("long")
    counts = docs.groupBy(own.alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    repeated = staged(counts.filter("__n > 1 AND __id IS NOT NULL").select("__id"), "neardup-repeated")
    if repeated.isEmpty():
        return docs.withColumn("__row", own), False
    by_text = F.xxhash64(own, F.col(text_col)).bitwiseOR(F.lit(1 << 62)).bitwiseAND(F.lit((1 << 63) - 1))
    marked = docs.join(repeated, own == F.col("__id"), "left")
    return marked.withColumn("__row", F.when(F.col("__id").isNull(), own).otherwise(by_text)).drop("__id"), True


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` but for near duplicates of a row with a smaller id.  Rows that
    share an id count by their texts, so an unrelated text stays; rows without an id
    stay."""
    keyed, repeats = _row_keys(docs, id_col, text_col)
    found = near_duplicate_classes(keyed.select("__row", text_col), "__row", text_col)
    if repeats:  # a class's smallest id need not be its smallest row
        ids = keyed.select("__row", F.col(id_col).cast("long").alias("__id")).distinct()
        found = staged(found.select("__row", "class_id").distinct().join(ids, "__row"), "neardup-rows")
        low = found.groupBy("class_id").agg(F.min("__id").alias("__low"))
        gone = found.join(low, "class_id").filter("__id > __low").select("__row")
    else:
        gone = found.filter(~F.col("kept")).select("__row")
    return keyed.join(gone.distinct(), "__row", "left_anti").select(*(F.col(_quoted(c)) for c in docs.columns))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
