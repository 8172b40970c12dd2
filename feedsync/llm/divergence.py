"""Source divergence audit by count cells (operator 13).

A language's terms are compared between each of its sources and the language, and
between its sources.  A term's smoothed share in a group is
``1 + floor(10^9 * (count + 5) / (N + 5 V))`` with ``N`` the group's occurrences of
kept terms and ``V`` the language's kept terms, those in at least ``MIN_DOCS`` of its
documents.  ``f`` is the distance of two shares.

Part ``term``: ``f`` depends on a term only through its cell, the pair (count in the
group, count in the language).  Terms are grouped into cells, ``f`` is evaluated once
per cell, cells with equal values are merged, and values are ranked with their
cumulative multiplicity.  Only the values that reach the report are expanded into
terms, which then stand in UTF-8 order; so a group's terms are never sorted as a whole.

Part ``pair``: the divergence of two sources is the sum of ``f`` over all kept terms.
A source's shares are evaluated once per distinct count.  Terms are dealt by hash into
chunks and sources into blocks; a task gets one chunk for two blocks and adds up ``f``
over its terms.  A term that neither source has is the cell (0, 0), whose multiplicity
is ``V`` less the terms counted, so absent terms cost nothing.

Documents are read once: each task counts words by (language, source, term) in a
bounded table, so a hot source or word crosses the network as few rows.  All
arithmetic is exact (decimals on the cluster, integers in tasks).

Defined results: null text, language and source are ''; each row is a document, also
when ids are null or repeat; the id is not read; a language without kept terms has
pairs of value 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedsync.llm.common import slices, staged

MIN_DOCS = 30
SMOOTH = 5
UNIT = 1_000_000_000
TOP = 50
HELD = 400_000  # counted keys that a task holds
SOURCE_BLOCK = 64
CHUNK_TERMS = 4_096

# Fixed value: a term is a run of ASCII letters and characters beyond ASCII.
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")
_UPPER = re.compile("[A-Z]+")


def folded(text: str) -> str:
    """``text`` with A-Z, and no other letter, in lower case."""
    return _UPPER.sub(lambda m: m.group().lower(), text)


COUNTS = "lang string, source string, term string, n long, docs long"


def _flush(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
    langs, sources, terms, n, docs = [], [], [], [], []
    for (lang, source), (count, seen) in held.items():
        langs += [lang] * (len(count) + 1)
        sources += [source] * (len(count) + 1)
        terms += [None, *count]  # the group itself, also when it has no terms
        n += [0, *count.values()]
        docs += [0, *map(seen.__getitem__, count)]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.string())]
        + [pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
        names=["lang", "source", "term", "n", "docs"],
    )


def term_counts(docs: DataFrame, held_keys: int = HELD) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term; a row
    with a null term for each group."""

    def count(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for b in slices(batch, "text"):
                columns = (b.column(c).to_pylist() for c in ("text", "lang", "source"))
                for text, lang, source in zip(*columns, strict=True):
                    key = (lang or "", source or "")
                    n, seen = held.get(key) or held.setdefault(key, (Counter(), Counter()))
                    if text:
                        words = TERM.findall(folded(text))
                        size -= len(n)
                        n.update(words)
                        seen.update(set(words))
                        size += len(n)
                    if size >= held_keys:
                        yield _flush(held)
                        held, size = {}, 0
        if held:
            yield _flush(held)

    counted = docs.select("text", "lang", "source").mapInArrow(count, COUNTS)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTH) / (total + SMOOTH * terms)), exactly."""
    top = (count + SMOOTH).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = total.cast("decimal(21,0)") + terms.cast("decimal(20,0)") * F.lit(SMOOTH).cast("decimal(1,0)")
    return F.call_function("div", top, below) + 1


def _kept(counts: DataFrame, min_docs: int) -> tuple[DataFrame, DataFrame]:
    """(counts of kept terms with the language's, a row for each group)."""
    words = counts.filter(F.col("term").isNotNull())
    by_lang = words.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("in_docs"))
    kept = staged(by_lang.filter(F.col("in_docs") >= min_docs).select("lang", "term", "lang_n"), "kept-terms")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("lang_n").alias("lang_total"))
    held = staged(words.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "kept-counts")
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (
        counts.filter(F.col("term").isNull()).select("lang", "source").join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left").na.fill(0, ["total", "v", "lang_total"])
    )
    return held, staged(groups, "term-groups")


def term_part(held: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank of the terms that a group has more of."""
    group = ["lang", "source"]
    cells = held.groupBy(*group, "n", "lang_n").agg(F.count(F.lit(1)).alias("terms"))
    cells = cells.join(groups, group)
    p = _share(F.col("n"), F.col("total"), F.col("v"))
    q = _share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    cells = cells.select(*group, "n", "lang_n", "terms", (p - q).alias("value")).filter(F.col("value") > 0)
    merged = cells.groupBy(*group, "value").agg(F.sum("terms").alias("terms"))
    # every value has a term, so no more than ``top`` values matter; each task cuts first
    down = W.partitionBy(*group).orderBy(F.desc("value"))
    best = merged.withColumn("at", F.row_number().over(down)).filter(F.col("at") <= top)
    before = F.sum("terms").over(down.rowsBetween(W.unboundedPreceding, -1))
    best = best.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < top)
    chosen = cells.drop("terms").join(best.select(*group, "value"), [*group, "value"])
    terms = held.join(chosen, [*group, "n", "lang_n"]).select(*group, F.col("term").alias("item"), "value")
    order = W.partitionBy(*group).orderBy(F.desc("value"), "item")
    return terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


PARTIAL = "lang string, a string, b string, f long, terms long"


def _partial_pairs(table: pa.Table) -> pa.Table:
    """For one chunk of terms and two blocks of sources: the sum of ``f`` over the terms
    that a source of the blocks has, and how many these are.  Every source of the
    blocks has a row without a term."""
    first, second = table.column("one")[0].as_py(), table.column("two")[0].as_py()
    lang = table.column("lang")[0].as_py()
    term, count = table.column("term").to_pylist(), table.column("n").to_numpy()
    named = {}  # source -> (column, block, denominator)
    where = np.empty(len(term), np.int64)
    rows = zip(*(table.column(c).to_pylist() for c in ("source", "block", "below")), strict=True)
    for i, (source, block, below) in enumerate(rows):
        where[i] = named.setdefault(source, (len(named), block, int(below)))[0]
    at = {t: i for i, t in enumerate(dict.fromkeys(t for t in term if t is not None))}
    row = np.array([-1 if t is None else at[t] for t in term], np.int64)
    shares = np.empty((len(at), len(named)), np.int64)
    if at:
        for j, _, below in named.values():
            mine = (where == j) & (row >= 0)
            counts, cell = np.unique(count[mine], return_inverse=True)  # the source's cells
            value = [1 + UNIT * (int(c) + SMOOTH) // below for c in (0, *counts)]
            shares[:, j] = value[0]
            shares[row[mine], j] = np.array(value[1:], np.int64)[cell]
    names = np.array(list(named), object)
    block = np.array([b for _, b, _ in named.values()])
    left, right = np.flatnonzero(block == first), np.flatnonzero(block == second)
    f = np.array([np.abs(shares[:, [i]] - shares[:, right]).sum(0) for i in left], np.int64).ravel()
    a, b = np.repeat(left, len(right)), np.tile(right, len(left))
    a, b, f = a[a != b], b[a != b], f[a != b]
    if first != second:  # the other direction
        a, b, f = np.r_[a, b], np.r_[b, a], np.r_[f, f]
    out = {
        "lang": pa.array([lang] * len(a), pa.string()),
        "a": pa.array(names[a].tolist(), pa.string()),
        "b": pa.array(names[b].tolist(), pa.string()),
        "f": pa.array(f, pa.int64()),
        "terms": pa.array(np.full(len(a), len(at)), pa.int64()),
    }
    return pa.table(out)


def pair_part(
    held: DataFrame, groups: DataFrame, chunk_terms: int = CHUNK_TERMS, source_block: int = SOURCE_BLOCK
) -> DataFrame:
    """lang, source, item, value, rank of every other source of the language."""
    most = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c")).first()[0] or 0
    blocks = -(-most // source_block) or 1
    below = F.col("total").cast("decimal(21,0)") + F.col("v") * F.lit(SMOOTH).cast("decimal(1,0)")
    chunks = F.greatest(F.ceil(F.col("v") / chunk_terms), F.lit(1)).cast("long")
    facts = groups.select(
        "lang", "source", below.alias("below"), chunks.alias("chunks"), F.expr(f"pmod(xxhash64(source), {blocks})").alias("block")
    )
    marks = facts.withColumns({"chunk": F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)),
                               "term": F.lit(None).cast("string"), "n": F.lit(0).cast("long")})
    counted = held.select("lang", "source", "term", "n").join(facts, ["lang", "source"])
    counted = counted.withColumn("chunk", F.expr("pmod(xxhash64(term), chunks)"))
    columns = ["lang", "source", "block", "below", "chunk", "term", "n"]
    rows = counted.select(*columns).unionByName(marks.select(*columns))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    dealt = rows.withColumn("other", other).withColumns(
        {"one": F.least("block", "other"), "two": F.greatest("block", "other")}
    )
    parts = dealt.groupBy("lang", "one", "two", "chunk").applyInArrow(_partial_pairs, PARTIAL)
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("f").alias("f"), F.sum("terms").alias("terms"))
    zero = _share(F.lit(0).cast("long"), F.col("total"), F.col("v"))
    none = groups.select("lang", "source", "v", F.when(F.col("v") > 0, zero).alias("zero"))
    mine = none.withColumnsRenamed({"source": "a", "zero": "zero_a"})
    theirs = none.select("lang", F.col("source").alias("b"), F.col("zero").alias("zero_b"))
    absent = (F.col("v") - F.col("terms")) * F.abs(F.col("zero_a") - F.col("zero_b"))
    value = F.when(F.col("v") > 0, F.col("f") + absent).otherwise(F.lit(0).cast("long"))
    whole = sums.join(mine, ["lang", "a"]).join(theirs, ["lang", "b"])
    found = whole.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), value.alias("value"))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return found.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank."""
    counts = staged(term_counts(docs), "term-counts")
    held, groups = _kept(counts, min_docs)
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pair_part(held, groups).withColumn("part", F.lit("pair")).select(*columns)
    return pairs.unionByName(term_part(held, groups, top).withColumn("part", F.lit("term")).select(*columns))
