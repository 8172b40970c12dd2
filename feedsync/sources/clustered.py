"""Tables stored in key order, and reads of the row groups that some keys may be in.

A table sorted by its code has narrow code statistics in every Parquet row group (and a
Bloom filter of the codes).  A scan for a set of codes then carries a filter that these
statistics can answer: at most ``at_most`` ranges ``lo <= code <= hi`` that hold all
codes, each range a single code if there are no more codes than that.  The ranges only
choose what is read; a semi-join on the codes themselves decides which rows come back, so
rows are the same whatever the ranges, the files or their order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RANGES = 64


def write_clustered(df: DataFrame, path: str, by: str, spread: Sequence[str] = (), row_group_bytes: int = 32 << 20) -> None:
    """Write ``df`` in the order of ``by``, in row groups of about ``row_group_bytes``.

    Files are cut at ranges of (``by``, ``spread``): with ``spread`` the rows of a hot key lie in
    several files.  NULL keys come first, in any of the sorted files."""
    order = [by, *spread]
    (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.option("parquet.block.size", str(row_group_bytes))
        .option(f"parquet.bloom.filter.enabled#{by}", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .parquet(path)
    )


def key_ranges(keys: DataFrame, by: str, at_most: int = MAX_RANGES) -> list[tuple[object, object]]:
    """At most ``at_most`` ranges (lowest, highest) that hold every ``by`` of ``keys``, of about
    equally many rows.  NULLs are in none.  The ranges alone reach the driver."""
    found = keys.select(by).filter(F.col(by).isNotNull()).repartitionByRange(at_most, by)
    rows = found.groupBy(F.spark_partition_id()).agg(F.min(by).alias("lo"), F.max(by).alias("hi")).collect()
    return sorted((r["lo"], r["hi"]) for r in rows)


def in_ranges(by: str, ranges: Sequence[tuple[object, object]]) -> Column:
    """``by`` lies in one of ``ranges``, as a flat tree that the Parquet scan takes.  Each branch
    first tests the range that holds all of its ranges, so a row goes down one path."""
    key = F.col(by)
    whole = lambda lo, hi: key == lo if lo == hi else (key >= lo) & (key <= hi)
    nodes = [(lo, hi, whole(lo, hi)) for lo, hi in sorted(ranges)]
    while len(nodes) > 1:
        pairs = [
            (a[0], max(a[1], b[1]), whole(a[0], max(a[1], b[1])) & (a[2] | b[2]))
            for a, b in zip(nodes[::2], nodes[1::2])
        ]
        nodes = pairs + nodes[len(nodes) - len(nodes) % 2 :]
    return nodes[0][2] if nodes else F.lit(False)


def scoped(table: DataFrame, keys: DataFrame, by: str, at_most: int = MAX_RANGES) -> DataFrame:
    """The rows of ``table`` whose ``by`` is one of ``keys``, read from the row groups that may
    hold one.  Repeated keys repeat no row; a NULL is no key."""
    near = table.filter(in_ranges(by, key_ranges(keys, by, at_most)))
    return near.join(keys.select(by), by, "left_semi").select(*table.columns)
