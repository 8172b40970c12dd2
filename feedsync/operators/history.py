"""Effective-dated apply: changes close and open date ranges instead of deleting rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedsync.constants import NOT_OWN_FLAG, OWN_FLAG, PAIR_KEYS
from feedsync.functions.columns import is_true

START, END = "eff_start_date", "eff_end_date"
HISTORY_KEYS = (*PAIR_KEYS, "own_ind")


def _date(text: str) -> Column:
    return F.lit(text).cast("date")


# An open end of a range, on either side.
_FIRST, _LAST = "0001-01-01", "9999-12-31"


def merge_ranges(rows: DataFrame, keys: Sequence[str], start: str = START, end: str = END) -> DataFrame:
    """Overlapping and touching ranges of a key as one: keys, start, end, ``n_ranges``
    (distinct start days merged).  A NULL end of a range is open; a range that ends
    before it starts never holds and stays as it is.

    Gaps and islands: ranges are first reduced to the longest of each key and start day,
    combined map-side, so the window of a key holds one row for each calendar day at
    most, however many rows the key has."""
    keys = list(keys)
    s, e = F.coalesce(F.col(start), _date(_FIRST)), F.coalesce(F.col(end), _date(_LAST))
    dated = rows.select(*keys, s.alias("_s"), e.alias("_e")).withColumn("_void", F.col("_e") < F.col("_s"))
    longest = dated.filter(~F.col("_void")).groupBy(*keys, "_s").agg(F.max("_e").alias("_e"))
    order = W.partitionBy(*keys).orderBy("_s")
    before = F.max("_e").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = before.isNull() | (F.col("_s") > F.date_add(before, 1))
    islands = longest.withColumn("_new", opens.cast("int")).withColumn("_island", F.sum("_new").over(order))
    merged = islands.groupBy(*keys, "_island").agg(
        F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.count(F.lit(1)).alias("n_ranges")
    )
    void = dated.filter("_void").select(*keys, "_s", "_e").distinct().withColumn("n_ranges", F.lit(1).cast("bigint"))
    return merged.drop("_island").unionByName(void).select(
        *keys,
        F.nullif("_s", _date(_FIRST)).alias(start),
        F.nullif("_e", _date(_LAST)).alias(end),
        "n_ranges",
    )


def apply_history(
    current: DataFrame, changes: DataFrame, new_rows: DataFrame, on_date, keys: Sequence[str] = HISTORY_KEYS
) -> DataFrame:
    """The date ranges of a table after a change set that takes effect on ``on_date``.

    ``changes`` (pair keys and ``change``) closes the ranges of deleted pairs the day
    before, cancels those that had not begun, and opens a range for inserted pairs; own
    rows are never closed.  ``new_rows`` (pair keys, own_ind) open ranges too.  Rows with a
    NULL key are not stored, as in every apply.  Ranges are then merged, so history is
    kept and a pair has one row for each time it was in force."""
    d = F.lit(on_date).cast("date")
    gone = changes.filter(F.col("change") == "delete").select(*PAIR_KEYS).withColumn("_gone", F.lit(True))
    j = current.select(*keys, START, END).join(gone, list(PAIR_KEYS), "left")
    own = is_true(F.col("own_ind") == F.lit(OWN_FLAG))
    closed = is_true(F.col("_gone")) & ~own & (F.col(END).isNull() | (F.col(END) >= d))
    begun = F.col(START).isNull() | (F.col(START) < d)
    kept = j.filter(~closed | begun).withColumn(END, F.when(closed, F.date_sub(d, 1)).otherwise(F.col(END)))
    added = (
        changes.filter(F.col("change") == "insert")
        .select(*PAIR_KEYS, F.lit(NOT_OWN_FLAG).alias("own_ind"))
        .unionByName(new_rows.select(*PAIR_KEYS, "own_ind"))
        .filter(F.col("prop_code").isNotNull() & F.col("competitor_id").isNotNull())
        .withColumns({START: d, END: F.lit(None).cast("date")})
    )
    return merge_ranges(kept.select(*keys, START, END).unionByName(added.select(*keys, START, END)), keys)
