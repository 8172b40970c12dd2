"""B06, B07 (report), B09: quarantine reports of raw feed rows.

The three group-level reports are produced by *one* join of the raw feed with
a table of (code, reason) - each code has at most one reason, so the join never
multiplies rows - instead of one semi-join per report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsync.constants import HOST_ROLE
from feedsync.operators.classify import MISMATCH, NO_PROPERTY, NON_SINGLE
from feedsync.functions.columns import canonical_code
from feedsync.operators.validate import non_single
from feedsync.schemas import FEED_COLUMNS

MALFORMED = "malformed"
DUPLICATE_HOST = "duplicate_host"
MISSING_PROPERTY = "missing_property"
ID_MISMATCH = "id_mismatch"


def report(feed: DataFrame, keys: DataFrame, role: str | None = None, on_raw: bool = True) -> DataFrame:
    """Raw feed rows whose code is in ``keys.prop_code`` (generic B06/B09).

    ``on_raw`` (default, SURVEY rule 7) compares the raw code as written with
    the canonical code, so rows whose code needed canonicalising drop out, as
    in the reference; ``on_raw=False`` compares the canonical form.
    """
    f = feed.select(*FEED_COLUMNS)
    if role is not None:
        f = f.filter(F.col("role") == F.lit(role))
    code = F.col("raw_code") if on_raw else canonical_code(F.col("raw_code"))
    k = keys.select(F.col("prop_code").alias("_code")).distinct()
    return f.join(k, code == F.col("_code"), "left_semi")


def report_rule(name: str) -> Column:
    """Condition on a feed tagged by :func:`classify.tag_rows` that puts a row
    in report ``name`` - on stored columns only, so it reaches the scan."""
    st = F.col("state")
    if name == DUPLICATE_HOST:
        return (st == F.lit(NON_SINGLE)) & (F.col("role") == F.lit(HOST_ROLE))
    if name == MISSING_PROPERTY:
        return st == F.lit(NO_PROPERTY)
    if name == ID_MISMATCH:
        return st == F.lit(MISMATCH)
    raise ValueError(f"unknown report {name!r}")


def reports_from_tags(tagged: DataFrame, on_raw: bool = True, malformed: bool = False) -> DataFrame:
    """All report rows from a feed tagged by :func:`classify.tag_rows` - no
    join needed.  Report codes are valid canonical codes, so a raw code equals
    one of them exactly when it equals its own canonical code and that code
    carries the reason (rule 7).  ``malformed`` adds the rows without a valid code."""
    reason = F.lit(None).cast("string")
    for name in (ID_MISMATCH, MISSING_PROPERTY, DUPLICATE_HOST):
        reason = F.when(report_rule(name), F.lit(name)).otherwise(reason)
    if on_raw:
        reason = F.when(F.col("raw_code") == F.col("prop_code"), reason)
    if malformed:
        reason = F.when(~F.col("code_ok"), F.lit(MALFORMED)).otherwise(reason)
    return tagged.withColumn("report", reason).filter(F.col("report").isNotNull()).select(*FEED_COLUMNS, "report")


def tagged_report(tagged: DataFrame, name: str, on_raw: bool = True) -> DataFrame:
    """One report straight from the tagged feed (a filter, pushed to the scan
    when the tagged feed is staged)."""
    cond = report_rule(name)
    if on_raw:
        cond = cond & (F.col("raw_code") == F.col("prop_code"))
    return tagged.filter(cond).select(*FEED_COLUMNS)
