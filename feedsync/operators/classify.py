"""Classify each single-host group against reference tables.

All joins here are between tables with one row per key on the right
(``distinct`` is computed map-side first), so a hot property never multiplies
rows, and the host table (one row per property) is the only thing shuffled
repeatedly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.constants import OWN_FLAG
from feedsync.functions.columns import is_true

NON_SINGLE = "non_single"
NO_PROPERTY = "no_property"
ABSENT = "absent"
MATCH = "match"
MISMATCH = "mismatch"


def current_rows(compset: DataFrame, active_only: bool = False, on_date=None) -> DataFrame:
    """Compset rows that count for matching.  With ``active_only`` only rows
    flagged active (``active_ind = 'Y'``); with ``on_date`` only rows whose
    effective range (``eff_start_date``..``eff_end_date``, open ends allowed)
    holds that date.  A table without the columns a rule needs is an error."""
    needed = ["active_ind"] * active_only + ["eff_start_date", "eff_end_date"] * (on_date is not None)
    missing = [c for c in needed if c not in compset.columns]
    if missing:
        raise ValueError(f"match rule needs the columns {', '.join(missing)}")
    if active_only:
        compset = compset.filter(F.col("active_ind") == F.lit(OWN_FLAG))
    if on_date is not None:
        d = F.lit(on_date).cast("date")
        compset = compset.filter(
            (F.col("eff_start_date").isNull() | (F.col("eff_start_date") <= d))
            & (F.col("eff_end_date").isNull() | (F.col("eff_end_date") >= d))
        )
    return compset


def classify_codes(
    groups: DataFrame,
    prop: DataFrame,
    compset: DataFrame,
    own_only: bool = True,
    active_only: bool = False,
    on_date=None,
) -> DataFrame:
    """B07 + B08: every valid code (one row of :func:`host_groups` each) with a
    ``state``:

    * ``non_single`` - not exactly one host row;
    * ``no_property`` - code not in the property table;
    * ``absent`` - no compset row for the code;
    * ``match`` - a compset row of the code carries the host's id (an own row
      when ``own_only``); a NULL host id never matches;
    * ``mismatch`` - otherwise.

    The three reference sides are reduced to distinct keys first (map-side),
    so each join meets at most one row per key and a hot property never
    multiplies rows.  This is the summary the feed is tagged with
    (:func:`tag_rows`).  ``active_only`` / ``on_date`` restrict the rows that
    can match (:func:`current_rows`); presence is judged on all rows.
    """
    known = prop.select("prop_code").distinct().withColumn("_known", F.lit(True))
    present = compset.select("prop_code").distinct().withColumn("_present", F.lit(True))
    candidates = current_rows(compset, active_only, on_date)
    own = candidates.filter(F.col("own_ind") == F.lit(OWN_FLAG)) if own_only else candidates
    own_ids = (
        own.select("prop_code", F.col("competitor_id").alias("host_id")).distinct().withColumn("_match", F.lit(True))
    )
    state = (
        F.when(F.col("n_host") != 1, F.lit(NON_SINGLE))
        .when(~is_true(F.col("_known")), F.lit(NO_PROPERTY))
        .when(~is_true(F.col("_present")), F.lit(ABSENT))
        .when(is_true(F.col("_match")), F.lit(MATCH))
        .otherwise(F.lit(MISMATCH))
    )
    return (
        groups.join(known, "prop_code", "left")
        .join(present, "prop_code", "left")
        .join(own_ids, ["prop_code", "host_id"], "left")
        .select(*groups.columns, state.alias("state"))
    )


def tag_rows(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Attach the summary of each row's code (``codes`` without its key columns).

    One join of the feed with a table holding one row per code, for every
    later split (single-host rows, matched rows, reports, season fan-out).
    Rows of a hot code meet a single summary row, so adaptive skew handling can
    split their partition.  Rows without a valid code get NULLs.
    """
    return rows.join(codes, "prop_code", "left")


def new_hosts(host_state: DataFrame, run_ts=None) -> DataFrame:
    """An own, active compset row for every ``absent`` host, stamped with the
    run's clock.  ``absent`` means that the code has no compset row at all, so
    there is nothing to subtract.  NULL ids are kept here;
    :func:`apply_changes` rejects them (SURVEY rule 16)."""
    return host_state.filter(F.col("state") == F.lit(ABSENT)).select(
        "prop_code",
        F.col("host_id").alias("competitor_id"),
        F.lit(OWN_FLAG).alias("own_ind"),
        F.lit(OWN_FLAG).alias("active_ind"),
        F.lit(run_ts).cast("timestamp").alias("last_upd_ts"),
    )
