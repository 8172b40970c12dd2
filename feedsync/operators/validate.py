"""Derive ids and names, canonicalise codes, count hosts per group."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsync.constants import CODE_PATTERN, HOST_ROLE
from feedsync.functions.columns import canonical_code, full_match, guarded_int, is_true, null_concat
from feedsync.schemas import FEED_COLUMNS


def derive(feed: DataFrame) -> DataFrame:
    """``competitor_id`` (guarded int of ``ext_id``) and ``competitor_name``
    (``chain_name || ' ' || hotel_name``, NULL if a part is NULL), plus the
    NULL-safe host flag used by every later step."""
    return feed.withColumns(
        {
            "competitor_id": guarded_int(F.col("ext_id")),
            "competitor_name": null_concat(F.col("chain_name"), F.col("hotel_name")),
            "is_host": is_true(F.col("role") == F.lit(HOST_ROLE)),
        }
    )


def check_codes(
    feed: DataFrame,
    pattern: str = CODE_PATTERN,
    normalise: Callable[[Column], Column] = canonical_code,
) -> DataFrame:
    """B04 (tagging form): add ``prop_code`` (normalised raw code) and
    ``code_ok`` (whole code matches ``pattern``; NULL is never ok)."""
    code = normalise(F.col("raw_code"))
    return feed.withColumn("prop_code", code).withColumn("code_ok", is_true(full_match(F.col("prop_code"), pattern)))


def split_codes(
    feed: DataFrame,
    pattern: str = CODE_PATTERN,
    normalise: Callable[[Column], Column] = canonical_code,
) -> tuple[DataFrame, DataFrame]:
    """(valid rows with canonical ``prop_code``, malformed raw rows)."""
    tagged = check_codes(feed, pattern, normalise)
    valid = tagged.filter(F.col("code_ok")).drop("code_ok")
    malformed = tagged.filter(~F.col("code_ok")).select(*FEED_COLUMNS)
    return valid, malformed


def host_groups(valid: DataFrame) -> DataFrame:
    """One row per ``prop_code``: ``n_host``, ``n_comp`` and the host's id.

    A plain grouped count, so it is combined map-side: a code owning a third
    of the feed costs one partial row per input partition, not a hot task.
    ``host_id`` is only meaningful when ``n_host = 1``.
    """
    host = F.col("is_host")
    return valid.groupBy("prop_code").agg(
        F.count_if(host).alias("n_host"),
        F.count_if(~host).alias("n_comp"),
        F.max(F.when(host, F.col("competitor_id"))).alias("host_id"),
    )


def non_single(groups: DataFrame) -> DataFrame:
    """Groups with too few or too many hosts (zero-host groups included)."""
    return groups.filter(F.col("n_host") != 1)


def single_host_rows(valid: DataFrame, groups: DataFrame) -> DataFrame:
    """Valid rows of groups with exactly one host (semi-join on the code)."""
    ok = groups.filter(F.col("n_host") == 1).select("prop_code")
    return valid.join(ok, "prop_code", "left_semi")
