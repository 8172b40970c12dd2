"""Competitor renames and competitor-table upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_records(derived: DataFrame, competitor: DataFrame, valid_only: bool = False) -> DataFrame:
    """(competitor_id, old_name, new_name) where the feed names a stored id
    differently.  Built from *all* raw rows, as the reference does; a NULL id
    or name is never a rename.  The feed's (id, name) pairs are de-duplicated
    map-side first, so a competitor listed by every host costs one row per
    partition.  ``valid_only`` leaves rows with a malformed code out."""
    if valid_only:
        derived = derived.filter(F.col("code_ok"))
    names = (
        derived.filter(F.col("competitor_id").isNotNull() & F.col("competitor_name").isNotNull())
        .select("competitor_id", "competitor_name")
        .distinct()
    )
    stored = competitor.select("competitor_id", F.col("competitor_name").alias("old_name"))
    return (
        names.join(stored, "competitor_id")
        .filter(F.col("competitor_name") != F.col("old_name"))
        .select("competitor_id", "old_name", F.col("competitor_name").alias("new_name"))
    )


def rename_pick(renames: DataFrame) -> DataFrame:
    """One new name per id (the greatest), so overlaying never fans out when
    the feed gives one id two new names."""
    return renames.groupBy("competitor_id").agg(F.max("new_name").alias("new_name"))


def rename_listings(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Overlay new names on competitor rows; adds ``renamed``.  Host rows
    keep their name (hosts are renamed through :func:`renamed_hosts`)."""
    pick = rename_pick(renames)
    j = rows.join(pick, "competitor_id", "left")
    renamed = ~F.col("is_host") & F.col("new_name").isNotNull()
    return j.withColumn(
        "competitor_name", F.when(renamed, F.col("new_name")).otherwise(F.col("competitor_name"))
    ).withColumn("renamed", renamed).drop("new_name")


def renamed_hosts(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Competitor-table rows (id, new name) for matched hosts renamed in the feed."""
    pick = rename_pick(renames)
    hosts = rows.filter(F.col("is_host")).select("competitor_id")
    return hosts.join(pick, "competitor_id").select("competitor_id", F.col("new_name").alias("competitor_name"))


def renamed_pairs(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Distinct (id, name) of the competitor rows after renames.  The pairs are made
    distinct first, so the rename join meets each pair once and listing rows are
    never shuffled by competitor."""
    pairs = rows.filter(~F.col("is_host")).select("competitor_id", "competitor_name").distinct()
    return (
        pairs.join(rename_pick(renames), "competitor_id", "left")
        .select("competitor_id", F.coalesce("new_name", "competitor_name").alias("competitor_name"))
        .distinct()
    )


def split_named(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs with id and name, the others): a NULL id is no key and a NULL name no
    update, so neither may reach the competitor table."""
    whole = F.col("competitor_id").isNotNull() & F.col("competitor_name").isNotNull()
    return pairs.filter(whole), pairs.filter(~whole)


def competitor_upserts(pairs: DataFrame, competitor: DataFrame, hosts: DataFrame, user: str, ts=None) -> DataFrame:
    """Named pairs not stored as they are (same id and name), then the renamed
    hosts appended; stamped with the batch user and the run's clock."""
    named, _ = split_named(pairs)
    stored = competitor.select("competitor_id", "competitor_name")
    fresh = named.distinct().join(stored, ["competitor_id", "competitor_name"], "left_anti")
    return fresh.unionByName(hosts.select("competitor_id", "competitor_name")).withColumns(
        {"last_upd_by": F.lit(user), "last_upd_ts": F.lit(ts).cast("timestamp")}
    )
