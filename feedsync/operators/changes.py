"""Change sets between a desired and a current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedsync.constants import NOT_OWN_FLAG, OWN_FLAG, PAIR_KEYS
from feedsync.functions.columns import is_true
from feedsync.operators.classify import MATCH


def diff(desired: DataFrame, current: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """Keys to insert (desired only) and to delete (current only), tagged
    ``change``.  Keys are joined as a whole, so a hot property spreads over
    partitions by its second key; a NULL key never matches (rule 3)."""
    keys = list(keys)
    d = desired.select(*keys).distinct().withColumn("_d", F.lit(True))
    c = current.select(*keys).distinct().withColumn("_c", F.lit(True))
    # one full outer join of the two key sets: a key on one side only is a
    # change; NULL keys never match, so they stay one-sided as in an anti-join
    j = d.join(c, keys, "full_outer")
    return j.filter(F.col("_d").isNull() | F.col("_c").isNull()).select(
        *keys, F.when(F.col("_c").isNull(), F.lit("insert")).otherwise(F.lit("delete")).alias("change")
    )


def compset_diff(matched: DataFrame, compset: DataFrame, host_state: DataFrame) -> DataFrame:
    """Competitor pairs of matched hosts to insert into / delete from the
    compset table.  A pair that the table holds as an own row is no competitor pair:
    it is neither inserted again nor is its own row deleted.  One full outer join of
    the two pair sets."""
    desired = matched.filter(~F.col("is_host")).select(*PAIR_KEYS).distinct().withColumn("_d", F.lit(True))
    hosts = host_state.filter(F.col("state") == F.lit(MATCH)).select("prop_code")
    own = is_true(F.col("own_ind") == F.lit(OWN_FLAG))
    current = (
        compset.join(hosts, "prop_code", "left_semi")
        .groupBy(*PAIR_KEYS)
        .agg(F.bool_or(own).alias("_own"), F.bool_or(~own).alias("_c"))
    )
    j = desired.join(current, list(PAIR_KEYS), "full_outer")
    wanted = is_true(F.col("_d")) & ~is_true(F.col("_own"))
    stored = is_true(F.col("_c"))
    return j.filter(wanted != stored).select(
        *PAIR_KEYS, F.when(wanted, F.lit("insert")).otherwise(F.lit("delete")).alias("change")
    )


def config_pairs(matched: DataFrame, current: DataFrame, keys: Sequence[str] = PAIR_KEYS) -> DataFrame:
    """B16, all classes at once: the pairs to insert into, to delete from and to keep in
    the config (``change``: insert, delete, keep).

    A pair is desired if a matched listing of a code with pinned seasons has it, so
    the change set needs no fan-out: only inserted pairs are expanded later.  One full
    outer join of the two pair sets; NULL keys never match.  ``is_own`` and ``is_comp``
    tell in which roles a pair is listed, ``n_fan`` bounds its code's fan-out."""
    keys = list(keys)
    d = matched.groupBy(*keys).agg(
        F.bool_or("is_host").alias("is_own"),
        F.bool_or(~F.col("is_host")).alias("is_comp"),
        F.max("n_fan").alias("n_fan"),
        F.max("n_season").alias("n_season"),
    )
    c = current.select(*keys).distinct().withColumn("_c", F.lit(True))
    j = d.filter("n_fan > 0").join(c, keys, "full_outer")
    wanted, stored = F.col("n_fan").isNotNull(), is_true(F.col("_c"))
    change = F.when(~stored, F.lit("insert")).when(~wanted, F.lit("delete")).otherwise(F.lit("keep"))
    return j.filter(wanted | stored).select(*keys, change.alias("change"), "is_own", "is_comp", "n_fan", "n_season")


def config_updates(current: DataFrame, pairs: DataFrame, seasons: DataFrame) -> DataFrame:
    """B16, update class: stored rows of kept pairs, in seasons pinned for their property,
    whose weekend and own flags no desired row of that pair and season has.

    (keys, season_id, we_before, own_before, we_after, own_after), distinct.  A flag
    that some desired row has stays; another becomes the greatest desired one (a pair
    listed as host and as competitor is an own row).  NULL flags compare as values.
    Nothing is fanned out: stored rows meet one row of their pair and one of their
    season, which holds the distinct values of a flag.
    """
    kept = pairs.filter(F.col("change") == "keep").select(*PAIR_KEYS, "is_own", "is_comp")
    flags = seasons.groupBy("prop_code", "season_id").agg(
        F.collect_set("we_ind").alias("_set"),
        F.bool_or(F.col("we_ind").isNull()).alias("_null"),
        F.max("we_ind").alias("_we"),
    )
    rows = current.select(*PAIR_KEYS, "season_id", "we_ind", "own_ind").distinct()
    rows = rows.join(kept, list(PAIR_KEYS)).join(flags, ["prop_code", "season_id"])
    same_we = F.when(F.col("we_ind").isNull(), F.col("_null")).otherwise(F.array_contains("_set", F.col("we_ind")))
    own, comp = F.lit(OWN_FLAG), F.lit(NOT_OWN_FLAG)
    same_own = is_true((F.col("own_ind") == own) & F.col("is_own") | (F.col("own_ind") == comp) & F.col("is_comp"))
    return rows.filter(~(same_we & same_own)).select(
        *PAIR_KEYS,
        "season_id",
        F.col("we_ind").alias("we_before"),
        F.col("own_ind").alias("own_before"),
        F.when(same_we, F.col("we_ind")).otherwise(F.col("_we")).alias("we_after"),
        F.when(same_own, F.col("own_ind")).when(F.col("is_own"), own).otherwise(comp).alias("own_after"),
    )


def change_set(current: DataFrame, inserts: DataFrame, deletes: DataFrame, updates: DataFrame) -> DataFrame:
    """All accepted changes of the config with the flags before and after: a row for each
    inserted row, each stored row of a deleted pair, each updated row."""
    none = F.lit(None).cast("string")
    key = [*PAIR_KEYS, "season_id"]
    added = inserts.filter(F.col("prop_code").isNotNull() & F.col("competitor_id").isNotNull()).select(
        F.lit("insert").alias("change"), *key, none.alias("we_before"), none.alias("own_before"),
        F.col("we_ind").alias("we_after"), F.col("own_ind").alias("own_after"),
    )
    gone = current.join(deletes.select(*PAIR_KEYS).distinct(), list(PAIR_KEYS), "left_semi").select(
        F.lit("delete").alias("change"), *key, F.col("we_ind").alias("we_before"),
        F.col("own_ind").alias("own_before"), none.alias("we_after"), none.alias("own_after"),
    )
    return added.unionByName(gone).unionByName(updates.withColumn("change", F.lit("update")).select(*added.columns))
