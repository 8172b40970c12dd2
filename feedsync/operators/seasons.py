"""Pin season maps to runs and fan listings out over seasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsync.constants import NOT_OWN_FLAG, OWN_FLAG
from feedsync.operators.skew import salted_join


def pin_runs(
    table: DataFrame,
    pins: DataFrame,
    keys: Sequence[str] = ("prop_code", "run_id"),
    dedupe: bool = False,
) -> DataFrame:
    """Rows of ``table`` whose (code, run) is pinned.  Duplicate pins
    multiply rows as in the reference unless ``dedupe`` (SURVEY rule 15)."""
    p = pins.select(*keys)
    if dedupe:
        p = p.distinct()
    return table.join(p, list(keys), "inner").select(*table.columns)


def season_counts(seasons: DataFrame) -> DataFrame:
    """(prop_code, n_season): pinned season rows of each code, counted map-side."""
    return seasons.groupBy("prop_code").agg(F.count(F.lit(1)).alias("n_season"))


def own_flag(is_host: Column) -> Column:
    return F.when(is_host, F.lit(OWN_FLAG)).otherwise(F.lit(NOT_OWN_FLAG))


def expand_seasons(rows: DataFrame, seasons: DataFrame, fan: DataFrame, rows_per_task: int = 250_000) -> DataFrame:
    """One row per listing x pinned season of its code.

    ``rows`` has prop_code, competitor_id, own_ind, ``n_fan`` and ``n_season``: upper
    bounds of the rows its code fans out to and of the code's seasons; ``fan`` has the two
    by prop_code, for the codes of ``rows``.  Both inputs are made distinct, so the join
    output is distinct by construction; seasons of other codes never move, and a hot
    code is cut on both sides (:func:`skew.salted_join`).
    """
    sizes = ["n_fan", "n_season"]
    s = seasons.select("prop_code", "season_id", "we_ind").join(fan.select("prop_code", *sizes), "prop_code")
    r = rows.select("prop_code", "competitor_id", "own_ind", *sizes)
    return salted_join(r, s, ["prop_code"], *sizes, rows_per_task).select(
        "prop_code", "competitor_id", "season_id", "we_ind", "own_ind"
    )


def season_rows(config: DataFrame, run_id: int, data_date, user: str, run_ts) -> DataFrame:
    """Desired config rows as the run's compset seasons, with its id, date and stamp."""
    return config.withColumns(
        {
            "run_id": F.lit(run_id).cast("bigint"),
            "data_date": F.lit(data_date).cast("date"),
            "last_upd_by": F.lit(user),
            "last_upd_ts": F.lit(run_ts).cast("timestamp"),
        }
    )
