"""Apply a change set to a table state, producing the next state."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedsync.constants import PAIR_KEYS
from feedsync.functions.columns import is_true
from feedsync.schemas import AUDIT_BY, AUDIT_TS


def _null_key(keys: Sequence[str]):
    cond = F.lit(False)
    for k in keys:
        cond = cond | F.col(k).isNull()
    return cond


def align(df: DataFrame, like: DataFrame) -> DataFrame:
    """Project ``df`` onto the columns and types of ``like``; columns it lacks
    become typed NULLs, extra columns are dropped (union by name, never by
    position - SURVEY rule 14)."""
    cols = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in like.schema.fields
        ]
    )


def apply_changes(
    current: DataFrame,
    inserts: DataFrame,
    deletes: DataFrame,
    keys: Sequence[str] = PAIR_KEYS,
    stamp_with: tuple[str, object] | None = None,
    keep: Column | None = None,
    defaults: Mapping[str, object] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(next state, rejected inserts).

    Every current row whose key is deleted goes (all seasons of a pair, as the
    reference's DELETE does); inserts with a NULL key are rejected instead of
    being re-inserted on every run (rule 16).  ``stamp_with=(user, ts)`` sets
    the audit columns of inserted rows when the table has them.  Rows for which
    ``keep`` is true stay whatever is deleted (the compset's own rows).  ``defaults``
    are values of table columns that inserts lack.
    """
    keys = list(keys)
    for c, value in (defaults or {}).items():
        if c not in current.columns:
            raise ValueError(f"default for {c}, which is not in the table")
        if c not in inserts.columns:
            inserts = inserts.withColumn(c, F.lit(value))
    if stamp_with is not None:
        inserts = stamp(inserts, *stamp_with)
    rejected = inserts.filter(_null_key(keys))
    ok = inserts.filter(~_null_key(keys))
    marks = deletes.select(*keys).distinct()
    if keep is None:
        kept = current.join(marks, keys, "left_anti")
    else:
        j = current.join(marks.withColumn("_gone", F.lit(True)), keys, "left")
        kept = j.filter(F.col("_gone").isNull() | is_true(keep)).select(*current.columns)
    return kept.unionByName(align(ok, current)), rejected


def apply_updates(
    current: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    columns: dict[str, tuple[str, str]],
    stamp_with: tuple[str, object] | None = None,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """``current`` with the columns of the rows that ``updates`` names changed.

    ``columns`` maps a column to its (before, after) columns in ``updates``; a row is
    meant if its keys are equal and its values are those before, NULLs included, so rows
    that share a key are told apart.  Changed rows are re-stamped.

    The rows meet the list of updates of their ``by`` keys (default: all keys).  If a later
    step joins by the same keys, the table moves once for both."""
    by = list(by or keys)
    u = updates.select(*keys, *(c for pair in columns.values() for c in pair)).filter(~_null_key(by))
    u = u.groupBy(*(F.col(k).alias(f"_{k}") for k in by)).agg(
        F.collect_list(F.struct(*(F.col(c) for c in u.columns if c not in by))).alias("_updates")
    )

    def meant(x: Column) -> Column:
        found = F.lit(True)
        for k in keys:
            if k not in by:
                found = found & (F.col(k) == x[k])
        for c, (before, _) in columns.items():
            found = found & F.col(c).eqNullSafe(x[before])
        return found

    same = F.lit(True)
    for k in by:
        same = same & (F.col(k) == F.col(f"_{k}"))
    rows = current.join(u, same, "left").withColumn("_update", F.explode_outer(F.filter("_updates", meant)))
    changed = F.col("_update").isNotNull()
    new = {c: F.when(changed, F.col("_update")[after]).otherwise(F.col(c)) for c, (_, after) in columns.items()}
    if stamp_with is not None:
        stamps = {AUDIT_BY: F.lit(stamp_with[0]), AUDIT_TS: F.lit(stamp_with[1]).cast("timestamp")}
        new |= {c: F.when(changed, v).otherwise(F.col(c)) for c, v in stamps.items() if c in current.columns}
    return rows.withColumns(new).select(*current.columns)


def deactivate_changes(
    current: DataFrame,
    inserts: DataFrame,
    deletes: DataFrame,
    keys: Sequence[str] = PAIR_KEYS,
    flag: str = "active_ind",
    stamp_with: tuple[str, object] | None = None,
    keep: Column | None = None,
    on: str = "Y",
    off: str = "N",
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`apply_changes`, but removed rows stay with ``flag`` set to
    ``off`` (and re-stamped) instead of being deleted; inserts get ``on``.
    One left join of the table with the distinct delete keys - no row is
    dropped, so history is kept."""
    keys = list(keys)
    if flag not in current.columns:
        raise ValueError(f"{flag} not in table")
    marks = deletes.select(*keys).distinct().withColumn("_gone", F.lit(True))
    j = current.join(marks, keys, "left")
    gone = is_true(F.col("_gone")) & ~is_true(F.lit(False) if keep is None else keep)
    cols = {flag: F.when(gone, F.lit(off)).otherwise(F.col(flag))}
    if stamp_with is not None:
        user, ts = stamp_with
        if AUDIT_BY in current.columns:
            cols[AUDIT_BY] = F.when(gone, F.lit(user)).otherwise(F.col(AUDIT_BY))
        if AUDIT_TS in current.columns:
            cols[AUDIT_TS] = F.when(gone, F.lit(ts).cast("timestamp")).otherwise(F.col(AUDIT_TS))
    kept = j.withColumns(cols).drop("_gone").select(*current.columns)
    return apply_changes(kept, inserts.withColumn(flag, F.lit(on)), deletes.limit(0), keys, stamp_with)


def one_per_key(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: the greatest of the other columns (compared as a
    struct, column by column).  A grouped max, so it combines map-side and
    picks the same row on every recomputation."""
    keys = list(keys)
    others = [c for c in rows.columns if c not in keys]
    if not others:
        return rows.distinct()
    return rows.groupBy(*keys).agg(F.max(F.struct(*others)).alias("_row")).select(*keys, "_row.*")


def upsert(
    current: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    stamp_with: tuple[str, object] | None = None,
    single: bool = True,
) -> DataFrame:
    """Replace rows of ``current`` that share a key with ``rows``, add the rest.
    With ``single`` (default) the new rows are reduced to one per key first,
    so the table keeps its key unique even when the feed names one id twice.  A
    row with a NULL key matches nothing and would be added on every run, so it
    is left out."""
    keys = list(keys)
    rows = rows.filter(~_null_key(keys))
    if single:
        rows = one_per_key(rows, keys)
    if stamp_with is not None:
        rows = stamp(rows, *stamp_with)
    kept = current.join(rows.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(align(rows, current))


def stamp(df: DataFrame, user: str, ts, by_col: str = AUDIT_BY, ts_col: str = AUDIT_TS) -> DataFrame:
    """Audit stamp of one run: the same user and clock read on every row."""
    return df.withColumn(by_col, F.lit(user)).withColumn(ts_col, F.lit(ts).cast("timestamp"))
