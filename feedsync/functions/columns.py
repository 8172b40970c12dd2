"""Column expressions. All built-in functions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def full_match(c: Column, pattern: str) -> Column:
    """True iff the whole string matches (``$`` alone would accept a final newline)."""
    return c.rlike(r"\A(?:" + pattern + r")\z")


def is_true(c: Column) -> Column:
    """NULL-safe predicate: NULL counts as false."""
    return F.coalesce(c, F.lit(False))


def canonical_code(c: Column) -> Column:
    """Default normaliser of property codes: trim blanks, upper case."""
    return F.upper(F.trim(c))


def guarded_int(c: Column) -> Column:
    """String -> int that never raises and never rounds.

    Only an all-digit value (after trimming blanks) is cast; ``try_cast`` turns
    overflow into NULL.  Anything else is NULL.
    """
    t = F.trim(c)
    return F.when(full_match(t, "[0-9]+"), t.try_cast(T.IntegerType()))


def null_concat(*cols: Column, sep: str = " ") -> Column:
    """Join with a separator; NULL if any part is NULL."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(c)
    return F.concat(*parts)
