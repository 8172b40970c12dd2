"""A fan-out join that stays balanced when one key holds a large share of the rows.

Adaptive execution (``spark.sql.adaptive.skewJoin.enabled``) splits an oversized
shuffle partition of a join in which one side has one row per key.  A fan-out join,
where *both* sides carry many rows of the hot key (listings x seasons), needs more:
:func:`salted_join` cuts every key on both sides into as many parts as its output needs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LINE, _COLUMN = "_line", "_column"


def parts_of(n_out: Column, rows_per_task: int) -> Column:
    """Parts of a key whose join gives ``n_out`` rows: one for each ``rows_per_task``."""
    return F.greatest(F.lit(1), F.ceil(F.coalesce(n_out, F.lit(0)) / F.lit(rows_per_task))).cast("int")


def rectangle(n_out: Column, n_small: Column, rows_per_task: int) -> tuple[Column, Column]:
    """(parts of the big side, parts of the small side) of a key.

    A cell of the grid holds about ``rows_per_task`` output rows.  With ``L`` and ``S``
    rows and a grid of ``a`` by ``b`` cells, ``L * b + S * a`` rows are copied; for
    ``P = a * b`` parts that is least at ``b = sqrt(P * S / L)``, some
    ``2 * L * S / sqrt(rows_per_task)`` rows, where copying only the small side needs
    ``L * S * S / rows_per_task``."""
    parts = parts_of(n_out, rows_per_task)
    small = F.greatest(F.coalesce(n_small, F.lit(1)), F.lit(1))
    big = F.greatest(F.coalesce(n_out, F.lit(0)) / small, F.lit(1))
    b = F.least(F.greatest(F.floor(F.sqrt(parts * small / big)), F.lit(1)), parts).cast("int")
    return F.ceil(parts / b).cast("int"), b


def salted_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], n_out: str, n_small: str, rows_per_task: int = 250_000
) -> DataFrame:
    """``big.distinct().join(small.distinct(), keys)`` without hot tasks.

    ``n_out`` and ``n_small``, columns of both sides and the same for all rows of a key,
    are upper bounds of the key's output rows and of its ``small`` rows.  They give each
    key its grid (:func:`rectangle`), row by row: no list of hot keys, no limit on how
    many there are, nothing broadcast.  A ``big`` row goes to one line of the grid, by a
    hash of the row (so equal rows meet and one exchange serves both the de-duplication
    and the join), and is copied to its cells; a ``small`` row likewise to one column.
    """
    keys = list(keys)
    a, b = rectangle(F.col(n_out), F.col(n_small), rows_per_task)
    spread = [F.col(k) for k in [*keys, _LINE, _COLUMN]]

    def dealt(df: DataFrame, own: str, own_parts: Column, other: str, other_parts: Column) -> DataFrame:
        columns = [c for c in df.columns if c not in (n_out, n_small)]
        place = F.pmod(F.xxhash64(*columns), own_parts).cast("int")
        copies = F.explode(F.sequence(F.lit(0), other_parts - 1))
        return df.withColumn(own, place).withColumn(other, copies).drop(n_out, n_small).repartition(*spread).distinct()

    left, right = dealt(big, _LINE, a, _COLUMN, b), dealt(small, _COLUMN, b, _LINE, a)
    return left.join(right, [*keys, _LINE, _COLUMN]).drop(_LINE, _COLUMN)
