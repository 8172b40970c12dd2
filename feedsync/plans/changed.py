"""Table states of which a run writes only the buckets that it changes.

    changed/<table>/data/run=<id>/bucket=<b>/   rows of the buckets that run <id> changed
    changed/<table>/list/run=<id>/              (bucket, run, n_rows): where each bucket lies
    changed/<table>/schema/run=<id>/            an empty file, for a state without rows

A row's bucket is a hash of its change key, so a change set names its buckets without a
look at the table.  A run reads and writes the buckets that its changes fall into and
lists the others where they were; a run without changes writes a list and no data.  The
list has one row for each bucket, a number fixed with the table, so it may be collected.
A folder of a run is never written to by another run: a failed run leaves the states of
earlier ones as they were, and its retry replaces its own folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsync.constants import PAIR_KEYS
from feedsync.plans.snapshots import RunLayout
from feedsync.session import path_exists, remove_path

BUCKET = "bucket"
LIST = "bucket int, run bigint, n_rows bigint"


@dataclass(frozen=True)
class ChangedOnly:
    """``buckets`` of each table, and the key that deals its rows to them."""

    buckets: int = 64
    keys: Mapping[str, Sequence[str]] = field(
        default_factory=lambda: {"compset": PAIR_KEYS, "competitor": ("competitor_id",), "comp_config": PAIR_KEYS}
    )

    def bucket(self, name: str) -> Column:
        return F.pmod(F.xxhash64(*self.keys[name]), F.lit(self.buckets)).cast("int")

    def touched(self, name: str, changes: Sequence[DataFrame]) -> list[int]:
        """The buckets that the keys of ``changes`` fall into: no more than ``buckets``."""
        keys = list(self.keys[name])
        found = changes[0].select(*keys)
        for c in changes[1:]:
            found = found.unionByName(c.select(*keys))
        stored = F.lit(True)
        for k in keys:  # a NULL key is never stored
            stored = stored & F.col(k).isNotNull()
        rows = found.filter(stored).select(self.bucket(name).alias(BUCKET)).distinct().collect()
        return sorted(r[BUCKET] for r in rows)


def _folder(layout: RunLayout, name: str, part: str) -> str:
    return f"{layout.root.rstrip('/')}/changed/{name}/{part}/run={layout.run_id}"


def has_changed(spark: SparkSession, root: str, name: str, run_id: int) -> bool:
    return path_exists(spark, _folder(RunLayout(root, run_id), name, "list"))


def bucket_list(spark: SparkSession, root: str, name: str, run_id: int) -> list[tuple[int, int, int]]:
    """(bucket, run that wrote it, rows) of the state after run ``run_id``."""
    path = _folder(RunLayout(root, run_id), name, "list")
    return sorted((r[BUCKET], r["run"], r["n_rows"]) for r in spark.read.schema(LIST).parquet(path).collect())


def read_changed(
    spark: SparkSession, root: str, name: str, run_id: int, buckets: Sequence[int] | None = None
) -> DataFrame:
    """The state of ``name`` after run ``run_id``, or those ``buckets`` of it: a scan of
    their folders only."""
    schema = spark.read.parquet(_folder(RunLayout(root, run_id), name, "schema")).schema
    wanted = None if buckets is None else set(buckets)
    paths = [
        f"{_folder(RunLayout(root, run), name, 'data')}/{BUCKET}={b}"
        for b, run, _ in bucket_list(spark, root, name, run_id)
        if wanted is None or b in wanted
    ]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_changed(
    after: DataFrame, layout: RunLayout, name: str, conf: ChangedOnly, base: int | None, touched: Sequence[int] | None
) -> int:
    """Write the state of ``name`` after this run and return its rows.

    ``after`` holds the next rows of the ``touched`` buckets, the other buckets stay as
    run ``base`` lists them; without ``base`` it holds the whole state."""
    spark, data = after.sparkSession, _folder(layout, name, "data")
    remove_path(spark, data)  # of an earlier attempt
    kept = [] if base is None else [r for r in bucket_list(spark, layout.root, name, base) if r[0] not in set(touched)]
    fresh: list[tuple[int, int, int]] = []
    if base is None or touched:
        # a hot bucket is shared out over several files, small ones share a task
        rows = after.withColumn(BUCKET, conf.bucket(name)).hint("rebalance", BUCKET)
        # in key order, so that row groups can be skipped by their code statistics
        rows = rows.sortWithinPartitions(BUCKET, *conf.keys[name])
        rows.write.partitionBy(BUCKET).parquet(data)
        # counted from the files' footers: no column is read
        if path_exists(spark, data):
            written = spark.read.schema(rows.schema).parquet(data).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
            fresh = [(r[BUCKET], layout.run_id, r["n"]) for r in written.collect()]
    spark.createDataFrame([], after.schema).write.mode("overwrite").parquet(_folder(layout, name, "schema"))
    listed = spark.createDataFrame(sorted(kept + fresh), LIST)
    listed.coalesce(1).write.mode("overwrite").parquet(_folder(layout, name, "list"))
    return sum(n for _, _, n in kept + fresh)
