"""Reference-table readers (Parquet snapshots or JDBC)."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsync.schemas import TABLE_COLUMNS


@dataclass(frozen=True)
class ParquetSource:
    """Tables under ``root``: either ``root/<name>.parquet`` files or snapshot
    tables ``root/<name>/run=<id>/`` written by :mod:`feedsync.plans.snapshots`."""

    root: str
    run_id: int | None = None  # snapshot to read; None = plain <name>.parquet
    # per table: the column whose values are its folders (``season_map`` by ``run_id``)
    folders: dict[str, str] = field(default_factory=dict)

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        if self.run_id is None:
            return spark.read.parquet(f"{self.root.rstrip('/')}/{name}.parquet")
        return spark.read.parquet(f"{self.root.rstrip('/')}/{name}/run={self.run_id}")


@dataclass(frozen=True)
class JdbcSource:
    """A database reached over JDBC.  ``partitioning`` maps a table name to
    (column, lower, upper, num_partitions) so the scan runs as parallel range
    reads instead of Spark's single-partition default."""

    url: str
    properties: dict[str, str] = field(default_factory=dict)
    schema: str | None = None
    partitioning: dict[str, tuple[str, int, int, int]] = field(default_factory=dict)
    fetchsize: int = 10_000
    # per table: database column name -> our column name (case-insensitive)
    rename: dict[str, dict[str, str]] = field(default_factory=dict)

    def table_name(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def read_options(self, name: str) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table_name(name), "fetchsize": str(self.fetchsize)}
        opts.update(self.properties)
        if name in self.partitioning:
            col, lo, hi, n = self.partitioning[name]
            opts.update(
                {"partitionColumn": col, "lowerBound": str(lo), "upperBound": str(hi), "numPartitions": str(n)}
            )
        return opts

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.read_options(name)).load()

    def write_options(self, name: str, batchsize: int = 10_000, num_partitions: int | None = None) -> dict[str, str]:
        opts = {"url": self.url, "dbtable": self.table_name(name), "batchsize": str(batchsize)}
        opts.update(self.properties)
        if num_partitions:
            opts["numPartitions"] = str(num_partitions)  # caps concurrent connections
        return opts

    def append(self, df: DataFrame, name: str, batchsize: int = 10_000, num_partitions: int | None = None) -> None:
        """Bulk append (one batched INSERT stream per task), e.g. a run's new
        config rows when the database stays the system of record."""
        df.write.format("jdbc").options(**self.write_options(name, batchsize, num_partitions)).mode("append").save()


def pinned_folders(table: DataFrame, pins: DataFrame, by: str = "run_id", at_most: int = 10_000) -> DataFrame:
    """``table``, stored in folders by ``by``, cut to the folders that some pin names, so that
    the join of the pins reads no others.

    The pinned ids become a filter on the partition column, which the scan applies to
    its file listing.  The driver lists the folders anyway and takes one id for each; with more than
    ``at_most`` pinned ids the table comes back as it is, and the join alone decides.
    Rows are the same either way; a NULL pin names no folder."""
    ids = [r[0] for r in pins.select(by).filter(F.col(by).isNotNull()).distinct().limit(at_most + 1).collect()]
    return table if len(ids) > at_most else table.filter(F.col(by).isin(ids))


def read_table(
    spark: SparkSession,
    source: ParquetSource | JdbcSource,
    name: str,
    columns: list[str] | None = None,
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Open ``name`` with all its columns.

    ``rename`` maps source column names (case-insensitive, as in the database
    catalog) to ours.  The columns of :data:`TABLE_COLUMNS` must be there; every
    other column is carried through to the table's next state.  ``columns``
    asks for a projection instead.
    """
    df = source.load(spark, name)
    rename = rename if rename is not None else getattr(source, "rename", {}).get(name)
    if rename:
        lower = {k.lower(): v for k, v in rename.items()}
        df = df.select([F.col(c).alias(lower.get(c.lower(), c)) for c in df.columns])
    if columns is not None:
        return df.select(*columns)
    missing = [c for c in TABLE_COLUMNS.get(name, []) if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks the columns {', '.join(missing)}")
    return df
