"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from feedsync.session import shared_dir

# White space as the corpus contracts define it: ASCII space and \t..\r.
ASCII_SPACE = "[\\x20\\x09-\\x0D]+"


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per session, so that jobs run
    wherever the driver was started."""
    sc = spark.sparkContext
    if getattr(sc, "_feedsync_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="feedsync-"), "feedsync.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._feedsync_shipped = True


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table: its
    lineage ends there, and a lost executor costs only the reads of its tasks."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str | pa.Array, size: int = 4 << 20, rows: int = 4096):
    """``batch`` in parts with about ``size`` bytes of ``column`` (its name or values) and
    at most ``rows`` rows (a row at least), so that what a task holds as Python objects
    stays small whatever Spark sends."""
    values = batch.column(column) if isinstance(column, str) else column
    lengths = pc.fill_null(pc.binary_length(values), 0).to_numpy()
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = min(at + rows, max(at + 1, int(np.searchsorted(ends, before + size, side="right"))))
        yield batch.slice(at, to - at)
        at = to


def texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column; null is empty."""
    return [t or "" for t in column.to_pylist()]


def binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, type=pa.binary())


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and odd multipliers), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class BoundedCache(dict):
    """``cache[key]`` computes a missing value once.  When it is full, its entries
    become the old generation, from which those that are asked for again return; so
    a task's memory stays bounded whatever the number of distinct keys."""

    def __init__(self, compute, max_entries: int = 300_000, max_key: int = 64):
        super().__init__()
        self.compute, self.max_entries, self.max_key = compute, max_entries, max_key
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.max_key:
            if len(self) >= self.max_entries:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
