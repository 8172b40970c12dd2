"""Deterministic sharded file output that survives lost tasks.

A task writes its files under a temporary name of its own attempt and returns
their manifest rows.  Spark writes the manifest as a table, whose commit protocol
admits one attempt of each task; only files that the manifest names are then
renamed to their final names.  The renaming job can be repeated: a file that is in
place already is left.  Readers start from the manifest, so files of lost
attempts are never read.

Paths are URIs that pyarrow's file systems open (file, hdfs, s3, gs).
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame

MANIFEST = "shard long, seq long, name string, temporary string, bytes long, records long, sha256 string"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


class Attempt:
    """The files of one task attempt."""

    def __init__(self, out: str):
        self.system, self.root = file_system(out)
        self.folder = f"{self.root}/_temporary/{uuid.uuid4().hex}"
        self.made = False

    def path(self, name: str) -> str:
        if not self.made:
            self.system.create_dir(self.folder, recursive=True)
            self.made = True
        return f"{self.folder}/{name}"

    def open(self, name: str):
        path = self.path(name)
        return path, self.system.open_output_stream(path, compression=None)


def manifest_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["shard", "seq", "name", "temporary", "bytes", "records", "sha256"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, types, strict=True)],
        names=names,
    )


def commit(manifest: DataFrame, out: str) -> DataFrame:
    """Run the writing job, rename what its manifest names, return the manifest."""
    spark = manifest.sparkSession
    manifest.write.parquet(f"{out}/_manifest")
    written = spark.read.schema(manifest.schema).parquet(f"{out}/_manifest")

    def rename(batches):
        system, root = file_system(out)
        for b in batches:
            moved = []
            for name, temporary in zip(b.column("name").to_pylist(), b.column("temporary").to_pylist(), strict=True):
                final = f"{root}/{name}"
                if system.get_file_info(final).type == fs.FileType.NotFound:
                    system.create_dir(final.rpartition("/")[0], recursive=True)
                    try:
                        system.move(temporary, final)
                    except FileNotFoundError:  # another attempt of this task came first
                        if system.get_file_info(final).type == fs.FileType.NotFound:
                            raise
                moved.append(name)
            yield pa.RecordBatch.from_arrays([pa.array(moved, pa.string())], names=["name"])

    written.select("name", "temporary").mapInArrow(rename, "name string").write.parquet(f"{out}/_committed")
    return written.drop("temporary")
