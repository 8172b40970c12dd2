"""Ordered export: one total order, parts that match their list, and pruned season folders."""

import glob
import gzip
import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from feedsync.operators import export_ordered, pin_runs, read_export, verify_export
from feedsync.sources import ParquetSource, pinned_folders, read_table

KEYS = ("code", "id")
SCHEMA = "code string, id int, name string, w decimal(10,3)"


def _bytes(path):
    names = sorted(glob.glob(f"{path}/data/part-*"), key=os.path.basename)
    return b"".join(open(n, "rb").read() for n in names), names


@pytest.fixture
def table(spark):
    texts = ["a", "", None, 'q"q', "x\ny", " pad ", "c,d"]
    rows = [(f"P{i % 7}" if i % 3 else "HOT", i % 50 or None, texts[i % 7], i % 11) for i in range(900)]
    return spark.createDataFrame(rows, "code string, id int, name string, w int").select(
        "code", "id", "name", (F.col("w") / 8).cast("decimal(10,3)").alias("w")
    )


def test_equal_bytes_from_reordered_input(spark, tmp_path, table):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    parts = export_ordered(table, a, KEYS, rows_per_file=50)
    export_ordered(table.repartition(5, "name").orderBy(F.desc("w")), b, KEYS, rows_per_file=70)
    (left, names), (right, _) = _bytes(a), _bytes(b)
    assert left == right and len(names) >= 18 and parts.count() == len(names)
    got = read_export(spark, a, table.schema, KEYS)
    assert rows_of(got.drop("position")) == rows_of(table)
    seen = [tuple(r)[1:] for r in got.orderBy("position").collect()]
    nulls_first = lambda r: tuple((v is not None, v) for v in r)
    assert [r.position for r in got.orderBy("position").collect()] == list(range(1, 901))
    assert [nulls_first(r) for r in seen] == sorted(nulls_first(r) for r in seen)
    assert sum(r.n_rows for r in parts.collect()) == 900 and min(r.first_row for r in parts.collect()) == 1


def test_damaged_parts_are_found(spark, tmp_path, table):
    path = f"{tmp_path}/a"
    export_ordered(table, path, KEYS, rows_per_file=300)
    verify_export(spark, path, table.schema, KEYS)
    name = _bytes(path)[1][0]
    text = open(name, "rb").read()
    crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
    if os.path.exists(crc):
        os.remove(crc)
    for broken in (text.replace(b"0.125", b"0.250", 1), text[: text.rindex(b"\n", 0, -1) + 1], text + text[:20]):
        with open(name, "wb") as f:
            f.write(broken)
        with pytest.raises(RuntimeError, match="parts"):
            verify_export(spark, path, table.schema, KEYS)
    with open(name, "wb") as f:
        f.write(text)
    verify_export(spark, path, table.schema, KEYS)
    os.remove(name)
    with pytest.raises(RuntimeError, match="parts"):
        verify_export(spark, path, table.schema, KEYS)


def test_a_compressed_export_is_the_same_text(spark, tmp_path, table):
    a, b = f"{tmp_path}/a", f"{tmp_path}/b"
    export_ordered(table, a, KEYS, rows_per_file=300)
    parts = export_ordered(table, b, KEYS, rows_per_file=300, compression="gzip")
    (plain, _), (_, names) = _bytes(a), _bytes(b)
    assert b"".join(gzip.open(n).read() for n in names) == plain
    assert sum(r.n_bytes for r in parts.collect()) == sum(map(os.path.getsize, names)) < len(plain)
    assert rows_of(read_export(spark, b, table.schema, KEYS)) == rows_of(read_export(spark, a, table.schema, KEYS))
    name = next(n for n in names if b"0.125" in gzip.open(n).read())
    os.remove(os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc"))
    text = gzip.open(name).read()
    with gzip.open(name, "wb") as f:
        f.write(text.replace(b"0.125", b"0.250", 1))
    with pytest.raises(RuntimeError, match="parts"):
        verify_export(spark, b, table.schema, KEYS)
    with open(name, "r+b") as f:
        f.truncate(os.path.getsize(name) // 2)
    with pytest.raises(Exception, match="(?i)unexpected end|parts"):
        verify_export(spark, b, table.schema, KEYS)


def test_empty_and_nested(spark, tmp_path, table):
    path = f"{tmp_path}/a"
    assert export_ordered(table.limit(0), path, KEYS).count() == 0
    assert read_export(spark, path, table.schema, KEYS).count() == 0
    with pytest.raises(ValueError, match="nested"):
        export_ordered(table.withColumn("x", F.array(F.lit(1))), f"{tmp_path}/b", KEYS)


def test_pins_prune_season_folders(spark, tmp_path, fixtures_small):
    fixtures_small["season_map"].write.partitionBy("run_id").parquet(f"{tmp_path}/season_map.parquet")
    stored = read_table(spark, ParquetSource(str(tmp_path)), "season_map")
    pins = fixtures_small["run_pin"].filter(F.col("run_id") == 2).unionByName(
        spark.createDataFrame([("P000001", None), ("P000001", 99)], "prop_code string, run_id bigint")
    )
    kept = pinned_folders(stored, pins)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "run_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    read = {f for (f,) in kept.select(F.input_file_name()).distinct().collect()}
    assert read and all("/run_id=2/" in f for f in read)
    want = pin_runs(fixtures_small["season_map"], pins)
    got = pin_runs(kept, pins)
    assert rows_of(got) == rows_of(want) and got.count() > 0
    # more pinned runs than the bound: the same rows, no filter
    assert rows_of(pin_runs(pinned_folders(stored, pins, at_most=1), pins)) == rows_of(want)
    assert pinned_folders(stored, pins.limit(0)).count() == 0
