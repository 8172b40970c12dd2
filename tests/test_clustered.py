"""Scans for the feed's codes skip row groups and lose no row."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from feedsync.constants import RunContext
from feedsync.plans.changed import ChangedOnly
from feedsync.plans.run import run_reconciliation
from feedsync.sources import in_ranges, key_ranges, scoped, write_clustered

from conftest import rows_of


def _scanned(df) -> int:
    """Rows that the scan of a plan without shuffles gives out."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    return plan.collectLeaves().head().metrics().apply("numOutputRows").value()


def _row_groups(path, by):
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.to_arrow_schema().names.index(by)
        for g in range(meta.num_row_groups):
            yield meta.row_group(g).column(at).statistics, meta.row_group(g).num_rows


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("clustered") / "t")
    # a third of the rows under one code, some under none
    code = F.when(F.col("id") % 3 == 0, "P050000").when(F.col("id") % 1000 == 1, F.lit(None))
    rows = spark.range(60_000).withColumn("code", code.otherwise(F.format_string("P%06d", F.pmod(F.hash("id"), F.lit(100_000)))))
    write_clustered(rows, path, "code", ["id"], row_group_bytes=4096)
    return path


def test_row_groups_are_skipped(spark, stored):
    table = spark.read.parquet(stored)
    keys = spark.createDataFrame([(f"P{i:06d}",) for i in range(1000, 3000)], "code string")
    ranges = key_ranges(keys, "code", 8)
    assert 1 <= len(ranges) <= 8
    groups = list(_row_groups(stored, "code"))
    met = [n for s, n in groups if s is not None and s.has_min_max and any(s.min <= hi and lo <= s.max for lo, hi in ranges)]
    assert len(groups) > 50 and len(met) < len(groups) / 5
    near = table.filter(in_ranges("code", ranges))
    scan = near._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert "Or(" in scan.metadata().apply("PushedFilters")
    # the reader gives out no more than the row groups that a range meets
    assert 0 < _scanned(near) <= sum(met) < 60_000 / 5
    want = table.filter("code >= 'P001000' AND code < 'P003000'")
    assert rows_of(scoped(table, keys, "code", 8)) == rows_of(want)


@pytest.mark.parametrize(
    "codes",
    [[], [None], ["P050000"], [None, "P050000", "P050000", "P000001"], [f"P{i:06d}" for i in range(0, 100_000, 997)], ["", "~"]],
)
def test_scope_is_the_semi_join(spark, stored, codes):
    table = spark.read.parquet(stored)
    keys = spark.createDataFrame([(c,) for c in codes], "code string")
    want = table.join(keys.distinct(), "code", "left_semi").select(*table.columns)
    for at_most in (1, 64):
        assert rows_of(scoped(table, keys, "code", at_most)) == rows_of(want)


def test_hot_code_lies_in_several_files(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more data
    try:
        write_clustered(spark.read.parquet(stored), path, "code", ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(path).filter("code = 'P050000'").select(F.input_file_name().alias("f"))
    assert files.distinct().count() > 1


def test_few_keys_are_single_codes(spark):
    keys = spark.createDataFrame([("A",), ("C",), ("B",), ("B",)], "code string")
    assert all(lo <= hi for lo, hi in key_ranges(keys, "code", 64))
    assert [lo for lo, _ in key_ranges(keys, "code", 64)] == ["A", "B", "C"]


def test_run_with_key_ranges_is_the_same_run(spark, tmp_path, fixtures_small):
    whole = run_reconciliation(spark, fixtures_small, RunContext(run_id=1), str(tmp_path / "a"), changed=ChangedOnly(8))
    cut = run_reconciliation(
        spark, fixtures_small, RunContext(run_id=1), str(tmp_path / "b"), changed=ChangedOnly(8), key_ranges=16
    )
    assert cut.counts() == whole.counts()
