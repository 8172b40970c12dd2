"""What a registered query reads several times is computed once, and goes when it is read no more."""

import os
import time

import pytest
from conftest import SF_SMALL, rows_of
from pyspark.sql import functions as F

from feedsync.operators import export_ordered, read_export
from feedsync.plans.round_trips import StagedOnce
from feedsync.session import shared_dir
from feedsync.sources import accepted, check_fields, in_ranges


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", ["config_after", "config_change_set", "config_deletes_stored", "compset_history", "output_audit"])
def test_traded_pairs_and_codes_are_read_back(spark, name):
    from __spark_entry__ import queries

    files = " ".join(queries()[name](spark, SF_SMALL).inputFiles())
    assert "/staged-" in files or "clustered-config" in files
    assert "lineitem.parquet" not in files and "orders.parquet" not in files


def test_the_changed_pairs_of_the_history_are_joined_once(spark):
    from __spark_entry__ import queries

    assert "/history_changes/" in " ".join(queries()["compset_history"](spark, SF_SMALL).inputFiles())


def test_staged_views_are_the_lazy_views(spark, views_small):
    from __spark_entry__ import queries

    for name in ("config_inserts", "config_deletes_matched", "touched_properties", "compset_rejected"):
        assert rows_of(queries()[name](spark, SF_SMALL)) == rows_of(views_small[name])


def test_an_export_is_parsed_once_to_be_read(spark, tmp_path):
    table = spark.range(500).select(F.concat(F.lit("P"), F.col("id") % 9).alias("code"), "id")
    export_ordered(table, f"{tmp_path}/a", ["code"], rows_per_file=60)
    got = read_export(spark, f"{tmp_path}/a", table.schema, ["code"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1 and "Window" not in plan  # the list of parts
    want = sorted((r.code, r.id) for r in table.collect())
    assert [(r.position, r.code, r.id) for r in got.orderBy("position").collect()] == [
        (i, *r) for i, r in enumerate(want, 1)
    ]


def test_a_record_is_cut_once(spark):
    records = spark.createDataFrame([('P000001,H,1,"a,b",c', True), ("x,y", True)], "record string, closed boolean")
    checked = check_fields(records)
    assert _optimized(accepted(checked)).count("from_csv") == 1
    assert [tuple(r) for r in accepted(checked).collect()] == [("P000001", "H", "1", "a,b", "c")]


def test_a_key_is_tested_against_one_path_of_the_ranges(spark):
    ranges = [(f"P{i:03}", f"P{i:03}z") for i in range(0, 640, 10)]
    keys = spark.range(700).select(F.format_string("P%03dk", "id").alias("code"))
    inside = keys.filter(in_ranges("code", ranges))
    outermost = _optimized(inside).replace(" ", "")
    assert "code#" in outermost and ">=P000)AND(" in outermost and "<=P630z)" in outermost
    assert inside.count() == 64
    assert keys.filter(in_ranges("code", ranges[::-1])).count() == 64
    assert keys.filter(in_ranges("code", [("P1", "P3"), ("P2", "P25")])).count() == keys.filter("code >= 'P1' and code <= 'P3'").count()


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (str(found.apply(i)) for i in range(found.size())) if "/shuffle_" in f}


def test_a_staged_step_leaves_no_shuffles(spark):
    rows = [(f"P{i % 5}" if i % 4 else None, i % 7) for i in range(400)] * 2
    table = spark.createDataFrame(rows, "prop_code string, id int")
    before = _shuffle_files(spark)
    stage = StagedOnce(spark, ["whole", "cut"], {"cut": 3})
    spread = table.repartition(6, "id")
    whole, cut = stage("whole", spread), stage("cut", spread)
    assert stage("other", spread) is spread
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert rows_of(whole) == rows_of(cut) == rows_of(table)
    stage.drop("cut")
    assert os.listdir(stage.root.removeprefix("file:")) == ["whole"]


@pytest.mark.parametrize("name", ["config_export", "config_export_order"])
def test_an_export_keeps_no_step_on_disk(spark, name):
    from __spark_entry__ import queries

    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root))
    rows = queries()[name](spark, SF_SMALL)
    new = [f"{d}/{f}" for top in set(os.listdir(root)) - before for d, _, fs in os.walk(f"{root}/{top}") for f in fs]
    assert not [f for f in new if "/staged-" in f]
    parts = [f for f in new if "/config-export-" in f and "/data/part-" in f]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    assert rows.count() > 1000
