"""Faults that a table state must not show, and codes beyond six digits."""

import pytest
from pyspark.sql import functions as F

from feedsync.constants import RunContext
from feedsync.operators import apply_changes, competitor_upserts, current_rows, upsert
from feedsync.plans.job import run_job
from feedsync.plans.run import run_reconciliation
from feedsync.plans.snapshots import Bucketing, RunLayout, latest_complete_run, read_state, write_table
from feedsync.plans.views import reconcile_views
from feedsync.sources import ParquetSource, write_feed
from feedsync.sources.fixtures import fixture_tables, load_tpch

from conftest import SF_SMALL


def test_upsert_takes_no_null_key_or_name(spark):
    names = "competitor_id int, competitor_name string"
    stored = spark.createDataFrame([(5, "A"), (6, "B")], names)
    pairs = spark.createDataFrame([(5, None), (None, "X"), (6, "C"), (7, "D")], names)
    hosts = spark.createDataFrame([], names)
    rows = competitor_upserts(pairs, stored, hosts, "batch")
    assert sorted((r.competitor_id, r.competitor_name) for r in rows.collect()) == [(6, "C"), (7, "D")]
    after = stored
    for _ in range(3):
        after = upsert(after, pairs.filter("competitor_id IS NULL").unionByName(rows.select(*after.columns)), ["competitor_id"])
    assert sorted(map(tuple, after.collect())) == [(5, "A"), (6, "C"), (7, "D")]


def test_own_row_survives_when_the_host_stops_being_its_own_competitor(spark, fixtures_small):
    t = dict(fixtures_small)
    own = t["compset"].filter("own_ind = 'Y'").count()
    # every host that the feed lists as its own competitor
    first = reconcile_views(t)
    assert first["compset_after"].filter("own_ind = 'Y'").count() >= own
    stored = first["compset_after"]
    # no pair is both an own and a competitor row (a pair may have several date ranges)
    twice = stored.groupBy("prop_code", "competitor_id").agg(F.count_distinct("own_ind").alias("n"))
    twice = twice.filter("n > 1 AND competitor_id IS NOT NULL")
    assert twice.count() == 0
    t["compset"] = stored
    t["listing"] = t["listing"].filter("NOT (role = 'C' AND ext_id LIKE '%n/a%')").filter(
        ~((F.col("role") == "C") & (F.col("ext_id").try_cast("int") % 3 == 1))
    )
    after = reconcile_views(t)["compset_after"]
    gone = stored.filter("own_ind = 'Y'").select("prop_code", "competitor_id").exceptAll(
        after.filter("own_ind = 'Y'").select("prop_code", "competitor_id")
    )
    assert gone.count() == 0


def test_apply_keeps_protected_rows(spark):
    rows = spark.createDataFrame([("P1", 5, "Y"), ("P1", 5, "N"), ("P1", 6, "N")], "prop_code string, competitor_id int, own_ind string")
    gone = rows.select("prop_code", "competitor_id").distinct()
    after, _ = apply_changes(rows, rows.limit(0), gone, keep=F.col("own_ind") == "Y")
    assert [tuple(r) for r in after.collect()] == [("P1", 5, "Y")]


@pytest.mark.parametrize("bucketed", [False, True])
def test_empty_states(spark, tmp_path, bucketed):
    b = Bucketing(4, {"compset": ("prop_code", "competitor_id")}, prefix="e_") if bucketed else None
    layout = RunLayout(str(tmp_path), 1)
    one = spark.createDataFrame([("P1", 5)], "prop_code string, competitor_id int")
    write_table(one.limit(0), layout, "compset", b)  # a first state without rows
    assert read_state(spark, str(tmp_path), "compset", 1, b).count() == 0
    write_table(one, layout, "compset", b)
    assert read_state(spark, str(tmp_path), "compset", 1, b).count() == 1
    write_table(one.limit(0), layout, "compset", b)  # replaces the earlier attempt
    assert read_state(spark, str(tmp_path), "compset", 1, b).columns == one.columns
    assert read_state(spark, str(tmp_path), "compset", 1, b).count() == 0


def test_unreadable_audit_is_an_error(spark, tmp_path):
    assert latest_complete_run(spark, str(tmp_path / "new")) is None
    (tmp_path / "audit" / "run=1").mkdir(parents=True)
    (tmp_path / "audit" / "run=1" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        latest_complete_run(spark, str(tmp_path))


def test_bucketed_states_of_two_roots_are_apart(spark, tmp_path):
    b = Bucketing(4, {"compset": ("prop_code", "competitor_id")}, prefix="r_")
    for n, root in ((1, "a"), (2, "b")):
        rows = spark.createDataFrame([(f"P{n}", n)] * n, "prop_code string, competitor_id int")
        write_table(rows, RunLayout(str(tmp_path / root), 1), "compset", b)
    for n, root in ((1, "a"), (2, "b")):
        assert read_state(spark, str(tmp_path / root), "compset", 1, b).count() == n
    # turning buckets on over a plain root reads the plain state
    write_table(rows, RunLayout(str(tmp_path / "c"), 1), "compset")
    assert read_state(spark, str(tmp_path / "c"), "compset", 1, b).count() == 2


def test_match_rules_need_their_columns(spark):
    plain = spark.createDataFrame([("P1", 5, "Y")], "prop_code string, competitor_id int, own_ind string")
    with pytest.raises(ValueError, match="active_ind"):
        current_rows(plain, active_only=True)
    with pytest.raises(ValueError, match="eff_start_date"):
        current_rows(plain, on_date="2024-01-01")


def test_codes_of_seven_digits_stay_apart(spark):
    tables = load_tpch(spark, SF_SMALL)
    big = 1_000_000
    tables["customer"] = tables["customer"].withColumn("c_custkey", F.col("c_custkey") + big)
    tables["orders"] = tables["orders"].withColumn("o_custkey", F.col("o_custkey") + big)
    t = fixture_tables(tables)
    codes = t["run_pin"].select("prop_code").distinct()
    assert codes.count() == tables["customer"].count()
    assert codes.filter("length(prop_code) = 8").count() == codes.count()
    ids = t["competitor"].groupBy("competitor_id").count().filter("count > 1")
    assert ids.count() == 0
    v = reconcile_views(t)
    assert v["malformed_codes"].count() < v["feed_scan"].count() / 10
    assert v["matched_rows"].count() > 0


def test_extra_columns_survive_two_runs(spark, tmp_path, fixtures_small):
    tables = str(tmp_path / "tables")
    for name in ("property", "compset", "competitor", "season_map", "comp_config"):
        fixtures_small[name].withColumn("note", F.lit(name)).write.parquet(f"{tables}/{name}.parquet")
    write_feed(fixtures_small["listing"], str(tmp_path / "feed"))
    fixtures_small["run_pin"].write.option("header", "true").csv(str(tmp_path / "pins"))
    root = str(tmp_path / "root")
    for run in (1, 2):
        run_job(spark, str(tmp_path / "feed"), str(tmp_path / "pins"), ParquetSource(tables), RunContext(run_id=run), root=root)
    for name in ("compset", "competitor", "comp_config"):
        state = read_state(spark, root, name, 2)
        assert set(fixtures_small[name].columns) | {"note"} == set(state.columns)
        kept = state.filter("last_upd_by = 'seed'")
        assert kept.count() > 0 and kept.filter(f"note <> '{name}' OR note IS NULL").count() == 0


def test_rejected_competitor_rows_are_reported(spark, tmp_path, fixtures_small):
    res = run_reconciliation(spark, fixtures_small, RunContext(run_id=1), root=str(tmp_path / "r"))
    assert res.counts()["competitor_rejected"] == 11
    after = read_state(spark, res.layout.root, "competitor", 1)
    assert after.filter("competitor_id IS NULL OR competitor_name IS NULL").count() == 0
