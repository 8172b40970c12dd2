"""Plan shape: filters and column pruning reach the scan, nothing is broadcast by the
static planner, and a change set reads the config once."""

import re

from feedsync.plans.snapshots import RunLayout, stage_to
from feedsync.plans.views import reconcile_views


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_staged_scans_push_filters_and_prune(spark, tmp_path, fixtures_small):
    v = reconcile_views(fixtures_small, stage=stage_to(RunLayout(str(tmp_path), 1), spark))
    plan = _plan(v["matched_rows"])
    assert "EqualTo(state,match)" in plan and "EqualTo(code_ok,true)" in plan
    scanned = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    assert "n_host" not in scanned and "host_id" not in scanned and "is_host" not in scanned  # pruned

    reports = _plan(v["id_mismatch_report"])
    assert "EqualTo(state,mismatch)" in reports

    # B16 scoping reads only the code column of the staged summary
    ins = v["config_inserts"]
    assert ins.count() == 536


def test_no_static_broadcast(spark, fixtures_small):
    v = reconcile_views(fixtures_small)
    for name in ("desired_config", "config_after", "compset_after", "competitor_after"):
        plan = v[name]._jdf.queryExecution().sparkPlan().toString()
        assert "Broadcast" not in plan and "TakeOrdered" not in plan
        assert plan.count("SortMergeJoin") >= 1


def test_change_set_reads_the_config_once(spark, tmp_path, fixtures_small):
    t = {}
    for name, df in fixtures_small.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
        t[name] = spark.read.parquet(f"{tmp_path}/{name}.parquet")
    for name in ("config_inserts", "config_deletes", "touched_properties"):
        plan = reconcile_views(t)[name]._jdf.queryExecution().analyzed().toString()
        reads = [line for line in plan.splitlines() if "Relation" in line and "sys_weight" in line]
        # touched takes inserts, deletes and updates of the one change set (its exchange is
        # reused), and the update class looks at the stored flags
        assert len(reads) == (4 if name == "touched_properties" else 1), name


def test_upserts_do_not_shuffle_listings_by_competitor(spark, fixtures_small):
    plan = _plan(reconcile_views(fixtures_small)["competitor_upserts"])
    # what goes to the rename join is the distinct pairs: never a listing column
    for line in plan.splitlines():
        if "Exchange hashpartitioning(competitor_id" in line:
            assert "raw_code" not in line and "prop_code" not in line
