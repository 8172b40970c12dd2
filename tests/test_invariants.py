
from pyspark.sql import functions as F

from feedsync.constants import PAIR_KEYS
from feedsync.plans.views import reconcile_views


def test_valid_plus_malformed_is_feed(views_small):
    v = views_small
    assert v["valid_codes"].count() + v["malformed_codes"].count() == v["feed_scan"].count()


def test_single_host_rows_split_by_property(views_small):
    v = views_small
    single = v["single_host_rows"].count()
    with_prop = v["with_property"].count()
    # rows of single-host groups without property = those groups' rows
    missing = (
        v["single_host_rows"]
        .join(v["host_state"].select("prop_code"), "prop_code", "left_anti")
        .count()
    )
    assert with_prop + missing == single


def test_inserts_not_in_current_and_deletes_in_current(views_small, fixtures_small):
    v = views_small
    cur = fixtures_small["comp_config"].select(*PAIR_KEYS)
    assert v["config_inserts"].join(cur, list(PAIR_KEYS), "left_semi").count() == 0
    assert v["config_deletes"].join(cur, list(PAIR_KEYS), "left_anti").count() == 0


def test_after_keys(views_small, fixtures_small):
    v = views_small
    k = list(PAIR_KEYS)
    cur = fixtures_small["comp_config"].select(*k).distinct()
    expect = cur.join(v["config_deletes"], k, "left_anti").unionByName(v["config_inserts"].select(*k)).distinct()
    expect = expect.filter("competitor_id IS NOT NULL")  # a NULL id is rejected on apply
    got = v["config_after"].select(*k).distinct()
    assert expect.exceptAll(got).count() == 0 and got.exceptAll(expect).count() == 0


def test_applying_twice_changes_nothing(views_small, fixtures_small):
    t = dict(fixtures_small)
    t["comp_config"] = views_small["config_after"]
    v2 = reconcile_views(t)
    # a listing without id can never be stored: it stays an insert that is rejected
    assert v2["config_inserts"].filter("competitor_id IS NOT NULL").count() == 0
    assert v2["config_deletes"].count() == 0


def test_scope_matched_is_subset(views_small):
    v = views_small
    matched, every = v["config_deletes_matched"], v["config_deletes"]
    assert matched.exceptAll(every).count() == 0 and 0 < matched.count() < every.count()
    codes = v["desired_config"].select("prop_code").distinct()
    assert matched.join(codes, "prop_code", "left_anti").count() == 0
    # a pair of the wider scope only is of a property without desired rows
    assert every.exceptAll(matched).join(codes, "prop_code", "left_semi").count() == 0


def test_host_states_cover_single_groups(views_small):
    v = views_small
    n_single = v["host_counts"].filter(F.col("n_host") == 1).count()
    states = {r["state"]: r["count"] for r in v["host_state"].groupBy("state").count().collect()}
    assert states == {"absent": 10, "match": 101, "mismatch": 7}
    assert sum(states.values()) + 14 == n_single  # 14 without property


def test_join_and_tag_forms_of_reports_agree(fixtures_small, views_small):
    """The generic join-based report gives the same rows as the tag-based filters."""
    from feedsync.operators import check_codes, derive, host_groups, report

    feed = fixtures_small["listing"]
    groups = host_groups(check_codes(derive(feed)).filter("code_ok"))
    dup = report(feed, groups.filter("n_host <> 1"), role="H")
    assert dup.exceptAll(views_small["duplicate_host_report"]).count() == 0
    assert dup.count() == views_small["duplicate_host_report"].count() == 10

    states = views_small.state
    for state, name in (("no_property", "missing_property_report"), ("mismatch", "id_mismatch_report")):
        rows = report(feed, states.filter(F.col("state") == state))
        assert rows.exceptAll(views_small[name]).count() == 0
        assert views_small[name].exceptAll(rows).count() == 0
    parts = ("malformed_codes", "duplicate_host_report", "missing_property_report", "id_mismatch_report")
    assert views_small["_all_reports"].count() == sum(views_small[n].count() for n in parts)
