"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL, rows_of

EXPECTED_SF0001 = {
    "valid_codes": 1252,
    "malformed_codes": 63,
    "host_counts": 143,
    "non_single_hosts": 11,
    "single_host_rows": 1155,
    "duplicate_host_report": 10,
    "with_property": 1030,
    "missing_property_report": 115,
    "matched_rows": 885,
    "id_mismatch_report": 60,
    "new_hosts": 10,
    "rename_records": 4,
    "renamed_hosts": 3,
    "renamed_listings": 78,
    "competitor_upserts": 6,
    "compset_diff": 391,
    "pinned_seasons": 292,
    "desired_config": 1720,
    "config_inserts": 536,
    "config_deletes": 417,
    "config_deletes_stored": 417,
    "config_deletes_matched": 161,
    "config_after": 1820,
    "touched_properties": 128,
    "competitor_rejected": 11,
    "table_scan": 1215,
    "compset_seasons": 1720,
    "config_export": 1820,
    "config_updates": 48,
    "config_change_set": 1406,
    "compset_history": 1520,
    "written_reports": 248,
}


def test_contract_keys():
    q, o = entry.queries(), entry.oracle_sql()
    # every query of the library itself has SQL; optional ones are tested on their own
    assert set(entry.QUERY_NAMES) <= set(q) and set(entry.QUERY_NAMES) <= set(o)
    assert set(o) <= set(q)
    assert len(entry.QUERY_NAMES) >= 27


@pytest.mark.parametrize("name", entry.QUERY_NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    sdf = entry.queries()[name](spark, SF_SMALL)
    odf = duck_small.execute(entry.oracle_sql()[name]).df()
    assert sorted(sdf.columns) == sorted(odf.columns)
    got, want = rows_of(sdf), rows_of(odf)
    assert len(got) == len(want)
    assert got == want
    if name in EXPECTED_SF0001:
        assert len(got) == EXPECTED_SF0001[name]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["prop_code", "competitor_id", "season_id", "we_ind", "own_ind"]
    assert df.count() == 536
