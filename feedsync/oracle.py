"""Independent SQL definitions of every registered query, for DuckDB.

The driver registers only its own tables, so each query is one ``WITH`` chain:
the fixture views of FIXTURES.md (derived from customer, supplier, nation,
orders, lineitem) followed by the operator views it depends on.  The chain for
a query is assembled from the dependency graph below, so every statement is
written exactly once.

These strings are deliberately *not* generated from the Spark code: they are a
"""

from __future__ import annotations

import re

# ---------------------------------------------------------------------------
# Fixture views (FIXTURES.md §3), portable between Spark SQL and DuckDB.
# ---------------------------------------------------------------------------
FIXTURE_VIEWS: dict[str, str] = {
    "fx_pairs": (
        "SELECT DISTINCT o_custkey AS custkey, l_suppkey AS suppkey "
        "FROM orders JOIN lineitem ON o_orderkey = l_orderkey"
    ),
    "fx_host": (
        "SELECT c_custkey AS custkey, "
        "'P' || lpad(CAST(c_custkey AS STRING),CAST(greatest(6,length(CAST(c_custkey AS STRING))) AS INT),'0') AS prop_code, "
        "CASE WHEN c_custkey % 17 = 0 THEN ' ' || lower('P' || lpad(CAST(c_custkey AS STRING),CAST(greatest(6,length(CAST(c_custkey AS STRING))) AS INT),'0')) || ' ' "
        "WHEN c_custkey % 19 = 0 THEN 'X-' || CAST(c_custkey AS STRING) "
        "ELSE 'P' || lpad(CAST(c_custkey AS STRING),CAST(greatest(6,length(CAST(c_custkey AS STRING))) AS INT),'0') END AS feed_code, "
        "CASE WHEN c_custkey % 31 = 0 THEN 'n/a' ELSE CAST(3 * c_custkey + 1 AS STRING) END AS feed_ext_id, "
        "CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_mktsegment END AS chain, "
        "c_name AS hotel FROM customer"
    ),
    "listing": (
        "SELECT feed_code AS raw_code, 'H' AS role, feed_ext_id AS ext_id, chain AS chain_name, hotel AS hotel_name "
        "FROM fx_host WHERE custkey % 23 <> 0 "
        "UNION ALL SELECT feed_code, 'H', feed_ext_id, chain, hotel FROM fx_host WHERE custkey % 29 = 0 "
        "UNION ALL SELECT feed_code, 'C', feed_ext_id, chain, hotel FROM fx_host WHERE custkey % 53 = 0 "
        "UNION ALL SELECT feed_code, 'C', 'n/a', 'NEW', hotel FROM fx_host WHERE custkey % 61 = 7 "
        "UNION ALL SELECT h.feed_code, 'C', "
        "CASE WHEN (p.custkey + p.suppkey) % 97 = 0 THEN 'id ' || CAST(p.suppkey AS STRING) "
        "ELSE CAST(3 * p.suppkey AS STRING) END, n_name, "
        "CASE WHEN (p.custkey + p.suppkey) % 89 = 0 THEN NULL ELSE s_name END "
        "FROM fx_pairs p JOIN fx_host h ON h.custkey = p.custkey "
        "JOIN supplier ON s_suppkey = p.suppkey JOIN nation ON n_nationkey = s_nationkey "
        "WHERE (p.custkey * 7 + p.suppkey) % 10 < 8"
    ),
    "property": (
        "SELECT 'P' || lpad(CAST(c_custkey AS STRING),CAST(greatest(6,length(CAST(c_custkey AS STRING))) AS INT),'0') AS prop_code FROM customer WHERE c_custkey % 11 <> 0"
    ),
    "compset": (
        "SELECT prop_code AS prop_code, CAST(3 * p.suppkey AS INT) AS competitor_id, 'N' AS own_ind, "
        "CASE WHEN (p.custkey + p.suppkey) % 4 = 0 THEN 'N' ELSE 'Y' END AS active_ind, "
        "CAST(DATE '2020-01-01' + CAST(p.custkey % 365 AS INT) AS DATE) AS eff_start_date, "
        "CASE WHEN p.suppkey % 6 = 0 THEN DATE '2023-06-30' END AS eff_end_date, "
        "'seed' AS last_upd_by, TIMESTAMP '2020-01-01 00:00:00' AS last_upd_ts "
        "FROM fx_pairs p JOIN fx_host h ON h.custkey = p.custkey "
        "WHERE (p.custkey * 7 + p.suppkey) % 10 >= 2 AND p.custkey % 13 <> 0 "
        "UNION ALL SELECT prop_code, CAST(3 * custkey + CASE WHEN custkey % 41 = 0 THEN 2 ELSE 1 END AS INT), 'Y', "
        "'Y', DATE '2020-01-01', NULL, 'seed', TIMESTAMP '2020-01-01 00:00:00' "
        "FROM fx_host WHERE custkey % 13 <> 0 "
        "UNION ALL SELECT prop_code, CAST(3 * p.suppkey AS INT), 'N', 'N', "
        "CAST(DATE '2020-01-01' + CAST(p.custkey % 365 AS INT) - 100 AS DATE), "
        "CAST(DATE '2020-01-01' + CAST(p.custkey % 365 AS INT) + "
        "CASE p.custkey % 3 WHEN 0 THEN 10 WHEN 1 THEN -1 ELSE -30 END AS DATE), "
        "'seed', TIMESTAMP '2020-01-01 00:00:00' FROM fx_pairs p JOIN fx_host h ON h.custkey = p.custkey "
        "WHERE (p.custkey * 7 + p.suppkey) % 10 >= 2 AND p.custkey % 13 <> 0 AND (p.custkey + p.suppkey) % 59 = 0"
    ),
    "competitor": (
        "SELECT CAST(3 * s_suppkey AS INT) AS competitor_id, "
        "CASE WHEN s_suppkey % 5 = 0 THEN 'OLD ' ELSE '' END || n_name || ' ' || s_name AS competitor_name, "
        "'seed' AS last_upd_by, TIMESTAMP '2020-01-01 00:00:00' AS last_upd_ts "
        "FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 7 <> 0 "
        "UNION ALL SELECT CAST(3 * c_custkey + 1 AS INT), "
        "CASE WHEN c_custkey % 43 = 0 THEN 'OLD ' ELSE '' END || c_mktsegment || ' ' || c_name, "
        "'seed', TIMESTAMP '2020-01-01 00:00:00' "
        "FROM customer WHERE c_custkey % 13 <> 0"
    ),
    "season_map": (
        "SELECT 'P' || lpad(CAST(c_custkey AS STRING),CAST(greatest(6,length(CAST(c_custkey AS STRING))) AS INT),'0') AS prop_code, CAST(r AS BIGINT) AS run_id, "
        "CAST(r * 10 + s AS INT) AS season_id, CASE WHEN s = 1 THEN 'N' ELSE 'Y' END AS we_ind "
        "FROM customer CROSS JOIN (SELECT 1 AS r UNION ALL SELECT 2 UNION ALL SELECT 3) a "
        "CROSS JOIN (SELECT 1 AS s UNION ALL SELECT 2) b WHERE c_custkey % 47 <> 0"
    ),
    "run_pin": (
        "SELECT 'P' || lpad(CAST(c_custkey AS STRING),CAST(greatest(6,length(CAST(c_custkey AS STRING))) AS INT),'0') AS prop_code, CAST(1 + c_custkey % 3 AS BIGINT) AS run_id "
        "FROM customer"
    ),
    "comp_config": (
        "SELECT prop_code, CAST(id AS INT) AS competitor_id, CAST((1 + custkey % 3) * 10 + s AS INT) AS season_id, "
        "CASE WHEN custkey % 61 <> 7 AND (custkey + 2 * suppkey) % 71 = 0 THEN NULL "
        "WHEN custkey % 61 <> 7 AND (custkey + 2 * suppkey) % 61 = 0 THEN CASE WHEN s = 1 THEN 'Y' ELSE 'N' END "
        "WHEN s = 1 THEN 'N' ELSE 'Y' END AS we_ind, "
        "CASE WHEN suppkey % 3 = 0 THEN 'Y' ELSE 'N' END AS cmptn_ind, "
        "CAST((1 + custkey % 100) * 0.125 AS DECIMAL(38,18)) AS sys_weight, "
        "CAST((1 + suppkey % 100) * 0.25 AS DECIMAL(38,18)) AS usr_weight, "
        "CAST((1 + suppkey % 50) * 0.015625 AS DECIMAL(38,18)) AS closed_fill_in_rt, "
        "CASE WHEN suppkey % 4 = 0 THEN CAST((1 + custkey % 10) * 0.5 AS DECIMAL(38,18)) END AS closed_fill_in_usr, "
        "CASE WHEN suppkey IS NULL OR (custkey % 61 <> 7 AND (2 * custkey + suppkey) % 67 = 0) "
        "THEN 'Y' ELSE 'N' END AS own_ind, CAST(custkey % 7 AS INT) AS prd_profile_id, "
        "'seed' AS last_upd_by, TIMESTAMP '2020-01-01 00:00:00' AS last_upd_ts FROM ("
        "SELECT h.prop_code, p.custkey, p.suppkey, 3 * p.suppkey AS id "
        "FROM fx_pairs p JOIN fx_host h ON h.custkey = p.custkey WHERE p.custkey % 13 <> 0 AND "
        "CASE WHEN p.custkey % 61 = 7 THEN (p.custkey * 7 + p.suppkey) % 10 < 8 AND (p.custkey + p.suppkey) % 97 <> 0 "
        "ELSE (p.custkey * 7 + p.suppkey) % 10 >= 1 AND (p.custkey + p.suppkey) % 9 <> 0 END "
        "UNION ALL SELECT prop_code, custkey, NULL, 3 * custkey + 1 FROM fx_host "
        "WHERE custkey % 61 = 7 AND custkey % 13 <> 0) c "
        "CROSS JOIN (SELECT 1 AS s UNION ALL SELECT 2) b"
    ),
}

# ---------------------------------------------------------------------------
# Operator views (DuckDB dialect).  Fixed values shared with the Spark side:
# code pattern P + six digits or more, host role 'H', own flag 'Y', program code 'MRC',
# audit user 'batch'.
# ---------------------------------------------------------------------------
_FEED_COLS = "raw_code, role, ext_id, chain_name, hotel_name"

# One record more for each customer (fixtures.feed_lines): raw text, fields, and whether the
# number of fields is right.
_CODE = "'P' || lpad(CAST(c_custkey AS VARCHAR), CAST(greatest(6, length(CAST(c_custkey AS VARCHAR))) AS INT), '0')"
_OWN = "CAST(3 * c_custkey + 1 AS VARCHAR)"
_NL = "chr(10)"

OPERATOR_VIEWS: dict[str, str] = {
    "planted_records": (
        f"SELECT c_custkey % 8 AS m, c_mktsegment AS seg, c_name AS hotel, {_CODE} AS code, {_OWN} AS own, "
        "CASE c_custkey % 8 "
        f"WHEN 0 THEN {_CODE} || ',H,' || {_OWN} || ',' || c_mktsegment || ',' || c_name || ',EXTRA' "
        f"WHEN 1 THEN {_CODE} || ',H' "
        f"WHEN 3 THEN {_CODE} || ',X,no ' || {_OWN} || ',' || c_mktsegment || ',' || c_name "
        f"WHEN 4 THEN {_CODE} || ',C,99999' || lpad({_OWN}, 9, '0') || ',' || c_mktsegment || ',' || c_name "
        f"WHEN 5 THEN ',H,' || {_OWN} || ',' || c_mktsegment || ',' END AS record FROM customer"
    ),
    "listing_records": (
        f"SELECT *, concat_ws(',', coalesce(raw_code, ''), coalesce(role, ''), coalesce(ext_id, ''), "
        "coalesce(chain_name, ''), coalesce(hotel_name, '')) AS record, "
        "regexp_full_match(trim(ext_id), '[0-9]+') AS id_ok FROM listing"
    ),
    # B03 + B04: derived columns and canonical code on every raw row.
    "derived": (
        f"SELECT {_FEED_COLS}, upper(trim(raw_code)) AS prop_code, "
        "CASE WHEN regexp_full_match(trim(ext_id), '[0-9]+') THEN TRY_CAST(trim(ext_id) AS INTEGER) END AS competitor_id, "
        "chain_name || ' ' || hotel_name AS competitor_name, "
        "coalesce(role = 'H', false) AS is_host, "
        "coalesce(regexp_full_match(upper(trim(raw_code)), 'P[0-9]{6,}'), false) AS code_ok "
        "FROM listing"
    ),
    "valid": "SELECT * FROM derived WHERE code_ok",
    # B05
    "host_counts": (
        "SELECT prop_code, CAST(count(*) FILTER (WHERE is_host) AS BIGINT) AS n_host, "
        "CAST(count(*) FILTER (WHERE NOT is_host) AS BIGINT) AS n_comp, "
        "max(competitor_id) FILTER (WHERE is_host) AS host_id "
        "FROM valid GROUP BY prop_code"
    ),
    "single_rows": (
        "SELECT v.* FROM valid v WHERE EXISTS "
        "(SELECT 1 FROM host_counts g WHERE g.prop_code = v.prop_code AND g.n_host = 1)"
    ),
    # B07 + B08: one row per single-host group with its classification.
    "host_state": (
        "SELECT g.prop_code, g.host_id, "
        "CASE WHEN NOT EXISTS (SELECT 1 FROM property p WHERE p.prop_code = g.prop_code) THEN 'no_property' "
        "WHEN NOT EXISTS (SELECT 1 FROM compset c WHERE c.prop_code = g.prop_code) THEN 'absent' "
        "WHEN EXISTS (SELECT 1 FROM compset c WHERE c.prop_code = g.prop_code AND c.own_ind = 'Y' "
        "AND c.competitor_id = g.host_id) THEN 'match' ELSE 'mismatch' END AS state "
        "FROM host_counts g WHERE g.n_host = 1"
    ),
    "with_property_rows": (
        "SELECT s.* FROM single_rows s WHERE EXISTS "
        "(SELECT 1 FROM host_state h WHERE h.prop_code = s.prop_code AND h.state <> 'no_property')"
    ),
    "matched": (
        "SELECT s.* FROM single_rows s WHERE EXISTS "
        "(SELECT 1 FROM host_state h WHERE h.prop_code = s.prop_code AND h.state = 'match')"
    ),
    # B11
    "rename_records": (
        "SELECT f.competitor_id, c.competitor_name AS old_name, f.competitor_name AS new_name "
        "FROM (SELECT DISTINCT competitor_id, competitor_name FROM derived "
        "WHERE competitor_id IS NOT NULL AND competitor_name IS NOT NULL) f "
        "JOIN competitor c ON c.competitor_id = f.competitor_id WHERE f.competitor_name <> c.competitor_name"
    ),
    "rename_pick": "SELECT competitor_id, max(new_name) AS new_name FROM rename_records GROUP BY competitor_id",
    "renamed_matched": (
        "SELECT m.prop_code, m.role, m.is_host, m.competitor_id, "
        "CASE WHEN m.is_host THEN m.competitor_name ELSE coalesce(r.new_name, m.competitor_name) END AS competitor_name, "
        "NOT m.is_host AND r.new_name IS NOT NULL AS renamed "
        "FROM matched m LEFT JOIN rename_pick r ON r.competitor_id = m.competitor_id"
    ),
    "renamed_hosts": (
        "SELECT r.competitor_id, r.new_name AS competitor_name FROM matched m "
        "JOIN rename_pick r ON r.competitor_id = m.competitor_id WHERE m.is_host"
    ),
    # B13
    # (a pair that is an own row already is no competitor pair)
    "desired_pairs": (
        "SELECT DISTINCT m.prop_code, m.competitor_id FROM matched m WHERE NOT m.is_host AND NOT EXISTS "
        "(SELECT 1 FROM compset c WHERE c.own_ind = 'Y' AND c.prop_code = m.prop_code "
        "AND c.competitor_id = m.competitor_id)"
    ),
    "current_pairs": (
        "SELECT DISTINCT c.prop_code, c.competitor_id FROM compset c "
        "WHERE NOT coalesce(c.own_ind = 'Y', false) AND EXISTS "
        "(SELECT 1 FROM host_state h WHERE h.prop_code = c.prop_code AND h.state = 'match')"
    ),
    # B17 on the compset and competitor tables
    "new_hosts_v": (
        "SELECT h.prop_code, h.host_id AS competitor_id, 'Y' AS own_ind, 'Y' AS active_ind, "
        "TIMESTAMP '2024-01-01 00:00:00' AS last_upd_ts FROM host_state h WHERE h.state = 'absent'"
    ),
    "compset_ins": (
        "SELECT d.prop_code, d.competitor_id, 'N' AS own_ind FROM desired_pairs d WHERE NOT EXISTS "
        "(SELECT 1 FROM current_pairs c WHERE c.prop_code = d.prop_code AND c.competitor_id = d.competitor_id) "
        "UNION ALL SELECT prop_code, competitor_id, own_ind FROM new_hosts_v"
    ),
    "compset_del": (
        "SELECT c.prop_code, c.competitor_id FROM current_pairs c WHERE NOT EXISTS "
        "(SELECT 1 FROM desired_pairs d WHERE d.prop_code = c.prop_code AND d.competitor_id = c.competitor_id)"
    ),
    "upserts_v": (
        "SELECT DISTINCT r.competitor_id, r.competitor_name FROM renamed_matched r "
        "WHERE NOT r.is_host AND r.competitor_id IS NOT NULL AND r.competitor_name IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM competitor c "
        "WHERE c.competitor_id = r.competitor_id AND c.competitor_name = r.competitor_name) "
        "UNION ALL SELECT competitor_id, competitor_name FROM renamed_hosts"
    ),
    # the compset as date ranges: changes against the pairs in force on the data date
    "in_force": (
        "SELECT * FROM compset WHERE coalesce(eff_start_date <= DATE '2024-01-01', true) "
        "AND coalesce(eff_end_date >= DATE '2024-01-01', true)"
    ),
    "dated_pairs": (
        "SELECT DISTINCT m.prop_code, m.competitor_id FROM matched m WHERE NOT m.is_host AND NOT EXISTS "
        "(SELECT 1 FROM in_force c WHERE c.own_ind = 'Y' AND c.prop_code = m.prop_code "
        "AND c.competitor_id = m.competitor_id)"
    ),
    "dated_rows": (
        "SELECT c.prop_code, c.competitor_id, c.own_ind, c.eff_start_date AS s, "
        "CASE WHEN g.gone AND coalesce(c.eff_end_date >= DATE '2024-01-01', true) "
        "THEN DATE '2023-12-31' ELSE c.eff_end_date END AS e "
        "FROM (SELECT *, NOT coalesce(own_ind = 'Y', false) AND EXISTS "
        "(SELECT 1 FROM in_force f WHERE f.prop_code = compset.prop_code "
        "AND f.competitor_id = compset.competitor_id AND NOT coalesce(f.own_ind = 'Y', false)) AND EXISTS "
        "(SELECT 1 FROM host_state h WHERE h.prop_code = compset.prop_code AND h.state = 'match') AND NOT EXISTS "
        "(SELECT 1 FROM dated_pairs d WHERE d.prop_code = compset.prop_code "
        "AND d.competitor_id = compset.competitor_id) AS gone FROM compset) c, LATERAL (SELECT c.gone AS gone) g "
        "WHERE NOT (g.gone AND coalesce(c.eff_start_date >= DATE '2024-01-01', false) "
        "AND coalesce(c.eff_end_date >= DATE '2024-01-01', true)) "
        "UNION ALL SELECT d.prop_code, d.competitor_id, 'N', DATE '2024-01-01', NULL FROM dated_pairs d "
        "WHERE d.competitor_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM in_force f "
        "WHERE f.prop_code = d.prop_code AND f.competitor_id = d.competitor_id) "
        "UNION ALL SELECT prop_code, competitor_id, own_ind, DATE '2024-01-01', NULL FROM new_hosts_v "
        "WHERE competitor_id IS NOT NULL"
    ),
    "dated_days": (
        "SELECT prop_code, competitor_id, own_ind, coalesce(s, DATE '0001-01-01') AS s, "
        "max(coalesce(e, DATE '9999-12-31')) AS e FROM dated_rows GROUP BY 1, 2, 3, 4"
    ),
    "dated_steps": (
        "SELECT *, max(e) OVER (PARTITION BY prop_code, competitor_id, own_ind ORDER BY s "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM dated_days"
    ),
    "dated_islands": (
        "SELECT *, sum(CASE WHEN before IS NULL OR s > before + 1 THEN 1 ELSE 0 END) "
        "OVER (PARTITION BY prop_code, competitor_id, own_ind ORDER BY s) AS island FROM dated_steps"
    ),
    # B14 + B15
    "pinned_seasons": (
        "SELECT s.prop_code, s.run_id, s.season_id, s.we_ind FROM season_map s "
        "JOIN run_pin p ON p.prop_code = s.prop_code AND p.run_id = s.run_id"
    ),
    "desired_config": (
        "SELECT DISTINCT m.prop_code, m.competitor_id, s.season_id, s.we_ind, "
        "CASE WHEN m.is_host THEN 'Y' ELSE 'N' END AS own_ind "
        "FROM matched m JOIN pinned_seasons s ON s.prop_code = m.prop_code"
    ),
    # B16
    "config_scoped": (
        "SELECT c.* FROM comp_config c WHERE EXISTS (SELECT 1 FROM valid v WHERE v.prop_code = c.prop_code)"
    ),
    "inserts_v": (
        "SELECT d.* FROM desired_config d WHERE NOT EXISTS (SELECT 1 FROM config_scoped c "
        "WHERE c.prop_code = d.prop_code AND c.competitor_id = d.competitor_id)"
    ),
    "deletes_v": (
        "SELECT DISTINCT c.prop_code, c.competitor_id FROM config_scoped c WHERE NOT EXISTS "
        "(SELECT 1 FROM desired_config d WHERE d.prop_code = c.prop_code AND d.competitor_id = c.competitor_id)"
    ),
    # B16, update class: stored rows of desired pairs and seasons whose flags no desired row has
    "updates_v": (
        "SELECT DISTINCT c.prop_code, c.competitor_id, c.season_id, c.we_ind AS we_before, c.own_ind AS own_before, "
        "CASE WHEN EXISTS (SELECT 1 FROM desired_config d WHERE d.prop_code = c.prop_code "
        "AND d.competitor_id = c.competitor_id AND d.season_id = c.season_id "
        "AND d.we_ind IS NOT DISTINCT FROM c.we_ind) THEN c.we_ind ELSE d.we END AS we_after, "
        "CASE WHEN EXISTS (SELECT 1 FROM desired_config d WHERE d.prop_code = c.prop_code "
        "AND d.competitor_id = c.competitor_id AND d.season_id = c.season_id "
        "AND d.own_ind IS NOT DISTINCT FROM c.own_ind) THEN c.own_ind ELSE d.own END AS own_after "
        "FROM comp_config c JOIN (SELECT prop_code, competitor_id, season_id, max(we_ind) AS we, max(own_ind) AS own "
        "FROM desired_config GROUP BY ALL) d ON d.prop_code = c.prop_code "
        "AND d.competitor_id = c.competitor_id AND d.season_id = c.season_id "
        "WHERE NOT EXISTS (SELECT 1 FROM desired_config e WHERE e.prop_code = c.prop_code "
        "AND e.competitor_id = c.competitor_id AND e.season_id = c.season_id "
        "AND e.we_ind IS NOT DISTINCT FROM c.we_ind AND e.own_ind IS NOT DISTINCT FROM c.own_ind)"
    ),
    # B17
    "after_v": (
        "SELECT c.prop_code, c.competitor_id, c.season_id, "
        "CASE WHEN u.prop_code IS NULL THEN c.we_ind ELSE u.we_after END AS we_ind, c.cmptn_ind, "
        "c.sys_weight, c.usr_weight, c.closed_fill_in_rt, c.closed_fill_in_usr, "
        "CASE WHEN u.prop_code IS NULL THEN c.own_ind ELSE u.own_after END AS own_ind, c.prd_profile_id, "
        "CASE WHEN u.prop_code IS NULL THEN c.last_upd_by ELSE 'batch' END AS last_upd_by, "
        "CASE WHEN u.prop_code IS NULL THEN c.last_upd_ts ELSE TIMESTAMP '2024-01-01 00:00:00' END AS last_upd_ts "
        "FROM comp_config c LEFT JOIN updates_v u ON u.prop_code = c.prop_code "
        "AND u.competitor_id = c.competitor_id AND u.season_id = c.season_id "
        "AND u.we_before IS NOT DISTINCT FROM c.we_ind AND u.own_before IS NOT DISTINCT FROM c.own_ind "
        "WHERE NOT EXISTS "
        "(SELECT 1 FROM deletes_v d WHERE d.prop_code = c.prop_code AND d.competitor_id = c.competitor_id) "
        "UNION ALL SELECT prop_code, competitor_id, season_id, we_ind, NULL, NULL, NULL, NULL, NULL, own_ind, NULL, "
        "'batch', TIMESTAMP '2024-01-01 00:00:00' FROM inserts_v "
        "WHERE prop_code IS NOT NULL AND competitor_id IS NOT NULL"
    ),
    # Accepted changes only
    "touched_v": (
        "SELECT DISTINCT prop_code, 'MRC' AS pgm_code FROM (SELECT prop_code FROM deletes_v UNION ALL "
        "SELECT prop_code FROM updates_v UNION ALL "
        "SELECT prop_code FROM inserts_v WHERE prop_code IS NOT NULL AND competitor_id IS NOT NULL) t"
    ),
}

_RAW = f"SELECT {_FEED_COLS} FROM listing l"

# Final statements, one per registered query.
QUERIES: dict[str, str] = {
    "feed_scan": f"SELECT {_FEED_COLS} FROM listing",
    "derive_id_name": f"SELECT {_FEED_COLS}, competitor_id, competitor_name FROM derived",
    "valid_codes": f"SELECT {_FEED_COLS}, prop_code FROM valid",
    "malformed_codes": f"SELECT {_FEED_COLS} FROM derived WHERE NOT code_ok",
    "host_counts": "SELECT prop_code, n_host, n_comp FROM host_counts",
    "non_single_hosts": "SELECT prop_code, n_host, n_comp FROM host_counts WHERE n_host <> 1",
    "single_host_rows": f"SELECT {_FEED_COLS}, prop_code, competitor_id, competitor_name FROM single_rows",
    "duplicate_host_report": (
        f"{_RAW} WHERE l.role = 'H' AND EXISTS (SELECT 1 FROM host_counts g "
        "WHERE g.n_host <> 1 AND g.prop_code = l.raw_code)"
    ),
    "with_property": f"SELECT {_FEED_COLS}, prop_code, competitor_id, competitor_name FROM with_property_rows",
    "missing_property_report": (
        f"{_RAW} WHERE EXISTS (SELECT 1 FROM host_state h WHERE h.state = 'no_property' "
        "AND h.prop_code = l.raw_code)"
    ),
    "host_state": "SELECT prop_code, host_id, state FROM host_state WHERE state <> 'no_property'",
    "matched_rows": f"SELECT {_FEED_COLS}, prop_code, competitor_id, competitor_name FROM matched",
    "id_mismatch_report": (
        f"{_RAW} WHERE EXISTS (SELECT 1 FROM host_state h WHERE h.state = 'mismatch' "
        "AND h.prop_code = l.raw_code)"
    ),
    "new_hosts": "SELECT prop_code, competitor_id, own_ind, active_ind, last_upd_ts FROM new_hosts_v",
    "rename_records": "SELECT competitor_id, old_name, new_name FROM rename_records",
    "renamed_hosts": "SELECT competitor_id, competitor_name FROM renamed_hosts",
    "renamed_listings": (
        "SELECT prop_code, role, competitor_id, competitor_name FROM renamed_matched WHERE renamed"
    ),
    "competitor_upserts": (
        "SELECT competitor_id, competitor_name, 'batch' AS last_upd_by, "
        "TIMESTAMP '2024-01-01 00:00:00' AS last_upd_ts FROM upserts_v"
    ),
    "compset_after": (
        "SELECT c.* FROM compset c WHERE c.own_ind = 'Y' OR NOT EXISTS "
        "(SELECT 1 FROM compset_del d WHERE d.prop_code = c.prop_code AND d.competitor_id = c.competitor_id) "
        "UNION ALL SELECT prop_code, competitor_id, own_ind, 'Y', NULL, NULL, 'batch', "
        "TIMESTAMP '2024-01-01 00:00:00' FROM compset_ins "
        "WHERE prop_code IS NOT NULL AND competitor_id IS NOT NULL"
    ),
    "compset_rejected": (
        "SELECT prop_code, competitor_id, own_ind FROM compset_ins WHERE prop_code IS NULL OR competitor_id IS NULL"
    ),
    "competitor_after": (
        "SELECT c.* FROM competitor c WHERE NOT EXISTS "
        "(SELECT 1 FROM upserts_v u WHERE u.competitor_id = c.competitor_id) "
        "UNION ALL SELECT competitor_id, max(competitor_name), 'batch', TIMESTAMP '2024-01-01 00:00:00' "
        "FROM upserts_v GROUP BY competitor_id"
    ),
    "compset_diff": (
        "SELECT d.prop_code, d.competitor_id, 'insert' AS change FROM desired_pairs d WHERE NOT EXISTS "
        "(SELECT 1 FROM current_pairs c WHERE c.prop_code = d.prop_code AND c.competitor_id = d.competitor_id) "
        "UNION ALL SELECT c.prop_code, c.competitor_id, 'delete' FROM current_pairs c WHERE NOT EXISTS "
        "(SELECT 1 FROM desired_pairs d WHERE d.prop_code = c.prop_code AND d.competitor_id = c.competitor_id)"
    ),
    "compset_history": (
        "SELECT prop_code, competitor_id, own_ind, nullif(min(s), DATE '0001-01-01') AS eff_start_date, "
        "nullif(max(e), DATE '9999-12-31') AS eff_end_date, CAST(count(*) AS BIGINT) AS n_ranges "
        "FROM dated_islands GROUP BY prop_code, competitor_id, own_ind, island"
    ),
    "written_reports": (
        f"SELECT {_FEED_COLS}, 'malformed-codes' AS report FROM derived WHERE NOT code_ok "
        f"UNION ALL {_RAW.replace(' FROM', ", 'duplicate-property-codes' FROM")} WHERE l.role = 'H' AND EXISTS "
        "(SELECT 1 FROM host_counts g WHERE g.n_host <> 1 AND g.prop_code = l.raw_code) "
        f"UNION ALL {_RAW.replace(' FROM', ", 'non-existent-property-codes' FROM")} WHERE EXISTS "
        "(SELECT 1 FROM host_state h WHERE h.state = 'no_property' AND h.prop_code = l.raw_code) "
        f"UNION ALL {_RAW.replace(' FROM', ", 'id-mismatches' FROM")} WHERE EXISTS "
        "(SELECT 1 FROM host_state h WHERE h.state = 'mismatch' AND h.prop_code = l.raw_code)"
    ),
    "pinned_seasons": "SELECT prop_code, run_id, season_id, we_ind FROM pinned_seasons",
    "desired_config": "SELECT prop_code, competitor_id, season_id, we_ind, own_ind FROM desired_config",
    "config_inserts": "SELECT prop_code, competitor_id, season_id, we_ind, own_ind FROM inserts_v",
    "config_deletes": "SELECT prop_code, competitor_id FROM deletes_v",
    "config_deletes_stored": "SELECT prop_code, competitor_id FROM deletes_v",
    "config_deletes_matched": (
        "SELECT d.prop_code, d.competitor_id FROM deletes_v d WHERE EXISTS "
        "(SELECT 1 FROM desired_config c WHERE c.prop_code = d.prop_code)"
    ),
    "config_updates": (
        "SELECT prop_code, competitor_id, season_id, we_before, own_before, we_after, own_after FROM updates_v"
    ),
    "config_change_set": (
        "SELECT 'insert' AS change, prop_code, competitor_id, season_id, NULL AS we_before, NULL AS own_before, "
        "we_ind AS we_after, own_ind AS own_after FROM inserts_v "
        "WHERE prop_code IS NOT NULL AND competitor_id IS NOT NULL "
        "UNION ALL SELECT 'delete', c.prop_code, c.competitor_id, c.season_id, c.we_ind, c.own_ind, NULL, NULL "
        "FROM comp_config c WHERE EXISTS "
        "(SELECT 1 FROM deletes_v d WHERE d.prop_code = c.prop_code AND d.competitor_id = c.competitor_id) "
        "UNION ALL SELECT 'update', prop_code, competitor_id, season_id, we_before, own_before, we_after, own_after "
        "FROM updates_v"
    ),
    "config_after": "SELECT * FROM after_v",
    "config_export": "SELECT * FROM after_v",
    "config_export_order": (
        "SELECT row_number() OVER (ORDER BY prop_code NULLS FIRST, competitor_id NULLS FIRST, season_id NULLS FIRST, "
        "we_ind NULLS FIRST, cmptn_ind NULLS FIRST, sys_weight NULLS FIRST, usr_weight NULLS FIRST, "
        "closed_fill_in_rt NULLS FIRST, closed_fill_in_usr NULLS FIRST, own_ind NULLS FIRST, "
        "prd_profile_id NULLS FIRST, last_upd_by NULLS FIRST, last_upd_ts NULLS FIRST) AS position, * FROM after_v"
    ),
    "feed_rejects": (
        "SELECT record, 'ext_id' AS field, 'not a whole number' AS reason, ext_id AS value "
        "FROM listing_records WHERE NOT id_ok "
        "UNION ALL SELECT record, 'hotel_name', 'missing', NULL FROM listing_records WHERE hotel_name IS NULL "
        "UNION ALL SELECT record, NULL, '6 fields, not 5', NULL FROM planted_records WHERE m = 0 "
        "UNION ALL SELECT record, NULL, '2 fields, not 5', NULL FROM planted_records WHERE m = 1 "
        "UNION ALL SELECT record, 'role', 'not allowed', 'X' FROM planted_records WHERE m = 3 "
        "UNION ALL SELECT record, 'ext_id', 'not a whole number', 'no ' || own FROM planted_records WHERE m = 3 "
        "UNION ALL SELECT record, 'ext_id', 'out of range', '99999' || lpad(own, 9, '0') "
        "FROM planted_records WHERE m = 4 "
        "UNION ALL SELECT record, 'raw_code', 'missing', NULL FROM planted_records WHERE m = 5 "
        "UNION ALL SELECT record, 'hotel_name', 'missing', NULL FROM planted_records WHERE m = 5"
    ),
    "feed_accepted": (
        f"SELECT {_FEED_COLS} FROM listing_records WHERE id_ok AND hotel_name IS NOT NULL "
        f"UNION ALL SELECT code, 'H', own, seg || {_NL} || 'annex', hotel FROM planted_records WHERE m = 2 "
        "UNION ALL SELECT code, 'C', own, seg || ', \"two\"', hotel FROM planted_records WHERE m = 6 "
        f"UNION ALL SELECT code, 'H', own, seg || {_NL} || {_NL}, hotel || ',x' FROM planted_records WHERE m = 7"
    ),
    "pinned_seasons_stored": "SELECT s.prop_code, s.run_id, s.season_id, s.we_ind FROM season_map s "
    "JOIN run_pin p ON p.prop_code = s.prop_code AND p.run_id = s.run_id",
    "table_scan": "SELECT * FROM compset",
    "compset_seasons": (
        "SELECT prop_code, competitor_id, season_id, we_ind, own_ind, CAST(1 AS BIGINT) AS run_id, "
        "DATE '2024-01-01' AS data_date, 'batch' AS last_upd_by, TIMESTAMP '2024-01-01 00:00:00' AS last_upd_ts "
        "FROM desired_config"
    ),
    "competitor_rejected": (
        "SELECT DISTINCT competitor_id, competitor_name FROM renamed_matched "
        "WHERE NOT is_host AND (competitor_id IS NULL OR competitor_name IS NULL)"
    ),
    "touched_properties": "SELECT prop_code, pgm_code FROM touched_v",
}


def _deps(sql: str, names: list[str]) -> list[str]:
    return [n for n in names if re.search(rf"\b{n}\b", sql)]


def build(query_sql: str, fixtures: bool = True) -> str:
    """Prefix ``query_sql`` with exactly the views it needs, in order.

    ``fixtures=False`` leaves the domain tables (listing, property, compset,
    competitor, season_map, run_pin, comp_config) to the caller's catalogue,
    e.g. small random tables in property tests."""
    views = {**FIXTURE_VIEWS, **OPERATOR_VIEWS} if fixtures else dict(OPERATOR_VIEWS)
    order = list(views)
    needed: set[str] = set()
    stack = _deps(query_sql, order)
    while stack:
        n = stack.pop()
        if n in needed:
            continue
        needed.add(n)
        stack.extend(_deps(views[n], [m for m in order if m != n]))
    # each view is computed once, however many statements use it
    ctes = [f"{n} AS MATERIALIZED ({views[n]})" for n in order if n in needed]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + query_sql


def _audit_sql() -> str:
    parts = []
    for name, key in AUDITED.items():
        parts.append(
            f"SELECT '{name}' AS output, CAST(count(*) AS BIGINT) AS n_rows, "
            f"CAST(count(DISTINCT {key}) AS BIGINT) AS n_keys FROM ({QUERIES[name]}) q_{name}"
        )
    return " UNION ALL ".join(parts)


# Outputs summarised by the audit (B21) and the property key each one carries.
AUDITED = {
    "malformed_codes": "raw_code",
    "duplicate_host_report": "raw_code",
    "missing_property_report": "raw_code",
    "id_mismatch_report": "raw_code",
    "new_hosts": "prop_code",
    "competitor_upserts": "competitor_id",
    "compset_diff": "prop_code",
    "config_inserts": "prop_code",
    "config_deletes": "prop_code",
    "config_updates": "prop_code",
    "config_after": "prop_code",
    "touched_properties": "prop_code",
}


# Dates, times and decimals are compared as text, which both engines spell alike.
AMOUNTS = ("sys_weight", "usr_weight", "closed_fill_in_rt", "closed_fill_in_usr")
AS_TEXT = {
    "new_hosts": ["last_upd_ts"],
    "competitor_upserts": ["last_upd_ts"],
    "competitor_after": ["last_upd_ts"],
    "config_after": [*AMOUNTS, "last_upd_ts"],
    "config_export": [*AMOUNTS, "last_upd_ts"],
    "config_export_order": [*AMOUNTS, "last_upd_ts"],
    "compset_after": ["eff_start_date", "eff_end_date", "last_upd_ts"],
    "table_scan": ["eff_start_date", "eff_end_date", "last_upd_ts"],
    "compset_seasons": ["data_date", "last_upd_ts"],
    "compset_history": ["eff_start_date", "eff_end_date"],
}


def as_text(name: str, sql: str) -> str:
    if name not in AS_TEXT:
        return sql
    casts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in AS_TEXT[name])
    return f"SELECT * REPLACE ({casts}) FROM ({sql}) q"


def oracle_queries() -> dict[str, str]:
    out = {name: build(as_text(name, sql)) for name, sql in QUERIES.items()}
    out["output_audit"] = build(_audit_sql())
    return out
