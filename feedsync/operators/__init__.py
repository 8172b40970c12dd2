"""DataFrame -> DataFrame operators; no action is triggered inside them."""

from feedsync.operators.apply import align, apply_changes, apply_updates, deactivate_changes, stamp, upsert
from feedsync.operators.changes import change_set, compset_diff, config_pairs, config_updates, diff
from feedsync.operators.classify import (
    classify_codes,
    current_rows,
    new_hosts,
    tag_rows,
)
from feedsync.operators.export import export_ordered, read_export, verify_export
from feedsync.operators.publish import audit, export_csv, publish_report, touched
from feedsync.operators.renames import (
    competitor_upserts,
    rename_listings,
    rename_pick,
    rename_records,
    renamed_hosts,
    renamed_pairs,
    split_named,
)
from feedsync.operators.reports import (
    report,
    report_rule,
    reports_from_tags,
    tagged_report,
)
from feedsync.operators.seasons import expand_seasons, pin_runs, season_counts, season_rows
from feedsync.operators.skew import salted_join
from feedsync.operators.validate import (
    check_codes,
    derive,
    host_groups,
    non_single,
    single_host_rows,
    split_codes,
)

__all__ = [
    "align",
    "apply_changes",
    "apply_updates",
    "audit",
    "check_codes",
    "classify_codes",
    "competitor_upserts",
    "current_rows",
    "compset_diff",
    "change_set",
    "config_pairs",
    "config_updates",
    "deactivate_changes",
    "derive",
    "diff",
    "expand_seasons",
    "export_csv",
    "export_ordered",
    "host_groups",
    "new_hosts",
    "non_single",
    "pin_runs",
    "publish_report",
    "read_export",
    "rename_listings",
    "rename_pick",
    "rename_records",
    "renamed_hosts",
    "renamed_pairs",
    "salted_join",
    "season_counts",
    "season_rows",
    "split_named",
    "report",
    "report_rule",
    "reports_from_tags",
    "tagged_report",
    "single_host_rows",
    "split_codes",
    "tag_rows",
    "stamp",
    "touched",
    "upsert",
    "verify_export",
]
