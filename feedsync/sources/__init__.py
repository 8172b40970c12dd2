from feedsync.sources.clustered import in_ranges, key_ranges, scoped, write_clustered
from feedsync.sources.feed import read_feed, read_renames, read_run_pins, split_corrupt, stage_parsed, write_feed
from feedsync.sources.fixtures import fixture_tables
from feedsync.sources.records import FEED_FIELDS, Dialect, Field, accepted, check_fields, read_records, rejects
from feedsync.sources.tables import JdbcSource, ParquetSource, pinned_folders, read_table

__all__ = [
    "Dialect",
    "FEED_FIELDS",
    "Field",
    "JdbcSource",
    "ParquetSource",
    "accepted",
    "check_fields",
    "fixture_tables",
    "in_ranges",
    "key_ranges",
    "pinned_folders",
    "read_feed",
    "read_records",
    "read_renames",
    "read_run_pins",
    "read_table",
    "rejects",
    "split_corrupt",
    "scoped",
    "stage_parsed",
    "write_clustered",
    "write_feed",
]
