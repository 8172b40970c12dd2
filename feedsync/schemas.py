"""Fixed schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

FEED_COLUMNS = ["raw_code", "role", "ext_id", "chain_name", "hotel_name"]

# Parent/child feed: one host row ('H') and its competitor rows per code.
FEED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FEED_COLUMNS])

RUN_PIN_SCHEMA = T.StructType(
    [T.StructField("prop_code", T.StringType(), True), T.StructField("run_id", T.LongType(), True)]
)

# (competitor id, new name) renames file; the reference reads it but its use
# is switched off.
RENAMES_SCHEMA = T.StructType(
    [T.StructField("competitor_id", T.IntegerType(), True), T.StructField("competitor_name", T.StringType(), True)]
)

CORRUPT_COLUMN = "_corrupt_record"

# Audit columns stamped on inserted rows when the target table carries them.
AUDIT_BY = "last_upd_by"
AUDIT_TS = "last_upd_ts"

# Columns each reference table must provide; all others are carried through.
TABLE_COLUMNS: dict[str, list[str]] = {
    "property": ["prop_code"],
    "compset": ["prop_code", "competitor_id", "own_ind"],
    "competitor": ["competitor_id", "competitor_name"],
    "season_map": ["prop_code", "run_id", "season_id", "we_ind"],
    "comp_config": ["prop_code", "competitor_id", "season_id", "we_ind", "own_ind"],
    "run_pin": ["prop_code", "run_id"],
}


def with_corrupt_column(schema: T.StructType, name: str = CORRUPT_COLUMN) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(name, T.StringType(), True)])
