"""Batch job entry: open the sources (B01, B02), run, publish.

    python -m feedsync.plans.job --feed s3a://.../feed.csv \\
        --season-pins .../pins.csv --tables /warehouse/ref --root /shared/recon --run-id 42

Reference tables come from a Parquet root (plain ``<name>.parquet`` files or
the latest complete run of a previous reconciliation under ``--root``) or a
JDBC database (``--jdbc-url``).  The feed is parsed once and staged; rows that
do not fit the schema are written to the run's ``corrupt-rows`` report.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedsync.constants import PAIR_KEYS, RunContext
from feedsync.operators import publish_report
from feedsync.plans.changed import ChangedOnly
from feedsync.plans.run import RunResult, counted, run_reconciliation
from feedsync.plans.snapshots import Bucketing, RunLayout, latest_complete_run, read_state
from feedsync.plans.views import MatchRules, SkewConf
from feedsync.schemas import FEED_COLUMNS
from feedsync.session import build_session, input_bytes, shared_dir, shared_root, size_shuffle
from feedsync.sources import (
    FEED_FIELDS,
    Field,
    JdbcSource,
    ParquetSource,
    accepted,
    check_fields,
    pinned_folders,
    read_feed,
    read_records,
    read_run_pins,
    read_table,
    rejects,
    split_corrupt,
    stage_parsed,
)
from feedsync.sources.feed import CORRUPT_COLUMN

REFERENCE_TABLES = ("property", "compset", "competitor", "season_map", "comp_config")
# Tables whose next state the run writes; a later run starts from them.
STATEFUL = ("compset", "competitor", "comp_config")


def open_sources(
    spark: SparkSession,
    layout: RunLayout,
    raw_feed: DataFrame,
    season_pins_path: str,
    source: ParquetSource | JdbcSource,
    continue_from_root: bool = True,
    bucketing: Bucketing | None = None,
) -> tuple[dict[str, DataFrame], DataFrame, int | None]:
    """(tables for :func:`run_reconciliation`, corrupt feed rows, the run whose states
    the tables hold).

    ``raw_feed`` is the feed as parsed by :func:`read_feed` (batch) or one
    micro-batch of the feed stream; it is staged once, so the CSV is parsed a
    single time.  The stateful tables continue from the latest complete run
    under the run root, if there is one.
    """
    parsed = stage_parsed(spark, raw_feed, layout.stage("feed_parsed"))
    feed, corrupt = split_corrupt(parsed)
    t = {"listing": feed, "run_pin": read_run_pins(spark, season_pins_path)}
    prev = latest_complete_run(spark, layout.root, before=layout.run_id) if continue_from_root else None
    for name in REFERENCE_TABLES:
        if prev is not None and name in STATEFUL:
            t[name] = read_state(spark, layout.root, name, prev, bucketing)
            continue
        t[name] = read_table(spark, source, name)
        by = getattr(source, "folders", {}).get(name)
        if by == "run_id":
            # folders of runs that no pin names are never read
            kept = pinned_folders(t[name], t["run_pin"], by)
            t[name] = kept.withColumn(by, F.col(by).cast("bigint"))
        if isinstance(source, JdbcSource):
            # one read of the database for the whole run: every consumer sees one state
            t[name] = stage_parsed(spark, t[name], layout.stage(f"table_{name}"))
    return t, corrupt, prev


def run_tables(
    spark: SparkSession,
    layout: RunLayout,
    raw_feed: DataFrame,
    season_pins_path: str,
    source: ParquetSource | JdbcSource,
    ctx: RunContext,
    skew: SkewConf | None = None,
    scope: str = "valid",
    rules: MatchRules | None = None,
    admit_new_hosts: bool = False,
    bucketing: Bucketing | None = None,
    changed: ChangedOnly | None = None,
    extra_reports: dict[str, int] | None = None,
    ordered_export: bool = False,
    key_ranges: int = 0,
) -> RunResult:
    """Open the sources for ``raw_feed``, write its corrupt rows, run."""
    tables, corrupt, prev = open_sources(spark, layout, raw_feed, season_pins_path, source, bucketing=bucketing)
    corrupt_path = layout.report("corrupt-rows")
    n_corrupt = counted(corrupt.select(CORRUPT_COLUMN), lambda d: publish_report(d, corrupt_path, header=True))
    return run_reconciliation(
        spark,
        tables,
        ctx,
        root=layout.root,
        skew=skew,
        scope=scope,
        rules=rules,
        admit_new_hosts=admit_new_hosts,
        bucketing=bucketing,
        extra_reports={"corrupt_rows": n_corrupt, **(extra_reports or {})},
        changed=changed,
        base_run=prev,
        ordered_export=ordered_export,
        key_ranges=key_ranges,
    )


def run_job(
    spark: SparkSession,
    feed_path: str,
    season_pins_path: str,
    source: ParquetSource | JdbcSource,
    ctx: RunContext,
    root: str | None = None,
    skew: SkewConf | None = None,
    scope: str = "valid",
    rules: MatchRules | None = None,
    admit_new_hosts: bool = False,
    bucketing: Bucketing | None = None,
    changed: ChangedOnly | None = None,
    strict: Sequence[Field] | None = None,
    ordered_export: bool = False,
    key_ranges: int = 0,
) -> RunResult:
    """One run from a CSV feed.  With ``strict`` field rules, records that break one are kept out
    of the run and reported with field, reason and value (``reports/.../rejected-fields``)."""
    layout = RunLayout(shared_root(spark, root or f"{shared_dir(spark)}/feedsync"), ctx.run_id)
    raw, reports = read_feed(spark, feed_path), {}
    if strict:
        records = read_records(spark, feed_path, header=FEED_COLUMNS)
        checked = stage_parsed(spark, check_fields(records, strict), layout.stage("feed_checked"))
        raw = accepted(checked, strict).withColumn(CORRUPT_COLUMN, F.lit(None).cast("string"))
        path = layout.report("rejected-fields")
        reports["rejected_fields"] = counted(rejects(checked), lambda d: publish_report(d, path, header=True))
    return run_tables(
        spark,
        layout,
        raw,
        season_pins_path,
        source,
        ctx,
        skew,
        scope,
        rules,
        admit_new_hosts,
        bucketing,
        changed,
        extra_reports=reports,
        ordered_export=ordered_export,
        key_ranges=key_ranges,
    )


def jdbc_source(
    url: str,
    schema: str | None = None,
    user: str | None = None,
    password_env: str | None = None,
    driver: str | None = None,
    tables_file: str | None = None,
) -> JdbcSource:
    """A database source from command-line options; the password comes from the
    environment, so it shows up in no process list."""
    given = {"user": user, "password": os.environ[password_env] if password_env else None, "driver": driver}
    tables = {}
    if tables_file:
        with open(tables_file) as f:
            tables = json.load(f)
    return JdbcSource(
        url,
        {k: v for k, v in given.items() if v is not None},
        schema,
        partitioning={n: tuple(t["partition"]) for n, t in tables.items() if "partition" in t},
        rename={n: t["rename"] for n, t in tables.items() if "rename" in t},
    )


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="feed reconciliation run")
    p.add_argument("--feed", required=True)
    p.add_argument("--season-pins", required=True)
    p.add_argument("--tables", help="Parquet root of the reference tables")
    p.add_argument("--jdbc-url")
    p.add_argument("--jdbc-schema")
    p.add_argument("--jdbc-user")
    p.add_argument("--jdbc-password-env", metavar="NAME", help="environment variable that holds the password")
    p.add_argument("--jdbc-driver", help="driver class")
    p.add_argument(
        "--jdbc-tables",
        metavar="FILE",
        help='JSON: {table: {"rename": {database column: our column}, "partition": [column, lower, upper, count]}}',
    )
    p.add_argument("--root", help="run root on shared storage (default: under spark.checkpoint.dir)")
    p.add_argument("--run-id", type=int, required=True)
    p.add_argument("--data-date", type=dt.date.fromisoformat)
    p.add_argument("--scope", choices=["valid", "matched"], default="valid")
    p.add_argument("--admit-new-hosts", action="store_true", help="match hosts stored as new in the same run")
    p.add_argument("--active-only", action="store_true", help="only active compset rows can match")
    p.add_argument("--on-data-date", action="store_true", help="only rows effective on the data date can match")
    p.add_argument("--deactivate-removed", action="store_true", help="flag removed compset rows instead of deleting")
    p.add_argument("--bucket-states", type=int, metavar="N", help="keep config/compset states bucketed into N buckets")
    p.add_argument(
        "--changed-buckets",
        type=int,
        default=64,
        metavar="N",
        help="deal each state to N buckets and write only those a run changes (0: whole states; default 64)",
    )
    p.add_argument("--strict", action="store_true", help="reject records whose fields break the feed's rules")
    p.add_argument("--ordered-export", action="store_true", help="config export sorted, with a verified list of parts")
    p.add_argument("--season-folders", action="store_true", help="the season map is stored in folders by run_id")
    p.add_argument(
        "--key-ranges", type=int, default=0, metavar="N",
        help="look for config changes only in N ranges of the feed's codes (for states in code order; 0: all rows)",
    )
    a = p.parse_args(argv)
    spark = build_session()
    # size the shuffles for the feed and the stored tables together
    size_shuffle(spark, input_bytes(spark, a.feed) + (input_bytes(spark, a.tables) if a.tables else 0))
    if a.jdbc_url:
        source: ParquetSource | JdbcSource = jdbc_source(
            a.jdbc_url, a.jdbc_schema, a.jdbc_user, a.jdbc_password_env, a.jdbc_driver, a.jdbc_tables
        )
    elif a.tables:
        source = ParquetSource(a.tables, folders={"season_map": "run_id"} if a.season_folders else {})
    else:
        p.error("one of --tables or --jdbc-url is required")
    bucketing = (
        Bucketing(a.bucket_states, {"comp_config": PAIR_KEYS, "compset": PAIR_KEYS}) if a.bucket_states else None
    )
    rules = MatchRules(
        active_only=a.active_only, on_data_date=a.on_data_date, deactivate_removed=a.deactivate_removed
    )
    res = run_job(
        spark,
        a.feed,
        a.season_pins,
        source,
        RunContext.now(a.run_id, a.data_date),
        a.root,
        scope=a.scope,
        rules=rules,
        admit_new_hosts=a.admit_new_hosts,
        bucketing=bucketing,
        changed=ChangedOnly(a.changed_buckets) if a.changed_buckets and not bucketing else None,
        strict=FEED_FIELDS if a.strict else None,
        ordered_export=a.ordered_export,
        key_ranges=a.key_ranges,
    )
    for r in sorted(res.audit, key=lambda r: r["output"]):
        print(f"{r['output']:28s} {r['n_rows']:>12d} {'' if r['n_keys'] is None else r['n_keys']:>10}")


if __name__ == "__main__":
    main()
