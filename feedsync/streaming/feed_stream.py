"""Runs driven by arriving feed files (Structured Streaming, file source).

The reference is a batch job started once per delivered feed.  Here a file
stream over the delivery folder does the bookkeeping instead of a scheduler:
one file is one delivery, one micro-batch takes one file, and it becomes one
reconciliation run (``foreachBatch``).  Deliveries that wait are never merged:
a merged feed would double every host.  The header is checked as in the batch
reader (SURVEY rule 13).  The stream checkpoint
records which files were processed; the run id is derived from the batch id,
so a micro-batch replayed after a failure rewrites exactly the same run
partitions (all run outputs are idempotent per run id).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from feedsync.constants import RunContext
from feedsync.plans.job import run_tables
from feedsync.plans.snapshots import Bucketing, RunLayout
from feedsync.plans.views import MatchRules, SkewConf
from feedsync.schemas import CORRUPT_COLUMN, FEED_SCHEMA, with_corrupt_column
from feedsync.sources import JdbcSource, ParquetSource


def start_feed_stream(
    spark: SparkSession,
    feed_dir: str,
    season_pins_path: str,
    source: ParquetSource | JdbcSource,
    root: str,
    first_run_id: int = 1,
    available_now: bool = True,
    context: Callable[[int], RunContext] | None = None,
    skew: SkewConf | None = None,
    scope: str = "valid",
    rules: MatchRules | None = None,
    bucketing: Bucketing | None = None,
) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    reader = (
        spark.readStream.schema(with_corrupt_column(FEED_SCHEMA))
        .option("header", "true")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("enforceSchema", "false")
        .option("maxFilesPerTrigger", "1")
    )
    stream = reader.csv(feed_dir)
    make_ctx = context or (lambda run_id: RunContext.now(run_id))

    def one_run(batch: DataFrame, batch_id: int) -> None:
        ctx = make_ctx(first_run_id + batch_id)
        layout = RunLayout(root, ctx.run_id)
        run_tables(spark, layout, batch, season_pins_path, source, ctx, skew, scope, rules, bucketing=bucketing)

    w = stream.writeStream.foreachBatch(one_run).option("checkpointLocation", f"{root.rstrip('/')}/_stream")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
