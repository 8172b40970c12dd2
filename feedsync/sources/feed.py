"""CSV feed and run-pin readers with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsync.schemas import CORRUPT_COLUMN, FEED_SCHEMA, RENAMES_SCHEMA, RUN_PIN_SCHEMA, with_corrupt_column

# Keep blanks: canonicalisation is the operators' job, not the reader's.
_CSV_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _csv_reader(spark: SparkSession, schema: T.StructType, check_header: bool, keep_corrupt: bool):
    r = spark.read.option("header", "true").options(**_CSV_KEEP_BLANKS)
    if check_header:
        # Header names must equal the schema's (positional binding otherwise
        # accepts swapped columns silently).
        r = r.option("enforceSchema", "false")
    if keep_corrupt:
        schema = with_corrupt_column(schema)
        r = r.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
    return r.schema(schema)


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType = FEED_SCHEMA,
    check_header: bool = True,
    keep_corrupt: bool = True,
) -> DataFrame:
    """Read the parent/child feed.  Rows that do not fit the schema keep their
    text in ``_corrupt_record`` (use :func:`split_corrupt`)."""
    return _csv_reader(spark, schema, check_header, keep_corrupt).csv(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that parsed, rows that did not).  The corrupt column is dropped
    from the first; the second keeps the fields that did parse next to the
    raw line.  Spark refuses to query the raw line straight from CSV (a
    ``count()`` of the second part would prune to it alone), so pass a staged
    copy of the parsed feed (:func:`stage_parsed`) when the rejects are
    counted or written."""
    if CORRUPT_COLUMN not in df.columns:
        return df, df.limit(0)
    ok = df.filter(F.col(CORRUPT_COLUMN).isNull()).drop(CORRUPT_COLUMN)
    bad = df.filter(F.col(CORRUPT_COLUMN).isNotNull())
    return ok, bad


def stage_parsed(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Write the parsed feed (corrupt column included) once as Parquet and
    continue from it: the CSV is parsed a single time and both parts of
    :func:`split_corrupt` can be queried freely."""
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_run_pins(spark: SparkSession, path: str, check_header: bool = True) -> DataFrame:
    """(prop_code, run_id) pins; not deduplicated here."""
    return _csv_reader(spark, RUN_PIN_SCHEMA, check_header, keep_corrupt=False).csv(path)


def read_renames(spark: SparkSession, path: str, check_header: bool = True) -> DataFrame:
    """(competitor_id, competitor_name) renames file, same reader rules."""
    return _csv_reader(spark, RENAMES_SCHEMA, check_header, keep_corrupt=False).csv(path)


def write_feed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write a feed as headed CSV without trimming blanks."""
    df.write.mode(mode).option("header", "true").options(**_CSV_KEEP_BLANKS).csv(path)
