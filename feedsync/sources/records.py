"""B01, strict: a delimited feed as raw records, and a reason for every field it rejects.

:func:`read_records` reads lines, so large files are split, and still joins the lines of a
record whose quoted field holds line breaks.  Whether a line starts inside quotes depends on
all lines before it, but every line's effect is one of three: it sets the state, turns it, or
leaves it.  Effects compose, so they are folded inside each block of a file, then over
the blocks (one row a block).  Only files in which some line leaves a quote open are
looked at this way; the lines of all others never move.

:func:`check_fields` parses each record with ``from_csv`` and names the field, the reason and
the value of everything that does not fit.  Nothing is dropped: a record is either accepted
whole or appears among the rejects with its text.

Defined results: blank records are skipped, as Spark's CSV reader does; a line equal to the
header is a header, and a file without one is an error; a null or empty field is ``missing``
if required and accepted otherwise; a quote that opens in the middle of a field is text; a
record of more than ``max_lines`` lines, or one that the file's end cuts off, is rejected
line by line (``quote not closed``), so no group of lines is unbounded; an empty feed gives no
rows.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedsync.functions.columns import full_match, is_true
from feedsync.schemas import CORRUPT_COLUMN


@dataclass(frozen=True)
class Field:
    """What a field must be: its type, whether it may be missing, and the values (fixed, or
    a pattern of the whole trimmed value) it may take."""

    name: str
    type: str = "string"
    required: bool = False
    allowed: tuple[str, ...] = ()
    pattern: str | None = None


FEED_FIELDS = (
    Field("raw_code", required=True),
    Field("role", required=True, allowed=("H", "C")),
    Field("ext_id", "int"),
    Field("chain_name"),
    Field("hotel_name", required=True),
)

WHOLE_NUMBERS = ("tinyint", "smallint", "int", "bigint")


@dataclass(frozen=True)
class Dialect:
    sep: str = ","
    escape: str = "\\"  # '"' for doubled quotes

    def closed(self, text: Column) -> Column:
        """``text``, which starts outside quotes, with every whole quoted field replaced."""
        return self._closed_bare(self._bare(text))

    def _bare(self, text: Column) -> Column:
        """Without escaped quotes and escapes.  Outside quotes an escape is text, and going
        without it moves no quote that opens or closes a field."""
        mark = re.escape(self.escape)
        return F.regexp_replace(text, '""' if self.escape == '"' else f'{mark}["{mark}]', "")

    def _closed_bare(self, bare: Column) -> Column:
        return F.regexp_replace(bare, rf'(^|{re.escape(self.sep)})"[^"]*"', "$1x")

    def leaves_open(self, text: Column) -> Column:
        return text.contains('"') & self.closed(text).rlike(rf'(^|{re.escape(self.sep)})"')

    def stays_open(self, text: Column) -> Column:
        """Whether a line that starts inside quotes ends inside quotes."""
        bare = self._bare(text)
        rest = self._closed_bare(F.regexp_replace(bare, r'^[^"]*"', "x"))
        return ~bare.contains('"') | rest.rlike(rf'(^|{re.escape(self.sep)})"')

    def field_count(self, record: Column) -> Column:
        rest = F.when(record.contains('"'), self.closed(record)).otherwise(record)
        return F.length(rest) - F.length(F.replace(rest, F.lit(self.sep), F.lit(""))) + 1

    def options(self) -> dict[str, str]:
        return {
            "sep": self.sep,
            "escape": self.escape,
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": CORRUPT_COLUMN,
            "ignoreLeadingWhiteSpace": "false",
            "ignoreTrailingWhiteSpace": "false",
        }


def _before(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds the effect of all earlier rows: ``set_before`` (the state they set, or null) and
    ``turned_before`` (0 or 1).  A row's own effect is ``sets`` (state or null) and ``turns``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    earlier = w.rowsBetween(Window.unboundedPreceding, -1)
    mark = F.when(F.col("sets").isNotNull(), F.struct("sets", F.col("_seen").alias("seen")))
    out = df.withColumn("_seen", F.sum("turns").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.withColumn("_mark", F.last(mark, ignorenulls=True).over(earlier))
    turned = (F.col("_seen") - F.col("turns") - F.coalesce(F.col("_mark.seen"), F.lit(0))) % 2
    return out.withColumns(
        {
            "set_before": F.col("_mark.sets").bitwiseXOR(turned.cast("int")),
            "turned_before": F.when(F.col("_mark").isNull(), turned.cast("int")).otherwise(0),
        }
    ).drop("_seen", "_mark")


def _joined_lines(lines: DataFrame, dialect: Dialect, max_lines: int) -> DataFrame:
    """(record, closed) from the lines of files that hold quoted line breaks."""
    opens, stays = (c.cast("int") for c in (dialect.leaves_open(F.col("value")), dialect.stays_open(F.col("value"))))
    effects = lines.withColumns({"opens": opens, "stays": stays}).select(
        "file", "block", "at", "value", "opens", "stays",
        F.when(F.col("opens") == F.col("stays"), F.col("opens")).alias("sets"),
        F.when((F.col("opens") == 1) & (F.col("stays") == 0), 1).otherwise(0).alias("turns"),
    )
    at = ["file", "block"]
    folded = _before(effects, at, ["at"])
    after = F.coalesce(F.col("sets"), F.col("set_before").bitwiseXOR(F.col("turns")))
    turned = F.when(after.isNull(), F.col("turned_before").bitwiseXOR(F.col("turns"))).otherwise(0)
    ends = folded.groupBy(*at).agg(F.max_by(F.struct(after.alias("sets"), turned.alias("turns")), "at").alias("e"))
    # one row a block: the state each block starts in (a file starts outside quotes)
    starts = _before(ends.select(*at, "e.*"), ["file"], ["block"]).select(
        *at, F.coalesce("set_before", "turned_before").alias("entry")
    )
    state = F.coalesce(F.col("set_before"), F.col("turned_before").bitwiseXOR(F.col("entry")))
    known = folded.join(starts, at).withColumn("inside", state)
    known = known.withColumn("ends_inside", F.when(F.col("inside") == 1, F.col("stays")).otherwise(F.col("opens")))

    alone = known.filter((F.col("inside") == 0) & (F.col("ends_inside") == 0))
    parts = known.filter((F.col("inside") == 1) | (F.col("ends_inside") == 1))
    here = F.when(F.col("inside") == 0, F.struct("block", "at"))
    upto = Window.partitionBy(*at).orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    parts = parts.withColumn("_start", F.last(here, ignorenulls=True).over(upto))
    last = parts.groupBy(*at).agg(F.max("_start").alias("_s"))
    by_block = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*at, F.last("_s", ignorenulls=True).over(by_block).alias("_carried"))
    parts = parts.join(carried, at).withColumn("start", F.coalesce("_start", "_carried"))
    place = F.struct("block", "at")
    ends_of = parts.groupBy("file", "start").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("ends_inside", place).alias("open_end")
    )
    parts = parts.join(ends_of, ["file", "start"])
    whole = (F.col("n") <= max_lines) & (F.col("open_end") == 0)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n")
    joined = parts.filter(whole).groupBy("file", "start").agg(text.alias("record")).select("record", F.lit(True).alias("closed"))
    broken = parts.filter(~whole).select(F.col("value").alias("record"), F.lit(False).alias("closed"))
    single = alone.select(F.col("value").alias("record"), F.lit(True).alias("closed"))
    return single.unionByName(joined).unionByName(broken)


def read_records(
    spark: SparkSession,
    path: str,
    header: Sequence[str] | None = None,
    dialect: Dialect = Dialect(),
    max_lines: int = 1000,
) -> DataFrame:
    """(record, closed): every record of the files under ``path`` with its raw text.

    ``header`` names the columns of the header line that each file must hold.  One row
    a file (its name and two flags) comes to the driver, which lists the files anyway.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    title = dialect.sep.join(header) if header else None
    is_title = F.col("value").eqNullSafe(F.lit(title))
    files = (
        lines.groupBy("file")
        .agg(F.max(dialect.leaves_open(F.col("value"))).alias("opens"), F.max(is_title).alias("titled"))
        .collect()
    )
    bare = [f["file"] for f in files if header and not f["titled"]]
    if bare:
        raise ValueError(f"{len(bare)} files lack the header {title}, for example {bare[0]}")
    opened = [(f["file"],) for f in files if f["opens"]]
    if not opened:
        out = lines.select(F.col("value").alias("record"), F.lit(True).alias("closed"))
    else:
        names = F.broadcast(spark.createDataFrame(opened, "file string"))  # at most the file listing
        out = lines.join(names, "file", "left_anti").select(F.col("value").alias("record"), F.lit(True).alias("closed"))
        out = out.unionByName(_joined_lines(lines.join(names, "file", "left_semi"), dialect, max_lines))
    out = out.filter(~F.col("closed") | (F.trim("record") != ""))
    return out.filter(~F.col("record").eqNullSafe(F.lit(title))) if header else out


def _fault(f: Field) -> Column:
    """The field's first fault, or null."""
    c = F.col(f"parsed.`{f.name}`")
    text = F.trim(c)
    empty = c.isNull() | (text == "")
    reason = F.when(empty, F.lit("missing") if f.required else F.lit(None).cast("string"))
    if f.type in WHOLE_NUMBERS:
        reason = reason.when(~full_match(text, "[+-]?[0-9]+"), F.lit("not a whole number"))
        reason = reason.when(text.try_cast(f.type).isNull(), F.lit("out of range"))
    elif f.type != "string":
        reason = reason.when(text.try_cast(f.type).isNull(), F.lit(f"not a {f.type}"))
    if f.allowed:
        reason = reason.when(~text.isin(*f.allowed), F.lit("not allowed"))
    if f.pattern:
        reason = reason.when(~is_true(full_match(text, f.pattern)), F.lit("malformed"))
    fault = F.struct(F.lit(f.name).alias("field"), reason.alias("reason"), c.alias("value"))
    return F.when(reason.isNotNull(), fault)


def _once(value: Column) -> Column:
    """``value`` as the row of a generator: what uses it later reads the result, where the
    optimizer would put a copy of the expression into every use."""
    return F.explode(F.array(value))


def check_fields(records: DataFrame, fields: Sequence[Field] = FEED_FIELDS, dialect: Dialect = Dialect()) -> DataFrame:
    """record, ``parsed`` (its fields as text) and ``faults``: (field, reason, value) of all
    that does not fit, empty for an accepted record.  A record that cannot be cut into
    its fields has one fault without a field."""
    names = [f.name for f in fields]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT_COLUMN]])
    parsed = F.from_csv(F.col("record"), schema.simpleString()[7:-1].replace(":", " "), dialect.options())
    found = dialect.field_count(F.col("record"))
    n = len(names)
    shape = (
        F.when(~F.col("closed"), F.lit("quote not closed"))
        .when(found != n, F.concat(found.cast("string"), F.lit(f" fields, not {n}")))
        .when(F.col(f"parsed.{CORRUPT_COLUMN}").isNotNull(), F.lit("malformed"))
    )
    whole = F.struct(
        F.lit(None).cast("string").alias("field"), shape.alias("reason"), F.lit(None).cast("string").alias("value")
    )
    each = F.array_compact(F.array(*[_fault(f) for f in fields]))
    faults = F.when(shape.isNotNull(), F.array(whole)).otherwise(each)
    cut = records.select("record", "closed", _once(parsed).alias("parsed"))
    return cut.select("record", "parsed", _once(faults).alias("faults"))


def accepted(checked: DataFrame, fields: Sequence[Field] = FEED_FIELDS, typed: bool = False) -> DataFrame:
    """The rows without a fault; fields as text as in the feed's schema, or ``typed``."""
    cols = [F.col(f"parsed.`{f.name}`") for f in fields]
    if typed:
        cols = [(c if f.type == "string" else F.trim(c).try_cast(f.type)) for c, f in zip(cols, fields)]
    return checked.filter(F.size("faults") == 0).select(*[c.alias(f.name) for c, f in zip(cols, fields)])


def rejects(checked: DataFrame) -> DataFrame:
    """One row for each fault: record, field, reason, value."""
    return checked.select("record", F.explode("faults").alias("f")).select("record", "f.*")
