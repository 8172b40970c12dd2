"""Exact de-duplication by a content sort (operator 5), in DataFrame functions only.

Rows are range-partitioned on the bytes of the normalised text and sorted inside
each partition, so equal texts lie side by side; a window then compares whole
neighbouring texts and keeps the row with the smallest identifier.

* The splitters are sampled from a short routing key (the first bytes and a hash
  of the text), so the sample that reaches the driver stays small however long
  the texts are.  Only routing uses the prefix: sorting and comparing take all.
* A text with more than ``max(min_hot, rows / 65536)`` copies is cut into salted
  runs which land in different ranges, by the rows' places in the input, so rows
  without an id or with a repeated one spread too.  There are fewer than 65,536 such texts,
  which bounds their broadcast; their keeper comes from a pre-aggregated count by
  SHA-256 of the whole text.
* The text crosses the network once: the original is carried beside the
  normalised form only where the two differ.

Defined results: a null text counts as empty, and all empty texts are one group;
a null identifier counts as larger than every other; of rows that repeat both
identifier and text one is kept; an empty table gives an empty result; other
columns pass through untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feedsync.llm.common import staged

# Every run of white space that is not already one space.
_RUNS = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
_PREFIX = 32


def normalised(text: Column) -> Column:
    """Null as empty; each run of ASCII white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _RUNS, " ")


def hot_texts(docs: DataFrame, id_col: str, text_col: str, min_hot: int) -> DataFrame:
    """Texts with very many copies: sha, run count, keeper, copies.  Fewer than 65,536."""
    limit = max(min_hot, -(-docs.count() // 65_536))
    sha = F.sha2(normalised(F.col(text_col)).cast("binary"), 256)
    return staged(
        docs.groupBy(sha.alias("__sha"))
        .agg(F.count(F.lit(1)).alias("__hot_n"), F.min(id_col).alias("__hot_keep"))
        .filter(F.col("__hot_n") > limit)
        .withColumn("__runs", F.ceil(F.col("__hot_n") / limit)),
        "exact-hot",
    )


def _marked(docs: DataFrame, id_col: str, text_col: str, min_hot: int) -> DataFrame:
    hot = hot_texts(docs, id_col, text_col, min_hot)
    text = F.col(text_col)
    others = [F.col(c) for c in docs.columns if c != text_col]
    rows = docs.select(
        F.struct(*others).alias("__doc"),
        F.col(id_col).alias("__id"),
        normalised(text).alias("__norm"),
        F.when(F.lit(False) | text.isNull() | (text != normalised(text)), F.struct(text.alias("t"))).alias("__raw"),
    ).withColumn("__sha", F.sha2(F.col("__norm").cast("binary"), 256))
    rows = rows.join(F.broadcast(hot), "__sha", "left").withColumns(
        {
            # the keeper's own rows lie together; the others spread, also without an id
            "__salt": F.when(F.col("__runs").isNull() | F.col("__id").eqNullSafe(F.col("__hot_keep")), F.lit(0).cast("long"))
            .otherwise(F.pmod(F.monotonically_increasing_id(), F.col("__runs"))),
            "__prefix": F.substring("__norm", 1, _PREFIX),
            "__hash": F.xxhash64("__norm"),
        }
    )
    route = ["__prefix", "__hash", "__salt"]
    run = W.partitionBy(*route, "__norm")
    ordered = run.orderBy(F.col("__id").asc_nulls_last())
    local = (
        rows.repartitionByRange(*route)
        .sortWithinPartitions(*route, "__norm", F.col("__id").asc_nulls_last())
        .withColumns(
            {
                "__nth": F.row_number().over(ordered),
                "__min": F.min("__id").over(run),
                "__n": F.count(F.lit(1)).over(run),
            }
        )
    )
    keep = F.when(F.col("__runs").isNull(), F.col("__min")).otherwise(F.col("__hot_keep"))
    return local.select(
        "__doc",
        "__id",
        "__norm",
        "__raw",
        "__sha",
        keep.alias("__keep"),
        F.coalesce("__hot_n", "__n").alias("__size"),
        ((F.col("__nth") == 1) & F.col("__id").eqNullSafe(keep)).alias("__kept"),
    )


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_hot: int = 256) -> DataFrame:
    """One row per row of ``docs``: its identifier, the identifier that stays, the
    group's size, whether it stays, and the SHA-256 of the normalised text."""
    return _marked(docs, id_col, text_col, min_hot).select(
        F.col("__id").alias(id_col),
        F.col("__keep").alias("keep_id"),
        F.col("__size").alias("group_size"),
        F.col("__kept").alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_hot: int = 256) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns as they were."""
    kept = _marked(docs, id_col, text_col, min_hot).filter("__kept")
    original = F.when(F.col("__raw").isNull(), F.col("__norm")).otherwise(F.col("__raw.t"))
    return kept.select(
        *[original.alias(c) if c == text_col else F.col("__doc").getField(c).alias(c) for c in docs.columns]
    )
