"""The corpus pipeline: toxicity filter, exact and near de-duplication, removal of
repeated passages, and packing, each by an operator of ``feedsync.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes a
stage's result as Parquet in the shared folder and reads it back as the next stage's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from feedsync.llm.common import ship_package, staged  # noqa: E402
from feedsync.llm.exact import drop_duplicates  # noqa: E402
from feedsync.llm.neardup import keep_one_of_each  # noqa: E402
from feedsync.llm.packing import pack_documents  # noqa: E402
from feedsync.llm.substring import remove_repeats  # noqa: E402
from feedsync.llm.toxicity import score, train, training_sample  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject.  The model learns from the
    labelled rows among ``docs`` that are not held out."""
    ship_package(spark)
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    model = train(training_sample(docs, labels))
    # the whole row goes through the scoring task, so nothing is joined back
    return score(docs, model, keep_columns=True).filter(F.col("predicted") == 0).select("row.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal normalised texts."""
    return drop_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship_package(spark)
    return keep_one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that a document with a smaller id has too; ``n_chars``
    of a text that lost words is its new length."""
    ship_package(spark)
    cut = remove_repeats(docs.withColumn("__before", F.length("text")))
    if "n_chars" in docs.columns:
        changed = ~F.length("text").eqNullSafe(F.col("__before"))
        kind = docs.schema["n_chars"].dataType
        cut = cut.withColumn("n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, packed: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    ship_package(spark)
    return pack_documents(docs).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("best_fit_packing", pack),
]

# A trained classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
