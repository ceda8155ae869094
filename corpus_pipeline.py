"""Training corpus from documents, in five stages; each one's rows are written and are the next
one's input.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns
of ``documents``. Null and empty texts, repeated rows and extra columns are treated as the
operators' docstrings say; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyroom.llm import jaccard_join, pieces, pii, quality, tiling
from tallyroom.llm.tables import ship_package, small_batches, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rates good stay; toxic and poor ones go."""
    ship_package(spark)
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    return quality.selected(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    ship_package(spark)
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    return jaccard_join.one_per_component(docs, jaccard_join.near_copies(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which a benchmark item leaks go."""
    ship_package(spark)
    small_batches(spark)
    return tiling.clean(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by marks; n_chars follows the new text."""
    return pii.redacted(docs.select(*COLUMNS), length="n_chars")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (pieces of the whole text) and n_tokens of what is left; a null
    text has null ids."""
    ship_package(spark)
    small_batches(spark)
    return pieces.tokenised(docs.select(*COLUMNS), pieces.load_model(), ["doc_id", "lang", "source"])


STAGES = [
    ("quality classifier", quality_classifier),
    ("near copies", near_copies),
    ("benchmark decontamination", decontamination),
    ("personal data", privacy),
    ("pieces", tokens),
]

ORACLE_SQL = None  # SQL cannot express the fitted stages


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
