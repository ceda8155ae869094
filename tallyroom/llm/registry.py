"""Named queries of the operators, with SQL checks where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyroom.llm import ann, chat, html_text, idcoder, jaccard_join, langid, lexical, pieces, pii, quality, resample, sharding, tiling
from tallyroom.llm.tables import ship_package, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def add(name: str, run: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return run(spark, folder)

    QUERIES[name] = query
    if sql is not None:
        ORACLES[name] = sql


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.train(docs, table(spark, folder, "labels")))


def _language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return langid.predict(docs, langid.train(docs))


add("op1_multi_index", lambda spark, folder: ann.neighbours(table(spark, folder, "embeddings")))
add("op2_pii", lambda spark, folder: pii.report(table(spark, folder, "documents")))
add("op3_ordinal_quality", _quality)
add("op4_page_text", lambda spark, folder: html_text.extract(table(spark, folder, "pages")))
add("op5_language", _language)
add("op6_pieces", lambda spark, folder: pieces.round_trip(table(spark, folder, "documents"), pieces.load_model()))
add("op7_jaccard_join", lambda spark, folder: jaccard_join.near_copies(table(spark, folder, "documents")))
add("op8_perspectives", lambda spark, folder: chat.perspectives(table(spark, folder, "conversations")), chat.SQL)
add("op9_shards", lambda spark, folder: sharding.shards(table(spark, folder, "documents")))
add("op10_tiling", lambda spark, folder: tiling.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark")))
add("op11_token_files", lambda spark, folder: idcoder.round_trip(table(spark, folder, "documents")))
add("op12_resample", lambda spark, folder: resample.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    resample.SQL)
add("op13_bag_search", lambda spark, folder: lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    lexical.SQL)
