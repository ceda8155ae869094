"""Each stage of the pipeline on its predecessor's rows, against a plain Python version."""

import os
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tallyroom.llm import pieces, quality, tiling
from tallyroom.llm.tables import table, written
from tests.llm.test_jaccard_join import brute
from tests.llm.test_pii import base

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="sample data not present")


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower())


def leaky(text, items):
    """Is an item covered to 60 % by runs of five shared words? (No run of these texts overlaps another.)"""
    mine = words(text)
    seeds = {tuple(mine[i:i + 5]) for i in range(len(mine) - 4)}
    for item in items:
        w = words(item)
        hit = {p for i in range(len(w) - 4) if tuple(w[i:i + 5]) in seeds for p in range(i, i + 5)}
        if len(hit) >= tiling.COVERAGE * len(w):
            return True
    return False


def test_stages(spark):
    docs = table(spark, FOLDER, "documents")
    model = quality.train(docs, table(spark, FOLDER, "labels"))
    seen, steps = rows(docs), {}
    for name, stage in P.STAGES:
        docs = written(stage(spark, docs, FOLDER), "test-stage")
        steps[name] = (seen, rows(docs))
        seen = steps[name][1]
        assert name == P.STAGES[-1][0] or docs.columns == P.COLUMNS

    before, after = steps["quality classifier"]
    assert set(after) == {i for i, r in before.items()
                          if quality._sigmoid(model.latent(r.text or "") - model.thresholds[-1]) >= quality.KEEP}
    before, after = steps["near copies"]
    assert set(after) == {i for i, (_, c) in brute([(i, r.text) for i, r in before.items()]).items() if i == c}
    before, after = steps["benchmark decontamination"]
    items = [r.text for r in table(spark, FOLDER, "benchmark").collect()]
    assert set(after) == {i for i, r in before.items() if not leaky(r.text, items)} and len(after) < len(before)
    before, after = steps["personal data"]
    assert set(after) == set(before) and any(base(r.text) for r in before.values())
    for i, r in after.items():
        assert not base(r.text) and r.n_chars == len(r.text)
        if not base(before[i].text):
            assert r.text == before[i].text or "[" in r.text
    before, after = steps["pieces"]
    library = pieces.load_model().library
    assert set(after) == set(before)
    assert all(r.ids == library.encode(before[i].text) and r.n_tokens == len(r.ids) for i, r in after.items())


def test_nulls_clashing_columns_and_an_empty_table(spark):
    docs = table(spark, FOLDER, "documents").limit(3).withColumn("key", F.lit("k")).withColumn("row", F.lit(1))
    odd = docs.unionByName(spark.createDataFrame([(None, None, None, None, None, "k", 1), (5, "", "en", "s", 0, "k", 1), (5, "", "en", "s", 0, "k", 1)],
                                                 docs.schema))
    for name, stage in P.STAGES:
        assert stage(spark, odd, FOLDER).count() <= 6
        assert stage(spark, odd.limit(0), FOLDER).collect() == []


def test_texts_reach_the_workers_once_and_in_small_batches(spark, make_docs):
    from tallyroom.llm.tables import BATCH_ROWS, packed, small_batches

    docs = make_docs([(1, "a b c"), (2, None)])
    rows, at = packed(docs, "key")
    assert rows.columns == ["key"] and docs.columns[at] == "text"
    wide, at = packed(docs.withColumn("text", F.lit(7)), "key")  # a text that is no string is cast beside its row
    assert wide.columns == ["key", "text"] and at is None and dict(wide.dtypes)["text"] == "string"
    assert sorted(r.doc_id for r in tiling.clean(docs, docs.selectExpr("doc_id item_id", "text")).collect()) == [2]
    model = quality.Ordinal(quality.np.zeros(quality.DIMENSIONS), quality.np.array([-1.0, -0.5]))
    assert quality.selected(docs, model, keep=0.0).collect() == docs.collect()
    old = spark.conf.get(BATCH_ROWS)
    try:
        for chosen, want in (("10000", "1000"), ("77", "77")):
            spark.conf.set(BATCH_ROWS, chosen)
            small_batches(spark)
            assert spark.conf.get(BATCH_ROWS) == want
    finally:
        spark.conf.set(BATCH_ROWS, old)
