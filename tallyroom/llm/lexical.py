"""Ranked lexical search by bags: documents that no query can tell apart are scored once.

Of a document only its terms among the items' terms and its length class ``m`` enter a score.
Documents are therefore restricted to the items' vocabulary, hashed by (terms, frequencies, m),
and grouped where hash and bag are equal. A task scores its classes against all items of a block
through the items' inverted lists and keeps the k best classes of each item; ties go to the class
with the smaller first doc_id, so that no document of a class left out could be among the k best.
The k best classes over all tasks are expanded into their members by ascending doc_id, of which
each class needs its first k only.

Items are taken in blocks of bounded size, so what a task holds does not grow with their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.tables import long_lists, text_views, written
from tallyroom.llm.termwords import words

K = 50
BLOCK_CHARS = 4_000_000  # characters of items that are sent to the tasks at once
CELLS = 2_000_000  # scores that a task holds at once


@dataclass
class Block:
    """Items of one block: their ids, their vocabulary, and for each term the items that hold it."""

    ids: list[int]
    index: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray


def item_blocks(items: DataFrame, block_chars: int) -> Iterator[Block]:
    """``items`` (item_id, text) in blocks of about ``block_chars`` characters; rows of one item_id stay together."""
    items = items.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna()
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_chars))
    for i in range(n):
        terms: dict[int, set[bytes]] = {}
        for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == i).collect():
            terms.setdefault(r.item_id, set()).update(words(np.frombuffer(r.text.encode(), np.uint8)))
        index = {t: k for k, t in enumerate(sorted(set().union(*terms.values())))}
        pairs = sorted((index[t], k) for k, found in enumerate(terms.values()) for t in found)
        term, item = np.array(pairs, np.int64).reshape(-1, 2).T
        yield Block(list(terms), index, np.searchsorted(term, np.arange(len(index) + 1)), item.copy())


def _bags(block):
    """doc_id, number of terms, the items' terms in it and how often each occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = block.value.index.get
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                n, terms, counts = [], [], []
                for text in text_views(rows.column(1)):
                    w = words(text)
                    n.append(len(w))
                    found = np.fromiter((x for x in map(find, w) if x is not None), np.int64)
                    t, c = np.unique(found, return_counts=True)
                    terms.append(t)
                    counts.append(c.astype(np.int64))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(n, pa.int64()), long_lists(terms), long_lists(counts)],
                                                 names=["doc_id", "n", "terms", "counts"])
    return run


def _holders(n_terms: int):
    """Documents that hold each term, added up within a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=n_terms)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["term", "df"])
    return run


def _best(block, weights, k: int):
    """Per task: each item's k best classes as (item, class_id, first, score)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b, w = block.value, weights.value
        n_items = len(b.ids)
        lengths = np.diff(b.starts)
        best = [np.zeros((3, 0), np.int64) for _ in range(n_items)]  # -score, first, class_id
        least = np.ones(n_items, np.int64)
        step = max(1, CELLS // max(1, n_items))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                rows = batch.slice(at, step)
                class_id = rows.column(0).to_numpy()
                first = rows.column(1).fill_null((1 << 63) - 1).to_numpy()
                sizes = np.diff(rows.column(3).offsets.to_numpy())
                terms, counts = (rows.column(i).flatten().to_numpy() for i in (3, 4))
                own = np.repeat(np.arange(rows.num_rows), sizes)
                part = w[terms] * (1_000_000_000 * counts // (1000 * counts + 20 * rows.column(2).to_numpy()[own]))
                many = lengths[terms]
                ends = np.cumsum(many)
                item = b.items[np.repeat(b.starts[:-1][terms] - (ends - many), many) + np.arange(ends[-1] if len(ends) else 0)]
                cell = item * rows.num_rows + np.repeat(own, many)
                # sums stay below 2^53 for items of up to 100,000 terms, so doubles are exact
                score = np.bincount(cell, np.repeat(part, many), n_items * rows.num_rows).astype(np.int64).reshape(n_items, -1)
                for i in np.flatnonzero((score >= least[:, None]).any(1)).tolist():
                    new = np.flatnonzero(score[i] >= least[i])
                    both = np.concatenate([best[i], np.stack([-score[i, new], first[new], class_id[new]])], axis=1)
                    best[i] = both[:, np.lexsort(both[::-1])[:k]]
                    if best[i].shape[1] == k:
                        least[i] = -best[i][0, -1]
        found = np.concatenate(best, axis=1) if best else np.zeros((3, 0), np.int64)
        item = np.repeat(np.array(b.ids, np.int64), [x.shape[1] for x in best])
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(found[2]), pa.array(found[1]), pa.array(-found[0])],
                                         names=["item_id", "class_id", "first", "score"])
    return run


def length_class(n, documents: int, terms: int):
    """100 - 50 + (50 n N) div L, the length part of a document's score."""
    return F.expr(f"50 + (50L * {n} * {documents}L) div {terms}L")


def term_weights(block: Block, bags: DataFrame, documents: int) -> np.ndarray:
    """floor(1000 ln((2 N + 2) / (2 df + 1))) of every term of the block."""
    df = np.zeros(len(block.index), np.int64)
    for r in (bags.select("terms").mapInArrow(_holders(len(block.index)), "term long, df long")
              .groupBy("term").agg(F.sum("df").alias("df")).collect()):
        df[r.term] = r.df
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def search(docs: DataFrame, items: DataFrame, k: int = K, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The ``k`` highest-scoring rows of ``docs`` (doc_id, text) for each of ``items`` (item_id, text):
    item_id, rank (from 1), doc_id, score; only scores above 0, ties to the smaller doc_id.

    Terms are runs of digits, letters and characters above ASCII, A-Z lower-cased. Null and empty
    texts have none and take no part in the counts. Repeated rows are documents of their own; a null
    doc_id ranks behind equal scores. Rows of one item_id are one item; items without an id or
    without terms find nothing. Other columns are ignored; empty tables give an empty result.
    """
    found = [_searched(docs, block, k) for block in item_blocks(items, block_chars)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _searched(docs: DataFrame, block: Block, k: int) -> DataFrame:
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(block)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bags = written(rows.mapInArrow(_bags(held), "doc_id long, n long, terms array<long>, counts array<long>"), "item-bags")
    documents, terms = bags.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = spark.sparkContext.broadcast(term_weights(block, bags, documents))

    bag = ["h", "m", "terms", "counts"]
    bags = (bags.where(F.size("terms") > 0).withColumn("m", length_class("n", documents, max(terms, 1)))
            .withColumn("h", F.xxhash64("m", "terms", "counts")).select("doc_id", *bag))
    classes = written(bags.groupBy(*bag).agg(F.min("doc_id").alias("first"))
                      .withColumn("class_id", F.monotonically_increasing_id()), "bag-classes")
    best = classes.select("class_id", "first", "m", "terms", "counts").mapInArrow(
        _best(held, weights, k), "item_id long, class_id long, first long, score long")
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), "first", "class_id")
    chosen = written(best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
                     .select("item_id", "class_id", "score"), "best-classes")

    chosen_bags = written(classes.join(chosen.select("class_id").distinct(), "class_id", "left_semi").select("class_id", *bag), "best-bags")
    by_doc = Window.partitionBy(*bag).orderBy(F.asc_nulls_last("doc_id"))
    members = (bags.join(chosen_bags.select("h").distinct(), "h", "left_semi")
               .withColumn("place", F.row_number().over(by_doc)).where(F.col("place") <= k).drop("place")
               .join(chosen_bags, bag).select("class_id", "doc_id"))
    by_item = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (chosen.join(members, "class_id").withColumn("rank", F.row_number().over(by_item)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))


SQL = r"""
WITH doc_terms AS (
  SELECT k, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT *, row_number() OVER () AS k FROM documents)),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM benchmark WHERE item_id IS NOT NULL),
sizes AS (SELECT k, doc_id, count(*) AS n FROM doc_terms GROUP BY ALL),
totals AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
tf AS (SELECT k, w, count(*) AS tf FROM doc_terms GROUP BY ALL),
weights AS (
  SELECT w, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM tf, totals GROUP BY w, n_docs),
scores AS (
  SELECT item_id, k, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM item_terms JOIN weights USING (w) JOIN tf USING (w) JOIN sizes USING (k), totals GROUP BY item_id, k),
ranked AS (
  SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
  FROM scores JOIN sizes USING (k) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
