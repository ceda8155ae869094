"""Importance resampling towards a target text collection, with an exact weighted-selection cutoff.

Every document's features (runs of words) fall into hashed buckets; a bucket's gain is the log
ratio of its smoothed share in the target and in the corpus, a document's weight the sum of its
features' gains, and its score the weight plus a Gumbel draw that its doc_id fixes. The k highest
scores are the resample.

The cutoff is found by weighted median-of-medians selection over the written keys: each round every
task reports the median of its keys that are still open, with their number; the median of those
medians, weighted by the numbers, becomes the pivot, and a count of the keys beyond it discards a
quarter of the open keys or more. It ends at the exact key; only the winners are sorted. The driver
sees one row per task and round.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.tables import text_views, written
from tallyroom.llm.termwords import words

BUCKETS = 10_000
RUN = 1  # words of the longest feature
LEAST_WORDS = 20  # documents with fewer take no part in the draw
PERCENT = 10
SEED = "2024"

Key = tuple[int, int, int]  # -score, doc_id, n_features: the smallest come first


def feature_buckets(text: np.ndarray, run: int, buckets: int) -> tuple[np.ndarray, int]:
    """Bucket of every feature of a text, and its number of words."""
    w = words(text)
    if run > 1:
        found = [b" ".join(w[i:i + k]) for k in range(1, run + 1) for i in range(len(w) - k + 1)]
    else:
        found = w
    return np.fromiter(map(crc32, found), np.int64, len(found)) % buckets, len(w)


def _counts(run: int, buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                found = [feature_buckets(t, run, buckets)[0] for t in text_views(batch.column(0).slice(at, 1000))]
                total += np.bincount(np.concatenate(found), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])
    return count


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all rows of ``texts`` (text) by bucket; a task adds up its own first."""
    rows = (texts.select(F.col("text").cast("string")).mapInArrow(_counts(run, buckets), "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())
    total = np.zeros(buckets, np.int64)
    for r in rows:
        total[r.bucket] = r.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's smoothed target share over its corpus share."""
    n, big_s, big_t = len(corpus), int(corpus.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log(float(t + 1) * (big_s + n) / (float(s + 1) * (big_t + n))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(run: int, gain):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight, size = [], [], []
            for text in text_views(batch.column(1)):
                found, n_words = feature_buckets(text, run, len(gain.value))
                n.append(len(found))
                weight.append(int(gain.value[found].sum()))
                size.append(n_words)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.int64()), pa.array(size, pa.int64())],
                                             names=["doc_id", "n_features", "weight", "n_words"])
    return weigh


def gumbel(seed: str) -> Column:
    """floor(-1000 ln(-ln u)) where u comes from the first 32 bits of sha256 of ``<seed>:<doc_id>``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296
    return F.floor(-1000 * F.log(-F.log(u)))


def weighted(docs: DataFrame, target: DataFrame, run: int = RUN, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, n_words of every row of ``docs``; score is null without a doc_id."""
    gain = docs.sparkSession.sparkContext.broadcast(gains(bucket_counts(docs, run, buckets), bucket_counts(target, run, buckets)))
    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(_weigh(run, gain), "doc_id long, n_features long, weight long, n_words long")
            .withColumn("score", F.col("weight") + gumbel(seed)))


def _order(keys: np.ndarray) -> np.ndarray:
    return np.lexsort(keys[::-1])


def _before(keys: np.ndarray, key: Key) -> np.ndarray:
    """Which keys (3, n) come before ``key``."""
    a, b, c = keys
    x, y, z = key
    return (a < x) | ((a == x) & ((b < y) | ((b == y) & (c < z))))


def _probe(low: Key | None, pivot: Key | None, high: Key | None):
    """Per task: open keys before and at the pivot, and the medians and numbers on both sides."""
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy() for i in range(3)])
            inside = np.ones(keys.shape[1], bool)
            if high is not None:
                inside &= _before(keys, high)
            if low is not None:
                inside &= ~_before(keys, low) & ~(keys == np.array(low)[:, None]).all(0)
            held.append(keys[:, inside])
        keys = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
        keys = keys[:, _order(keys)]
        first = int(_before(keys, pivot).sum()) if pivot is not None else keys.shape[1]
        at = int((keys == np.array(pivot)[:, None]).all(0).sum()) if pivot is not None else 0
        row = {"n_before": first, "n_at": at, "n_after": keys.shape[1] - first - at}
        for side, (i, j) in {"before": (0, first), "after": (first + at, keys.shape[1])}.items():
            middle = keys[:, (i + j - 1) // 2].tolist() if j > i else [None] * 3
            row |= {f"{side}_{k}": v for k, v in enumerate(middle)}
        yield pa.RecordBatch.from_pylist([row], schema=pa.schema([(c, pa.int64()) for c in PROBE]))
    return probe


PROBE = ["n_before", "n_at", "n_after", "before_0", "before_1", "before_2", "after_0", "after_1", "after_2"]


def weighted_median(medians: list[tuple[Key, int]]) -> Key:
    """The first key at which half of all weight is reached."""
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in sorted(medians):
        seen += n
        if seen >= half:
            return key
    raise ValueError("no open keys")


def cutoff(keys: DataFrame, k: int) -> tuple[Key, int]:
    """The k-th of the keys (a, b, c), smallest first, and how many keys come before it; ``k`` is from 1
    to their number. ``keys`` should be a written table: every round reads it, cut to the open range."""
    low = pivot = high = None
    need = k  # position of the wanted key among the open ones
    before_all = 0
    while True:
        rows = keys
        if high is not None:
            rows = rows.where(F.col("a") <= high[0])
        if low is not None:
            rows = rows.where(F.col("a") >= low[0])
        found = rows.select("a", "b", "c").mapInArrow(_probe(low, pivot, high), ", ".join(f"{c} long" for c in PROBE)).collect()
        n_before, n_at = sum(r.n_before for r in found), sum(r.n_at for r in found)
        if pivot is not None and n_before < need <= n_before + n_at:
            return pivot, before_all + n_before
        if need <= n_before:
            side, high = "before", pivot
        else:
            side, low = "after", pivot
            need -= n_before + n_at
            before_all += n_before + n_at
        medians = [(tuple(r[f"{side}_{i}"] for i in range(3)), r[f"n_{side}"]) for r in found if r[f"n_{side}"]]
        pivot = weighted_median(medians)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, run: int = RUN,
             buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_features, weight, score, rank.

    Of the N rows with at least ``least_words`` words, floor(percent * N / 100) with the highest scores
    are drawn, ties to the smaller doc_id; rank counts them from 1 and is null for all others. Null
    and empty texts have no features and weight 0. Rows without a doc_id have no score and are never
    drawn nor counted in N. Repeated rows each take part; among equal rows any may be drawn. Other
    columns are ignored; an empty target only smooths. An empty table gives an empty result.
    """
    rows = written(weighted(docs, target, run, buckets, seed).withColumn("eligible", (F.col("n_words") >= least_words) & F.col("score").isNotNull())
                   .drop("n_words"), "resample-scores")
    n = rows.where("eligible").count()
    k = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    undrawn = F.lit(None).cast("long").alias("rank")
    if not k:
        return rows.select(*columns, undrawn)
    keys = rows.where("eligible").select((-F.col("score")).alias("a"), F.col("doc_id").alias("b"), F.col("n_features").alias("c"))
    (a, b, c), first = cutoff(keys, k)

    score, doc = F.col("score"), F.col("doc_id")
    tie = (score == -a) & (doc == b)
    before = (score > -a) | ((score == -a) & (doc < b)) | (tie & (F.col("n_features") < c))
    at = tie & (F.col("n_features") == c)
    drawn = F.col("eligible") & (before | at)
    winners = rows.where(drawn).groupBy(*columns).agg(F.count("*").alias("copies"), F.first(at).alias("last"))
    taken = F.when(F.col("last"), F.lit(k - first)).otherwise(F.col("copies"))
    winners = written(winners.select(*columns, "copies", F.least(taken, "copies").alias("taken")), "resample-winners")
    ordered = written(winners.select(*columns, F.explode(F.sequence(F.lit(1), "taken")).alias("copy"))
                      .orderBy(F.desc("score"), "doc_id", "n_features", "copy")
                      .select(*columns, F.monotonically_increasing_id().alias("place")), "resample-order")
    left_over = winners.where("taken < copies").select(*columns, F.explode(F.sequence(F.col("taken") + 1, "copies"))).drop("col")
    return (ranked(ordered).unionByName(left_over.select(*columns, undrawn))
            .unionByName(rows.where(~drawn | ~F.col("eligible")).select(*columns, undrawn)))


def ranked(ordered: DataFrame) -> DataFrame:
    """Replace ``place``, a sorted table's monotonically increasing id, by rank (1, 2, 3, ...). One
    number per task of the sort reaches the driver."""
    part = F.shiftright("place", 33)
    starts, total = [], 0
    for r in sorted(ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect(), key=lambda r: r.part):
        starts.append((r.part, total))
        total += r.n
    starts = ordered.sparkSession.createDataFrame(starts, "part long, start long")
    place = F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return ordered.withColumn("part", part).join(starts, "part").withColumn("rank", place).drop("part", "start", "place")


#: crc32 of a word's UTF-8 bytes as SQL, with the usual table made from its polynomial.
SQL = r"""
WITH crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
texts AS (
  SELECT doc_id AS id, 0 AS side, coalesce(text, '') AS text, row_number() OVER () AS k FROM documents
  UNION ALL SELECT item_id, 1, coalesce(text, ''), row_number() OVER () FROM benchmark),
words AS (
  SELECT side, k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM texts),
hexed AS (SELECT w, hex(encode(w)) AS h FROM (SELECT DISTINCT w FROM words)),
buckets AS (
  SELECT w, xor(list_reduce(list_concat([4294967295], list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
                            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b
  FROM hexed, crc_table),
counts AS (SELECT b, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM words JOIN buckets USING (w) GROUP BY b),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM counts),
gains AS (
  SELECT b, CAST(floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000)))) AS BIGINT) AS gain
  FROM counts, totals),
weights AS (
  SELECT k, count(*) AS n, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN buckets USING (w) JOIN gains USING (b) WHERE side = 0 GROUP BY k),
scored AS (
  SELECT id AS doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (k) WHERE side = 0),
placed AS (
  SELECT doc_id, n_features, weight, score, n_features >= 20 AS fit,
         row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND place <= 10 * n // 100 THEN place END AS rank FROM placed
"""
