"""Nearest neighbours by an inverted multi-index.

Vectors are split into two halves and each half is quantised with its own codebook; a pair of
centroids is a cell, and every vector is listed in its cell. For a query the centroids of each
half are sorted by their inner product with the query's half, and the pairs are walked in order
of the summed product (multi-sequence: above any sum lies a prefix of every sorted row) until the
lists seen hold enough candidates. All vectors of those cells are then reranked with the exact
product; a matrix product with a bound on its rounding picks those that may be among the nearest.

Equal vectors are one entry of the index, with the smallest of their ids, as many as an answer can
show; so copies neither use up a walk nor take places from other vectors. Codebooks are fitted on
a bounded sample; every entry is indexed and every walked list is read whole. Cells are dealt into blocks by their first centroid; a query goes to each block with a bit
map of the cells it walked there. A block with many vectors or queries is cut by hash on both
sides, so that no task holds more than a bounded number of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.llm.tables import hash_share, written

SAMPLE = 20_000  # distinct vectors that fit the codebooks: the bound of the sample
CENTROIDS = 256  # of each half, where the sample has eight vectors for each
SHARE = 0.33  # share of all distinct vectors that a walk collects, for a recall over 0.9 on vectors without clusters
LEAST = 2_000  # distinct vectors that a walk collects at least
BLOCK = 16_384  # distinct vectors of a block: few blocks, as each gives back its best for every query
QUERIES = 2_048  # queries of a block
AT_ONCE = 128  # queries that are scored together
HALVINGS = 12  # of the sums between which a walk ends; the cells above the lower one are sorted


def kmeans(points: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids by Lloyd's rounds from random points; a centroid without points stays."""
    k = min(k, len(points))
    centres = points[np.random.default_rng(seed).choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        count = np.bincount(near, minlength=k)
        centres[count > 0] = sums[count > 0] / count[count > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1)[None, :] - 2 * points @ centres.T, axis=1)


class MultiIndex:
    """Two codebooks, and how many distinct vectors each cell holds."""

    def __init__(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None):
        self.left, self.right = left, right
        self.counts = np.zeros(len(left) * len(right), int) if counts is None else counts

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        half = self.left.shape[1]
        return nearest(vectors[:, :half], self.left) * len(self.right) + nearest(vectors[:, half:], self.right)

    def walk(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """Cells in order of the summed product until they hold ``wanted`` vectors.

        Both halves are sorted, so the cells above a sum are a prefix of each row, and cumulated counts
        say how many vectors they hold. Halving finds a low sum that holds enough; the cells above it
        are put in order."""
        half = self.left.shape[1]
        a, b = self.left @ query[:half], self.right @ query[half:]
        first, second = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        a, b, rows = a[first], b[second], np.arange(len(a))
        counts = self.counts.reshape(len(a), len(b))[first[:, None], second]
        held = np.zeros((len(a), len(b) + 1), np.int64)
        np.cumsum(counts, axis=1, out=held[:, 1:])
        low, high, width = a[-1] + b[-1], a[0] + b[0], np.full(len(a), len(b))
        for _ in range(HALVINGS):
            middle = low + (high - low) / 2
            reached = np.searchsorted(-b, a - middle, side="right")  # of each row, the cells with a + b >= middle
            if held[rows, reached].sum() < wanted:
                high = middle
            else:
                low, width = middle, reached
        i, j = np.nonzero((np.arange(len(b)) < width[:, None]) & (counts > 0))
        order = np.argsort(-(a[i] + b[j]), kind="stable")
        order = order[:np.searchsorted(np.cumsum(counts[i, j][order]), wanted) + 1]
        return first[i[order]] * len(b) + second[j[order]]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.float64)


def _assign(held, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = held.value.cells(_matrix(batch.column(1), dims))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cells.astype(np.int32))],
                                                 names=["ids", "v", "cell"])
    return run


def _walks(held, dims: int, wanted: int, blocks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held.value
        shape = len(index.left), len(index.right)
        for batch in batches:
            for part in range(0, batch.num_rows, 256):
                rows = batch.slice(part, 256)
                at, block, bits = [], [], []
                for i, q in enumerate(_matrix(rows.column(1), dims)):
                    seen = np.zeros(shape, bool)
                    seen.ravel()[index.walk(q, wanted)] = True
                    for b in range(blocks):
                        if seen[b::blocks].any():
                            at.append(i)
                            block.append(b)
                            bits.append(np.packbits(seen[b::blocks]).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(at, pa.int64())), rows.column(1).take(pa.array(at, pa.int64())),
                     pa.array(block, pa.int32()), pa.array(bits, pa.binary())], names=["query_id", "q", "block", "bits"])
    return run


def _best(rough: np.ndarray, error: float, exact, ids: np.ndarray, query_id: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` distinct (score, id) of the vectors' ids, without the query's own; ties by id.
    ``exact`` gives the scores of the vectors at some places, from which ``rough`` differs by ``error`` at most."""
    take = k
    while True:
        # all vectors that may tie with the last one; an id of several vectors may ask for more of them
        last = np.partition(rough, len(rough) - take)[len(rough) - take] if take < len(rough) else -np.inf
        top = np.flatnonzero(~(rough < last - 2 * error))
        pairs = {(-s, i) for s, own in zip(exact(top).tolist(), ids[top], strict=True) for i in own.tolist() if i != query_id}
        # a vector that was not scored lies below ``last - error``
        if len(top) == len(rough) or sum(-s >= last - error for s, _ in pairs) >= k:
            best = sorted(pairs)[:k]
            return np.array([i for _, i in best], np.int64), np.array([-s for s, _ in best], np.float64)
        take = 2 * len(top)


def _rerank(k: int, width: int, blocks: int):
    def run(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(vectors):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        q = np.stack(queries["q"].to_numpy()).astype(np.float64)
        v = np.stack(vectors["v"].to_numpy()).astype(np.float64)
        ids, query_ids, cell = vectors["ids"].to_numpy(), queries["query_id"].to_numpy(), vectors["cell"].to_numpy()
        first, copies = np.array([x[0] for x in ids]), np.array([len(x) for x in ids])
        place = cell // width // blocks * width + cell % width  # of the cell in the block's bit map
        # of two sums of the same products in any order, by twice as much as they can differ
        errors = 4 * (q.shape[1] + 2) * np.finfo(float).eps * np.linalg.norm(q, axis=1) * np.linalg.norm(v, axis=1).max() + 1e-300
        out = []
        for i, bits in enumerate(queries["bits"]):
            if i % AT_ONCE == 0:
                rough = q[i:i + AT_ONCE] @ v.T
            walked = np.unpackbits(np.frombuffer(bits, np.uint8))[place].astype(bool)
            some = np.flatnonzero(walked & ((copies > 1) | (first != query_ids[i])))

            def exact(top: np.ndarray) -> np.ndarray:  # one order of addition for every pair: equal vectors tie exactly
                return np.add.accumulate(v[some[top]] * q[i], axis=1)[:, -1] + 0.0

            found, score_of = _best(rough[i % AT_ONCE, some], errors[i], exact, ids[some], query_ids[i], k)
            out.append((np.full(len(found), query_ids[i]), found, score_of))
        return pd.DataFrame({c: np.concatenate([o[n] for o in out]) for n, c in enumerate(("query_id", "vec_id", "score"))})
    return run


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part: with an id, not null, not zero, every component
    present and finite, and of the most common length (ties: the longer)."""
    df = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    df = df.where("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0").where(
        "forall(v, x -> coalesce(x = x AND abs(x) < double('inf'), false)) AND exists(v, x -> x <> 0)")
    common = df.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return df.where(F.size("v") == (common.n if common else 0))


def entries(good: DataFrame, total: int, most: int) -> DataFrame:
    """(ids, v): each distinct vector once, with its ``most`` smallest ids. Ids are gathered per
    share of them first, so that a vector with many copies is not one task's."""
    shares = max(1, int(total ** 0.5))
    some = good.groupBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(shares)).alias("share")).agg(
        F.slice(F.array_sort(F.collect_set("vec_id")), 1, most).alias("ids"))
    return some.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, most).alias("ids")).select("ids", "v")


def neighbours(vectors: DataFrame, every: int = 20, k: int = 20, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """Queries are the vectors whose vec_id is divisible by ``every``. Per query its ``k`` found
    neighbours with the largest inner product: query_id, rank (from 1), vec_id, score.

    Ties go to the smaller vec_id; a query is not its own neighbour, nor are other rows with its
    vec_id. Repeated rows count once. Vectors that :func:`usable` leaves out take no part; an
    empty table gives an empty result. Other columns are ignored.
    """
    spark = vectors.sparkSession
    good = usable(vectors)
    total = good.count()
    different = good.select(F.xxhash64("v")).distinct().count()
    sample = (good.where(hash_share(["v"], SAMPLE, different)).select("v").distinct()
              .orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect())
    points = np.array([r.v for r in sample], np.float64)
    if not len(points):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = points.shape[1]
    size, half = int(min(CENTROIDS, max(1, len(points) // 8))), dims // 2
    index = MultiIndex(kmeans(points[:, :half], size), kmeans(points[:, half:], size))
    books = spark.sparkContext.broadcast(index)
    listed = written(entries(good, total, k + 1).mapInArrow(_assign(books, dims), "ids array<long>, v array<double>, cell int"),
                     "vector-cells")
    counts = np.zeros(size * size, int)
    for r in listed.groupBy("cell").count().collect():  # at most CENTROIDS * CENTROIDS cells
        counts[r.cell] = r["count"]
    index = spark.sparkContext.broadcast(MultiIndex(index.left, index.right, counts))
    blocks = int(min(size, max(1, counts.sum() // BLOCK)))
    wanted = max(least, int(share * counts.sum()))
    asked = written(good.where(F.col("vec_id") % every == 0).distinct().mapInArrow(
        _walks(index, dims, wanted, blocks), "query_id long, q array<double>, block int, bits binary"), "vector-walks")
    listed = listed.withColumn("block", (F.expr(f"cell div {size}") % blocks).cast("int"))

    # both sides of a block are cut by hash, each piece of one side meets each of the other
    pieces = (listed.groupBy("block").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("nv"))
              .join(asked.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("nq")), "block"))
    left = (asked.join(pieces, "block").withColumn("b", F.pmod(F.xxhash64("query_id"), "nq").cast("int"))
            .select("block", F.explode(F.sequence(F.lit(0), F.col("nv") - 1)).alias("a"), "b", "query_id", "q", "bits"))
    right = (listed.join(pieces, "block").withColumn("a", F.pmod(F.xxhash64("v"), "nv").cast("int"))
             .select("block", "a", F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("b"), "ids", "v", "cell"))
    key = ["block", "a", "b"]
    found = (left.groupBy(*key).cogroup(right.groupBy(*key))
             .applyInPandas(_rerank(k, size, blocks), "query_id long, vec_id long, score double"))
    rank = F.dense_rank().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return (found.withColumn("rank", rank).where(F.col("rank") <= k)
            .groupBy("query_id", "rank", "vec_id", "score").agg(F.lit(1).alias("one"))
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
