"""Benchmark decontamination by greedy string tiling.

Texts and benchmark items become word sequences. Equal runs of ``k`` words (found by their
rolling hash) are the seeds; seeds on one diagonal form matches. The longest match whose words
are all unmarked becomes a tile, its words are marked on both sides, and so on until no match of
``k`` words is left. Tiles do not depend on order, so passages in another order are covered too.
An item leaks into a document when tiles cover at least ``coverage`` of the item's words.

The benchmark is read in blocks of bounded size and every block meets all documents; nothing is
shuffled, and a document needs only its own seeds.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.tables import packed, row_texts, text_views
from tallyroom.llm.wordhash import Words, windows

WORDS = Words(bytes(b for b in range(128) if not chr(b).isalnum()))
K = 5  # words of the shortest tile
COVERAGE = 0.6  # share of an item's words that tiles must cover
BLOCK_CHARS = 8_000_000  # characters of benchmark text that are sent to the tasks at once

FOUND = "n_words long, item_id long, covered long, item_words long, tiles string"


class Block:
    """Benchmark items of one block, with an index from seed hash to (item, place)."""

    def __init__(self, items: list[tuple[int, str]], k: int):
        self.ids, self.sizes = [], []
        seeds, owner, place = [], [], []
        for item_id, text in items:
            words = WORDS.hashes(np.frombuffer(text.lower().encode(), np.uint8))
            if not len(words):
                continue
            length = min(k, len(words))  # an item shorter than a tile must occur whole
            found = windows(words, length)
            seeds.append(found)
            owner.append(np.full(len(found), len(self.ids)))
            place.append(np.arange(len(found)))
            self.ids.append(item_id)
            self.sizes.append(len(words))
        flat = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.seeds = flat[order]
        self.owner = (np.concatenate(owner) if seeds else np.zeros(0, int))[order]
        self.place = (np.concatenate(place) if seeds else np.zeros(0, int))[order]
        self.lengths = sorted({min(k, n) for n in self.sizes})


def tiles_of(pairs: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (text place, item place, words) from seed pairs of k words each.

    Ties go to the earlier place in the text, then in the item. A match that lost words to a
    longer tile is cut to its unmarked stretches, which compete again.
    """
    diagonals = defaultdict(list)
    for i, j in pairs:
        diagonals[i - j].append(i)
    heap = []
    for d, starts in diagonals.items():
        starts.sort()
        first = last = starts[0]
        for i in [*starts[1:], None]:
            if i is not None and i <= last + 1:
                last = i
                continue
            heap.append((-(last - first + k), first, first - d))
            first = last = i
    heapq.heapify(heap)
    in_text, in_item, tiles = set(), set(), []
    while heap:
        size, i, j = heapq.heappop(heap)
        size = -size
        if i not in in_text and j not in in_item and i + size - 1 not in in_text and j + size - 1 not in in_item \
                and not any(i + x in in_text or j + x in in_item for x in range(1, size - 1)):
            tiles.append((i, j, size))
            in_text.update(range(i, i + size))
            in_item.update(range(j, j + size))
            continue
        run = 0
        for x in range(size + 1):
            if x < size and i + x not in in_text and j + x not in in_item:
                run += 1
                continue
            if run >= k:
                heapq.heappush(heap, (-run, i + x - run, j + x - run))
            run = 0
    return tiles


def _lowered(column: pa.Array) -> pa.Array:
    return pa.array([x.lower() if x is not None else None for x in column.to_pylist()], pa.large_string())


def _tile(block, k: int, coverage: float, at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                yield _tiled(batch.slice(part, 500), block.value, k, coverage, at)
    return run


def _tiled(rows: pa.RecordBatch, b: Block, k: int, coverage: float, text_at: int | None) -> pa.RecordBatch:
    out = []
    for text in text_views(_lowered(row_texts(rows, text_at))):
        words = WORDS.hashes(text)
        best = (None, 0, None, None)
        for length in b.lengths if len(b.seeds) else []:
            seeds = windows(words, length)
            at = np.searchsorted(b.seeds, seeds)
            hits = np.flatnonzero(b.seeds[np.minimum(at, len(b.seeds) - 1)] == seeds)
            by_item = defaultdict(list)
            for i in hits.tolist():
                x = int(at[i])
                while x < len(b.seeds) and b.seeds[x] == seeds[i]:
                    if min(k, b.sizes[b.owner[x]]) == length:
                        by_item[int(b.owner[x])].append((i, int(b.place[x])))
                    x += 1
            for item, pairs in by_item.items():
                tiles = tiles_of(pairs, length)
                covered = sum(t[2] for t in tiles)
                if covered < coverage * b.sizes[item]:
                    continue
                rank = (covered / b.sizes[item], -b.ids[item])
                if best[0] is None or rank > (best[1] / best[2], -best[0]):
                    best = (b.ids[item], covered, b.sizes[item],
                            ",".join(f"{i}:{j}:{n}" for i, j, n in sorted(tiles)))
        out.append((len(words), *best))
    n, item, covered, size, tiles = zip(*out, strict=True) if out else ([],) * 5
    return pa.RecordBatch.from_arrays(
        [rows.column(0), pa.array(n, pa.int64()), pa.array(item, pa.int64()), pa.array(covered, pa.int64()),
         pa.array(size, pa.int64()), pa.array(tiles, pa.string())],
        names=["key", "n_words", "item_id", "covered", "item_words", "tiles"])


def benchmark_blocks(benchmark: DataFrame, block_chars: int) -> list[DataFrame]:
    """The benchmark cut into blocks of about ``block_chars`` characters, by item hash."""
    size = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = max(1, -(-size // block_chars))
    return [benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def leaks(docs: DataFrame, benchmark: DataFrame, k: int = K, coverage: float = COVERAGE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_words, contaminated, and the item
    (item_id, covered, item_words, tiles) with the largest covered share, ties to the smaller
    item_id; these are null unless the share reaches ``coverage``. ``tiles`` lists
    "text word:item word:words". Items with a null id or no word are not searched; a null or
    empty text is clean. Repeated rows are judged alike; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    parts = _searched(rows, "key long", benchmark, k, coverage, block_chars)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    if len(parts) > 1:  # the best item over all blocks; equal rows come back as often as they went in
        share = F.col("covered") / F.col("item_words")
        found = (found.groupBy("key", "n_words").agg(
            F.count("*").alias("rows"),
            F.max_by(F.struct("item_id", "covered", "item_words", "tiles"),
                     F.struct(F.coalesce(share, F.lit(-1.0)), -F.col("item_id"))).alias("best"))
            .select("key", "n_words", "best.*", F.explode(F.expr(f"sequence(1L, rows div {len(parts)})")))
            .drop("col"))
    return (found.withColumnRenamed("key", "doc_id")
            .withColumn("contaminated", F.col("item_id").isNotNull()))


def _searched(rows: DataFrame, key: str, benchmark: DataFrame, k: int, coverage: float, block_chars: int,
              text_at: int | None = None) -> list[DataFrame]:
    """``rows`` (key, text) against each block of the benchmark; with ``text_at`` the text is that field of the key."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).dropna()
    out = []
    for block in benchmark_blocks(items, block_chars):
        held = rows.sparkSession.sparkContext.broadcast(Block([(r.item_id, r.text) for r in block.collect()], k))
        out.append(rows.mapInArrow(_tile(held, k, coverage, text_at), f"{key}, {FOUND}"))
    return out


def clean(docs: DataFrame, benchmark: DataFrame, k: int = K, coverage: float = COVERAGE,
          block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows of ``docs`` into which no benchmark item leaks, with all their columns. The blocks of the
    benchmark sift the rows one after the other."""
    for block in benchmark_blocks(benchmark, block_chars):
        rows, at = packed(docs, "key")
        kind = rows.schema["key"].dataType.simpleString()
        found, = _searched(rows, f"key {kind}", block, k, coverage, 1 << 62, at)
        docs = found.where("item_id IS NULL").select("key.*")
    return docs
