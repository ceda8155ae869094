"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A document's latent quality is the sum of shared weights over hashed text features; ordered
thresholds cut it into grades: P(grade > g) = sigmoid(latent - threshold[g]). One fit on a
bounded sample of rated documents gives the expected grade and the tail probability by which
documents are selected.

Features are distinct word and symbol tokens of the whole text plus bucketed shares of capitals,
symbols, digits, repeated lines and short lines. Grades: 0 toxic, 1 poor, 2 good.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.tables import label_share, packed, row_texts

DIMENSIONS = 1 << 18
SAMPLE = 6_000  # rated documents that the fit reads, shared evenly by the grades: the bound of the sample
GRADES = 3
KEEP = 0.5  # documents whose tail probability P(grade >= 2) reaches this stay
MAX_CHUNK = 1 << 20  # characters that are split into tokens at once

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
SHAPES = 64  # slots at the end of the weights for bucketed shares


def slot_of(token: str) -> int:
    return zlib.crc32(token.encode()) % (DIMENSIONS - SHAPES)


def tokens_of(text: str) -> set[str]:
    """Distinct lower-cased tokens of a whole text, read in pieces that end at white space."""
    if len(text) <= MAX_CHUNK:
        return set(_TOKEN.findall(text.lower()))
    found, at = set(), 0
    while at < len(text):
        end = at + MAX_CHUNK
        if end < len(text):
            space = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = space + 1 if space > at else end
        found.update(_TOKEN.findall(text[at:end].lower()))
        at = end
    return found


_SYMBOLS = str.maketrans("", "", "%#*&$!|@~^=+<>{}[]\\/_")
_DIGITS = str.maketrans("", "", "0123456789")


def shape_slots(text: str) -> list[int]:
    """Slots of bucketed shares: eight buckets each for capitals, symbols, digits, repeated lines,
    short lines and length."""
    n = max(len(text), 1)
    capitals = (n - len(_without_capitals(text))) / n
    symbols = (n - len(text.translate(_SYMBOLS))) / n
    digits = (n - len(text.translate(_DIGITS))) / n
    lines = text.split("\n")
    repeated = 1 - len(set(lines)) / len(lines)
    short = sum(len(x) < 40 for x in lines) / len(lines)
    shares = (capitals, symbols * 4, digits * 4, repeated * 2, short, min(math.log10(n) / 7, 1))
    return [DIMENSIONS - SHAPES + 8 * i + min(int(x * 8), 7) for i, x in enumerate(shares)]


_CAPITALS = re.compile(r"[A-Z]+")


def _without_capitals(text: str) -> str:
    return _CAPITALS.sub("", text)


class Ordinal:
    """Fitted model: hashed weights and ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds
        self._known: dict[str, float] = {}

    def __reduce__(self):
        return Ordinal, (self.weights, self.thresholds)

    def latent(self, text: str) -> float:
        known, total = self._known, 0.0
        if len(known) > 400_000:
            known.clear()
        for token in tokens_of(text):
            w = known.get(token)
            if w is None:
                w = known[token] = float(self.weights[slot_of(token)])
            total += w
        return total + float(self.weights[shape_slots(text)].sum())

    def tails(self, latent: np.ndarray) -> np.ndarray:
        """P(grade > g) for each g, one row per document."""
        return _sigmoid(latent[:, None] - self.thresholds[None, :])


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit(rows: list[tuple[int, list[int]]], steps: int = 250, rate: float = 0.05, penalty: float = 2e-3) -> Ordinal:
    """Penalised maximum likelihood with Adam. ``rows`` are (grade, feature slots). Thresholds are
    kept in order by positive gaps; grades weigh alike, whatever their share."""
    weights = np.zeros(DIMENSIONS)
    if not rows:
        return Ordinal(weights, np.array([-1.0, -0.5]))
    grade = np.array([g for g, _ in rows])
    sizes = np.array([len(s) for _, s in rows])
    flat = np.fromiter((i for _, s in rows for i in s), np.int64, int(sizes.sum()))
    used, col = np.unique(flat, return_inverse=True)
    row = np.repeat(np.arange(len(rows)), sizes)
    seen = np.bincount(col)
    count = np.bincount(grade, minlength=GRADES).astype(float)
    cost = (len(rows) / (np.maximum(count, 1) * (count > 0).sum()))[grade]
    cost = np.sqrt(cost) / np.sqrt(cost).mean()
    theta = np.concatenate((np.zeros(len(used)), [-1.0], np.zeros(GRADES - 2)))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        w, first, gaps = theta[:len(used)], theta[len(used)], np.exp(theta[len(used) + 1:])
        cuts = first + np.concatenate(([0.0], np.cumsum(gaps)))
        latent = np.bincount(row, w[col], len(rows))
        above = np.concatenate((np.ones((len(rows), 1)), _sigmoid(latent[:, None] - cuts), np.zeros((len(rows), 1))), 1)
        here = np.arange(len(rows))
        chance = np.maximum(above[here, grade] - above[here, grade + 1], 1e-9)
        slope = above * (1 - above)
        d_latent = -cost * (slope[here, grade] - slope[here, grade + 1]) / chance
        d_cuts = np.zeros(GRADES - 1)
        for g in range(GRADES - 1):
            d_cuts[g] = (cost * (np.where(grade == g + 1, slope[:, g + 1], 0)
                                 - np.where(grade == g, slope[:, g + 1], 0)) / chance).sum()
        grad = np.concatenate((np.bincount(col, d_latent[row], len(used)), [d_cuts.sum()],
                               [d_cuts[i + 1:].sum() * gaps[i] for i in range(GRADES - 2)])) / len(rows)
        grad[:len(used)] += penalty * w / np.sqrt(seen)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-6)
    once = seen < 3  # a word of one or two documents says nothing about others
    weights[used] = np.where(once, 0.0, theta[:len(used)])
    gaps = np.exp(theta[len(used) + 1:])
    return Ordinal(weights, theta[len(used)] + np.concatenate(([0.0], np.cumsum(gaps))))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in range(0, batch.num_rows, 500):
            rows = batch.slice(part, 500)
            slots = [sorted({slot_of(t) for t in tokens_of(x or "")} | set(shape_slots(x or "")))
                     for x in rows.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(slots, pa.list_(pa.int32()))],
                                             names=["grade", "slots"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ordinal:
    """Fit on at most ``sample`` rated documents, drawn by the hash of doc_id. Grades have even parts,
    and a rare one is read whole.

    ``labels`` has doc_id, quality and toxic (0/1). Rows with a null doc_id or no rating take no
    part; of a doc_id rated twice the lower grade counts. Features of fewer than three documents of
    the sample weigh nothing, so very few ratings yield the thresholds only.
    """
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.cast("int").alias("grade")).dropna()
    graded = named.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    counts = {r.grade: r["count"] for r in graded.groupBy("grade").count().collect()}
    rated = (graded.where(label_share(["doc_id"], "grade", sample, counts))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most ``sample`` rows of two numbers, so this side may be broadcast
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .join(F.broadcast(rated), "doc_id"))
    rows = texts.select("grade", "text").mapInArrow(_features, "grade int, slots array<int>").collect()
    return fit(sorted((r.grade, r.slots) for r in rows))


def _score(held, keep: float, at: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                rows = batch.slice(part, 500)
                latent = np.array([model.latent(x or "") for x in row_texts(rows, at).to_pylist()])
                tails = np.round(model.tails(latent), 9)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.round(tails.sum(1), 9)), pa.array(tails[:, -1]),
                     pa.array(tails[:, -1] >= keep)], names=["key", "expected_grade", "tail", "keep"])
    return run


def score(docs: DataFrame, model: Ordinal, key: str = "doc_id", keep: float = KEEP) -> DataFrame:
    """Per row of ``docs`` (key, text): key, expected_grade (0 to 2), tail = P(grade >= 2), keep.

    ``key`` may be a struct. A null text scores as an empty one; repeated
    rows score alike, and other columns are ignored.
    """
    return _scored(docs.select(F.col(key).alias("key"), F.col("text").cast("string").alias("text")), model, keep
                   ).withColumnRenamed("key", key)


def _scored(rows: DataFrame, model: Ordinal, keep: float, at: int | None = None) -> DataFrame:
    """``rows`` (key, text); with ``at`` the text is that field of the key."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(_score(held, keep, at), f"key {kind}, expected_grade double, tail double, keep boolean")


def selected(docs: DataFrame, model: Ordinal, keep: float = KEEP) -> DataFrame:
    """Rows of ``docs`` that the classifier keeps, with all their columns."""
    rows, at = packed(docs, "key")
    return _scored(rows, model, keep, at).where("keep").select("key.*")
