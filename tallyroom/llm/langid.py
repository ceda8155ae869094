"""Language identification by word-first backoff.

Every word of a text votes with its log frequency per language. A word that training has not
met backs off to its character n-grams, the longest length first: the word scores by the mean
over its n-grams of the longest length of which any is known, down to single letters. The
language with the largest sum wins.

Frequencies come from a bounded sample of labelled documents, and the model keeps every word and
n-gram of it, those seen once too, so that a language with a single short document is learned.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.llm.tables import label_share

SAMPLE = 12_000  # labelled documents that training reads, shared evenly by the languages
LONGEST = 4  # characters of the longest n-gram
CACHE = 300_000  # words whose scores a task remembers
PIECE = 1 << 20  # characters that are split into words at once
FLOOR = 0.5  # count that an entry unseen in one language has there, and the most that all unseen ones share

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter:
    """Counts of lower-cased words (runs of letters) of a whole text."""
    if len(text) <= PIECE:
        return Counter(_WORD.findall(text.lower()))
    counts, at = Counter(), 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            space = max(text.rfind(" ", at, end), text.rfind("\n", at, end))
            end = space + 1 if space > at else end
        counts.update(_WORD.findall(text[at:end].lower()))
        at = end
    return counts


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams of a word with marked ends; single letters come without marks."""
    if n == 1:
        return list(word)
    marked = f"^{word}$"
    return [marked[i:i + n] for i in range(len(marked) - n + 1)]


class Table(Mapping):
    """Log frequencies per language by entry. It travels as an Arrow column and a matrix; the index is
    made where entries are looked up, so the driver holds no object per entry."""

    def __init__(self, entries: pa.Array, logs: np.ndarray):
        self.entries, self.logs = entries, logs
        self._index: dict[str, int] | None = None

    def __reduce__(self):
        return Table, (self.entries, self.logs)

    def get(self, entry, default=None):
        if self._index is None:
            self._index = {e: i for i, e in enumerate(self.entries.to_pylist())}
        at = self._index.get(entry)
        return default if at is None else self.logs[at]

    def __getitem__(self, entry):
        found = self.get(entry)
        if found is None:
            raise KeyError(entry)
        return found

    def __contains__(self, entry):
        return self.get(entry) is not None

    def __iter__(self):
        return iter(self.entries.to_pylist())

    def __len__(self):
        return len(self.entries)


class Backoff:
    """Log frequencies per language: one table of words, one per n-gram length."""

    def __init__(self, languages: list[str], tables: list[Table]):
        self.languages, self.tables = languages, tables  # tables[0]: words, tables[n]: n-grams
        self._seen: dict[str, np.ndarray] = {}

    def __reduce__(self):
        return Backoff, (self.languages, self.tables)

    def word(self, word: str) -> np.ndarray:
        got = self._seen.get(word)
        if got is None:
            if len(self._seen) >= CACHE:
                self._seen.clear()
            got = self._score(word)
            if len(word) <= 64:
                self._seen[word] = got
        return got

    def _score(self, word: str) -> np.ndarray:
        known = self.tables[0].get(word)
        if known is not None:
            return np.array(known)
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            table = self.tables[n]
            found = [x for x in map(table.get, grams_of(word, n)) if x is not None]
            if found:
                return np.mean(found, axis=0)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of its probability); ("und", 0) without a letter or a model. Ties go
        to the first language in alphabetical order."""
        counts = words_of(text or "")
        if not counts or not self.languages:
            return "und", 0.0
        total = np.zeros(len(self.languages))
        word = self.word
        rows = np.array([word(w) for w in counts])
        total = np.array(list(counts.values()), float) @ rows
        best = int(np.argmax(total))
        chance = 1.0 / float(np.exp(np.clip(total - total[best], -700, 0)).sum())
        return self.languages[best], round(chance, 9)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words and n-grams per language of a batch: the map side of the aggregation."""
    for batch in batches:
        for part in range(0, batch.num_rows, 1000):
            rows = batch.slice(part, 1000)
            by: dict[str, Counter] = {}
            for lang, text in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                by.setdefault(lang, Counter()).update(words_of(text or ""))
            langs, sizes, items, counts = [], [], [], []
            for lang, words in by.items():
                held = [Counter() for _ in range(LONGEST + 1)]
                held[0] = words
                for w, c in words.items():
                    for n in range(1, LONGEST + 1):
                        for g in grams_of(w, n):
                            held[n][g] += c
                for n, counter in enumerate(held):
                    langs += [lang] * len(counter)
                    sizes += [n] * len(counter)
                    items += counter.keys()
                    counts += counter.values()
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(sizes, pa.int32()), pa.array(items, pa.string()),
                 pa.array(counts, pa.int64())], names=["lang", "n", "item", "c"])


def held_out(doc_id) -> F.Column:
    """Documents that training does not read."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE, words: int | None = None, grams: int | None = None) -> Backoff:
    """Fit on about ``sample`` of the documents that have a language and are not held out, drawn by
    the hash of doc_id. Languages have even parts, and a rare one is read whole. A null doc_id is
    not sampled. ``words`` and ``grams``, where given, prune the model to that many of the most
    frequent words per language, and n-grams per language and length; by default nothing is pruned.

    An entry that a language has not seen counts ``FLOOR`` of its total, or of the number of unseen
    entries where that is larger: a small language does not win by what it never met."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                        F.col("text").cast("string").alias("text"))
    chosen = named.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r.lang: r["count"] for r in chosen.groupBy("lang").count().collect()}  # one row per language
    counted = (chosen.where(label_share(["doc_id"], "lang", sample, counts)).select("lang", "text")
               .mapInArrow(_counts, "lang string, n int, item string, c long")
               .groupBy("lang", "n", "item").agg(F.sum("c").alias("c")))
    if words is not None or grams is not None:
        order = Window.partitionBy("lang", "n").orderBy(F.desc("c"), "item")
        most = F.when(F.col("n") == 0, F.lit(words).cast("int")).otherwise(F.lit(grams).cast("int"))
        counted = counted.withColumn("r", F.row_number().over(order)).where(most.isNull() | (F.col("r") <= most))
    names = sorted(counts)
    if not names:
        return Backoff([], [Table(pa.array([], pa.string()), np.zeros((0, 0)))] * (LONGEST + 1))
    # one row per entry of the bounded sample, one column per language
    wide = counted.groupBy("n", "item").agg(
        *[F.sum(F.when(F.col("lang") == lang, F.col("c")).otherwise(0)).alias(f"c{i}") for i, lang in enumerate(names)])
    rows = wide.toArrow().combine_chunks()
    learned = [i for i in range(len(names)) if pc.sum(rows.column(f"c{i}")).as_py()]
    size = rows.column("n").to_numpy()
    tables = []
    for n in range(LONGEST + 1):
        at = np.flatnonzero(size == n)
        seen = np.stack([rows.column(f"c{i}").to_numpy()[at] for i in learned], axis=1) if learned else np.zeros((len(at), 0))
        total = np.maximum(seen.sum(0), 1)
        unseen = FLOOR / np.maximum(total, (seen == 0).sum(0))
        logs = np.log(np.where(seen > 0, seen / total, unseen))
        tables.append(Table(rows.column("item").take(pa.array(at)).combine_chunks(), logs))
    return Backoff([names[i] for i in learned], tables)


def _predict(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            for part in range(0, batch.num_rows, 500):
                rows = batch.slice(part, 500)
                found = [model.predict(t) for t in rows.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([f[0] for f in found], pa.string()),
                     pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])
    return run


def predict(docs: DataFrame, model: Backoff) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, lang_pred, score (0 to 1).

    ``und`` with score 0 for a text that is null or has no letter. Repeated rows are judged
    alike; other columns are ignored.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string")).mapInArrow(
        _predict(held), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
