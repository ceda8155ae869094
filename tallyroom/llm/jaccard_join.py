"""Near copies by T-occurrence search over inverted lists of word shingles.

A document with n shingles that reaches the wanted Jaccard similarity with another one shares
at least T = ceil(percent * n / 100) shingles with it, so it must share one of any n - T + 1 of
its own. Shingles are ordered with the longest inverted lists last and by hash otherwise; the
first n - T + 1 of a document enter the index. Following DivideSkip, the short lists of a
document are merged with a heap, which yields the candidates and how often each occurred; what
the bound on the rest cannot exclude is probed by binary search in the candidate's whole sorted
set, which gives the exact overlap. Among long lists the shorter ones come first.

Lists longer than ``SHORT`` are first refined: split by the size of the smaller partner (classes
of ratio ``RATIO``), which raises the overlap that a link needs from T to that of the two sizes,
so that a document stays only in lists of shingles that come early enough in its order. Documents
whose own rare shingles already use up what a link may miss drop out here. Refined lists of at
most ``SHORT`` documents are merged as pairs.

Lists that stay longer are not expanded into pairs. The document in which a list's shingle comes
first, the one with the fewest rare shingles, is its hub; every document is compared with the hub it shares most lists with, and with all its hubs only
in lists whose members are then not in one component. Pairs inside a component need no comparison, and Jaccard
distance is a metric, so a document whose similarity to the hub is below 1 - 2 * (1 - percent / 100)
cannot link with any that links with the hub; only what both rules and the two positions of the
shared shingle leave is compared after that. Equal sets are one node.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm.tables import components, long_lists, text_views, written
from tallyroom.llm.wordhash import Words, mix, windows

WORDS = Words(b" \t\n\x0b\x0c\r")
LONG = 64  # a list with more documents counts as long when shingles are ordered
MAX_LONG = 400_000  # long lists that are named to the tasks, the longest first: 6.4 MB
SHORT = 64  # members of a list that are merged as pairs
RATIO = 1.05  # of the sizes in one class
MIN_BITS, MAX_BITS = 1 << 16, 1 << 27  # size of the filter that picks the texts to shingle again


def shingle_set(text: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes. Fewer than k words: the sequence is one shingle."""
    words = WORDS.hashes(text)
    if not len(words):
        return np.zeros(0, np.int64)
    shingles = windows(words, k) if len(words) >= k else windows(words, len(words))
    return np.unique(shingles.view(np.int64))


def needed(n, percent: int):
    """Occurrences that any partner must have among n shingles."""
    return (percent * n + 99) // 100


def prefix_of(shingles: np.ndarray, percent: int, long_ones: np.ndarray) -> np.ndarray:
    """The shingles of a set that enter the index; ``long_ones`` has a row of sorted slots and a row of
    their counts."""
    n = len(shingles)
    p = n - needed(n, percent) + 1 if n else 0
    if long_ones.shape[1] and n:
        own = slots(shingles).astype(np.int64)
        at = np.minimum(np.searchsorted(long_ones[0], own), long_ones.shape[1] - 1)
        count = np.where(long_ones[0, at] == own, long_ones[1, at], 0)
        if count[:p].any():
            return shingles[np.argsort(count, kind="stable")][:p]
    return shingles[:p]


def slots(shingles: np.ndarray) -> np.ndarray:
    """The upper 32 bits of hashes, by which long lists are named. Shingles that share a slot are
    ordered alike, which any total order of shingles allows."""
    return (shingles.view(np.uint64) >> np.uint64(32)).astype(np.uint32)


def _slot_counts(k: int, parts: int):
    """Slots of all shingles, sorted and cut into ``parts`` ranges; differences are written as byte
    planes, of which the upper ones are nearly empty and compress away in the shuffle."""
    width = -(-(1 << 32) // parts)

    def out(held):
        flat = np.sort(np.concatenate(held))
        cuts = np.searchsorted(flat, np.arange(parts + 1, dtype=np.uint64) * np.uint64(width))
        rows = []
        for i in range(parts):
            piece = flat[cuts[i]:cuts[i + 1]]
            if len(piece):
                rows.append((i, np.diff(piece, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                           pa.array([r[1] for r in rows], pa.binary())], names=["part", "planes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for text in text_views(batch.column(0)):
                held.append(slots(shingle_set(text, k)))
                size += len(held[-1])
                if size > 4_000_000:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)
    return run


def _long_slots(key, frame):
    """Slots of one range with more than LONG occurrences."""
    import pandas as pd

    flat = np.concatenate([np.cumsum(np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel(),
                                     dtype=np.uint32) for x in frame["planes"]])
    slot, count = np.unique(flat, return_counts=True)
    return pd.DataFrame({"slot": slot[count > LONG].astype(np.int64), "c": count[count > LONG].astype(np.int64)})


def _prefixes(k: int, percent: int, long_ones):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 1000):
                rows = batch.slice(part, 1000)
                sig, n, prefix = [], [], []
                for text in text_views(rows.column(1)):
                    s = shingle_set(text, k)
                    n.append(len(s))
                    sig.append(mix(np.array([mix(s.view(np.uint64)).sum(dtype=np.uint64) + np.uint64(len(s))])))
                    prefix.append(prefix_of(s, percent, long_ones.value))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.concatenate(sig).view(np.int64)), pa.array(n, pa.int64()),
                     long_lists(prefix)], names=["doc_id", "sig", "n", "prefix"])
    return run


def _sets(k: int, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            slot = batch.column(2).to_numpy(zero_copy_only=False)
            wanted = np.flatnonzero((bits.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1))
            for part in range(0, len(wanted), 500):
                rows = wanted[part:part + 500]
                texts = batch.column(1).take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows].astype(np.int64)), long_lists([shingle_set(t, k) for t in text_views(texts)])],
                    names=["rep", "shingles"])
    return run


def _merge(percent: int):
    """Heap merge of a document's short lists: candidates that the counts cannot exclude."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for row in range(batch.num_rows):  # one document's lists at a time
                x, nx, n_long, lists, sizes = (batch.column(i)[row].as_py() for i in range(5))
                size = {y: n for ys, ns in zip(lists, sizes, strict=True) for y, n in zip(ys, ns, strict=True)}
                for y, same in groupby(heapq.merge(*lists)):
                    if _reaches(nx, size[y], sum(1 for _ in same) + n_long, percent):
                        a.append(y)
                        b.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
    return run


def _prefix_test(percent: int):
    """Candidates whose indexed shingles leave the bound within reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(i).to_numpy() for i in (2, 3))
            rows = [j for j, (x, y) in enumerate(_paired(batch, 4))
                    if _reaches(int(na[j]), int(nb[j]), len(np.intersect1d(x, y, assume_unique=True)), percent)]
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows)], names=["a", "b"])
    return run


def _paired(batch: pa.RecordBatch, first: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Integer arrays of two neighbouring list columns, row by row."""
    parts = []
    for i in (first, first + 1):
        parts.append((batch.column(i).offsets.to_numpy(), batch.column(i).values.to_numpy()))
    (at_a, a), (at_b, b) = parts
    for j in range(batch.num_rows):
        yield a[at_a[j]:at_a[j + 1]], b[at_b[j]:at_b[j + 1]]


def _reaches(nx: int, ny: int, count: int, percent: int) -> bool:
    """Can the overlap still reach the bound, given how many indexed shingles are shared?"""
    if 100 * min(nx, ny) < percent * max(nx, ny):
        return False
    overlap = -(-percent * (nx + ny) // (100 + percent))
    return count + needed(max(nx, ny), percent) - 1 >= overlap


def _overlaps(percent: int):
    """Exact test: binary probes of the smaller set in the larger one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked, gray = np.zeros((2, batch.num_rows), bool)
            for j, (x, y) in enumerate(_paired(batch, 2)):
                few, many = (x, y) if len(x) <= len(y) else (y, x)
                if not len(few):
                    continue
                found = many[np.minimum(np.searchsorted(many, few), len(many) - 1)] == few
                both = int(found.sum())
                union = len(x) + len(y) - both
                linked[j] = 100 * both >= percent * union
                gray[j] = 100 * both >= (2 * percent - 100) * union
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked), pa.array(gray & ~linked)],
                                             names=["a", "b", "linked", "gray"])
    return run


def near_copies(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    Words are runs of bytes other than white space, A-Z lower-cased. Two documents link when
    100 * intersection >= percent * union of their shingle sets; component_id is the smallest
    doc_id reachable. A null or empty text has no shingles and links with nothing, its
    component is itself. Repeated rows and equal texts share a component; a row with a null
    doc_id gets the component of its copies, or null. Other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    # which lists are long, over all shingles of all documents
    words = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 6
    parts = int(min(1 << 16, max(16, words // 2_000_000)))
    long_rows = (rows.select("text").mapInArrow(_slot_counts(k, parts), "part int, planes binary")
                 .groupBy("part").applyInPandas(_long_slots, "slot long, c long")
                 .orderBy(F.desc("c"), "slot").limit(MAX_LONG).collect())
    named = sorted((r.slot, r.c) for r in long_rows)
    long_ones = spark.sparkContext.broadcast(np.array(named, np.int64).reshape(-1, 2).T.copy())

    index = written(rows.mapInArrow(_prefixes(k, percent, long_ones),
                                    "doc_id long, sig long, n long, prefix array<long>"), "shingle-prefixes")
    first = index.where("n > 0").groupBy("sig").agg(F.min("doc_id").alias("rep"))

    # inverted lists with at least two different sets
    entries = index.select("sig", "n", F.posexplode("prefix").alias("pos", "h"))
    shared = entries.groupBy("h").count().where("count > 1").select("h")
    live = (entries.join(shared, "h").groupBy("h", "sig").agg(F.min("n").alias("n"), F.min("pos").alias("pos"))
            .join(first, "sig").where("rep IS NOT NULL").select("h", "rep", "n", "pos"))
    live = written(live, "shingle-lists")
    members = live.groupBy("h").agg(F.count("*").alias("members"))
    long_keys = members.where(F.col("members") > SHORT).select("h")
    in_long = live.join(long_keys, "h").groupBy("rep").agg(F.count("*").alias("n_long"))
    merged = _merged(live.join(members.where(F.col("members") <= SHORT).select("h"), "h"), in_long, percent)

    # long lists, by size class; what has become short is merged too, whatever the long rest may share
    live = written(_refined(live.join(long_keys, "h"), percent), "refined-lists")
    sizes = live.groupBy("h").agg(F.count("*").alias("members"), F.min(F.struct("pos", "rep", "n")).alias("hub"))
    sizes = sizes.select("h", "members", F.col("hub.rep").alias("hub"), F.col("hub.n").alias("hub_n"))
    short = live.join(sizes.where(F.col("members").between(2, SHORT)).select("h"), "h")
    any_rest = short.select("rep").distinct().withColumn("n_long", F.lit(1 << 40))
    merged = merged.unionByName(_merged(short, any_rest, percent))
    hubs = sizes.where(F.col("members") > SHORT).select("h", "hub", "hub_n")
    fitting = 100 * F.least("n", "hub_n") >= percent * F.greatest("n", "hub_n")
    best_hub = (live.join(hubs, "h").where("rep <> hub").where(fitting).groupBy("rep", "hub").count()
                .groupBy("rep").agg(F.max_by("hub", F.struct("count", -F.col("hub"))).alias("hub")))

    near = _reachable(index, merged, percent).unionByName(
        best_hub.select(F.col("hub").alias("a"), F.col("rep").alias("b"))).distinct()
    tested = _tested(spark, rows, near, k, percent)
    found = components(tested.where("linked").select("a", "b"), "copy-components")

    # a pair that sizes alone keep from linking was not tested, and may still be gray
    may_be_gray = 100 * F.least("n", "hub_n") >= (2 * percent - 100) * F.greatest("n", "hub_n")

    # in long lists whose members are not all in one component, every member meets the hub
    in_long_lists = live.join(hubs, "h")
    opened = written(_opened(in_long_lists, found), "open-lists")
    if not opened.isEmpty():
        to_hub = (opened.where("rep <> hub").where(fitting).select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
                  .join(tested.select("a", "b"), ["a", "b"], "left_anti"))
        tested = written(tested.unionByName(_tested(spark, rows, to_hub, k, percent)), "copy-tests")
        found = components(tested.where("linked").select("a", "b"), "copy-components")
        to_own_hub = tested.select(F.col("a").alias("hub"), F.col("b").alias("rep"), "linked", "gray")
        opened = written(_opened(opened.drop("component"), found).join(to_own_hub, ["hub", "rep"], "left").select(
            "h", "rep", "n", "pos", "component", (F.coalesce("linked", F.lit(False)) | (F.col("rep") == F.col("hub"))).alias("linked"),
            F.coalesce("gray", may_be_gray).alias("gray")), "open-lists")
    if "linked" in opened.columns and not opened.where("NOT linked").isEmpty():
        left = opened.where("NOT linked").toDF("h", "x", "nx", "px", "cx", "lx", "gx")
        right = opened.toDF("h", "y", "ny", "py", "cy", "ly", "gy")
        overlap = _overlap("nx", "ny", percent)
        across = (left.join(right, "h").where("cx <> cy AND (gx OR NOT ly)")
                  .where(100 * F.least("nx", "ny") >= percent * F.greatest("nx", "ny"))
                  .where((F.col("px") <= F.col("nx") - overlap) & (F.col("py") <= F.col("ny") - overlap))
                  .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        more = _tested(spark, rows, _reachable(index, across, percent), k, percent)
        found = components(tested.unionByName(more).where("linked").select("a", "b"), "copy-components")

    return (index.select("doc_id", "sig", "n").join(first, "sig", "left")
            .join(found.withColumnRenamed("node", "rep"), "rep", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.coalesce("component", "rep")).otherwise(F.col("doc_id"))
                    .alias("component_id")))


def _merged(entries: DataFrame, in_long: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) from lists of at most SHORT documents: each one's lists are merged."""
    lists = (entries.groupBy("h").agg(F.array_sort(F.collect_list(F.struct("rep", "n"))).alias("m"))
             .select(F.col("m.rep").alias("reps"), F.col("m.n").alias("sizes")))
    return (lists.select(F.posexplode("reps").alias("at", "x"), "reps", "sizes").where("at > 0")
            .select("x", F.expr("sizes[at]").alias("nx"), F.expr("slice(reps, 1, at)").alias("reps"),
                    F.expr("slice(sizes, 1, at)").alias("sizes"))
            .groupBy("x").agg(F.min("nx").alias("nx"), F.collect_list(F.struct("reps", "sizes")).alias("l"))
            .join(in_long.withColumnRenamed("rep", "x"), "x", "left")
            .select("x", "nx", F.coalesce("n_long", F.lit(0)).alias("n_long"), "l.reps", "l.sizes")
            .mapInArrow(_merge(percent), "a long, b long"))


def _overlap(x: str, y: str, percent: int) -> Column:
    """Shingles that two sets of ``x`` and ``y`` shingles share at least if they link."""
    return F.expr(f"({percent} * ({x} + {y}) + {99 + percent}) div {100 + percent}")


def _refined(entries: DataFrame, percent: int) -> DataFrame:
    """Entries (h, rep, n, pos) of long lists, split by the size class of the smaller partner.

    The first shingle that two linking sets share stands in each at a place <= n - overlap. A class
    bounds the smaller partner's size from below, and with it the overlap; entries that come later in
    their set leave the class's list. Lists without a document of their own class hold no pair.
    """
    own = F.floor(F.log(F.col("n").cast("double")) / math.log(RATIO))
    least = F.floor(F.log(F.ceil(F.col("n") * percent / 100).cast("double")) / math.log(RATIO))
    fits = (f"c -> pos <= n - ({percent} * (n + bigint(ceil(pow({RATIO}D, c) * 0.999999999D))) + {99 + percent}) div {100 + percent}")
    split = (entries.withColumn("own", own).withColumn("c", F.sequence(least, own))
             .withColumn("c", F.explode(F.expr(f"filter(c, {fits})"))))
    used = split.where("c = own").select("h", "c").distinct()
    return split.join(used, ["h", "c"], "left_semi").select(F.xxhash64("h", "c").alias("h"), "rep", "n", "pos")


def _opened(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Entries, with their documents' components, of the lists that hold more than one component."""
    placed = (entries.select("h", "hub", "hub_n", "rep", "n", "pos").join(found.withColumnRenamed("node", "rep"), "rep", "left")
              .withColumn("component", F.coalesce("component", "rep")))
    opened = placed.groupBy("h").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return placed.join(opened.select("h"), "h").select("h", "hub", "hub_n", "rep", "n", "pos", "component")


def _reachable(index: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) that their indexed shingles do not exclude."""
    known = index.where("n > 0").select("doc_id", "n", "prefix").dropDuplicates(["doc_id"])
    return (pairs.join(known.toDF("a", "na", "pa"), "a").join(known.toDF("b", "nb", "pb"), "b")
            .select("a", "b", "na", "nb", "pa", "pb").mapInArrow(_prefix_test(percent), "a long, b long"))


def _tested(spark: SparkSession, rows: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs with the outcome of the exact comparison: linked, or gray (near enough to a hub to link
    with a document that the hub links with)."""
    pairs = written(pairs, "copy-candidates")
    sets = _shingle_sets(spark, rows, pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), k)
    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    return written(both.mapInArrow(_overlaps(percent), "a long, b long, linked boolean, gray boolean"), "copy-tests")


def _shingle_sets(spark: SparkSession, rows: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """(rep, shingles) of the named documents. Texts are picked by a bit filter of bounded size, so
    the text column is not shuffled; false hits drop out in the join."""
    reps = written(reps, "copy-members")
    size = min(MAX_BITS, max(MIN_BITS, 1 << (8 * reps.count()).bit_length()))
    slot = F.pmod(F.xxhash64("rep"), F.lit(size))
    words = (reps.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(slot & 63))")).alias("b")).collect())
    filled = np.zeros(size >> 6, np.uint64)
    for r in words:
        filled[r.w] = np.uint64(r.b % (1 << 64))
    bits = spark.sparkContext.broadcast(filled)
    picked = (rows.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "rep").withColumn("slot", slot)
              .mapInArrow(_sets(k, bits), "rep long, shingles array<long>"))
    return written(picked.join(reps, "rep").dropDuplicates(["rep"]), "shingle-sets")


def one_per_component(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Rows of ``docs`` that stand for their component: one per component, the smallest doc_id.
    Rows without a doc_id stay, as nothing can name them."""
    keep = found.where("doc_id = component_id").select(F.col("doc_id").alias("keep_id")).distinct()
    kept = docs.join(keep, docs["doc_id"] == keep["keep_id"], "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id IS NULL"))
