"""Token ids in binary files: an adaptive context-mixing range coder.

Every document's text is encoded with a public tokenizer, an end id follows, and the ids of all
documents in ascending doc_id order are cut into segments of whole documents. A segment holds
blocks of a fixed number of ids; each block starts from the same fixed model, adapts on its own
ids and has its own checksum, so any block can be decoded alone.

Model of one id: order 2 and order 1 each predict the id that came last after the same two ids
or one id. Order 0 has the ids in 16 groups of about equal mass, of which it learns how
often each is used in the block; shares within a group are the segment's and stand in its
directory. The mixture ``w2 [id is order 2's] + w1 [id is order 1's] + w0 p0(id)`` has weights
that follow how often each order has been right in the block, where it was right the time before
and where it was not. A carryless range coder with a 64-bit
interval turns the mixture into 16-bit words. Blocks of a segment are coded side by side, one id
of every block a step, so that coder and decoder share one vectorised model.

Segment: ``HEADER``, then per document its id (int64), a null mark (uint8) and its number of ids
(int64); per block its number of words (uint32) and the crc32 of its ids as little-endian uint32
(uint32); the different ids (uint16) and their counts (uint64); crc32 of all that; the words. All
integers are little-endian. Segments are rows of Parquet files, one file a task, so that Spark's
commit protocol covers lost executors and any store that Spark can write to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.bytepieces import checked, encoder
from tallyroom.llm.tables import scratch_dir, text_views

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
BLOCK_IDS = 1024  # ids of a block; half as many make twice as many blocks, and a step's calls serve them all
SEGMENT_IDS = 1 << 23  # a segment is closed when it holds so many; the last document is kept whole
LANES = 8192  # blocks that are coded side by side; bounds memory

MAGIC = b"TRCM"
HEADER = struct.Struct("<4sHHIIQQI")  # magic, version, reserved, ids a block, blocks, documents, ids, different ids
SEGMENTS = "part long, before long, n_ids long, segment binary"
DECODED = "doc_id long, start long, n_tokens long, ids_crc32 long"

ONE, FINE = 15, 17  # frequencies add up to 2 to these: of a mixture or a group choice, of the ids of a group
GROUPS = 16  # groups of ids of about equal mass
SLOTS = 10  # bits: contexts that order 1 and order 2 remember in a block
RIGHT = 1 << 17  # mark of a remembered id that was predicted right when it last came
FLOOR = 4  # least frequency of a choice
RATE = 5  # adaptation shift of order 0
ALL = ONE + ONE + FINE  # bits that one id may take
U1, U16, U32, UONE, UFINE, UALL = (np.uint64(x) for x in (1, 16, 32, ONE, FINE, ALL))
SMALL = np.uint64(1 << ALL)  # intervals below this are too small for the next id
WORD = np.uint64(1 << 48)  # intervals below this lie within one upper word


def _targets() -> np.ndarray:
    out = np.zeros((16, 16), np.int16)
    for s in range(16):
        for k in range(15):
            out[s, k] = (k + 1) * FLOOR if k < s else (1 << ONE) - (15 - k) * FLOOR
    return out


TARGETS = _targets()


class _Order0:
    """Where every block's order 0 starts: ids in groups of about equal mass, with fixed shares in a group.
    Groups are chosen adaptively in each block."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray):
        total = int(counts.sum())
        before = np.cumsum(counts, dtype=np.int64) - counts
        group = before * GROUPS // total
        mass, n = np.bincount(group, counts, GROUPS)[group], np.bincount(group, minlength=GROUPS)[group]
        size = 1 + np.floor(counts / mass * ((1 << FINE) - n)).astype(np.int64)
        start = np.cumsum(size) - size
        first = np.flatnonzero(np.diff(group, prepend=-1))
        start -= np.repeat(start[first], np.diff(first, append=len(group)))
        self.ids = ids.astype(np.uint32)
        self.start, self.size = start.astype(np.uint64), size.astype(np.uint64)
        self.group = group
        self.at = np.zeros(GROUPS << FINE, np.uint16)  # position of the id whose share holds a place of its group
        self.at[(group << FINE) + start] = np.arange(len(ids))
        np.maximum.accumulate(self.at, out=self.at)
        self.place = np.zeros(1 << 16, np.int64)
        self.place[ids] = np.arange(len(ids))  # a guess may be another id: any place will do
        self.group_by_id = group.take(self.place)


class _Model:
    """State of blocks that are coded side by side. Arrays of both orders have order 1 first."""

    def __init__(self, lanes: int):
        self.base = np.arange(lanes) << SLOTS
        self.memory = np.zeros(2 * lanes << SLOTS, np.uint32)  # id after a context, plus 1; 0 where none is known
        self.hit = np.full((2, 2, lanes), 1 << (ONE - 2), np.int32)  # how often each order is right, by its last time there
        self.one = self.two = np.zeros(lanes, np.uint32)
        self.ends = np.tile(np.append(np.arange(1, 16) << (ONE - 4), 0).astype(np.int16), (lanes, 1))  # of groups 0 to 14
        self.row_at = np.arange(0, 16 * lanes, 16)

    def mix(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Weights of order 2's and order 1's ids for the next id of the first ``n`` blocks; 0 where an order
        knows none, or order 1 names the same."""
        one, two = self.one[:n], self.two[:n]
        low = np.uint32(32 - SLOTS)
        self.at = np.empty((2, n), np.int64)
        np.add(self.base[:n], (one * np.uint32(0x9E3779B1)) >> low, out=self.at[0])
        np.add(self.base[:n], ((one * np.uint32(40503) + two) * np.uint32(0x85EBCA6B)) >> low, out=self.at[1])
        self.at[1] += len(self.memory) // 2
        held = self.memory.take(self.at)
        self.known, self.sure = held != 0, held > np.uint32(RIGHT)
        self.guess = (held & np.uint32(RIGHT - 1)) - np.uint32(1)
        self.p = np.where(self.sure, self.hit[1, :, :n], self.hit[0, :, :n])
        f2 = self.p[1] * self.known[1]
        f1 = ((((1 << ONE) - f2) * self.p[0]) >> ONE) * (self.known[0] & (self.guess[0] != self.guess[1]))
        return f2.astype(np.uint64), f1.astype(np.uint64)

    def learn(self, n: int, ids: np.ndarray) -> None:
        right = self.guess == ids
        step = np.where(right, np.int32((1 << ONE) - 512), np.int32(64))
        step -= self.p
        step >>= 5
        step *= self.known
        sure = step * self.sure
        step -= sure
        self.hit[1, :, :n] += sure
        self.hit[0, :, :n] += step
        held = np.where(right, np.uint32(RIGHT + 1), np.uint32(1))
        held += ids
        self.memory.put(self.at, held)
        self.two, self.one = self.one, ids

    def group_of(self, v: np.ndarray) -> np.ndarray:
        """The group whose share holds ``v``, block by block."""
        flat, at = self.ends.ravel(), self.row_at[:len(v)]
        found = np.zeros(len(v), np.int64)
        for step in (8, 4, 2, 1):
            found += (flat.take(at + (found + (step - 1))) <= v) * step
        return found

    def choose(self, n: int, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and size of each block's ``group``, which the block then learns."""
        rows = self.ends[:n]
        flat, at = rows.ravel(), self.row_at[:n] + group
        start = flat.take(at - 1, mode="wrap") * (group > 0)
        size = np.where(group < 15, flat.take(at), 1 << ONE) - start
        step = TARGETS.take(group, 0)
        step -= rows
        step >>= RATE
        rows += step
        return start.astype(np.uint64), size.astype(np.uint64)


class _Interval:
    """Range coder state of every block: an id narrows it, full words leave or enter."""

    def __init__(self, lanes: int):
        self.low = np.zeros(lanes, np.uint64)
        self.range = np.full(lanes, (1 << 64) - 1, np.uint64)

    def narrow(self, n: int, start: np.ndarray, size: np.ndarray) -> None:
        """Code one id of each of the first ``n`` blocks; of an interval too small for the next id that
        crosses a border between words, the larger side stays."""
        r = self.range[:n] >> UALL
        np.multiply(r, size, out=self.range[:n])
        r *= start
        self.low[:n] += r
        lanes = np.flatnonzero(self._full(self.low[:n], self.range[:n]))
        while len(lanes):
            low, size = self.low.take(lanes), self.range.take(lanes)
            crossing = (low ^ (low + size - U1)) >= WORD
            if crossing.any():
                below = (~low + U1) & (WORD - U1)
                above = size - below
                up = crossing & (above > below)
                low = np.where(up, low + below, low)
                size = np.where(crossing, np.where(up, above, below), size)
            self.move(lanes, low)
            low, size = low << U16, np.minimum(size, WORD - U1) << U16  # a whole word's interval would overflow
            self.low[lanes], self.range[lanes] = low, size
            lanes = lanes[self._full(low, size)]

    @staticmethod
    def _full(low: np.ndarray, size: np.ndarray) -> np.ndarray:
        last = low + size
        last -= U1
        last ^= low
        full = last < WORD
        full |= size < SMALL
        return full


class _Writer(_Interval):
    def __init__(self, lanes: int, size: int):
        super().__init__(lanes)
        self.words = np.zeros((lanes, size), np.uint16)
        self.used = np.zeros(lanes, np.int64)

    def move(self, lanes: np.ndarray, low: np.ndarray) -> None:
        used = self.used.take(lanes)
        if int(used.max()) >= self.words.shape[1]:
            self.words = np.concatenate([self.words, np.zeros_like(self.words)], axis=1)
        self.words[lanes, used] = low >> np.uint64(48)
        self.used[lanes] = used + 1

    def close(self) -> list[np.ndarray]:
        lanes = np.arange(len(self.low))
        for _ in range(4):
            self.move(lanes, self.low)
            self.low <<= U16
        return [self.words[i, :self.used[i]] for i in lanes]


class _Reader(_Interval):
    def __init__(self, words: np.ndarray, sizes: np.ndarray):
        super().__init__(len(sizes))
        self.words = np.concatenate([words, np.zeros(1, np.uint16)]).astype(np.uint64)
        self.next = np.cumsum(sizes) - sizes
        self.code = np.zeros(len(sizes), np.uint64)
        for _ in range(4):
            self.move(np.arange(len(sizes)), None)

    def move(self, lanes: np.ndarray, low) -> None:
        at = self.next.take(lanes)
        word = self.words.take(at, mode="clip")  # a damaged block may ask for more
        self.code[lanes] = (self.code.take(lanes) << U16) | word
        self.next[lanes] = at + 1

    def value(self, n: int) -> np.ndarray:
        v = (self.code[:n] - self.low[:n]) // np.maximum(self.range[:n] >> UALL, U1)
        return np.minimum(v, np.uint64((1 << ALL) - 1))


def _steps(ids: int, block_ids: int) -> Iterator[int]:
    """Number of blocks that still have an id, step by step; only the last block may be shorter."""
    lanes = -(-ids // block_ids)
    last = ids - (lanes - 1) * block_ids
    for t in range(block_ids if lanes > 1 else last):
        yield lanes if t < last else lanes - 1


def encode_blocks(ids: np.ndarray, order0: _Order0, block_ids: int = BLOCK_IDS) -> list[np.ndarray]:
    """Words of each block of uint16 ids."""
    if not len(ids):
        return []
    lanes = -(-len(ids) // block_ids)
    grid = np.zeros(lanes * block_ids, np.uint16)
    grid[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, block_ids).T)
    model, out = _Model(lanes), _Writer(lanes, block_ids + 8)
    for t, n in enumerate(_steps(len(ids), block_ids)):
        now = grid[t, :n].astype(np.uint32)
        f2, f1 = model.mix(n)
        two, one = model.guess[1] == now, model.guess[0] == now
        both = f2 + f1
        rest = (U1 << UONE) - both
        place = order0.place.take(now)
        start, size = model.choose(n, order0.group.take(place))
        start = (both << U32) + rest * ((start << UFINE) + size * order0.start.take(place))
        size *= rest * order0.size.take(place)
        out.narrow(n, np.where(two, 0, np.where(one, f2 << U32, start)), np.where(two, f2 << U32, np.where(one, f1 << U32, size)))
        model.learn(n, now)
    return out.close()


def decode_blocks(words: np.ndarray, sizes: np.ndarray, order0: _Order0, ids: int, block_ids: int = BLOCK_IDS) -> np.ndarray:
    """uint16 ids from the words of blocks that lie one after the other; ``sizes`` are their numbers of words."""
    if not ids:
        return np.zeros(0, np.uint16)
    lanes = len(sizes)
    grid = np.zeros((block_ids, lanes), np.uint16)
    model, source = _Model(lanes), _Reader(words, sizes)
    for t, n in enumerate(_steps(ids, block_ids)):
        f2, f1 = model.mix(n)
        both = f2 + f1
        rest = (U1 << UONE) - both
        v = source.value(n)
        none = v >= both << U32
        two = v < f2 << U32
        x = np.where(none, v - (both << U32), np.uint64(0)) // rest
        group = model.group_of((x >> UFINE).astype(np.int64))
        now = np.where(two, model.guess[1], model.guess[0])
        group = np.where(none, group, order0.group_by_id.take(now, mode="clip"))
        start, size = model.choose(n, group)
        fine = np.minimum((np.maximum(x, start << UFINE) - (start << UFINE)) // size, np.uint64((1 << FINE) - 1))
        place = order0.at.take((group << FINE) + fine.astype(np.int64))
        now = np.where(none, order0.ids.take(place), now)
        start = (both << U32) + rest * ((start << UFINE) + size * order0.start.take(place))
        size *= rest * order0.size.take(place)
        source.narrow(n, np.where(two, 0, np.where(none, start, f2 << U32)), np.where(two, f2 << U32, np.where(none, size, f1 << U32)))
        model.learn(n, now)
        grid[t, :n] = now
    return np.ascontiguousarray(grid.T).ravel()[:ids]


def _crcs(ids: np.ndarray, ends: list[int]) -> list[int]:
    """crc32 of each run of ids, as little-endian uint32; ``ends`` are the runs' ends."""
    wide = ids.astype("<u4")
    return [zlib.crc32(wide[i:j]) for i, j in zip([0, *ends[:-1]], ends, strict=True)]


def _block_ends(total: int, block_ids: int) -> list[int]:
    return [*range(block_ids, total, block_ids), total] if total else []


def encode_segment(doc_ids: list, sizes: list[int], ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """One segment from whole documents: their ids (None allowed), numbers of token ids, all token ids."""
    counts = np.bincount(ids, minlength=1)
    different = np.flatnonzero(counts)
    order0 = _Order0(different, counts[different])
    words, step = [], LANES * block_ids
    for at in range(0, len(ids), step):
        words += encode_blocks(ids[at:at + step], order0, block_ids)
    head = HEADER.pack(MAGIC, 1, 0, block_ids, len(words), len(doc_ids), len(ids), len(different)) + b"".join([
        np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
        np.array([d is None for d in doc_ids], np.uint8).tobytes(), np.array(sizes, "<i8").tobytes(),
        np.array([len(w) for w in words], "<u4").tobytes(),
        np.array(_crcs(ids, _block_ends(len(ids), block_ids)), "<u4").tobytes(),
        different.astype("<u2").tobytes(), counts[different].astype("<u8").tobytes()])
    return head + struct.pack("<I", zlib.crc32(head)) + b"".join(w.astype("<u2").tobytes() for w in words)


def decode_segment(data: bytes) -> tuple[list, np.ndarray, np.ndarray]:
    """Documents' ids, numbers of token ids and all token ids; ValueError if a checksum is wrong."""
    magic, version, _, block_ids, blocks, docs, total, n_ids = HEADER.unpack_from(data)
    if magic != MAGIC or version != 1:
        raise ValueError("not a segment of token ids")
    size = HEADER.size + 17 * docs + 8 * blocks + 10 * n_ids
    if len(data) < size + 4 or zlib.crc32(data[:size]) != struct.unpack_from("<I", data, size)[0]:
        raise ValueError("checksum of the segment's directory is wrong")
    at, columns = HEADER.size, []
    for kind, n in (("<i8", docs), (np.uint8, docs), ("<i8", docs), ("<u4", blocks), ("<u4", blocks),
                    ("<u2", n_ids), ("<u8", n_ids)):
        columns.append(np.frombuffer(data, kind, n, at))
        at += columns[-1].nbytes
    doc_ids, nulls, sizes, used, sums, different, counts = columns
    order0 = _Order0(different, counts.astype(np.int64))
    words = np.frombuffer(data, "<u2", (len(data) - size - 4) // 2, size + 4)
    ends = np.concatenate([[0], np.cumsum(used, dtype=np.int64)])
    parts = []
    for i in range(0, blocks, LANES):
        j = min(i + LANES, blocks)
        n = min(total, j * block_ids) - i * block_ids
        parts.append(decode_blocks(words[ends[i]:ends[j]], used[i:j].astype(np.int64), order0, n, block_ids))
    ids = np.concatenate(parts)
    wrong = [k for k, (a, b) in enumerate(zip(_crcs(ids, _block_ends(total, block_ids)), sums.tolist(), strict=True)) if a != b]
    if wrong:
        raise ValueError(f"checksum of blocks {wrong} is wrong")
    return [None if x else int(d) for d, x in zip(doc_ids, nulls, strict=True)], sizes, ids


def tokenizer_spec(path: str | None = None) -> str:
    """A tokenizer file's content; without a path the public byte-level BPE with 50k ids."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def _encode(spec, end_id: int, block_ids: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(spec.value), checked([end_id])
        part, before = TaskContext.get().partitionId(), 0
        docs, sizes, held, total = [], [], [], 0

        def segment():
            ids = np.concatenate(held)
            data = encode_segment(docs, sizes, ids, block_ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                 pa.array([data], pa.binary())], names=["part", "before", "n_ids", "segment"])

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                rows = batch.slice(at, 2000)
                for doc_id, ids in zip(rows.column(0).to_pylist(), coder.encode(list(text_views(rows.column(1)))), strict=True):
                    held += [ids, end]
                    docs.append(doc_id)
                    sizes.append(len(ids) + 1)
                    total += sizes[-1]
                    if total >= segment_ids:
                        yield segment()
                        before += total
                        docs, sizes, held, total = [], [], [], 0
        if docs:
            yield segment()
    return run


def write(docs: DataFrame, path: str, spec: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS,
          segment_ids: int = SEGMENT_IDS) -> None:
    """Write the ids of every row of ``docs`` (doc_id, text) to ``path`` in ascending doc_id order.

    Null and empty texts are the end id alone. Rows with one doc_id are ordered by a hash of their
    text; null doc_ids come last. Other columns are ignored. An empty table writes files without
    segments. ``spec`` is the content of a tokenizer file with ids below 65536.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(spec or tokenizer_spec())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    ordered = rows.orderBy(F.asc_nulls_last("doc_id"), F.xxhash64("text"), "row").select("doc_id", "text")
    (ordered.mapInArrow(_encode(held, end_id, block_ids, segment_ids), SEGMENTS)
     .write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(path))


def _decode(offsets):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                part, before = batch.column(0)[row].as_py(), batch.column(1)[row].as_py()
                doc_ids, sizes, ids = decode_segment(batch.column(2)[row].as_buffer().to_pybytes())
                ends = np.cumsum(sizes)
                crc = _crcs(ids, ends.tolist())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(offsets.value[part] + before + ends - sizes, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(crc, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])
    return run


def _part_starts(files: DataFrame) -> dict[int, int]:
    """Ids before each task's file: one number a file reaches the driver."""
    out, total = {}, 0
    for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect():
        out[r.part] = total
        total += r.n
    return out


def read(spark, path: str) -> DataFrame:
    """Per document of files that :func:`write` wrote: doc_id, start (ids before it), n_tokens (with the end
    id), ids_crc32 (of its ids as little-endian uint32). A wrong checksum raises."""
    files = spark.read.schema(SEGMENTS).parquet(path)
    offsets = spark.sparkContext.broadcast(_part_starts(files.select("part", "n_ids")))
    return files.select("part", "before", "segment").mapInArrow(_decode(offsets), DECODED)


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data in batch.column(0):
            doc_ids, sizes, ids = decode_segment(data.as_buffer().to_pybytes())
            ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
            for at in range(0, len(doc_ids), 2000):
                to = min(at + 2000, len(doc_ids))
                lists = pa.LargeListArray.from_arrays(pa.array(ends[at:to + 1] - ends[at], pa.int64()),
                                                      pa.array(ids[ends[at]:ends[to]].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids[at:to], pa.int64()), lists.cast(pa.list_(pa.int32()))],
                                                 names=["doc_id", "ids"])


def tokens(spark, path: str) -> DataFrame:
    """(doc_id, ids) of files that :func:`write` wrote."""
    return spark.read.schema(SEGMENTS).parquet(path).select("segment").mapInArrow(_token_rows, "doc_id long, ids array<int>")


def round_trip(docs: DataFrame) -> DataFrame:
    """Write the ids of ``docs`` to a fresh shared folder and read them back as :func:`read` does."""
    path = scratch_dir(docs.sparkSession, "token-ids")
    write(docs, path)
    return read(docs.sparkSession, path)
