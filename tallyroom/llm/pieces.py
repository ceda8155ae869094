"""SentencePiece encoding and decoding with a max-plus parallel scan over giant documents.

A document becomes a row of symbols: a leading space mark, then its characters with spaces as
marks. A segmentation into pieces is a path; its weight is a sum. In a unigram model each piece
adds its score. In a BPE model a row of pieces is the model's own result exactly when every two
neighbours are what the model makes of their joined text, so a pair adds 0 or minus infinity.

A text is cut into chunks of equal length at any place. A boundary state is where the piece that
crosses the cut ends, and in a BPE model which piece it is. Every chunk yields its transfer
matrix between entry and exit states by dynamic programming; matrices are multiplied in the
max-plus algebra, blocks of chunks first and then the blocks, which gives each chunk's entry and
exit state, and each chunk is traced back on its own. Between two places that no piece can cross
(a space after another character) the path does not depend on the states, and that part is
encoded by the model's library. A text shorter than one chunk has no cut and is encoded by the
model's library as a whole; the results are the same.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyroom.llm.bytepieces import PieceTable
from tallyroom.llm.tables import small_batches, text_views
from tallyroom.llm.wordhash import run_hashes

MARK = "▁"
GUARD = "\ue000"  # a private-use character
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 32_768  # characters of a chunk
BLOCK = 256  # chunks that are multiplied in one task
CACHE = 80_000  # pairs of pieces that a task remembers
WORDS = 1 << 18  # words whose pieces a worker remembers; others are encoded each time they are met
SPLIT = 1 << 17  # bytes of text that are split at once, few enough for a cache; one text is never divided
MARK_BYTES = MARK.encode()
BLANK = np.array([32], np.uint8)


class Pieces:
    """A SentencePiece model: pieces, scores, and the two path weights."""

    def __init__(self, proto: bytes):
        self.proto = proto

    def __reduce__(self):
        return Pieces, (self.proto,)

    @cached_property
    def library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.proto)

    @cached_property
    def table(self) -> dict[str, int]:
        lib = self.library
        return {lib.id_to_piece(i): i for i in range(lib.get_piece_size())
                if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i))}

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.table))

    @cached_property
    def joined(self) -> set[str]:
        """Character pairs that occur inside a piece: no piece crosses any other pair."""
        if any(GUARD in p for p in self.table):
            raise ValueError("the guard character is in a piece")
        return {p[i:i + 2] for p in self.table for i in range(len(p) - 1)}

    @cached_property
    def spaces_split(self) -> bool:
        return not any(x[0] != MARK and x[1] == MARK for x in self.joined)

    @cached_property
    def is_bpe(self) -> bool:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(self.proto)
        norm = model.normalizer_spec
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
            raise ValueError("only models with the identity normaliser and a leading space are read")
        return model.trainer_spec.model_type == 2

    # --- whole symbols -------------------------------------------------------------------

    @cached_property
    def _met(self) -> PieceTable:
        return PieceTable(WORDS, np.uint32)

    def encode_texts(self, texts: list[str | None]) -> pa.Array:
        """Arrow list column with the pieces of whole texts; null stays null, empty text has none."""
        return self.encode_column(pa.array(texts, pa.large_string()))

    def encode_column(self, texts: pa.Array) -> pa.Array:
        """The same for an Arrow string column.

        Where no piece crosses the front of a space, a text is its words: stretches that start with a
        space. Words are found and hashed with array operations, and a worker remembers the pieces of
        words that it has met, so each call encodes only others. Two different words share a hash with a
        chance near 2^-64."""
        if not self.spaces_split:
            return pa.array([None if t is None else self.library.encode(t) for t in texts.to_pylist()], pa.list_(pa.int32()))
        views = [v if v.size < 3 or MARK_BYTES not in v.tobytes() else
                 np.frombuffer(v.tobytes().replace(MARK_BYTES, b" "), np.uint8) for v in text_views(texts)]
        ids, sizes, at = [], np.zeros(len(views), np.int64), 0
        while at < len(views):
            to, size = at, 0
            while to < len(views) and (to == at or size + len(views[to]) < SPLIT):
                size += len(views[to]) + 1
                to += 1
            got, sizes[at:to] = self._spelled(views[at:to])
            ids.append(got)
            at = to
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()),
                                        pa.array(flat.view(np.int32), pa.int32()), mask=texts.is_null())

    def _spelled(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces of texts one after the other, and how many each text has."""
        full = [t for t in texts if len(t)]
        if not full:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        b = np.concatenate(list(chain.from_iterable((BLANK, t) for t in full)))
        sizes = np.fromiter((len(t) + 1 if len(t) else 0 for t in texts), np.int64, len(texts))
        firsts = np.cumsum(sizes) - sizes
        blank = b == 32
        start = blank.copy()
        start[1:] &= ~blank[:-1]
        start[firsts[sizes > 0]] = True
        starts = np.flatnonzero(start)
        stops = np.append(starts[1:], len(b))
        ids, counts = self._met.ids(run_hashes(b, starts, stops), lambda new: self._fresh(b, starts[new], stops[new]))
        before = np.concatenate(([0], np.cumsum(counts)))
        ends = before[np.searchsorted(starts, firsts + sizes)]
        return ids, np.diff(ends, prepend=0)

    def _fresh(self, b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[list[int]]:
        """Pieces of words, whose first space the model puts in front by itself."""
        data = b.tobytes()
        words = [data[j + 1:k].decode() for j, k in zip(starts.tolist(), stops.tolist(), strict=True)]
        coded = self.library.encode(words, num_threads=1)
        if "" in words:  # a bare mark, which the library does not see
            bare = self.ids_of(MARK)
            coded = [c if w else bare for w, c in zip(words, coded, strict=True)]
        return coded

    def between(self, stretch: str) -> list[int]:
        """Pieces of symbols that no piece enters or leaves: encoded behind a character that is
        in no piece, whose own pieces are taken off."""
        if not stretch:
            return []
        got = self.library.encode(GUARD + stretch.replace(MARK, " "))
        return got[len(self.library.encode(GUARD)):]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)

    def decode_column(self, rows: pa.ListArray) -> list[str | None]:
        """Text of each list of pieces, null for null."""
        ends, flat = rows.offsets.to_numpy().tolist(), rows.values.to_numpy()
        there = rows.is_valid().to_numpy(zero_copy_only=False).tolist()
        return [self.library.decode(flat[i:j].tolist()) if x else None
                for i, j, x in zip(ends[:-1], ends[1:], there, strict=True)]

    # --- lattice -------------------------------------------------------------------------

    @cached_property
    def _pairs(self) -> dict[tuple[str, str], bool]:
        return {}

    def _whole(self, symbols: str) -> list[str]:
        """BPE pieces of symbols without the leading mark that the library adds."""
        return self._merge(list(symbols))

    def _merge(self, parts: list[str]) -> list[str]:
        lib, table = self.library, self.table
        while True:
            best, at = -math.inf, -1
            for i in range(len(parts) - 1):
                both = parts[i] + parts[i + 1]
                if both in table:
                    score = lib.get_score(table[both])
                    if score > best:
                        best, at = score, i
            if at < 0:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def follows(self, left: str, right: str) -> bool:
        """BPE: do two neighbouring pieces stay as they are?"""
        key = (left, right)
        got = self._pairs.get(key)
        if got is None:
            if len(self._pairs) > CACHE:
                self._pairs.clear()
            got = self._pairs[key] = self._whole(left + right) == [left, right]
        return got

    @cached_property
    def _own(self) -> dict[str, bool]:
        return {}

    def usable(self, piece: str) -> bool:
        """A single character, or a piece that the model can make of its own text."""
        if len(piece) == 1:
            return True
        if piece not in self.table:
            return False
        if not self.is_bpe:
            return True
        got = self._own.get(piece)
        if got is None:
            got = self._own[piece] = self._whole(piece) == [piece]
        return got

    def weight(self, left: str, piece: str) -> float:
        if self.is_bpe:
            return 0.0 if not left or left[-1] + piece[0] not in self.joined or self.follows(left, piece) else -math.inf
        if piece in self.table:
            return self.library.get_score(self.table[piece])
        return self.unknown

    @cached_property
    def unknown(self) -> float:
        """Unigram: score of a character outside the model, ten below the lowest piece."""
        return min(self.library.get_score(i) for i in self.table.values()) - 10.0

    def ids_of(self, piece: str) -> list[int]:
        if piece in self.table:
            return [self.table[piece]]
        lib = self.library
        first = lib.piece_to_id("<0x00>")
        if lib.is_byte(first):
            return [lib.piece_to_id(f"<0x{b:02X}>") for b in piece.encode()]
        return [lib.unk_id()]

    def state(self, over: int, piece: str) -> tuple[int, str]:
        return (over, piece if self.is_bpe else "")


class Chunk:
    """Symbols of a chunk with what a piece can reach on either side."""

    def __init__(self, model: Pieces, left: str, body: str, right: str):
        self.model, self.left, self.body, self.right = model, left, body, right
        self.text = body + right
        joined, n = model.joined, len(body)
        # the outermost places that no piece can cross: the path between them is the same for all states
        self.first = next((i for i in range(1, n) if body[i - 1:i + 1] not in joined), None)
        self.last = next((i for i in range(n - 1, 0, -1) if body[i - 1:i + 1] not in joined), None)
        self.open_left = bool(left) and left[-1] + body[:1] in joined
        self.open_right = bool(right) and body[-1:] + right[0] in joined

    def entries(self) -> list[tuple[int, str]]:
        """States in which the piece over the left cut can end: characters over the cut, piece."""
        m = self.model
        if not self.open_left:
            return [(0, "")]
        out = set()
        for back in range(1, min(m.longest, len(self.left)) + 1):
            for over in range(min(m.longest - back, len(self.text)) + 1):
                piece = self.left[len(self.left) - back:] + self.text[:over]
                if m.usable(piece):
                    out.add(m.state(over, piece))
        return sorted(out)

    def _steps(self, start: int, stop: int, leave: bool, paths: dict):
        """Visit (place, old piece, new piece, weight) in text order from the places in ``paths``."""
        m, text = self.model, self.text
        for at in range(start, stop):
            here = paths.get(at)
            if not here:
                continue
            for size in range(1, min(m.longest, len(text) - at) + 1):
                if at + size > stop and not leave:
                    break
                new = text[at:at + size]
                if m.usable(new):
                    for old in here:
                        gain = m.weight(old, new)
                        if gain > -math.inf:
                            yield at, old, new, gain

    def _weights(self, start: int, stop: int, leave: bool, entries: list[tuple[int, str]]) -> dict:
        """{exit state: best weight from each entry}; one pass serves all entries."""
        paths: dict = {}
        ends: dict = {}
        for i, (over, piece) in enumerate(entries):
            one = np.full(len(entries), -np.inf)
            one[i] = 0.0
            if start + over >= stop:  # the entering piece covers the whole stretch
                key = self.model.state(start + over - stop, piece) if leave else (0, "")
                ends[key] = np.maximum(ends[key], one) if key in ends else one
            else:
                spot = paths.setdefault(start + over, {})
                spot[piece] = np.maximum(spot[piece], one) if piece in spot else one
        for at, old, new, gain in self._steps(start, stop, leave, paths):
            got = paths[at][old] + gain
            if at + len(new) >= stop:
                key = self.model.state(at + len(new) - stop, new) if leave else (0, "")
                ends[key] = np.maximum(ends[key], got) if key in ends else got
            else:
                key = new if self.model.is_bpe else ""
                spot = paths.setdefault(at + len(new), {})
                spot[key] = np.maximum(spot[key], got) if key in spot else got
        return ends

    def transfer(self) -> list[tuple[tuple[int, str], tuple[int, str], float]]:
        """Max-plus matrix as (entry, exit, weight) triples."""
        entries, n = self.entries(), len(self.body)
        if self.first is None:
            out = self._weights(0, n, self.open_right, entries)
        else:
            head = self._weights(0, self.first, False, entries).get((0, ""), np.full(len(entries), -np.inf))
            tail = self._weights(self.last, n, self.open_right, [(0, "")])
            out = {x: head + w[0] for x, w in tail.items()}
        return [(e, x, float(v)) for x, w in out.items() for e, v in zip(entries, w, strict=True) if v > -math.inf]

    def _trace(self, start: int, entry: tuple[int, str], stop: int, leave: bool, goal: tuple[int, str]) -> list[int]:
        over, piece = entry
        if start + over >= stop:
            return []
        paths: dict = {start + over: {piece: (0.0, None)}}
        best = None
        for at, old, new, gain in self._steps(start, stop, leave, paths):
            got = paths[at][old][0] + gain
            if at + len(new) >= stop:
                key = self.model.state(at + len(new) - stop, new) if leave else (0, "")
                if key == goal and (best is None or got > best[0]):
                    best = (got, (at, old, new))
            else:
                key = new if self.model.is_bpe else ""
                spot = paths.setdefault(at + len(new), {})
                if key not in spot or got > spot[key][0]:
                    spot[key] = (got, (at, old, new))
        pieces, step = [], best[1]
        while step is not None:
            at, old, new = step
            pieces.append(new)
            step = paths[at][old][1]
        return [i for p in reversed(pieces) for i in self.model.ids_of(p)]

    def encode(self, entry: tuple[int, str], leave: tuple[int, str]) -> list[int]:
        """Pieces that start in this chunk, given its two boundary states."""
        n = len(self.body)
        if self.first is None:
            return self._trace(0, entry, n, self.open_right, leave)
        return [*self._trace(0, entry, self.first, False, (0, "")),
                *self.model.between(self.body[self.first:self.last]),
                *self._trace(self.last, (0, ""), n, self.open_right, leave)]


def symbols(text: str) -> str:
    return MARK + text.replace(" ", MARK)


def chunks_of(text: str, size: int, reach: int) -> Iterator[tuple[int, str, str, str]]:
    """(number, left context, body, right context) of a text's symbols."""
    s = symbols(text)
    for number, at in enumerate(range(0, len(s), size)):
        yield number, s[max(0, at - reach):at], s[at:at + size], s[at + size:at + size + reach]


Matrix = list[tuple[tuple[int, str], tuple[int, str], float]]


def product(a: Matrix, b: Matrix) -> Matrix:
    """Max-plus product of two sparse matrices."""
    rows: dict = {}
    for x, y, w in b:
        rows.setdefault(x, []).append((y, w))
    best: dict = {}
    for x, y, w in a:
        for z, v in rows.get(y, ()):
            if w + v > best.get((x, z), -math.inf):
                best[x, z] = w + v
    return [(x, z, w) for (x, z), w in best.items()]


def route(matrices: list[Matrix], entry=None, leave=None) -> list[tuple[int, str]]:
    """States at all cuts of a row of matrices on the best path between two states."""
    scores = [{(0, ""): 0.0} if entry is None else {entry: 0.0}]
    backs = []
    for m in matrices:
        new: dict = {}
        back: dict = {}
        for x, y, w in m:
            if x in scores[-1]:
                total = scores[-1][x] + w
                if total > new.get(y, -math.inf) or (total == new.get(y) and x < back[y]):
                    new[y], back[y] = total, x
        scores.append(new)
        backs.append(back)
    state = leave if leave in scores[-1] else max(sorted(scores[-1]), key=lambda s: scores[-1][s])
    states = [state]
    for back in reversed(backs):
        state = back[state]
        states.append(state)
    return states[::-1]


def load_model(path: str = MODEL) -> Pieces:
    """Read a model file on the driver; its bytes (about half a megabyte) go to the tasks."""
    with open(path, "rb") as f:
        return Pieces(f.read())


TRIPLE = "array<struct<x:int,xp:string,y:int,yp:string,w:double>>"


def _pack(m: Matrix) -> list[dict]:
    return [{"x": a[0], "xp": a[1], "y": b[0], "yp": b[1], "w": w} for a, b, w in m]


def _unpack(rows) -> Matrix:
    return [((r["x"], r["xp"]), (r["y"], r["yp"]), r["w"]) for r in rows]


def _encode_small(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 200):
                rows = batch.slice(part, 200)
                ids = model.value.encode_column(rows.column(1))
                yield pa.RecordBatch.from_arrays([rows.column(0), ids], names=["key", "ids"])
    return run


def _cut(model, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key = batch.column(0)[row].as_py()
                for number, left, body, right in chunks_of(batch.column(1)[row].as_py(), size, model.value.longest):
                    yield pa.RecordBatch.from_pydict(
                        {"key": [key], "chunk": pa.array([number], pa.int64()), "left": [left], "body": [body],
                         "right": [right]})
    return run


def _transfers(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("x", pa.int32()), ("xp", pa.string()), ("y", pa.int32()), ("yp", pa.string()),
                                   ("w", pa.float64())]))
        for batch in batches:
            got = [_pack(Chunk(model.value, *(batch.column(i)[row].as_py() for i in (2, 3, 4))).transfer())
                   for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(got, kind)],
                                             names=["key", "chunk", "m"])
    return run


def _block_product(key, frame):
    import pandas as pd

    frame = frame.sort_values("chunk")
    total = _unpack(frame["m"].iloc[0])
    for m in frame["m"].iloc[1:]:
        total = product(total, _unpack(m))
    return pd.DataFrame({"key": [key[0]], "block": [key[1]], "m": [_pack(total)]})


def _block_route(key, frame):
    import pandas as pd

    frame = frame.sort_values("block")
    states = route([_unpack(m) for m in frame["m"]])
    return pd.DataFrame({"key": key[0], "block": frame["block"], "x": [s[0] for s in states[:-1]],
                         "xp": [s[1] for s in states[:-1]], "y": [s[0] for s in states[1:]],
                         "yp": [s[1] for s in states[1:]]})


def _chunk_route(key, frame):
    import pandas as pd

    frame = frame.sort_values("chunk")
    first = frame.iloc[0]
    states = route([_unpack(m) for m in frame["m"]], (int(first.x), first.xp), (int(first.y), first.yp))
    return pd.DataFrame({"key": key[0], "chunk": frame["chunk"], "x": [s[0] for s in states[:-1]],
                         "xp": [s[1] for s in states[:-1]], "y": [s[0] for s in states[1:]],
                         "yp": [s[1] for s in states[1:]]})


def _encode_chunks(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, number, left, body, right, x, xp, y, yp = (batch.column(i)[row].as_py() for i in range(9))
                ids = Chunk(model.value, left, body, right).encode((x, xp), (y, yp))
                yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([number], pa.int64()),
                                                  pa.array([ids], pa.list_(pa.int32()))], names=["key", "chunk", "ids"])
    return run


def encode(docs: DataFrame, model: Pieces, keep: list[str], chunk: int = CHUNK) -> DataFrame:
    """Per row of ``docs``: the columns ``keep`` (with text among them or not) and ids (array of int).

    ids is null where text is null and empty where it is empty. Equal giant texts are encoded once;
    repeated rows come back as often as they went in. Characters outside the model become byte
    pieces, and the space mark in a text is read as a space, both as the model's library does.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*[F.col(f"`{c}`") for c in keep])
    rows = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    giant = F.length("text") >= chunk
    small = rows.where(F.col("text").isNull() | ~giant).mapInArrow(_encode_small(held), f"key {kind}, ids array<int>")

    large = rows.where(giant).withColumn("key", F.concat_ws(":", F.xxhash64("text"), F.crc32(F.col("text").cast("binary")),
                                                            F.length("text")))
    cut = (large.select("key", "text").dropDuplicates(["key"]).mapInArrow(
        _cut(held, chunk), "key string, chunk long, left string, body string, right string")
        .repartition(F.xxhash64("key", "chunk")))
    matrices = cut.mapInArrow(_transfers(held), f"key string, chunk long, m {TRIPLE}")
    blocked = matrices.withColumn("block", F.expr(f"chunk div {BLOCK}"))
    blocks = blocked.groupBy("key", "block").applyInPandas(_block_product, f"key string, block long, m {TRIPLE}")
    ends = blocks.groupBy("key").applyInPandas(
        _block_route, "key string, block long, x int, xp string, y int, yp string")
    states = (blocked.join(ends, ["key", "block"]).groupBy("key", "block")
              .applyInPandas(_chunk_route, "key string, chunk long, x int, xp string, y int, yp string"))
    ids = (cut.join(states, ["key", "chunk"]).select("key", "chunk", "left", "body", "right", "x", "xp", "y", "yp")
           .mapInArrow(_encode_chunks(held), "key string, chunk long, ids array<int>")
           .groupBy("key").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))),
                                                     lambda s: s["ids"])).alias("ids")))
    both = small.select(F.col("key").alias("row"), "ids").unionByName(large.join(ids, "key").select("row", "ids"))
    return both.select("row.*", "ids")


def tokenised(docs: DataFrame, model: Pieces, keep: list[str], chunk: int = CHUNK) -> DataFrame:
    """Columns ``keep``, ids and n_tokens (null for a null text)."""
    return encode(docs, model, keep, chunk).withColumn("n_tokens", F.when(F.col("ids").isNotNull(), F.size("ids")).cast("long"))


def _decoded(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 100):
                rows = batch.slice(part, 100)
                texts = model.value.decode_column(rows.column(1))
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(texts, pa.string())], names=["key", "text"])
    return run


def decode(rows: DataFrame, model: Pieces, key: str) -> DataFrame:
    """(key, decoded) from (key, ids): the text of the pieces, null for null ids."""
    held = rows.sparkSession.sparkContext.broadcast(model)
    kind = dict(rows.dtypes)[key]
    out = rows.select(F.col(key).alias("key"), "ids").mapInArrow(_decoded(held), f"key {kind}, text string")
    return out.select(F.col("key").alias(key), F.col("text").alias("decoded"))


def proof_of(text) -> F.Column:
    """What stands for a text in a comparison: two hashes and the length; null for null."""
    return F.when(text.isNotNull(), F.struct(F.xxhash64(text).alias("h"), F.crc32(text.cast("binary")).alias("c"),
                                             F.length(text).alias("n")))


def round_trip(docs: DataFrame, model: Pieces, chunk: int = CHUNK) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_hash (xxhash64 of the ids), n_chars of the decoded text, and
    whether it equals the text (space marks read as spaces; by hashes and length, so that the
    text does not travel along). Null text: null, and not a failure. Batches are made small for the session."""
    small_batches(docs.sparkSession)
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       proof_of(F.translate(text, MARK, " ")).alias("proof"))
    coded = encode(rows, model, ["doc_id", "proof"], chunk)
    kept = coded.select(F.struct("doc_id", "proof", F.size("ids").cast("long").alias("n_tokens"),
                                 F.xxhash64("ids").alias("ids_hash")).alias("row"), "ids")
    out = decode(kept, model, "row")
    there = F.col("decoded").isNotNull()
    return out.select("row.doc_id", F.when(there, F.col("row.n_tokens")).alias("n_tokens"),
                      F.when(there, F.col("row.ids_hash")).alias("ids_hash"),
                      F.length("decoded").cast("long").alias("n_chars"),
                      (proof_of(F.col("decoded")) == F.col("row.proof")).alias("exact"))
