"""Vectorised byte-level BPE over batches of texts, with the tokenizers library's results.

A byte-level tokenizer first splits a text into pieces (a word with the blank before it, a run of
digits, of marks, of white space, an English contraction) and merges inside pieces only. Here the
pieces of many texts are found and hashed with array operations; the ids of a piece come from a
table by its 64-bit hash, and the library's model encodes each piece that the table does not
hold. Two different pieces share a hash with a chance near 2^-64. Texts with characters whose
class the rule below does not know, or with a special token's string, are left to the library.
"""

from __future__ import annotations

import json
import os
from functools import cache
from itertools import chain

import numpy as np

from tallyroom.llm.wordhash import run_hashes

PIECES = 1_000_000  # pieces whose ids a worker remembers; others are encoded each time they are met
BLOCK = 1 << 17  # bytes of text that are split at once, few enough for a cache; one text is never divided

LETTER, DIGIT, MARK, SPACE, BREAK = 1, 2, 3, 4, 5


def _classes() -> np.ndarray:
    out = np.zeros(256, np.uint8)  # 0: not known
    out[33:127] = MARK
    out[[*range(65, 91), *range(97, 123), 0xC3, 0xC4, 0xC5]] = LETTER  # and the letters from U+00C0 to U+017F
    out[48:58] = DIGIT
    out[32], out[[9, 10, 13]] = SPACE, BREAK
    out[0xC2] = MARK
    return out


CLASSES = _classes()
MARKS_C2 = np.isin(np.arange(256), [0xA1, 0xAB, 0xBB, 0xBF])  # second bytes of four marks above ASCII
NOT_LETTERS_C3 = (0x97, 0xB7)


def classes(b: np.ndarray) -> np.ndarray:
    """Class of the character that each byte of UTF-8 belongs to."""
    c = CLASSES[b]
    high = np.flatnonzero(b >= 0x80)
    if len(high):
        cont = high[(b[high] & 0xC0) == 0x80]
        lead = b[cont - 1]
        kind = CLASSES[lead]
        kind[(lead == 0xC2) & ~MARKS_C2[b[cont]]] = 0
        kind[(lead == 0xC3) & np.isin(b[cont], NOT_LETTERS_C3)] = 0
        c[cont] = kind
        c[cont - 1] = np.where(lead >= 0xC0, kind, 0)
    return c


def piece_starts(b: np.ndarray, c: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """First bytes of all pieces; ``texts`` are the first bytes of the texts in ``b``."""
    white = c >= SPACE
    group = np.minimum(c, SPACE)
    change = group[1:] != group[:-1]
    change[texts[(texts > 0) & (texts < len(b))] - 1] = False
    start = np.empty(len(b), bool)
    start[0] = True
    start[1:] = change & (c[:-1] != SPACE)
    start[np.flatnonzero(change & white[:-1])] = True  # the last of a run of white space, which a word may take
    start[texts[texts < len(b)]] = True
    quotes = np.flatnonzero(b == 39)
    quotes = quotes[start[quotes]]
    if len(quotes):  # 's 't 'm 'd 're 've 'll end a word
        ahead = np.concatenate([b, np.zeros(3, np.uint8)])
        same = np.concatenate([start, np.ones(3, bool)])
        text_at = np.zeros(len(b) + 3, bool)
        text_at[texts] = True
        text_at[len(b):] = True
        x, y = ahead[quotes + 1], ahead[quotes + 2]
        one = np.isin(x, list(b"stmd")) & ~text_at[quotes + 1]
        two = (((x == 114) | (x == 118)) & (y == 101) | (x == 108) & (y == 108)) & ~text_at[quotes + 1] & ~text_at[quotes + 2]
        same[quotes[one | two] + 1] = False
        same[quotes[one] + 2] = True
        same[quotes[two] + 3] = True
        start = same[:len(b)]
    return np.flatnonzero(start)


class PieceTable:
    """Piece hash to a run of ids in a pool; open addressing."""

    def __init__(self, pieces: int, kind: type = np.uint16):
        self.bits = max(8, (2 * pieces - 1).bit_length())
        cells = np.zeros(2 << self.bits, np.uint64)  # a key and its run lie side by side
        self.keys, self.runs = cells[::2], cells[1::2]
        self.cells = cells
        self.pool = np.zeros(1 << 16, kind)
        self.size, self.used, self.most = 0, 0, pieces

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(run, known) of every hash."""
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at2 = at << 1
        key = self.cells.take(at2)
        at2 += 1
        run, known = self.cells.take(at2), key == h
        left = np.flatnonzero(~known & (key != 0))
        while len(left):
            at = (at[left] + 1 if len(at) == len(h) else at + 1) & ((1 << self.bits) - 1)
            key = self.keys[at]
            same = key == h[left]
            run[left[same]], known[left[same]] = self.runs[at[same]], True
            more = ~same & (key != 0)
            left, at = left[more], at[more]
        return run, known

    def keep(self, h: np.ndarray, runs: np.ndarray) -> None:
        h, runs = h[:self.most - self.used], runs[:self.most - self.used]
        self.used += len(h)
        at = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(h):
            free = self.keys[at] == 0
            self.keys[at[free]], self.runs[at[free]] = h[free], runs[free]
            left = self.keys[at] != h
            h, runs, at = h[left], runs[left], (at[left] + 1) & ((1 << self.bits) - 1)

    def add(self, ids: np.ndarray) -> int:
        """Put ids at the pool's end."""
        while self.size + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.size:self.size + len(ids)] = ids
        self.size += len(ids)
        return self.size - len(ids)


    def ids(self, h: np.ndarray, encode) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after the other, and how many each has. ``encode`` gives the ids of the pieces
        at the places it is handed, one of each that is not in the table."""
        run, known = self.find(h)
        new = np.flatnonzero(~known)
        if len(new):
            different, first, back = np.unique(h[new], return_index=True, return_inverse=True)
            found = encode(new[first])
            sizes = np.fromiter(map(len, found), np.uint64, len(found))
            own = np.cumsum(sizes) - sizes
            at = self.add(checked(list(chain.from_iterable(found)), self.pool.dtype.type))
            runs = ((own + np.uint64(at)) << np.uint64(24)) | sizes
            kept = self.most - self.used
            mark = at + int(own[kept]) if kept < len(found) else self.size
            self.keep(different, runs)
            run[new] = runs[back]
        sizes = (run & np.uint64((1 << 24) - 1)).astype(np.int64)
        total = np.cumsum(sizes)
        place = np.repeat((run >> np.uint64(24)).astype(np.int64) - (total - sizes), sizes)
        place += np.arange(len(place))
        ids = self.pool.take(place)
        if len(new):
            self.size = mark  # pieces beyond the table's size are forgotten
        return ids, sizes


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [x for x in range(256) if x not in plain]
    return {x: chr(x) for x in plain} | {x: chr(256 + i) for i, x in enumerate(rest)}


LETTERS = np.array([ord(byte_letters()[x]) for x in range(256)], "<u2")


def checked(ids: list[int], kind: type = np.uint16) -> np.ndarray:
    if ids and kind is np.uint16 and max(ids) > 0xFFFF:
        raise ValueError("ids below 65536 are expected")
    return np.array(ids, kind)


class Encoder:
    """Texts to uint16 ids as the library's ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, spec: str, pieces: int = PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.model = self.tokenizer.model
        known = json.loads(spec)
        split = known.get("pre_tokenizer") or {}
        self.by_piece = (not any(known.get(k) for k in ("normalizer", "truncation", "padding"))
                         and split.get("type") == "ByteLevel" and not split.get("add_prefix_space")
                         and split.get("use_regex", True) and known["model"]["type"] == "BPE")
        self.marks = [t["content"].encode() for t in known.get("added_tokens", [])]
        self.table = PieceTable(pieces)

    def encode(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        """Ids of every text, which is given as its UTF-8 bytes."""
        out, at = [], 0
        while at < len(texts):
            to, size = at, 0
            while to < len(texts) and (to == at or size + len(texts[to]) <= BLOCK):
                size += len(texts[to])
                to += 1
            out += self._block(texts[at:to])
            at = to
        return out

    def _library(self, text: np.ndarray) -> np.ndarray:
        return checked(self.tokenizer.encode(text.tobytes().decode(), add_special_tokens=False).ids)

    def _block(self, texts: list[np.ndarray]) -> list[np.ndarray]:
        if not self.by_piece:
            return [self._library(t) for t in texts]
        b = np.concatenate(texts)
        ends = np.cumsum([len(t) for t in texts])
        if not len(b):
            return [np.zeros(0, np.uint16) for _ in texts]
        firsts = ends - [len(t) for t in texts]
        c = classes(b)
        odd = set(np.searchsorted(ends, np.flatnonzero(c == 0), "right").tolist())
        data = b.tobytes()
        for mark in self.marks:
            at = data.find(mark)
            while at >= 0:
                odd.add(int(np.searchsorted(ends, at, "right")))
                at = data.find(mark, at + 1)
        starts = piece_starts(b, c, firsts)
        stops = np.append(starts[1:], len(b))
        if odd:
            own = np.searchsorted(ends, starts, "right")
            keep = ~np.isin(own, list(odd))
            starts, stops = starts[keep], stops[keep]
        ids, sizes = self.table.ids(run_hashes(b, starts, stops), lambda new: self._fresh(b, starts[new], stops[new]))
        at = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(starts, np.concatenate([firsts, [len(b)]]))]
        return [self._library(t) if k in odd else ids[at[k]:at[k + 1]] for k, t in enumerate(texts)]

    def _fresh(self, b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> list[list[int]]:
        """Ids of pieces, from the model. Each byte is one letter to it."""
        letters = LETTERS.take(b).tobytes().decode("utf-16-le")
        tokenize = self.model.tokenize
        return [[t.id for t in tokenize(letters[j:k])] for j, k in zip(starts.tolist(), stops.tolist(), strict=True)]


@cache
def encoder(spec: str) -> Encoder:
    """One per worker process, which keeps its table for the next task."""
    return Encoder(spec)
