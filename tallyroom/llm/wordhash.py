"""Vectorised 64-bit hashes of words and word windows, straight from UTF-8 bytes.

A word's hash is a polynomial in a random odd base, read off prefix sums of the whole text,
then mixed. Equal words have equal hashes; different ones collide with a chance near 2^-64.
"""

from __future__ import annotations

from functools import cache

import numpy as np

BLOCK = 1 << 20  # bytes that are hashed at once: bounds memory, never the text

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing generator."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_RANDOM = mix(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_BASE = _RANDOM[1000]


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    up, down = (np.cumprod(np.concatenate(([np.uint64(1)], np.full(BLOCK, b, np.uint64))), dtype=np.uint64)
                for b in (_BASE, inverse))
    return up, down


class Words:
    """Word splitter: ``separators`` are byte values, A-Z fold to a-z."""

    def __init__(self, separators: bytes):
        self.sep = np.zeros(256, bool)
        self.sep[list(separators)] = True
        fold = np.arange(256)
        fold[65:91] += 32
        self.value = _RANDOM[fold]

    def hashes(self, text: np.ndarray) -> np.ndarray:
        """uint64 hash of every word of a text, in order."""
        if len(text) <= BLOCK:
            return self._block(text)
        parts, at = [], 0
        while at < len(text):
            end = min(at + BLOCK, len(text))
            if end < len(text):
                cut = np.flatnonzero(self.sep[text[at:end]])
                if len(cut):
                    end = at + int(cut[-1]) + 1
                else:  # a word longer than a block is hashed whole
                    rest = np.flatnonzero(self.sep[text[end:]])
                    end = end + int(rest[0]) if len(rest) else len(text)
            parts.append(self._block(text[at:end]))
            at = end
        return np.concatenate(parts)

    def _block(self, b: np.ndarray) -> np.ndarray:
        n = len(b)
        if not n:
            return np.zeros(0, np.uint64)
        if n > BLOCK:
            return self._long_word(b)
        up, down = _powers()
        word = ~self.sep[b]
        edge = np.flatnonzero(np.diff(np.concatenate(([0], word.view(np.int8), [0]))))
        starts, ends = edge[::2], edge[1::2]
        sums = np.concatenate(([np.uint64(0)], np.cumsum(self.value[b] * up[:n], dtype=np.uint64)))
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def _long_word(self, b: np.ndarray) -> np.ndarray:
        up, _ = _powers()
        total, scale = 0, 1
        for at in range(0, len(b), BLOCK):
            piece = b[at:at + BLOCK]
            total += int(np.sum(self.value[piece] * up[:len(piece)], dtype=np.uint64)) * scale
            scale = scale * pow(int(_BASE), len(piece), 1 << 64) % (1 << 64)
        return mix(np.array([(total + len(b)) % (1 << 64)], np.uint64))


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words, in text order; none if there are fewer words."""
    m = len(words) - k + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    total = words[:m] * _RANDOM[300]
    for i in range(1, k):
        total = total + words[i:i + m] * _RANDOM[300 + i]
    return mix(total + np.uint64(k))


@cache
def _long_powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    return tuple(np.cumprod(np.concatenate(([np.uint64(1)], np.full((1 << bits) - 1, b, np.uint64))), dtype=np.uint64)
                 for b in (_BASE, inverse))


def run_hashes(b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """uint64 hash, never 0, of each run of bytes ``b[start:stop]``."""
    up, down = _long_powers(max(20, len(b).bit_length()))
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_RANDOM[:256].take(b) * up[:len(b)], dtype=np.uint64, out=sums[1:])
    return mix((sums.take(stops) - sums.take(starts)) * down.take(starts) + (stops - starts).astype(np.uint64)) | np.uint64(1)
