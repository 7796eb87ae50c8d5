"""Numpy helpers over texts laid end to end in one byte array: words, windows and their hashes.

Hashes are polynomials modulo 2**64 over random 64-bit values of the symbols, finished by a mixing step. Prefix sums
give the hash of any window in constant time.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

BYTE_BASE, WORD_BASE, SECOND_BASE = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1342543DE82EF95, 0xA0761D6478BD642F))
BYTE_VALUES = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base**i for i below n; sizes are rounded up so that few tables are kept."""
    return _powers(int(base), 1 << max(16, int(n).bit_length()))[:n]


def prefix(values: np.ndarray, base: np.uint64) -> np.ndarray:
    out = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def windows(prefix_sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of values[start:end], wherever they stand."""
    inverse = np.uint64(pow(int(base), -1, 2**64))
    size = len(prefix_sums)
    return mix((prefix_sums[end] - prefix_sums[start]) * powers(inverse, size)[start])


class Words:
    """The words of some texts: byte bounds, document of each, and the first word of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        """``data``: the texts, each followed by one blank; ``offsets``: their starts, and the end of all."""
        if lower:
            data = LOWER[data]
        self.data, self.offsets = data, offsets
        edge = np.diff(np.concatenate(([1], IS_SPACE[data].view(np.int8), [1])))
        self.start, self.end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(offsets) - 1), self.count)

    def hashes(self) -> np.ndarray:
        if not len(self.start):
            return np.zeros(0, dtype=np.uint64)
        return windows(prefix(BYTE_VALUES[self.data], BYTE_BASE), self.start, self.end, BYTE_BASE)


def laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end, each followed by a blank, and their starts."""
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    return np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8), offsets


def planes(x: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compress better."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes() if len(x) else b""


def from_planes(data: bytes, kind: type, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(-1, n).T).view(kind).ravel()


def covered(size: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of ``size`` positions lie in some [start, end)."""
    edge = np.zeros(size + 1, dtype=np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) > 0
