"""Vectorised word splitting and 64-bit hashing over batches of texts, for use inside tasks.

A batch of texts is joined to one byte buffer. Prefix sums of a polynomial over the bytes give the
hash of any span in constant time, so words, shingles and byte windows cost a few array passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser whose output bits all depend on all input bits."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U)) | U(1)
_power = [np.ones(1, U), np.ones(1, U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_power[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, U)
            steps[0] = 1
            _power[k] = np.cumprod(steps, dtype=U)
    return _power[0][:n], _power[1][:n]


class Spans:
    """Hashes of spans [start, end) of one byte buffer."""

    def __init__(self, data: np.ndarray):
        up, self.down = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(_BYTE[data] * up[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


WHITE = byte_set((0x20, 0x20), (0x09, 0x0D))
#: ASCII other than letters and digits.
NOT_WORD = byte_set((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def slices(texts: list[bytes], limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``limit`` bytes, a longer text by itself: bounds the arrays' size."""
    begin = size = 0
    for i, x in enumerate(texts):
        if i > begin and size + len(x) > limit:
            yield begin, i
            begin, size = i, 0
        size += len(x)
    if begin < len(texts):
        yield begin, len(texts)


def words(texts: list[bytes], separators: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, or of their first ``most`` bytes, with A-Z lower-cased, and for text i its words'
    range bounds[i]:bounds[i + 1]."""
    data = _LOWER[np.frombuffer(b" ".join([*texts, b""]), np.uint8)]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~separators[data]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    firsts = np.cumsum([0, *(len(x) + 1 for x in texts)])
    hashed = Spans(data).hash(start, end if most is None else np.minimum(end, start + most))
    return hashed, np.searchsorted(start, firsts)


_STEP = mix(np.arange(101, 101 + 64, dtype=U)) | U(1)


def shingle_sets(texts: list[bytes], k: int = 5) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its k-word shingles (words: runs without white space,
    A-Z lower-cased). Fewer words count as one shingle; no words give an empty set."""
    found: list[np.ndarray] = []
    for i, j in slices(texts):
        hashes, bounds = words(texts[i:j], WHITE)
        n = len(hashes)
        together = np.zeros(max(0, n - k + 1), U)
        for s in range(k):
            together += hashes[s : s + len(together)] * _STEP[s]
        together = mix(together)
        for b, e in zip(bounds[:-1], bounds[1:], strict=True):
            if e - b >= k:
                found.append(np.unique(together[b : e - k + 1]))
            elif e > b:
                found.append(mix(np.array([(hashes[b:e] * _STEP[: e - b]).sum(dtype=U) + U(e - b)], U)))
            else:
                found.append(np.zeros(0, U))
    return found


def utf8(texts) -> list[bytes]:
    """Null counts as empty."""
    return [x.encode("utf-8", "surrogatepass") if isinstance(x, str) else b"" for x in texts]
