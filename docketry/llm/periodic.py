"""Periodic runs of words: stretches that repeat with a smallest period q at least four times.

The words of a batch of texts are one array of numbers, texts set apart by numbers of their own. At each dyadic scale
B the array is cut into blocks of B words. A run of period q in [B, 2B) and of length 4q holds two blocks in a row
that occur again q words on, so each block is sought in the window of the following 3B words: the sums of squared
differences of a block and all its places there come from one number-theoretic transform, and those that are
zero modulo primes whose product exceeds the greatest sum are the exact occurrences. Their distances seed chains of
blocks, which are extended by direct comparison at both ends. Blocks that can't occur again, since a word of theirs
doesn't within 2B words, and blocks inside a run that is already known, whose distances are multiples of its
period, aren't transformed.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

LEAST, REPEATS, SLICE, CHUNK = 6, 4, 1 << 20, 1 << 20
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
U = np.uint64
# Primes, each with a primitive root and the power of two that divides prime - 1.
PRIMES = [(998244353, 3, 23), (469762049, 3, 26), (167772161, 3, 25)]


def transform(rows: np.ndarray, prime: int, root: int, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of each row, whose length is a power of two, in natural order."""
    n, p = rows.shape[1], U(prime)
    step = pow(root, (prime - 1) // n, prime)
    step = pow(step, -1, prime) if inverse else step
    powers = np.ones(max(n // 2, 1), U)
    width = 1
    while width < len(powers):
        powers[width : 2 * width] = powers[:width] * U(pow(step, width, prime)) % p
        width *= 2
    half, inner = n // 2, 1
    while half:
        x = rows.reshape(len(rows), 2, half, inner)
        low, high = x[:, 0], x[:, 1]
        out = np.empty((len(rows), half, 2, inner), U)
        out[:, :, 0] = (low + high) % p
        out[:, :, 1] = (low + (p - high)) % p * powers[::inner][:half, None] % p
        rows, half, inner = out.reshape(len(rows), n), half // 2, inner * 2
    return rows * U(pow(n, -1, prime)) % p if inverse else rows


def differences(blocks: np.ndarray, windows: np.ndarray, prime: int, root: int) -> np.ndarray:
    """For each block of B numbers and its window of 2B - 1: the sum of squared differences at each of the B places,
    modulo ``prime``."""
    size, p = blocks.shape[1], U(prime)
    block, window = blocks.astype(U) % p, windows.astype(U) % p
    turned = np.zeros((len(block), 2 * size), U)
    turned[:, 0], turned[:, size + 1 :] = block[:, 0], block[:, :0:-1]
    padded = np.zeros_like(turned)
    padded[:, : 2 * size - 1] = window
    both = transform(transform(turned, prime, root) * transform(padded, prime, root) % p, prime, root, inverse=True)[:, :size]
    sums = np.zeros((len(block), 2 * size), U)
    np.cumsum(window * window % p, axis=1, out=sums[:, 1:])
    squares = (block * block % p).sum(axis=1, keepdims=True) + sums[:, size:] - sums[:, :size]
    return (squares + U(2) * (p - both)) % p


def occurrences(numbers: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of each exact occurrence of the blocks of ``size`` numbers at ``at`` whose distance is
    ``size`` or more and less than twice that. Numbers aren't negative."""
    top = int(numbers.max(initial=0)) + 1
    padded = np.append(numbers, np.full(3 * size, top, numbers.dtype))
    starts, distances = [], []
    for low in range(0, len(at), step := max(1, CHUNK // size)):
        own = at[low : low + step]
        product, zero = 1, None
        for prime, root, power in PRIMES:
            if 2 * size > 1 << power:
                continue
            live = np.arange(len(own)) if zero is None else np.unique(zero[0])
            found = differences(padded[own[live][:, None] + np.arange(size)], padded[own[live][:, None] + np.arange(size, 3 * size - 1)], prime, root) == 0
            where = np.nonzero(found)
            now = live[where[0]], where[1]
            if zero is None:
                zero = now
            else:
                both = np.isin(now[0] * size + now[1], zero[0] * size + zero[1])
                zero = now[0][both], now[1][both]
            product *= prime
            if not len(zero[0]) or product > size * top * top:
                break
        else:
            raise ValueError("a text is too long for the transforms")
        starts.append(own[zero[0]])
        distances.append(zero[1] + size)
    return np.concatenate(starts), np.concatenate(distances)


def _equal_steps(numbers: np.ndarray, at: np.ndarray, distance: np.ndarray, size: int, way: int) -> np.ndarray:
    """How many places in a row from ``at`` on, in direction ``way``, equal the one ``distance`` on; at most ``size``."""
    found = np.zeros(len(at), np.int64)
    for low in range(0, len(at), step := max(1, CHUNK // size)):
        here = at[low : low + step, None] + way * np.arange(size)
        there = here + distance[low : low + step, None]
        inside = (here >= 0) & (there < len(numbers))
        same = inside & (numbers[np.where(inside, here, 0)] == numbers[np.where(inside, there, 0)])
        found[low : low + step] = np.where(same.all(axis=1), size, (~same).argmax(axis=1))
    return found


def periodic_runs(numbers: np.ndarray, longest: int | None = None) -> np.ndarray:
    """Rows (start, length, period), by start and period, of all runs in ``numbers``: stretches of smallest period q and
    length of at least ``LEAST`` and ``REPEATS`` x q that can't be extended. longest: no run is longer."""
    n = len(numbers)
    longest = n if longest is None else longest
    order = np.argsort(numbers, kind="stable")
    again = np.flatnonzero(numbers[order[1:]] == numbers[order[:-1]])
    gap = np.full(n, n + longest)
    gap[order[again]] = order[again + 1] - order[again]
    runs: dict[tuple[int, int], int] = {}
    size = 1
    while REPEATS * size <= longest:
        k = n // size
        good = (gap[: k * size] < 2 * size).reshape(k, size).all(axis=1)
        beside = np.zeros(k, bool)
        beside[:-1] |= good[1:]
        beside[1:] |= good[:-1]
        live = np.flatnonzero(good & beside) * size
        if len(live):
            reach = np.zeros(n + 1, np.int64)
            for (start, end), _ in runs.items():
                reach[start] = max(reach[start], end)
            reach = np.maximum.accumulate(reach)
            live = live[reach[live] < live + 3 * size]
        if len(live):
            start, distance = occurrences(numbers, live, size)
            fresh = reach[start] < start + distance + size
            start, distance = start[fresh], distance[fresh]
            order = np.lexsort((start, distance))
            start, distance = start[order], distance[order]
            edge = np.ones(len(start), bool)
            edge[1:] = (distance[1:] != distance[:-1]) | (start[1:] != start[:-1] + size)
            first = np.flatnonzero(edge)
            last = np.append(first[1:], len(start)) - 1
            first, last = first[last > first], last[last > first]
            begin, end, period = start[first], start[last] + size, distance[first]
            begin = begin - _equal_steps(numbers, begin - 1, period, size, -1)
            end = end + _equal_steps(numbers, end, period, size, 1) + period
            for s, e, q in sorted(zip(begin.tolist(), end.tolist(), period.tolist(), strict=True), key=lambda x: x[2]):
                if e - s >= max(LEAST, REPEATS * q):
                    runs.setdefault((s, e), q)
        size *= 2
    found = np.array([(s, e - s, q) for (s, e), q in runs.items()], np.int64).reshape(-1, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of(texts: list[str]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    """For each text the number of its words, its runs and its words without the repetitions, joined by one space."""
    part: list[list[str]] = []
    size = 0
    for text in texts:
        words = WORDS.findall(text)
        if part and size + len(words) > SLICE:
            yield from _runs_of_words(part)
            part, size = [], 0
        part.append(words)
        size += len(words)
    if part:
        yield from _runs_of_words(part)


def _runs_of_words(part: list[list[str]]) -> Iterator[tuple[int, list[tuple[int, int, int]], str]]:
    number: dict[str, int] = defaultdict(count().__next__)
    bounds = np.cumsum([0, *(len(x) + 1 for x in part)])
    numbers = np.zeros(bounds[-1], np.int64)
    for words, at in zip(part, bounds[:-1].tolist(), strict=True):
        numbers[at : at + len(words)] = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    numbers[bounds[1:] - 1] = len(number) + np.arange(len(part))  # a number of its own ends each text
    found = periodic_runs(numbers, max(map(len, part)))
    dropped = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(dropped, found[:, 0] + found[:, 2], 1)
    np.add.at(dropped, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(dropped[:-1]) == 0
    text = np.searchsorted(bounds, found[:, 0], "right") - 1
    edges = np.searchsorted(text, np.arange(len(part) + 1))
    for k, words in enumerate(part):
        own = found[edges[k] : edges[k + 1]]
        if len(own):
            at = int(bounds[k])
            runs = [(s - at, length, q) for s, length, q in own.tolist()]
            yield len(words), runs, " ".join(compress(words, kept[at : at + len(words)].tolist()))
        else:
            yield len(words), [], " ".join(words)


def periodic(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text; further columns are not read. Returns a row for each row: (doc_id, n_words, runs, collapsed),
    runs an array of (start, length, period) in words by start and period, collapsed the text without each run's
    words after its first period, joined by one space. Null and empty texts have no words, no runs and an
    empty collapsed text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [x if isinstance(x, str) else "" for x in batch["text"]]
            rows, at, size = [], 0, 0
            for row in runs_of(texts):
                rows.append(row)
                size += len(row[2])
                if size > SLICE or at + len(rows) == len(texts):
                    shown = [[{"start": s, "length": length, "period": q} for s, length, q in x] for _, x, _ in rows]
                    yield pd.DataFrame({"doc_id": batch["doc_id"].iloc[at : at + len(rows)].array, "n_words": [n for n, _, _ in rows], "runs": shown, "collapsed": [x for _, _, x in rows]})
                    at, rows, size = at + len(rows), [], 0

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
