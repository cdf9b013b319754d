"""Best-fit packing of token sequences by a configuration linear program.

Only the histogram of piece lengths, at most ``capacity`` numbers, decides the packing. The program has a
variable for each configuration, a multiset of lengths that fits in a sequence. Multiplicative weights
hold a price for each length; a knapsack by dynamic programming finds full configurations that hold each length, ties
drawn by price, and lengths that they cover get cheaper. Each is rounded to whole sequences as it comes, within
what is left. The few pieces that no full configuration takes any more go to a greedy fill, longest first. Pieces then take their places by rank in their length,
which Spark computes in two steps so that a length that many pieces share is split over tasks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.store import shuffle_width, small_batches, stored

CAPACITY, END_ID, CACHED_WORDS = 4096, 1, 600_000
#: Rounds of the program end when one places less than this share of all pieces.
STALLED = 0.0005
#: A length's price grows with this power of it: longer ones fit in fewer configurations and have to find theirs first.
POWER = 3

# Texts whose lower case has these characters only need no other normaliser; others go to the tokenizer whole.
_OTHER = re.compile("[^\x00-ɏ]|<\\|")
_LETTER = "a-zªµºß-öø-ÿĀ-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_NUMBER}]|[^\t-\r \x85\xa0{_LETTER}{_NUMBER}]+")


class _Words(dict):
    """Ids of a word as little-endian 32-bit bytes, from the tokenizer's model at first sight."""

    def __init__(self, tokenizer):
        self.model = tokenizer.model
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.letters = dict(zip(plain, map(chr, plain), strict=True)) | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHED_WORDS:
            self.clear()
        shown = word.encode().decode("latin-1").translate(self.letters)
        ids = self[word] = np.array([t.id for t in self.model.tokenize(shown)], "<u4").tobytes()
        return ids


def ids_of(texts: list[str], tokenizer, words: dict[str, bytes]) -> Iterator[bytes]:
    """The ids of each text, packed: what ``tokenizer.encode(text, add_special_tokens=False)`` gives."""
    for text in texts:
        low = text.lower()
        if _OTHER.search(low):
            yield np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        else:
            yield b"".join(map(words.__getitem__, _PIECES.findall(low)))


def pieces(docs: DataFrame, tokenizer_path: str | Callable[[], str], capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): each document's ids and then END_ID, cut only where
    they are longer than ``capacity``. tokenizer_path may be a function, which tells each executor its own path."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(tokenizer_path() if callable(tokenizer_path) else tokenizer_path)
        words = _Words(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            texts = [x if isinstance(x, str) else "" for x in batch["text"]]
            for doc_id, ids in zip(batch["doc_id"], ids_of(texts, tokenizer, words), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    small_batches(docs.sparkSession)
    plain = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    return plain.mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def knapsack(lengths: np.ndarray, price: np.ndarray, capacity: int, random: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """For each room up to ``capacity``: how much of it a multiset of lengths can fill, and which length (its number, -1 for
    none) a fullest one begins with. Of those that fill as much, one is drawn in proportion to its price. lengths ascend."""
    fill, choice = np.zeros(capacity + 1, np.int64), np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), "right")
    # The largest of log price + Gumbel noise is a draw in proportion to price; each room reads another stretch of noise.
    noise, log_price = random.gumbel(size=4 * len(lengths) + 1), np.log(price)
    starts = random.integers(0, 3 * len(lengths) + 1, capacity + 1)
    for room in range(1, capacity + 1):
        fill[room], choice[room] = fill[room - 1], -1
        if k := upto[room]:
            gain = fill[room - lengths[:k]] + lengths[:k]
            if (most := gain.max()) > fill[room]:
                same = np.flatnonzero(gain == most)
                fill[room], choice[room] = most, same[(log_price[same] + noise[starts[room] : starts[room] + k][same]).argmax()]
    return fill, choice


def _column(choice: np.ndarray, lengths: np.ndarray, first: int, capacity: int) -> np.ndarray:
    """The numbers of the lengths of a fullest multiset that holds the length number ``first``."""
    found, room = [first], capacity - int(lengths[first])
    while room > 0:
        if (i := choice[room]) >= 0:
            found.append(int(i))
            room -= int(lengths[i])
        else:
            room -= 1
    return np.array(found)


def _fullest(lengths: np.ndarray, left: np.ndarray, capacity: int) -> np.ndarray:
    """A multiset from the remaining counts: the longest first, then one or two lengths that fill the room
    exactly if there are such, else the longest that fits, again and again."""
    take = np.zeros(len(lengths), np.int64)
    index = np.full(capacity + 1, -1)
    have = np.flatnonzero(left)
    index[lengths[have]] = have
    take[have[-1]] = 1
    room = capacity - int(lengths[have[-1]])
    while room > 0:
        if left[have[-1]] <= take[have[-1]]:
            index[lengths[have[-1]]] = -1
        fits = index[1 : room + 1]
        if index[room] >= 0:
            ends = [index[room]]
        elif len(pair := np.flatnonzero((fits[:-1] >= 0) & (fits[:-1][::-1] >= 0))):
            i, j = fits[pair[-1]], fits[room - 2 - pair[-1]]
            ends = [i, j] if i != j or left[i] - take[i] > 1 else [i]
        elif len(some := np.flatnonzero(fits >= 0)):
            ends = [fits[some[-1]]]
        else:
            break
        for i in ends:
            take[i] += 1
            room -= int(lengths[i])
            if left[i] <= take[i]:
                index[lengths[i]] = -1
    return take


def _rounds(lengths: np.ndarray, left: np.ndarray, capacity: int, rounds: int, seed: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(numbers of lengths, how many of each, times): whole multiples of full configurations, taken from ``left``. A
    multiset holds few of the lengths, so that only those are kept.

    A length's price is its demand that is still uncovered, times a power of the length, so that it falls by a factor
    with each configuration that holds it. A round prices with one knapsack, which gives a fullest configuration for each
    length; each that is full, in random order, is rounded down to what the demand allows: all of it where it covers
    one piece, half of what is left where it can cover more. Rounds end when few configurations fit."""
    random, full = np.random.default_rng(seed), left.sum()
    for _ in range(rounds):
        have = np.flatnonzero(left)
        if not have.size:
            break
        own, placed = lengths[have], 0
        _, choice = knapsack(own, left[have] * own.astype(float) ** POWER, capacity, random)
        for first in random.permutation(len(have)):
            column = np.bincount(_column(choice, own, first, capacity), minlength=len(have))
            used = np.flatnonzero(column)
            if int(column @ own) == capacity and (n := int((left[have[used]] // column[used]).min())):
                n = -(-n // 2)
                yield have[used], column[used], n
                left[have[used]] -= n * column[used]
                placed += n * int(column.sum())
        if placed < STALLED * full:
            break


def _filled(lengths: np.ndarray, left: np.ndarray, capacity: int, rounds: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """As ``_rounds``, until nothing is left: what the program leaves is placed by a greedy fill."""
    yield from _rounds(lengths, left, capacity, rounds)
    while left.any():
        column = _fullest(lengths, left, capacity)
        used = np.flatnonzero(column)
        n = int((left[used] // column[used]).min())
        yield used, column[used], n
        left[used] -= n * column[used]


def _whole(found: Iterator[tuple[np.ndarray, np.ndarray, int]], size: int) -> list[tuple[np.ndarray, int]]:
    made = []
    for at, each, times in found:
        made.append((np.zeros(size, np.int64), times))
        made[-1][0][at] = each
    return made


def program(lengths: np.ndarray, left: np.ndarray, capacity: int, rounds: int = 10_000) -> list[tuple[np.ndarray, int]]:
    """(multiset, times) of the program: how many of each length."""
    return _whole(_rounds(lengths, left, capacity, rounds), len(lengths))


def configurations(lengths, counts, capacity: int = CAPACITY, rounds: int = 10_000) -> list[tuple[np.ndarray, int]]:
    """(multiset, times): together they hold each length exactly ``counts`` times. lengths ascend."""
    lengths, left = np.asarray(lengths, np.int64), np.asarray(counts, np.int64).copy()
    return _whole(_filled(lengths, left, capacity, rounds), len(lengths))


def _places(lengths, counts, capacity: int) -> pd.DataFrame:
    """Where the pieces of a length go: those of ranks low to high - 1 in sequences from ``first`` on, ``each``
    to a sequence, at ``base`` and after. Its size follows from ``capacity`` and grows with the logarithm of the counts."""
    rows, used, sequence = [], dict.fromkeys(lengths, 0), 0
    left = np.asarray(counts, np.int64).copy()
    for at, of, times in _filled(np.asarray(lengths, np.int64), left, capacity, 10_000):
        base = 0
        for i, each in zip(at[::-1].tolist(), of[::-1].tolist(), strict=True):
            length = int(lengths[i])
            rows.append((length, used[length], used[length] + each * times, sequence, each, base))
            used[length] += each * times
            base += each * length
        sequence += times
    return pd.DataFrame(rows, columns=["length", "low", "high", "first", "each", "base"])


def pack(docs: DataFrame, tokenizer_path: str | Callable[[], str], capacity: int = CAPACITY) -> DataFrame:
    """docs: doc_id, text; further columns are not read. Returns (doc_id, piece, start, length, ids_crc32,
    sequence_id, offset). Null texts are empty and so have one id; rows without doc_id are left out; a row
    that is there twice is packed twice; no documents give no rows."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer_path, capacity), "pieces")
    histogram = cut.groupBy("length").count().orderBy("length").collect()  # at most ``capacity`` rows
    places = _places([r["length"] for r in histogram], [r["count"] for r in histogram], capacity)
    schema = "length long, low long, high long, first long, each long, base long"
    places = spark.createDataFrame(places.values.tolist(), schema)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shuffle_width(spark))))
    before = (
        salted.groupBy("length", "salt").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    )
    own = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")) - 1
    ranked = salted.withColumn("own", own).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("own")).drop("own", "before", "salt")
    at = F.col("rank") - F.col("low")
    placed = ranked.join(F.broadcast(places), (ranked["length"] == places["length"]) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))).drop(places["length"])
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.floor(at / F.col("each"))).alias("sequence_id"), (F.col("base") + at % F.col("each") * F.col("length")).alias("offset")
    )
