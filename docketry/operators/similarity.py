"""Comparing texts: sequence ratio, containment and word overlap."""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from docketry.functions.text import norm_match, norm_verify
from docketry.sources.rounds import checkpointed, small


class _Spans:
    """Names of the spans of two texts, one after the other, that hold no popular character: equal spans have
    equal names. Spans of a power of two are named from those of half the length."""

    def __init__(self, codes: np.ndarray, left: np.ndarray):
        self.left, self.named, self.made = left, {1: np.unique(codes, return_inverse=True)[1].astype(np.int64)}, {}

    def _named(self, power: int) -> np.ndarray:
        if power not in self.named:
            half = self._named(power // 2)
            at = np.flatnonzero(self.left >= power)
            names = np.zeros(len(half), np.int64)
            names[at] = np.unique(half[at] * len(half) + half[at + power // 2], return_inverse=True)[1]
            self.named[power] = names
        return self.named[power]

    def within(self, size: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and names of the spans of this size between two places."""
        if size not in self.made:
            names = self._named(1 << (size.bit_length() - 1))
            at = np.flatnonzero(self.left >= size)
            self.made[size] = at, names[at] * len(names) + names[at + size - (1 << (size.bit_length() - 1))]
        at, found = self.made[size]
        i, j = np.searchsorted(at, (low, high - size + 1))
        return at[i:j], found[i:j]


def _left(rare: np.ndarray) -> np.ndarray:
    """For each place the number of characters from there to the next popular one."""
    places = np.arange(len(rare))
    stops = np.append(np.flatnonzero(~rare), len(rare))
    return stops[np.searchsorted(stops, places)] - places


def _alike(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common beginning."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        if differ.any():
            return at + int(differ.argmax())
        at, step = at + step, 2 * step
    return n


def matching_ratio(x: str, y: str) -> float:
    """difflib.SequenceMatcher(None, x, y).ratio(), to the same value, without its quadratic time on long texts:
    the longest common span without popular characters is found by names of spans, and its length in a part of
    the texts is at most that in the whole."""
    if not x or not y:
        return 0.0
    a, b = (np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in (x, y))
    known, counts = np.unique(b, return_counts=True)
    usual = known[counts <= len(b) // 100 + 1] if len(b) >= 200 else known
    left, shift = [_left(np.isin(t, usual)) for t in (a, b)], len(a)
    spans = _Spans(np.concatenate([a, b]), np.concatenate(left))
    longest = int(min(x.max() for x in left))
    total, parts = 0, [(0, len(a), 0, len(b), longest)]
    while parts:
        alo, ahi, blo, bhi, most = parts.pop()
        low, high, best = 0, min(most, ahi - alo, bhi - blo), None
        size = high
        while size > low:
            at_a, of_a = spans.within(size, alo, ahi)
            at_b, of_b = spans.within(size, shift + blo, shift + bhi)
            common = np.isin(of_a, of_b) if len(of_a) and len(of_b) else np.zeros(0, bool)
            if common.any():
                k = int(common.argmax())
                low, best = size, (int(at_a[k]), int(at_b[(of_b == of_a[k]).argmax()]) - shift)
            else:
                high = size - 1
            size = (low + high + 1) // 2
        i, j = best or (alo, blo)
        if best:
            back = _alike(a[alo:i][::-1], b[blo:j][::-1])
            i, j, low = i - back, j - back, low + back
        size = low + _alike(a[i + low : ahi], b[j + low : bhi])
        if size:
            total += size
            limit = high
            if alo < i and blo < j:
                parts.append((alo, i, blo, j, limit))
            if i + size < ahi and j + size < bhi:
                parts.append((i + size, ahi, j + size, bhi, limit))
    return 2.0 * total / (len(a) + len(b))


@F.pandas_udf(DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else matching_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def word_overlap(a: Column, b: Column) -> Column:
    """Share of a's distinct words that b has."""
    wanted = F.array_distinct(F.split(norm_match(a), " "))
    return F.size(F.array_intersect(wanted, F.split(norm_match(b), " "))) / F.size(wanted)


def word_hashes(c: Column) -> Column:
    """Hashes of the distinct normalised words, to be joined in place of the text."""
    return F.transform(F.array_distinct(F.split(norm_match(c), " ")), lambda w: F.xxhash64(w))


def hashed_overlap(a: Column, b: Column) -> Column:
    """``word_overlap`` of two columns of ``word_hashes``."""
    return F.size(F.array_intersect(a, b)) / F.size(a)


def sentence_hashes(c: Column) -> Column:
    return F.transform(F.array_distinct(sentences(c)), lambda x: F.xxhash64(x))


def verify(df: DataFrame, original: str, rebuilt: str, threshold: float = 0.9) -> DataFrame:
    """score and status of a rebuilt text; without original ``not started``, empty texts fail."""
    a, b = norm_verify(F.col(original)), norm_verify(F.coalesce(F.col(rebuilt), F.lit("")))
    score = F.when(F.col(original).isNull(), 0.0).otherwise(sequence_ratio(a, b))
    scored = df.withColumn("score", score)
    return scored.withColumn("verification", F.when(F.col(original).isNull(), "not started").when(F.col("score") >= threshold, "pass").otherwise("failed"))


def fidelity(a: Column, b: Column, least: float = 0.9) -> Column:
    """Whether two texts are alike to a ratio of ``least``."""
    return sequence_ratio(a, b) >= least


def contains_check(item: Column, page: Column, has_content: Column | None = None) -> Column:
    """Whether the normalised item text is in the normalised page text, as one of five labels. has_content is
    false where the item has no content field: such items stay unverified."""
    wanted, there = norm_match(F.coalesce(item, F.lit(""))), norm_match(F.coalesce(page, F.lit("")))
    label = F.when(there == "", "Skipped (No Direct Text)")
    if has_content is not None:
        label = label.when(~has_content, "Not Verified")
    label = label.when(F.coalesce(item, F.lit("")) == "", "Failed (Invalid Or Empty Content Field)")
    return label.when((wanted != "") & F.contains(there, wanted), "Verified (Direct Text Match)").otherwise("Failed (Direct Text Mismatch)")


def sentences(c: Column) -> Column:
    """Normalised text, split after full stops."""
    return F.split(F.replace(norm_verify(c), F.lit(". "), F.lit(".\x01")), "\x01")


def sentence_diff(a: Column, b: Column) -> tuple[Column, Column]:
    """Distinct sentences that b adds, and those that it lacks."""
    return F.array_except(sentences(b), sentences(a)), F.array_except(sentences(a), sentences(b))


def distinct_words(c: Column) -> Column:
    """Runs without white space in lower case, each once."""
    return F.filter(F.array_distinct(F.split(F.lower(c), r"\s+")), lambda w: w != "")


def overlap_match(headings: DataFrame, elements: DataFrame, key: str, heading: str, text: str, place: list[str], least_words: int = 5, percent: int = 85, few: int = 100_000) -> DataFrame:
    """The first element (by place) of each heading of ``least_words`` distinct words or more that holds ``percent``
    hundredths of them; words are runs without white space in lower case. A heading's words by rarity: an element
    that holds so many of them holds one of the first few, the probes, which alone meet the elements' words. Up to ``few``
    probes are sent to all tasks."""
    wanted = headings.select(key, distinct_words(F.col(heading)).alias("_w")).where(F.size("_w") >= least_words)
    held = elements.select(*place, distinct_words(F.col(text)).alias("_e")).where(F.size("_e") * 100 >= least_words * percent)
    vocabulary = small(wanted.select(F.explode("_w").alias("_word")).distinct())
    counts = held.select(F.explode("_e").alias("_word")).join(vocabulary, "_word", "left_semi").groupBy("_word").agg(F.count("*").alias("_n"))
    ranked = wanted.select(key, "_w", F.explode("_w").alias("_word")).join(counts, "_word", "left")
    ranked = ranked.groupBy(key, "_w").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_word"))).alias("_by"))
    missing = F.floor(F.size("_w") * (100 - percent) / 100).cast("int")
    probes = checkpointed(ranked.select(key, "_w", F.explode(F.slice("_by", F.lit(1), missing + 1)).alias("p")).select(key, "_w", F.col("p._word").alias("_word")))
    if probes.count() <= few:
        # Elements meet the probes where they stand: no word of theirs is moved.
        met = held.select(*place, "_e", F.explode("_e").alias("_word")).join(F.broadcast(probes), "_word")
    else:
        # Words move without the texts; only the pairs that share a probe get the element's words.
        pairs = held.select(*place, F.explode("_e").alias("_word")).join(probes, "_word").select(key, "_w", *(F.col(x).alias(f"_at_{x}") for x in place)).distinct()
        same = functools.reduce(Column.__and__, (F.col(f"_at_{x}").eqNullSafe(F.col(x)) for x in place))
        met = pairs.join(held, same)
    enough = 100 * F.size(F.array_intersect("_w", "_e")) >= percent * F.size("_w")
    return met.where(enough).groupBy(key).agg(F.min(F.struct(*place)).alias("p")).select(key, "p.*")
