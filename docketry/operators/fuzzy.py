"""Whether an item's text is in a page's text, nearly: the ratio of the item and its best window of the page."""

from __future__ import annotations

from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from docketry.functions.text import norm_match

THRESHOLD, SHORTEST, GRAM, PROBES, REACH = 88, 4, 4, 3, 9


class _Item:
    """Common subsequences of one text with others; the bits of a number are the places of the text."""

    def __init__(self, text: str):
        self.size, self.full, self.places = len(text), (1 << len(text)) - 1, defaultdict(int)
        for i, x in enumerate(text):
            self.places[x] |= 1 << i

    def common(self, other: str) -> int:
        """Length of the longest common subsequence."""
        free, places = self.full, self.places
        for x in other:
            if x in places:
                met = free & places[x]
                free = ((free + met) | (free & ~met)) & self.full
        return self.size - free.bit_count()

    def best_beginning(self, other: str) -> float:
        """The best ratio with a beginning of the other text that is shorter than this one."""
        free, best = self.full, 0.0
        for n, x in enumerate(other[: self.size - 1], 1):
            if x in self.places:
                met = free & self.places[x]
                free = ((free + met) | (free & ~met)) & self.full
                best = max(best, 2 * (self.size - free.bit_count()) / (self.size + n))
        return best

    def next_window(self, met: list[int], i: int, most: int) -> tuple[int, int]:
        """The most in common, with the window of the other text from i on, and the place of the next window that can have
        more: those before it lie in a stretch from i that has no more. met: for each character of the other text its
        places in this one."""
        free, full, m = self.full, self.full, self.size
        for own in met[i : i + m]:
            own &= free
            free = (free + own) | (free - own)
        free &= full
        most = max(most, m - free.bit_count())
        least, n = m - most, i + m
        for n, own in enumerate(met[i + m : i + REACH * m], i + m + 1):
            if own := own & free:
                free = ((free + own) | (free - own)) & full
                if free.bit_count() < least:
                    return most, n - m
        return most, n - m + 1


def _best(item: str, page: str) -> float:
    """The best ratio of the item with a window of its length, or a shorter window at either end of the page. All windows
    inside a stretch that has no more in common than the best one so far are left out."""
    own, m, last = _Item(item), len(item), len(page) - len(item)
    best = max(own.best_beginning(page), _Item(item[::-1]).best_beginning(page[::-1]))
    most = int(best * m)
    grams = defaultdict(list)
    for i in range(m - GRAM + 1):
        grams[item[i : i + GRAM]].append(i)
    shifts = Counter(min(max(j - i, 0), last) for j in range(len(page) - GRAM + 1) for i in grams.get(page[j : j + GRAM], ())[:PROBES])
    for i, _ in shifts.most_common(PROBES):
        most = max(most, own.common(page[i : i + m]))
    i, met = 0, [own.places.get(x, 0) for x in page]
    while i <= last:
        most, i = own.next_window(met, i, most)
    return max(best, most / m)


def window_score(item: str, page: str) -> int:
    """0 to 100: the rounded ratio (2 x common subsequence by the lengths) of the shorter text and its best window of the
    longer one, exact over all windows; 0 if one is empty."""
    item, page = sorted((item, page), key=len)
    if not item:
        return 0
    if item in page:
        return 100
    best = _best(item, page)
    return round(100 * (max(best, _best(page, item)) if len(item) == len(page) else best))


@F.pandas_udf(IntegerType())
def _window_scores(item: pd.Series, page: pd.Series) -> pd.Series:
    return pd.Series([None if a is None or b is None else window_score(a, b) for a, b in zip(item, page, strict=True)], dtype="Int32")


def fuzzy_check(item: Column, page: Column, threshold: int = THRESHOLD, shortest: int = SHORTEST) -> Column:
    """A label with the score: normalised items of ``shortest`` characters or more are verified by a best window of
    ``threshold`` or more, shorter ones by containment. Null and empty texts have labels of their own."""
    wanted, there = norm_match(F.coalesce(item, F.lit(""))), norm_match(F.coalesce(page, F.lit("")))
    short = F.length(wanted) < shortest
    score = _window_scores(F.when(~short & (there != ""), wanted), there)
    shown = F.concat(F.when(score >= threshold, "Verified").otherwise("Failed"), F.lit(" (Match "), score, F.lit("%)"))
    return (
        F.when(there == "", "Skipped (No Direct Text)")
        .when(F.coalesce(item, F.lit("")) == "", "Failed (Invalid Or Empty Content Field)")
        .when(wanted == "", "Not Verified (Empty Normalized Item Content)")
        .when(short, F.when(F.contains(there, wanted), "Verified (Exact Match)").otherwise("Failed (Exact Mismatch - Short)"))
        .otherwise(shown)
    )
