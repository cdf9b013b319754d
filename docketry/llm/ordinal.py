"""Ordinal cumulative-link regression on hashed words.

P(grade >= k) = sigmoid(w . x - t_k): one weight vector over all thresholds, which stay in order. x holds
1 / sqrt(n) for each of a text's n distinct hashed words, word beginnings and runs of symbols, and 1 for
each of its shape features: bands of its length and of its share of capitals, symbols, digits, distinct
words and distinct lines. The fit takes a bounded sample of the rated rows; scoring runs in tasks over all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.store import small_batches
from docketry.llm.wordhash import NOT_WORD, byte_set, slices, utf8, words

#: Digits and punctuation split words too, so that symbols stuck to a word don't hide it.
_SPLIT = NOT_WORD.copy()
_SPLIT[48:58] = True
#: All but ASCII symbols, to split off their runs.
_PLAIN = ~byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
_CAPITAL, _DIGIT = byte_set((65, 90)), byte_set((48, 57))
#: Bytes of a word's beginning, bands of a share, and shape features of a text.
BEGINNING, BANDS, SHAPES = 5, 10, 6
DIMENSIONS = 1 << 18


def features(texts, dimensions: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct hashed words, and its SHAPES shape features, which come after
    ``dimensions``. Null counts as empty."""
    found = []
    plain = utf8(texts)
    for i, j in slices(plain):
        own = plain[i:j]
        lower = utf8([x.decode("utf-8", "surrogatepass").lower() for x in own])
        kinds = [words(lower, _SPLIT), words(lower, _SPLIT, BEGINNING), words(lower, _PLAIN)]
        for k, text in enumerate(own):
            parts = [np.unique((h[b[k] : b[k + 1]] ^ np.uint64(salt)) % np.uint64(dimensions)) for salt, (h, b) in enumerate(kinds)]
            data = np.frombuffer(text, np.uint8)
            n, lines = max(1, len(data)), text.split(b"\n")
            total = int(kinds[0][1][k + 1] - kinds[0][1][k])
            shares = [_CAPITAL[data].sum() / n, (~_PLAIN[data]).sum() / n, _DIGIT[data].sum() / n, len(parts[0]) / max(1, total), len(set(lines)) / len(lines)]
            bands = [min(BANDS - 1, total.bit_length() // 2), *(min(BANDS - 1, int(BANDS * x**0.5)) for x in shares)]
            shape = dimensions + BANDS * np.arange(SHAPES) + np.array(bands)
            found.append((np.unique(np.concatenate(parts)).astype(np.int32), shape.astype(np.int32)))
    return found


@dataclass(frozen=True)
class CumulativeLink:
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, texts) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ..., a row for each text."""
        rows = features(texts, len(self.weights) - SHAPES * BANDS)
        score = np.array([self.weights[f].sum() / np.sqrt(max(1, len(f))) + self.weights[s].sum() for f, s in rows]).reshape(-1)
        return 1 / (1 + np.exp(-np.clip(score[:, None] - self.thresholds[None, :], -30, 30)))


def fit(texts, grades, **settings) -> CumulativeLink:
    """The model of a few texts at hand."""
    return fitted(features(texts, DIMENSIONS), grades, **settings)


def fitted(rows: list[tuple[np.ndarray, np.ndarray]], grades, dimensions: int = DIMENSIONS, steps: int = 200, rate: float = 4.0, least_texts: int = 8, least_z: float = 5.0) -> CumulativeLink:
    """Full-batch Adam on the mean log loss of the cumulative splits grade >= k; rows as ``features`` gives them.

    Only words with evidence take part: in at least ``least_texts`` texts, and for some split at least
    ``least_z`` standard deviations from what their number of texts would give by chance. Shape features
    all take part."""
    grades = np.asarray(grades, np.int64)
    top = int(grades.max(initial=0))
    if top < 1 or len(np.unique(grades)) < 2:
        raise ValueError("ratings of at least two grades are needed")
    above = grades[:, None] >= np.arange(1, top + 1)[None, :]
    share = np.clip(above.mean(axis=0), 1e-3, 1 - 1e-3)
    # Counts by feature, a text at a time: only what is kept is laid out whole.
    have, high = np.zeros(dimensions), np.zeros((top, dimensions))
    for (f, _), own in zip(rows, above, strict=True):
        have[f] += 1
        high[:, f] += own[:, None]
    there = np.maximum(have, 1)
    z = np.abs(high - there * share[:, None]) / np.sqrt(there * (share * (1 - share))[:, None])
    kept = (have >= least_texts) & (z.max(axis=0) >= least_z)
    parts = [(f[kept[f]], s, 1 / np.sqrt(max(1, len(f)))) for f, s in rows]
    del rows, have, high, z
    used, flat = np.unique(np.concatenate([x for f, s, _ in parts for x in (f, s)]), return_inverse=True)
    owner = np.repeat(np.arange(len(parts)), [len(f) + SHAPES for f, _, _ in parts])
    value = np.concatenate([np.r_[np.full(len(f), scale), np.ones(SHAPES)] for f, _, scale in parts])
    shape = used >= dimensions
    pace = np.where(shape, 0.1, 1.0)
    w, t = np.zeros(len(used)), -np.log(share / (1 - share))
    m, v, pull = np.zeros(len(used)), np.zeros(len(used)), np.zeros(top)
    for step in range(1, steps + 1):
        score = np.bincount(owner, w[flat] * value, len(parts))
        gap = (1 / (1 + np.exp(-np.clip(score[:, None] - t[None, :], -30, 30))) - above) / len(parts)
        slope = np.bincount(flat, gap.sum(axis=1)[owner] * value, len(used))
        m += 0.1 * (slope - m)
        v += 0.01 * (slope**2 - v)
        w -= rate / step**0.25 * pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-12)
        pull = 0.9 * pull + gap.sum(axis=0)
        t = np.sort(t + 0.2 * pull)
    weights = np.zeros(dimensions + SHAPES * BANDS)
    weights[used] = w
    return CumulativeLink(weights.astype(np.float32), t)


def rated_sample(docs: DataFrame, ratings: DataFrame, most: int) -> DataFrame:
    """The features of at most ``most`` rated documents (words, shape, grade), chosen by a hash of doc_id;
    of rows with the same doc_id the smallest text counts, and of its ratings the highest. ratings: doc_id, grade."""
    chosen = ratings.select("doc_id", "grade").where("doc_id IS NOT NULL AND grade IS NOT NULL").groupBy("doc_id").agg(F.max("grade").alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("grade").cast("int").alias("grade"))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = features(batch["text"], DIMENSIONS)
            yield pd.DataFrame({"words": [w for w, _ in rows], "shape": [s for _, s in rows], "grade": batch["grade"]})

    return texts.mapInPandas(hashed, "words array<int>, shape array<int>, grade int")


def fit_rated(docs: DataFrame, ratings: DataFrame, most: int) -> CumulativeLink | None:
    """The model of the rated sample, of which the driver gets hashed features, no texts. None if its ratings
    are of one grade only."""
    small_batches(docs.sparkSession)
    parts = rated_sample(docs, ratings, most).toArrow()
    grades = parts["grade"].to_numpy()
    if len(np.unique(grades)) < 2:
        return None
    words, shapes = (parts[name].combine_chunks() for name in ("words", "shape"))
    rows = [(words[i].values.to_numpy(), shapes[i].values.to_numpy()) for i in range(len(grades))]
    return fitted(rows, grades)


def graded(model: CumulativeLink, text: Column) -> Column:
    """A struct (expected, tails) for each text."""
    shared = model.weights, model.thresholds

    @F.pandas_udf("expected double, tails array<double>")
    def score(batch: pd.Series) -> pd.DataFrame:
        tails = CumulativeLink(*shared).tails(batch)
        return pd.DataFrame({"expected": tails.sum(axis=1), "tails": list(tails)})

    return score(text)
