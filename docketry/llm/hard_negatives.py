"""Hard negatives from Hilbert-ordered blocks with zone maps.

Vectors are put in the order of a Hilbert curve through their most spread dimensions and stored as Parquet rows of a
block of vectors each, with the least and greatest value of every dimension and the labels of the block. Anchors, in
the same order, are groups of bounded size. A search has asks: an anchor, a window of scores, and whether labels
must be equal. Interval arithmetic over a block's zone map bounds the scores that an anchor can have there; a group
reads the blocks in which one of its asks can be met, and no others. Each anchor's own block, which is read first of all,
gives a lower end to its windows, so that the bounds of other blocks have something to fall short of.

All that a task holds at a time is a group, a block or a page of zone maps, each of bounded size, and the
best candidates of the groups that it has met, which are handed on when they become many.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.store import shuffle_width, stored


@dataclass(frozen=True)
class Sizes:
    """Vectors in a block, anchors in a group, zone maps in a page on average, scores that an anchor keeps of its own
    block, candidates that a task holds before it sorts out the best."""

    block: int = 512
    group: int = 128
    page: int = 128
    seen: int = 64
    held: int = 400_000


KEY_DIMENSIONS, KEY_BITS = 15, 4
LEAST, MOST = -(1 << 62), 1 << 62


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of cells (rows of coordinates below 2**bits); coordinates x bits is at most 63."""
    x = [c.astype(np.int64) for c in cells.T]
    step = 1 << (bits - 1)
    while step > 1:
        low = step - 1
        for i in range(len(x)):
            high = (x[i] & step) != 0
            turn = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ turn)
            if i:
                x[i] = x[i] ^ turn
        step >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    flip, step = np.zeros_like(x[0]), 1 << (bits - 1)
    while step > 1:
        flip = np.where((x[-1] & step) != 0, flip ^ (step - 1), flip)
        step >>= 1
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for c in x:
            key = (key << 1) | (((c ^ flip) >> bit) & 1)
    return key


def _matrix(vectors: list) -> np.ndarray:
    """Vectors as rows; shorter ones end with zeros."""
    sizes = np.array([len(v) for v in vectors])
    found = np.zeros((len(vectors), int(sizes.max(initial=0))), np.int64)
    if len(vectors):
        found[np.arange(found.shape[1]) < sizes[:, None]] = np.concatenate(vectors)
    return found


def _packed(matrix: np.ndarray) -> tuple[bytes, int]:
    """The numbers in as few bytes each as hold all of them."""
    for kind in (np.int16, np.int32):
        if not matrix.size or np.iinfo(kind).min <= matrix.min() and matrix.max() <= np.iinfo(kind).max:
            return matrix.astype(kind).tobytes(), kind(0).nbytes
    return matrix.tobytes(), 8


def _unpacked(packed: bytes, width: int, rows: int) -> np.ndarray:
    return np.frombuffer(packed, {2: np.int16, 4: np.int32, 8: np.int64}[width]).reshape(rows, -1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with those of b; a product beyond a long is an error."""
    d = min(a.shape[1], b.shape[1])
    a, b = a[:, :d], b[:, :d]
    top = (int(np.abs(a.astype(object)).max()) if a.dtype == np.int64 and a.size else int(np.abs(a.astype(np.int64)).max(initial=0))) * (
        int(np.abs(b.astype(object)).max()) if b.dtype == np.int64 and b.size else int(np.abs(b.astype(np.int64)).max(initial=0))
    )
    if top * d < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return (a.astype(object) @ b.T.astype(object)).astype(np.int64)


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product that each anchor can have with vectors between low and high, rows of one
    block each, rounded outwards."""
    d = min(anchors.shape[1], low.shape[1])
    a, low, high = anchors[:, :d].astype(float), low[:, :d].astype(float), high[:, :d].astype(float)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    slack = (np.abs(a) @ np.maximum(np.abs(low), np.abs(high)).T) * (d + 2) * 2.0**-50
    slack[slack < 0.25] = 0  # the terms are whole numbers and their sums exact
    return least - slack, most + slack


_BLOCK = "block long, n int, width int, ids array<long>, labels array<long>, vectors binary, dimensions int, low array<long>, high array<long>, kinds array<long>, anchors array<int>"


def _blocks(size: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            held.append(batch[["vec_id", "label", "vector", "anchor"]])
            if sum(map(len, held)) >= size:
                rows = pd.concat(held)
                full = len(rows) // size * size
                for at in range(0, full, size):
                    yield _block(rows.iloc[at : at + size])
                held = [rows.iloc[full:]]
        if sum(map(len, held)):
            yield _block(pd.concat(held))

    return run


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    matrix = _matrix(rows["vector"].tolist())
    packed, width = _packed(matrix)
    ids, labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
    return pd.DataFrame(
        {
            "block": [ids.min()],
            "n": [len(ids)],
            "width": [width],
            "ids": [ids],
            "labels": [labels],
            "vectors": [packed],
            "dimensions": [matrix.shape[1]],
            "low": [matrix.min(axis=0)],
            "high": [matrix.max(axis=0)],
            "kinds": [np.unique(labels)],
            "anchors": [np.flatnonzero(rows["anchor"].to_numpy(bool)).astype(np.int32)],
        }
    )


def in_blocks(vectors: DataFrame, size: int = Sizes.block) -> DataFrame:
    """vectors: vec_id long, label long, vector array<long>, anchor boolean, one row for each vec_id. Stored in blocks
    along the curve; a block is named by its least vec_id."""

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, list[float]] = {}
        for batch in batches:
            if len(batch):
                m = _matrix(batch["vector"].tolist()).astype(float)
                for k, own in enumerate(zip(m.min(axis=0), m.max(axis=0), m.sum(axis=0), (m * m).sum(axis=0), strict=True)):
                    low, high, total, square, n = found.get(k, [own[0], own[1], 0.0, 0.0, 0])
                    found[k] = [min(low, own[0]), max(high, own[1]), total + own[2], square + own[3], n + len(m)]
        yield pd.DataFrame([(k, *x) for k, x in found.items()], columns=["k", "low", "high", "total", "square", "n"])

    plain = vectors.select("vec_id", "label", "vector", "anchor")
    each = plain.select("vector").mapInPandas(spread, "k int, low double, high double, total double, square double, n long")
    total = each.groupBy("k").agg(F.min("low").alias("low"), F.max("high").alias("high"), (F.sum("square") / F.sum("n") - F.pow(F.sum("total") / F.sum("n"), 2)).alias("spread"))
    # A row for each dimension at most, whatever the number of vectors.
    found = total.orderBy(F.desc("spread"), "k").limit(KEY_DIMENSIONS).collect()
    dims, low = np.array([r["k"] for r in found], int), np.array([r["low"] for r in found])
    width = np.array([max(r["high"] - r["low"], 1.0) for r in found])

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            m = _matrix(batch["vector"].tolist())
            m = np.pad(m, ((0, 0), (0, max(0, int(dims.max(initial=-1)) + 1 - m.shape[1]))))
            cells = np.floor((m[:, dims] - low) / width * (1 << KEY_BITS)).clip(0, (1 << KEY_BITS) - 1).astype(np.int64)
            batch["key"] = hilbert_keys(cells, KEY_BITS) if len(dims) else 0
            yield batch

    along = plain.mapInPandas(keyed, "vec_id long, label long, vector array<long>, anchor boolean, key long")
    ordered = along.repartitionByRange(shuffle_width(vectors.sparkSession), "key", "vec_id").sortWithinPartitions("key", "vec_id")
    return stored(ordered.mapInPandas(_blocks(size), _BLOCK), "blocks")


_GROUP = "group long, n int, width int, ids array<long>, labels array<long>, vectors binary, floor array<long>, seen array<array<long>>"


def _groups(positives: int, sizes: Sizes) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Groups of anchors; of each, from its own block: the score that its positives reach at least (floor) and the
    best scores of other labels."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            for row in batch[[len(x) > 0 for x in batch["anchors"]]].itertuples():
                matrix, labels = _unpacked(row.vectors, row.width, row.n), np.asarray(row.labels)
                scores = products(matrix[row.anchors], matrix)
                for k, own in zip(row.anchors, scores, strict=True):
                    same = np.delete(own, k)[np.delete(labels, k) == labels[k]]
                    other = -np.sort(-own[labels != labels[k]])[: sizes.seen]
                    held.append((int(row.ids[k]), int(labels[k]), matrix[k], int(-np.sort(-same)[positives - 1]) if len(same) >= positives else LEAST, other))
                while len(held) >= sizes.group:
                    yield _group(held[: sizes.group])
                    held = held[sizes.group :]
        if held:
            yield _group(held)

    return run


def _group(held: list[tuple]) -> pd.DataFrame:
    ids, labels, vectors, floor, seen = zip(*held, strict=True)
    packed, width = _packed(_matrix(list(vectors)))
    return pd.DataFrame({"group": [min(ids)], "n": [len(ids)], "width": [width], "ids": [ids], "labels": [labels], "vectors": [packed], "floor": [floor], "seen": [list(seen)]})


_ASKS = "group long, n int, width int, ids array<long>, labels array<long>, vectors binary, of array<int>, ask array<int>, low array<long>, high array<long>"


def _first_asks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each anchor: equal labels, any score that its positives can have."""
    for batch in batches:
        own = batch.drop(columns=["floor"])
        own["of"], own["ask"] = [np.arange(n) for n in batch["n"]], [np.zeros(n, int) for n in batch["n"]]
        own["low"], own["high"] = batch["floor"], [np.full(n, MOST) for n in batch["n"]]
        yield own


def _window_asks(negatives: int, low_percent: int, high_percent: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Of each anchor and positive: other labels, scores in the window."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            asks = []
            for ids, seen, met in zip(batch["ids"], batch["seen"], batch["met"], strict=True):
                place, own = {int(x): k for k, x in enumerate(ids)}, []
                for x in met:
                    k, score = place[x["anchor_id"]], int(x["score"])
                    low, high = -(-low_percent * score // 100), high_percent * score // 100
                    at = int(np.searchsorted(-np.asarray(seen[k]), -high)) + negatives - 1
                    low = max(low, int(seen[k][at])) if at < len(seen[k]) else low
                    if low <= high:
                        own.append((k, int(x["place"]), max(low, LEAST), min(high, MOST)))
                asks.append(sorted(own))
            own = batch[["group", "n", "width", "ids", "labels", "vectors"]].copy()
            for j, name in enumerate(("of", "ask", "low", "high")):
                own[name] = [[x[j] for x in a] for a in asks]
            yield own[[len(a) > 0 for a in asks]]

    return run


def _chosen(same: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The blocks of a page of zone maps that a group has to read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                least, most = bounds(_unpacked(row.vectors, row.width, row.n), _matrix([z["low"] for z in row.zones]), _matrix([z["high"] for z in row.zones]))
                kinds = [np.asarray(z["kinds"]) for z in row.zones]
                labels = np.asarray(row.labels)
                fits = np.stack([np.isin(labels, k) if same else (len(k) > 1) | (labels != k[0]) for k in kinds], axis=1)
                of = np.asarray(row.of)
                met = fits[of] & (most[of] >= np.asarray(row.low)[:, None]) & (least[of] <= np.asarray(row.high)[:, None])
                blocks = [z["block"] for z, x in zip(row.zones, met.any(axis=0), strict=True) if x]
                yield pd.DataFrame({"group": row.group, "block": pd.Series(blocks, dtype="int64")})

    return run


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    found = found.sort_values(["anchor_id", "ask", "score", "vec_id"], ascending=[True, True, False, True], kind="stable")
    return found[found.groupby(["anchor_id", "ask"]).cumcount() < k]


def _scored(same: bool, k: int, most_held: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """The best k rows of each ask among the blocks of this task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            for row in batch.itertuples():
                scores = products(_unpacked(row.vectors, row.width, row.n), _unpacked(row.of_vectors, row.of_width, row.of_n))
                of, low, high = np.asarray(row.of), np.asarray(row.low), np.asarray(row.high)
                # An anchor's asks lie side by side.
                first = np.searchsorted(of, np.arange(row.n))
                count = np.searchsorted(of, np.arange(row.n), "right") - first
                least, most = np.full(row.n, MOST), np.full(row.n, LEAST)
                np.minimum.at(least, of, low)
                np.maximum.at(most, of, high)
                ids, others = np.asarray(row.ids), np.asarray(row.of_ids)
                equal = np.asarray(row.labels)[:, None] == np.asarray(row.of_labels)
                a, b = np.nonzero((scores >= least[:, None]) & (scores <= most[:, None]) & (equal & (ids[:, None] != others) if same else ~equal))
                ask = np.repeat(first[a], count[a]) + np.arange(count[a].sum()) - np.repeat(np.cumsum(count[a]) - count[a], count[a])
                a, b = np.repeat(a, count[a]), np.repeat(b, count[a])
                score = scores[a, b]
                fits = (score >= low[ask]) & (score <= high[ask])
                found = pd.DataFrame({"group": row.group, "anchor_id": ids[a[fits]], "ask": np.asarray(row.ask)[ask[fits]], "score": score[fits], "vec_id": others[b[fits]]})
                held.append(_best(found, k))
                size += len(held[-1])
            if size > most_held:
                held = [_best(pd.concat(held), k)]
                size = len(held[0])
                if 2 * size > most_held:
                    yield held.pop()
                    size = 0
        if held:
            yield _best(pd.concat(held), k)

    return run


def _searched(asks: DataFrame, blocks: DataFrame, pages: DataFrame, n_pages: int, same: bool, k: int, sizes: Sizes) -> DataFrame:
    """(group, anchor_id, ask, place, score, vec_id): the best k rows of each ask, places from 1."""
    asks = stored(asks, "asks")
    wanted = asks.select("group", "n", "width", "labels", "vectors", "of", "low", "high", F.explode(F.sequence(F.lit(0), F.lit(n_pages - 1))).alias("page"))
    chosen = wanted.join(pages, "page").mapInPandas(_chosen(same), "group long, block long")
    read = blocks.select("block", *(F.col(x).alias(f"of_{x}") for x in ("n", "width", "ids", "labels", "vectors")))
    met = chosen.join(asks, "group").join(read, "block")
    found = met.mapInPandas(_scored(same, k, sizes.held), "group long, anchor_id long, ask int, score long, vec_id long")
    order = Window.partitionBy("anchor_id", "ask").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def hard_negatives(vectors: DataFrame, positives: int = 5, negatives: int = 3, low_percent: int = 50, high_percent: int = 95, sizes: Sizes = Sizes()) -> DataFrame:
    """vectors: vec_id, label (whole numbers), vector array<long>, anchor boolean; further columns are not read.

    Returns (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for each anchor and each of its
    first ``positives`` other rows of the same label, the first ``negatives`` rows of other labels whose score is at
    least low_percent and at most high_percent hundredths of the positive's. A score is an exact inner product; higher
    ones come first, ties by vec_id. An anchor without positives, or a positive without negatives, has no row.

    Rows with a null vec_id, label, vector or component take no part, nor does the null anchor mark make an anchor. Of rows
    with the same vec_id the one of least label and vector counts. Shorter vectors end with zeros. Empty tables give no
    rows. A score beyond a long is an error."""
    own = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<long>"), F.coalesce("anchor", F.lit(False)).alias("anchor"))
    own = own.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND NOT exists(vector, x -> x IS NULL)")
    own = own.groupBy("vec_id").agg(F.min(F.struct("label", "vector", "anchor")).alias("x")).select("vec_id", "x.*")
    blocks = in_blocks(own, sizes.block)
    n_pages = max(1, -(-blocks.count() // sizes.page))
    zones = blocks.select(F.pmod(F.xxhash64("block"), F.lit(n_pages)).cast("int").alias("page"), F.struct("block", "low", "high", "kinds").alias("zone"))
    pages = stored(zones.groupBy("page").agg(F.collect_list("zone").alias("zones")), "zones")
    groups = stored(blocks.select("n", "width", "ids", "labels", "vectors", "anchors").mapInPandas(_groups(positives, sizes), _GROUP), "groups")
    first = _searched(groups.drop("seen").mapInPandas(_first_asks, _ASKS), blocks, pages, n_pages, True, positives, sizes)
    first = stored(first.select("group", "anchor_id", "place", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "positives")
    met = first.groupBy("group").agg(F.collect_list(F.struct("anchor_id", "place", F.col("positive_score").alias("score"))).alias("met"))
    asks = groups.drop("floor").join(met, "group").mapInPandas(_window_asks(negatives, low_percent, high_percent), _ASKS)
    second = _searched(asks, blocks, pages, n_pages, False, negatives, sizes)
    second = second.select("anchor_id", F.col("ask").alias("place"), F.col("place").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return second.join(first.drop("group"), ["anchor_id", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
