"""Vectors: pooling, gates and exact nearest neighbours of a bounded query set."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Query vectors that tasks get at once; more are taken in blocks, each a pass over the vectors.
BLOCK_QUERIES = 10_000
#: Rows of either side that a task multiplies at once.
BLOCK_ROWS = 1000


def mean_vector(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Element-wise mean per key, not normalised again."""
    parts = df.select(key, F.posexplode(vector).alias("at", "x")).groupBy(key, "at").agg(F.avg("x").alias("x"))
    ordered = F.array_sort(F.collect_list(F.struct("at", "x")))
    return parts.groupBy(key).agg(F.transform(ordered, lambda s: s["x"]).alias("mean"))


def dim_gate(df: DataFrame, vector: str, dimension: int) -> DataFrame:
    return df.withColumn("indexed", F.coalesce(F.size(vector) == dimension, F.lit(False)))


class Best:
    """The k best of each query so far, by score and then by key, from blocks of scores that come one after the other."""

    def __init__(self, queries: int, k: int):
        self.k, self.least = k, np.full(queries, -np.inf)
        self.query, self.key, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)

    def add(self, keys: np.ndarray, scores: np.ndarray, first: int = 0) -> None:
        """scores: a row for each query from number ``first`` on and a column for each key; not a number: no candidate."""
        ranked, own = np.where(np.isnan(scores), -np.inf, scores), slice(first, first + len(scores))
        if ranked.shape[1] > self.k:
            self.least[own] = np.maximum(self.least[own], np.partition(ranked, -self.k, axis=1)[:, -self.k])
        query, at = np.nonzero((ranked >= self.least[own, None]) & (ranked > -np.inf))
        if not len(query):
            return
        query, key, score = (np.concatenate(x) for x in ((self.query, query + first), (self.key, keys[at]), (self.score, scores[query, at])))
        order = np.lexsort((key, -score, query))
        query, key, score = query[order], key[order], score[order]
        starts = np.flatnonzero(np.diff(query, prepend=-1))
        place = np.arange(len(query)) - np.repeat(starts, np.diff(starts, append=len(query)))
        self.query, self.key, self.score = (x[place < self.k] for x in (query, key, score))
        last = place[place < self.k] == self.k - 1
        self.least[self.query[last]] = np.maximum(self.least[self.query[last]], self.score[last])


def _nearest(wanted: np.ndarray, ids: np.ndarray, key: str, vector: str, k: int):
    """A task over vectors that gives the k of largest cosine for each query. Products of
    ``BLOCK_ROWS`` queries and as many vectors stand in memory at once."""

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = Best(len(ids), k)
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[at : at + BLOCK_ROWS]
                rows = np.array(part[vector].tolist(), np.float64).reshape(len(part), -1)
                if not rows.size:
                    continue
                keys, sizes = part[key].to_numpy(), np.linalg.norm(rows, axis=1)
                rows = (rows / np.where(sizes, sizes, np.nan)[:, None]).T
                for first in range(0, len(ids), BLOCK_ROWS):
                    cosine = np.round(wanted[first : first + BLOCK_ROWS] @ rows, 6)
                    cosine[ids[first : first + BLOCK_ROWS, None] == keys[None, :]] = np.nan
                    best.add(keys, cosine, first)
        yield pd.DataFrame({"query": ids[best.query], key: best.key, "cosine": best.score})

    return near


def knn(queries: DataFrame, vectors: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """The k vectors of largest cosine for each query, itself left out; ties by key. queries are a stated set of
    which a block goes to the tasks at once; a task multiplies a part of it by a part of a batch and keeps its k
    best. Vectors of no length have no neighbours, nor have those of other dimensions than the longest query. Keys are
    integers; rows without one take no part."""
    q = queries.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias(vector))
    v = vectors.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("long").alias(key), F.col(vector).cast("array<double>").alias(vector))
    sized = q.agg(F.count("*").alias("n"), F.max(F.size(vector)).alias("d")).first()
    q, v = (x.where(F.size(vector) == (sized["d"] or 0)) for x in (q, v))
    blocks = max(1, -(-sized["n"] // BLOCK_QUERIES))
    met = []
    for b in range(blocks):
        own = q.where(F.pmod(F.xxhash64(key), F.lit(blocks)) == b).toPandas()
        if len(own):
            wanted = np.array(own[vector].tolist(), np.float64)
            sizes = np.linalg.norm(wanted, axis=1)
            met.append(v.mapInPandas(_nearest(wanted / np.where(sizes, sizes, np.nan)[:, None], own[key].to_numpy(), key, vector, k), f"query long, {key} long, cosine double"))
    if not met:
        return v.sparkSession.createDataFrame([], f"query long, {key} long, cosine double, place int")
    order = Window.partitionBy("query").orderBy(F.col("cosine").desc(), key)
    return functools.reduce(DataFrame.unionByName, met).withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def vector_docs(df: DataFrame, doc_id: Column, doc_type: Column, vector: Column) -> DataFrame:
    """Rows of a vector index."""
    return df.select(doc_id.cast("string").alias("doc_id"), doc_type.alias("doc_type"), vector.alias("vector"))
