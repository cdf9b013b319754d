"""MinHash near-duplicates by an LSH forest.

Each document's 5-word shingles give minwise values; a tree is an order of the documents by its own run of
these values. Documents that agree on a tree's first ``DEPTH`` values form a region. Spark sorts all trees at
once, by ranges, so that a large region lies over many tasks; a task walks its stretch of the order once. The
candidates of a document are its neighbour of longest common prefix and the first document of its block: the
deepest prefix that is needed for a block of at most BLOCK documents, so depth follows the region's size.

The likeliest candidates of each document, by the lengths of the common prefixes over all trees, are confirmed
on full shingle sets, and these links give components. Regions that hold more than one component are left,
mostly since documents are alike but not enough; what can be alike across their components is found exactly by
rarest shingles, so that no pair which shares a region is left out. With 32 trees of depth 4 a pair of likeness
0.75 shares none with a chance of about 5 in a million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.components import components
from docketry.llm.store import free_name, small_batches, stored
from docketry.llm.wordhash import U, mix, shingle_sets, utf8

TREES, DEPTH, BLOCK, LIKELIEST = 32, 4, 64, 4
_FACTOR = (mix(np.arange(1, TREES * DEPTH + 1, dtype=U)) >> U(32)).astype(np.uint32) | np.uint32(1)


def minwise(shingles: np.ndarray) -> np.ndarray:
    """TREES * DEPTH minwise values of a set that isn't empty."""
    x = (shingles >> U(32)).astype(np.uint32)
    least = np.full(len(_FACTOR), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        np.minimum(least, np.multiply.outer(_FACTOR, x[i : i + 2048]).min(axis=1), out=least)
    return least


def _signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    tree = mix(np.arange(7001, 7001 + TREES, dtype=U))
    for batch in batches:
        rows = []
        for doc_id, version, s in zip(batch["doc_id"], batch["version"], shingle_sets(utf8(batch["text"])), strict=True):
            if not len(s):
                rows.append((doc_id, version, 0, 0, 0, None, None))
                continue
            values = minwise(s).reshape(TREES, DEPTH).astype(U)
            key = tree.copy()
            for d in range(DEPTH):
                key = mix(key + values[:, d])
            # A byte of each of the next tree's values: the order below DEPTH.
            deeper = np.ascontiguousarray(np.roll(values, -1, axis=0).astype(np.uint8)[:, :4]).view(">i4").ravel().astype(np.int32)
            rows.append((doc_id, version, len(s), int(s.sum(dtype=U).view(np.int64)), int(mix(s).sum(dtype=U).view(np.int64)), key.view(np.int64), deeper))
        yield pd.DataFrame(rows, columns=["doc_id", "version", "n_shingles", "d1", "d2", "regions", "deeper"])


def _heads(region: np.ndarray, deeper: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place of a sorted stretch the place of its block's first document (for that one itself, of its
    region's first), the length of the prefix that they have in common at least, and of that with the place before."""
    place = np.arange(len(region))
    new = np.r_[True, region[1:] != region[:-1]]
    differ = np.r_[np.uint32(0), deeper.view(np.uint32)[1:] ^ deeper.view(np.uint32)[:-1]]
    head, common, with_before, open_ = place.copy(), np.full(len(region), DEPTH), np.full(len(region), DEPTH), np.ones(len(region), bool)
    for depth in range(5):
        starts = new if depth == 0 else new | (differ >> np.uint32(32 - 8 * depth) != 0)
        run = np.cumsum(starts) - 1
        first = np.flatnonzero(starts)[run]
        if depth == 0:
            regions = first
        fits = open_ & ((np.bincount(run)[run] <= BLOCK) | (depth == 4))
        # Equal in all values and still many: blocks by place.
        head[fits] = (first + (place - first) // BLOCK * BLOCK)[fits]
        common[fits] = DEPTH + depth
        with_before[~starts] = DEPTH + depth
        open_ &= ~fits
    own = head == place
    return np.where(own, regions, head), np.where(own, DEPTH, common), with_before


_NEIGHBOURS = "region long, doc_id long, before long, before_common int, head long, head_common int"


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted rows (region, deeper, doc_id) of one task: those that share their region, with the document
    before and the head (the document itself where there is none) and the lengths of the common prefixes. The
    first and the last row of the task are kept in any case, as their region may go on in another task."""
    held, first = None, True
    for batch in batches:
        if held is not None:
            batch = pd.concat([held, batch], ignore_index=True)
        if len(batch) < 2:
            held = batch if len(batch) else held
            continue
        region, doc = batch["region"].to_numpy(), batch["doc_id"].to_numpy()
        same = np.r_[False, region[1:] == region[:-1]]
        head, common, with_before = _heads(region, batch["deeper"].to_numpy())
        kept = same | np.r_[same[1:], True]
        # The row held from the batch before is there already.
        kept[0] = first
        before = np.where(same, np.r_[doc[:1], doc[:-1]], doc)
        yield pd.DataFrame({"region": region, "doc_id": doc, "before": before, "before_common": with_before, "head": doc[head], "head_common": common})[kept]
        held, first = batch[-1:], False
    if held is not None and first:
        doc = held["doc_id"]
        yield pd.DataFrame({"region": held["region"], "doc_id": doc, "before": doc, "before_common": 0, "head": doc, "head_common": 0})


def _alike(threshold: int):
    @F.pandas_udf("boolean")
    def alike(left: pd.Series, right: pd.Series) -> pd.Series:
        a, b = shingle_sets(utf8(left)), shingle_sets(utf8(right))
        found = []
        for x, y in zip(a, b, strict=True):
            if 100 * min(len(x), len(y)) < threshold * max(len(x), len(y)):
                found.append(False)
                continue
            both = len(np.intersect1d(x, y, assume_unique=True))
            found.append(bool(both) and 100 * both >= threshold * (len(x) + len(y) - both))
        return pd.Series(found, dtype=bool)

    return alike


def _confirmed(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """pairs (a, b) whose full sets are alike."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("left_text"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("right_text"))
    return pairs.join(left, "a").join(right, "b").where(_alike(threshold)("left_text", "right_text")).select("a", "b")


def near_duplicates(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """docs: doc_id, text and any others. Returns (doc_id, n_shingles, component_id, kept), a row for each
    distinct doc_id; rows without doc_id are left out, null and blank texts are linked with nothing, of rows
    with the same doc_id one counts (the smallest set, ties by a hash). An empty table gives an empty result.

    threshold: least likeness, in hundredths. Documents with equal sets form a class; only its smallest
    doc_id enters the forest."""
    small_batches(docs.sparkSession)
    version = F.xxhash64(F.coalesce("text", F.lit("")))
    plain = docs.where("doc_id IS NOT NULL").select("doc_id", "text", version.alias("version"))
    schema = "doc_id long, version long, n_shingles long, d1 long, d2 long, regions array<long>, deeper array<int>"
    signed = stored(plain.mapInPandas(_signatures, schema), "minhash")
    one = signed.groupBy("doc_id").agg(F.min(F.struct("n_shingles", "d1", "d2", "version")).alias("s")).select("doc_id", "s.*")
    classes = one.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min(F.struct("doc_id", "version")).alias("s"), F.count("*").alias("members"))
    classes = stored(classes.select("n_shingles", "d1", "d2", F.col("s.doc_id").alias("class_id"), "s.version", "members"), "classes")
    placed = (
        signed.join(classes.select(F.col("class_id").alias("doc_id"), "version"), ["doc_id", "version"], "left_semi")
        .select("doc_id", F.explode(F.arrays_zip("regions", "deeper")).alias("x"))
        .select(F.col("x.regions").alias("region"), F.col("x.deeper").alias("deeper"), "doc_id")
    )
    order = ["region", "deeper", "doc_id"]
    members = stored(placed.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_neighbours, _NEIGHBOURS), "orders")
    chosen = members.select("doc_id").distinct().join(classes.select(F.col("class_id").alias("doc_id"), "version"), "doc_id")
    texts = stored(plain.join(chosen, ["doc_id", "version"], "left_semi").groupBy("doc_id").agg(F.first("text").alias("text")), "candidates")

    proposed = F.explode(F.array(F.struct(F.col("before").alias("other"), F.col("before_common").alias("common")), F.struct(F.col("head").alias("other"), F.col("head_common").alias("common"))))
    near = members.select("doc_id", proposed.alias("x")).select("doc_id", "x.*").where("doc_id <> other").repartition("doc_id").groupBy("doc_id", "other").agg(F.sum("common").alias("common"))
    near = stored(near, "neighbours")
    # At most two for each tree come together here.
    best = near.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct(-F.col("common"), "other"))).alias("x")).select("doc_id", F.explode(F.slice("x", 1, LIKELIEST)).alias("x"))
    best = stored(best.select(F.greatest("doc_id", "x.other").alias("a"), F.least("doc_id", "x.other").alias("b")).distinct(), "likeliest")
    links = stored(_confirmed(best, texts, threshold), "links")
    # Then all other candidates of documents that these links leave in different components.
    linked = components(links)
    rest = _across(near.select(F.greatest("doc_id", "other").alias("a"), F.least("doc_id", "other").alias("b")).distinct(), linked).join(best, ["a", "b"], "left_anti")
    more = _confirmed(stored(rest, "rest"), texts, threshold)
    # The stars found so far stand for their links.
    found = components(linked.toDF("a", "b").unionByName(more))
    # Regions of more than one component.
    member = members.select("region", "doc_id").join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("region", "doc_id", F.coalesce("component", "doc_id").alias("component"))
    mixed = member.groupBy("region").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("region")
    apart = stored(member.join(mixed, "region", "left_semi").select("doc_id", "component").distinct(), "apart")
    met = _confirmed(stored(_by_rare_shingles(apart, texts, threshold), "met"), texts, threshold)
    for end in ("a", "b"):
        met = met.join(apart.withColumnRenamed("doc_id", end), end).withColumnRenamed("component", f"{end}_in")
    joined = components(met.select(F.col("a_in").alias("a"), F.col("b_in").alias("b")))
    classed = one.join(classes.where("members > 1").drop("version", "members"), ["n_shingles", "d1", "d2"], "left")
    classed = classed.withColumn("node", F.coalesce("class_id", "doc_id")).join(found, "node", "left")
    classed = classed.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("node")).join(joined, "node", "left")
    component = F.coalesce("component", "node")
    return classed.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def _across(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """pairs (a, b) whose ends are in different components."""
    for end in ("a", "b"):
        pairs = pairs.join(found.select(F.col("node").alias(end), F.col("component").alias(f"{end}_in")), end, "left").withColumn(f"{end}_in", F.coalesce(f"{end}_in", end))
    return pairs.where("a_in <> b_in").select("a", "b")


def _by_rare_shingles(apart: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) of ``apart`` in different components that can still be alike, by necessary conditions
    only: with the shingles of each set in order of rarity, two alike sets share one among the first few,
    and what follows its first place must suffice for the overlap that they need."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "shingles": [s.view(np.int64) for s in shingle_sets(utf8(batch["text"]))]})

    each = texts.join(apart, "doc_id", "left_semi").select("doc_id", "text").mapInPandas(sets, "doc_id long, shingles array<long>")
    each = stored(each, "sets").select("doc_id", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    common = each.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = stored(
        each.join(common, "shingle")
        .groupBy("doc_id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
        # Shingles of no other set come first of all.
        .withColumn("alone", F.col("n") - F.size("shared")),
        "ranked",
    )
    probing = F.col("n") - F.ceil(F.col("n") * threshold / 100) + 1
    held = F.col("n") - F.ceil(F.col("n") * 2 * threshold / (100 + threshold)) + 1

    def first(length) -> DataFrame:
        cut = ranked.join(apart, "doc_id").withColumn("shared", F.slice("shared", 1, F.greatest(F.lit(0), (length - F.col("alone")).cast("int"))))
        return cut.select("doc_id", "component", "n", "alone", F.posexplode("shared").alias("at", "x")).select(
            F.col("x.shingle").alias("shingle"), "doc_id", "component", "n", (F.col("alone") + F.col("at")).alias("at")
        )

    x = first(probing)
    y = first(held).select("shingle", F.col("doc_id").alias("doc_y"), F.col("component").alias("component_y"), F.col("n").alias("n_y"), F.col("at").alias("at_y"))
    smaller = (F.col("n_y") < F.col("n")) | ((F.col("n_y") == F.col("n")) & (F.col("doc_y") < F.col("doc_id")))
    enough = (100 + threshold) * F.least(F.col("n") - F.col("at"), F.col("n_y") - F.col("at_y")) >= threshold * (F.col("n") + F.col("n_y"))
    met = x.join(y, (x["shingle"] == y["shingle"]) & (F.col("component") != F.col("component_y")) & smaller & enough)
    return met.select(F.greatest("doc_id", "doc_y").alias("a"), F.least("doc_id", "doc_y").alias("b")).distinct()


def keep_one(docs: DataFrame, threshold: int = 75) -> DataFrame:
    """docs without all but the smallest doc_id of each component; all columns stay. Of rows with the same
    doc_id the one with the smallest text stays (null first; ties: either). Rows without doc_id can't be told
    apart and all stay."""
    kept = near_duplicates(docs, threshold).where("kept").select("doc_id")
    mine = free_name("rank", docs.columns)
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.col("text").asc_nulls_first()))
    unique = docs.join(kept, "doc_id", "left_semi").withColumn(mine, first).where(F.col(mine) == 1).select(*docs.columns)
    return unique.unionByName(docs.where("doc_id IS NULL"))
