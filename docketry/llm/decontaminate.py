"""Benchmark decontamination by a prefix-filtered set join, in DataFrame functions only.

Every 13-word window of a benchmark item must occur whole, so one of its words is a sufficient prefix:
its rarest, by counts over all documents. Documents' words meet these prefix words; position and length
bounds drop windows that would leave the text, and the words of the window are compared in place.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.store import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marks the end of a document's words; no word holds it.
END = "\x00"
#: Windows that are broadcast at once, about 300 bytes each; more are taken in blocks of this size.
BLOCK_WINDOWS = 100_000


def words_of(text: Column) -> Column:
    """Words of a text whose A-Z are lower-cased; null has none. Other capitals stay as they are."""
    plain = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(plain, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def windows(items: DataFrame, size: int) -> DataFrame:
    """(item_id, window, size) of each distinct window; an item of fewer words, but not none, is one."""
    split = items.where("item_id IS NOT NULL").select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return (
        split.select("item_id", "words", F.explode(starts).alias("start"))
        .select("item_id", F.slice("words", F.col("start"), F.lit(size)).alias("window"))
        .distinct()
        .withColumn("size", F.size("window"))
    )


def _prefixed(found: DataFrame, docs: DataFrame) -> DataFrame:
    """Each window with its rarest word (ties: the smaller word) and that word's place in the window."""
    vocabulary = found.select(F.explode("window").alias("word")).distinct()
    counts = docs.select(F.explode(words_of(F.col("text"))).alias("word")).join(F.broadcast(vocabulary), "word").groupBy("word").agg(F.count("*").alias("n"))
    ranked = found.select("item_id", "window", "size", F.posexplode("window").alias("place", "word")).join(counts, "word", "left")
    best = ranked.groupBy("item_id", "window", "size").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("best"))
    return best.select("item_id", "window", "size", F.col("best.word").alias("word"), F.col("best.place").alias("place"))


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, percent: int = 5) -> DataFrame:
    """docs: doc_id, text; items: item_id, text; further columns are not read. Returns, for each distinct
    doc_id that isn't null, doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and items, the
    sorted ids. Null and empty texts have no words and aren't contaminated; of rows with the same doc_id one
    counts, by a hash of its text; no documents give no rows, no items leave all documents clean."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("version")).where("doc_id IS NOT NULL")
    table = stored(windows(items.select("item_id", "text"), size), "windows")
    n = table.count()
    blocks = max(1, -(-n // BLOCK_WINDOWS))
    ended = docs.select("doc_id", "version", words_of(F.col("text")).alias("words")).select(
        "doc_id", "version", "words", F.size("words").alias("n_words"), F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("at", "word")
    )
    nothing = spark.range(1).select(F.lit(None).cast("string").alias("item"), F.lit(None).cast("array<string>").alias("window"), F.lit(0).alias("size"), F.lit(END).alias("word"), F.lit(0).alias("place"))
    parts = []
    for block in range(blocks):
        own = table.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == block)
        prefixed = stored(_prefixed(own, docs), "prefixes").select(F.col("item_id").cast("string").alias("item"), "window", "size", "word", "place")
        known = prefixed.unionByName(nothing)
        start = F.col("at") - F.col("place")
        met = ended.join(
            F.broadcast(known),
            (ended["word"] == known["word"])
            & (F.col("window").isNull() | ((start >= 0) & (start + F.col("size") <= F.col("n_words")) & (F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("size")) == F.col("window")))),
        )
        parts.append(met.select("doc_id", "version", F.col("n_words").cast("long").alias("n_words"), "item", start.alias("start"), "size"))
    met = functools.reduce(DataFrame.unionByName, parts)
    spans = F.array_sort(F.collect_set(F.when(F.col("item").isNotNull(), F.struct("start", "size"))))
    hit = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda have, s: F.struct(
            F.greatest(have["end"], s["start"] + s["size"]).alias("end"),
            (have["n"] + F.greatest(F.lit(0), s["start"] + s["size"] - F.greatest(have["end"], s["start"]))).alias("n"),
        ),
        lambda have: have["n"].cast("long"),
    )
    found = met.groupBy("doc_id", "version").agg(F.max("n_words").alias("n_words"), spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    found = found.groupBy("doc_id").agg(F.min_by(F.struct("n_words", hit.alias("n_hit"), "items"), "version").alias("f")).select("doc_id", "f.*")
    found = found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "items")
    bad = (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", bad.alias("contaminated"), "items")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """docs without the contaminated ones; all columns stay."""
    bad = contamination(docs, items).where("contaminated").select("doc_id")
    return docs.join(bad, "doc_id", "left_anti")
