"""Table changes as snapshots: each returns the new state of the target."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.functions.text import word_count


def insert_absent(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the batch whose keys the target lacks, each key once; rows with a null key are skipped."""
    known = batch.dropna(subset=list(keys)).dropDuplicates(list(keys))
    return known.join(target.select(*keys), list(keys), "left_anti")


def _upsert(target: DataFrame, batch: DataFrame, key: str, columns: Sequence[str], keep_old_for_null: bool) -> DataFrame:
    new = batch.select(F.col(key).alias("_key"), *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_matched"))
    joined = target.join(new, target[key] == F.col("_key"), "full_outer")

    def value(c: str):
        if c == key:
            return F.coalesce(target[key], F.col("_key")).alias(key)
        if c not in columns:
            return target[c]
        if keep_old_for_null:
            return F.coalesce(F.col(f"_new_{c}"), target[c]).alias(c)
        return F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(target[c]).alias(c)

    return joined.select(*(value(c) for c in target.columns))


def upsert_keep(target: DataFrame, batch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Non-null values of the batch replace, others leave what was there."""
    return _upsert(target, batch, key, columns, True)


def upsert_replace(target: DataFrame, batch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """All given columns of a matched row are replaced, nulls too."""
    return _upsert(target, batch, key, columns, False)


def replace_children(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """All rows of the batch's keys go, then the batch is added."""
    return target.join(batch.select(key).distinct(), key, "left_anti").unionByName(batch)


def delete_where(df: DataFrame, column: str, value, negate: bool = False) -> DataFrame:
    """What stays after deleting rows whose column equals the value, or with negate does not; nulls equal no value."""
    same = F.col(column).eqNullSafe(F.lit(value))
    return df.where(same if negate else ~same)


def claim(df: DataFrame, status: str = "status") -> DataFrame:
    free = F.col(status).isNull() | ~F.col(status).isin("pass", "in_progress")
    return df.withColumn("claimed", free).withColumn(status, F.when(free, "in_progress").otherwise(F.col(status)))


def touch(target: DataFrame, batch: DataFrame, key: str, start: str = "start", always: Sequence[str] = ("end", "status")) -> DataFrame:
    """Status rows after a step: the start is written only where it is null, the other columns always; keys
    that the target lacks are added. One row a key in the batch."""
    new = batch.select(F.col(key).alias("_key"), F.col(start).alias("_start"), *(F.col(c).alias(f"_new_{c}") for c in always), F.lit(True).alias("_matched"))
    joined = target.join(new, target[key] == F.col("_key"), "full_outer")
    values = {key: F.coalesce(target[key], F.col("_key")), start: F.coalesce(target[start], F.col("_start"))}
    values |= {c: F.when(F.col("_matched"), F.col(f"_new_{c}")).otherwise(target[c]) for c in always}
    return joined.select(*(values.get(c, target[c]).alias(c) for c in target.columns))


def pair_pages(pages: DataFrame, *readings: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every page with what each reader gave for it, null where it gave nothing. One row a page in each."""
    for reading in readings:
        pages = pages.join(reading, list(key), "left")
    return pages


def map_folders(ids: DataFrame, sources: Sequence[tuple[DataFrame, str]], key: str) -> DataFrame:
    """The folder of each id: that of the last of the sources (ids, folder) that holds it; status ``pass``, or
    ``fail_mapping`` for ids of no source."""
    held = [df.select(key, F.struct(F.lit(k).alias("place"), F.lit(folder).alias("folder")).alias("f")) for k, (df, folder) in enumerate(sources)]
    best = functools.reduce(DataFrame.unionByName, held).groupBy(key).agg(F.max("f").alias("f"))
    return ids.join(best, key, "left").select(key, F.col("f.folder").alias("folder"), F.when(F.col("f").isNotNull(), "pass").otherwise("fail_mapping").alias("status"))


def upsert_counts(target: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """target (key, count_char, count_word) with the counts of docs' texts written over."""
    counts = docs.select(key, F.length(text).cast("long").alias("count_char"), word_count(F.col(text)).cast("long").alias("count_word"))
    return upsert_replace(target, counts, key, ["count_char", "count_word"])


def project(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """The configured columns under their new names; a table's alias before a column's name is dropped."""
    return df.select(*(F.col(column.rsplit(".", 1)[-1]).alias(name) for column, name in names.items()))


def one_by_key(df: DataFrame, key: str, *order) -> DataFrame:
    """One row for each key, the first in the order."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return df.withColumn("_place", place).where("_place = 1").drop("_place")
