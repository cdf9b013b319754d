"""Numbering, segments and batches over ordered rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def assign_versions(df: DataFrame) -> DataFrame:
    """df: id, title, start_date, version. In titles of two or more rows, rows without version get the numbers
    after the title's largest, by date and id."""
    title = Window.partitionBy("title")
    order = Window.partitionBy("title", F.col("version").isNull()).orderBy("start_date", "id")
    numbered = df.withColumn("_n", F.count("*").over(title)).withColumn("_most", F.coalesce(F.max("version").over(title), F.lit(0)))
    version = F.coalesce("version", F.col("_most") + F.row_number().over(order)).cast("long")
    return numbered.withColumn("version", version).where("_n > 1").drop("_n", "_most")


def page_windows(df: DataFrame, key: str, page: str, width: int = 3) -> DataFrame:
    """First page of the window in which each page is read, and the pages of the window that ends there."""
    order = Window.partitionBy(key).orderBy(page).rowsBetween(1 - width, 0)
    return df.withColumn("window_start", F.greatest(F.lit(0), F.col(page) - width + 1)).withColumn("pages", F.count("*").over(order))


def segments(df: DataFrame, key: str, position: str, is_head: Column) -> DataFrame:
    """Number of the section of each element: those before the first heading are section 0."""
    return df.withColumn("section", F.sum(is_head.cast("long")).over(Window.partitionBy(key).orderBy(position)))


#: Text of a section that holds none.
NO_TEXT = "[No content]"


def sections(df: DataFrame, key: str, position: str, level: str, text: str, placeholder: str = NO_TEXT) -> DataFrame:
    """Sections of each document's elements (level: 1 to 6 of a heading, else null): each heading of the first level
    starts one; without such, each of the second; without both, all is one. What stands before the first heading is
    a section if it isn't blank. Returns key, section (from 1), body (the elements' texts, a line each; the
    placeholder if they are blank)."""
    whole, order = Window.partitionBy(key), Window.partitionBy(key).orderBy(position)
    head = F.min(F.when(F.col(level) <= 2, F.col(level))).over(whole)
    parts = df.withColumn("_head", F.coalesce(F.col(level) == head, F.lit(False))).withColumn("_part", F.sum(F.col("_head").cast("long")).over(order))
    ordered = F.array_sort(F.collect_list(F.struct(position, text)))
    bodies = parts.groupBy(key, "_part").agg(F.array_join(F.transform(ordered, lambda x: F.coalesce(x[text], F.lit(""))), "\n").alias("body"), F.count_if("_head").alias("_heads"))
    blank = F.btrim("body", F.lit(" \t\r\n")) == ""
    many = F.count("*").over(whole) > 1
    kept = bodies.withColumn("_drop", (F.col("_heads") == 0) & blank & many).where("NOT _drop")
    section = F.row_number().over(Window.partitionBy(key).orderBy("_part")).cast("long")
    return kept.select(key, section.alias("section"), F.when(blank, placeholder).otherwise(F.col("body")).alias("body"))


def anchor_ids(df: DataFrame, key: str, position: str, level: str, anchor: str) -> DataFrame:
    """df of headings with the anchors that they lack: ``section_<n>`` by the place among all of the first level,
    ``section-h<level>-<n>`` by the place among those of a lower level without anchor; anchors that are there stay."""
    there = F.col(anchor).isNotNull() & (F.col(anchor) != "")
    n = F.row_number().over(Window.partitionBy(key, level).orderBy(position))
    missing = F.row_number().over(Window.partitionBy(key, level, there).orderBy(position))
    made = F.when(F.col(level) == 1, F.concat(F.lit("section_"), n)).otherwise(F.concat(F.lit("section-h"), level, F.lit("-"), missing))
    return df.withColumn("_made", F.when(there, F.col(anchor)).otherwise(made)).withColumn(anchor, F.col("_made")).drop("_made")


def promote_levels(df: DataFrame, key: str, level: str) -> DataFrame:
    lift = F.col(level) - F.min(level).over(Window.partitionBy(key)) + 1
    return df.withColumn("promoted", F.least(F.lit(5), F.greatest(F.lit(1), lift)))


def last_n(df: DataFrame, key: str, order: str, n: int = 10) -> DataFrame:
    back = F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))
    return df.withColumn("back", back).where(F.col("back") <= n)


def batch_ids(df: DataFrame, key: str, order: str, size: int) -> DataFrame:
    """Batches of ``size`` rows within each key."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return df.withColumn("batch", F.floor((n - 1) / size))


def nest_headings(df: DataFrame, key: str, position: str, level: str, deepest: int = 6) -> DataFrame:
    """Place of the heading that holds each block: the nearest earlier one of a lower level. Blocks without
    level are text, under the nearest heading; null where there is none. Positions are integers."""
    before = Window.partitionBy(key).orderBy(position).rangeBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(level, F.lit(deepest + 1))
    last = [F.when(own > k, F.max(F.when(F.col(level) == k, F.col(position))).over(before)) for k in range(1, deepest + 1)]
    return df.withColumn("parent", F.greatest(*last))


def match_multiline(df: DataFrame, key: str, position: str, text: str, heading: Column, most: int = 6) -> DataFrame:
    """Lines at which the heading starts, with the number of lines that it takes, joined by spaces."""
    ahead = Window.partitionBy(key).orderBy(position, text).rowsBetween(0, most - 1)
    sizes = F.sequence(F.lit(1), F.size("_lines"))
    found = F.filter(sizes, lambda n: F.array_join(F.slice("_lines", F.lit(1), n), " ") == heading)
    return df.withColumn("_lines", F.collect_list(text).over(ahead)).withColumn("lines", F.get(found, F.lit(0))).where("lines IS NOT NULL").drop("_lines")


def outline(df: DataFrame, key: str, position: str, level: str) -> DataFrame:
    """Top headings, each with the places of the second-level headings up to the next top one."""
    part = F.sum(F.when(F.col(level) == 1, 1).otherwise(0)).over(Window.partitionBy(key).orderBy(position))
    parts = df.where(F.col(level) <= 2).withColumn("_part", part).where("_part > 0")
    nested = F.array_sort(F.collect_list(F.when(F.col(level) == 2, F.col(position))))
    return parts.groupBy(key, "_part").agg(F.min(position).alias("top"), nested.alias("nested")).drop("_part")
