"""Landed sitemaps to lists of addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.sources.rounds import checkpointed


def _blocks(xml: Column, name: str) -> Column:
    return F.regexp_extract_all(xml, F.lit(rf"(?is)<(?:\w+:)?{name}(?:\s[^>]*)?>(.*?)</(?:\w+:)?{name}\s*>"), F.lit(1))


def _address(block: Column) -> Column:
    text = F.btrim(F.regexp_extract(block, r"(?is)<(?:\w+:)?loc(?:\s[^>]*)?>(?:\s*<!\[CDATA\[)?(.*?)(?:\]\]>\s*)?</(?:\w+:)?loc\s*>", 1), F.lit(" \t\r\n"))
    for entity, shown in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(shown))
    return F.nullif(text, F.lit(""))


def sitemap_links(docs: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """(url, is_index, loc), a row for each address of each sitemap, repeated ones included: of a sitemap index those of
    its sitemaps, whatever else it holds, otherwise those of its pages."""
    maps = _blocks(c := F.col(xml), "sitemap")
    is_index = F.size(maps) > 0
    parts = F.when(is_index, maps).otherwise(_blocks(c, "url"))
    each = docs.where(c.isNotNull()).select(F.col(url).alias("url"), is_index.alias("is_index"), F.explode(parts).alias("part"))
    return each.select("url", "is_index", _address(F.col("part")).alias("loc")).where("loc IS NOT NULL")


def expand_sitemaps(docs: DataFrame, roots: DataFrame, url: str = "url", xml: str = "xml") -> DataFrame:
    """docs: landed sitemaps, one for each address; roots: root, the first sitemap of each site. Returns (root,
    urls_count, urls): all page addresses that are reached through sitemap indexes, sorted and distinct, and
    their number before that. Each sitemap counts once for a root, so that loops end; sitemaps that were not landed and
    roots without pages have none: such roots have no row. Each round follows the indexes of one more level."""
    links = checkpointed(sitemap_links(docs, url, xml))
    below = links.where("is_index").select("url", F.col("loc").alias("next")).distinct()
    frontier = checkpointed(roots.select("root", F.col("root").alias("url")).where("root IS NOT NULL").distinct())
    seen = frontier
    while not frontier.isEmpty():
        reached = frontier.join(below, "url").select("root", F.col("next").alias("url")).distinct()
        frontier = checkpointed(reached.join(seen, ["root", "url"], "left_anti"))
        seen = checkpointed(seen.unionByName(frontier))
    pages = seen.join(links.where("NOT is_index"), "url")
    # An address's repetitions are counted before the list is made.
    counted = pages.groupBy("root", "loc").agg(F.count("*").alias("n"))
    return counted.groupBy("root").agg(F.sum("n").alias("urls_count"), F.array_sort(F.collect_list("loc")).alias("urls"))
