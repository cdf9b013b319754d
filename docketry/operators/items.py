"""Layout items and lines in their order: noise, footnotes, counsel and rules from tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.operators.pages import cleaned

# Tags that are shown, tags whose items are headings, and headings that are no content.
INCLUDED = ["Title", "Subtitle", "Heading", "Heading-h1", "Heading-h2", "Heading-h3", "Heading-h4", "Heading-h5", "Heading-h6", "Paragraph", "Enum", "List", "List-l1", "List-l2", "List-l3", "List-l4", "Table", "Clause", "Endnotes", "Glossary", "Footnote"]
HEADINGS = ["Heading", "Heading-h1", "Heading-h2", "Heading-h3", "Heading-h4", "Heading-h5", "Heading-h6"]
TITLES = ["Title", "Subtitle"]
EMPTY_HEADINGS = ["heading", "headings", "content", "contents", "table of contents", "tables of contents"]
PAGE_LINE = r"^page(\s*no\.?)?(\s*\d+)?\s*$"

c = F.col


def kept_items(items: DataFrame, key: str, place: str, tag: str, content: str, included: list[str] = INCLUDED) -> DataFrame:
    """The items of a document that are shown, with their new place from 1 (``shown_at``): footnotes after all others, else in
    order. A missing tag is a paragraph, a missing content empty. Tables of contents, tags that aren't ``included``
    and headings such as `contents` go; lines such as `page 12`, unless they are titles or headings, are emptied."""
    kind, text = F.coalesce(c(tag), F.lit("Paragraph")), F.coalesce(c(content), F.lit(""))
    bare = F.lower(F.regexp_replace(text, r"(?U)^\s+|\s+$", ""))
    foot = kind == "Footnote"
    shown = foot | ((kind != "Table of Contents") & kind.isin(included) & ~(kind.isin(HEADINGS) & bare.isin(EMPTY_HEADINGS)))
    blank = ~foot & ~kind.isin(HEADINGS + TITLES) & bare.rlike(PAGE_LINE)
    own = items.where(shown).withColumns({tag: kind, content: F.when(blank, "").otherwise(text), "_foot": foot})
    order = Window.partitionBy(key).orderBy("_foot", place)
    return own.withColumn("shown_at", F.row_number().over(order)).drop("_foot")


def pair_counsel(lines: DataFrame, key: str, place: str, line: str) -> DataFrame:
    """(key, place, counsel, law_firm_agency): counsel named in lines, each with the firm of the next line. A line with
    `For the ` begins a party, one with `Self-represented` is counsel without firm, one with `Mr`, `Ms` or `SC` is
    counsel; another line is the firm of the counsel right before it. Empty lines and placeholders don't count."""
    own = lines.select(key, place, cleaned(c(line)).alias("_line")).where("_line IS NOT NULL")
    has = lambda x: F.contains("_line", F.lit(x))
    kind = F.when(has("Self-represented"), "self").when(has("For the "), "party").when(has("Mr") | has("Ms") | has("SC"), "counsel").otherwise("other")
    following = Window.partitionBy(key).orderBy(place)
    own = own.withColumn("_kind", kind)
    own = own.withColumns({"_next": F.lead("_line").over(following), "_next_kind": F.lead("_kind").over(following)}).where(c("_kind").isin("self", "counsel"))
    alone = c("_kind") == "self"
    name = F.when(alone, F.replace("_line", F.lit(" (Self-represented)"), F.lit(""))).otherwise(c("_line"))
    firm = F.when(alone, "Self-represented").when(c("_next_kind") == "other", c("_next"))
    return own.select(key, place, name.alias("counsel"), firm.alias("law_firm_agency"))


def page_items(replies: DataFrame, key: str, first_page: str, pages: str, reply: str) -> DataFrame:
    """(key, place, page_number, item): the items of a reply for a window of ``pages`` pages from ``first_page`` on, a JSON
    list of objects, in order from 0. An item's page is its ``page_index_in_chunk`` after the first, or the first if that
    is no whole number of the window. item is the object as a VARIANT. Replies that are no list have no rows, list members
    that are no objects none either."""
    value = F.try_parse_json(reply)
    each = replies.where(F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))).select(key, first_page, pages, F.posexplode(F.try_variant_get(value, "$", "array<variant>")).alias("place", "item"))
    each = each.where(F.startswith(F.schema_of_variant("item"), F.lit("OBJECT")))
    offset = F.try_variant_get("item", "$.page_index_in_chunk", "variant")
    index = F.when(F.schema_of_variant(offset) == "BIGINT", F.try_variant_get("item", "$.page_index_in_chunk", "bigint"))
    fits = F.coalesce(index.between(0, c(pages) - 1), F.lit(False))
    return each.select(key, "place", (c(first_page) + F.when(fits, index).otherwise(0)).cast("long").alias("page_number"), "item")


def rules_from(table: DataFrame, most: int = 10_000) -> list[tuple[str, bool, list[str]]]:
    """Heading rules from a table of (place, level, case_counts, pattern), for ``functions.headings.heading_level``: rows
    in the order of place and pattern; neighbours of one level and case are one alternation. Rules are few: more than
    ``most`` are an error. Rows without level or pattern are none."""
    rows = table.where("level IS NOT NULL AND pattern IS NOT NULL").select("place", "level", F.coalesce("case_counts", F.lit(False)).alias("case_counts"), "pattern").orderBy("place", "pattern").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    found: list[tuple[str, bool, list[str]]] = []
    for row in rows:
        if not found or found[-1][:2] != (row["level"], row["case_counts"]):
            found.append((row["level"], row["case_counts"], []))
        found[-1][2].append(row["pattern"])
    return found


def carried(lines: DataFrame, key: str, place: str, is_label: Column, text: str) -> DataFrame:
    """Lines without labels, each label put before the next line that is none; of labels in a row the last counts, and a
    label at the end stands as it is."""
    whole = Window.partitionBy(key).orderBy(place)
    own = lines.withColumn("_label", F.coalesce(is_label, F.lit(False)))
    own = own.withColumns({"_before": F.lag(F.when(c("_label"), c(text))).over(whole), "_after": F.lead("_label").over(whole)})
    own = own.where(~c("_label") | c("_after").isNull())
    merged = F.when(~c("_label") & c("_before").isNotNull(), F.concat("_before", F.lit(" "), F.ltrim(text))).otherwise(c(text))
    return own.withColumn(text, merged).drop("_label", "_before", "_after")
