"""Flat HTML as columns: links and text. For nested removal a parser is needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The entities that pages use; the ampersand comes last.
ENTITIES = [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")]


def _pieces(html: Column) -> Column:
    plain = F.regexp_replace(html, r"(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>", "\x01")
    plain = F.regexp_replace(plain, r"(?s)<[^>]*>", "\x01")
    for entity, shown in ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(shown))
    return F.filter(F.transform(F.split(plain, "\x01"), lambda x: F.btrim(x, F.lit(" \t\n\r"))), lambda x: x != "")


def html_text(html: Column) -> Column:
    return F.array_join(_pieces(html), " ")


def html_lines(html: Column) -> Column:
    return F.array_join(_pieces(html), "\n")


def hrefs(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'<a[^>]*href="([^"]+)"'), F.lit(1))


def links(html: Column) -> Column:
    """(href, text) of each link with an address in either quotes; text without tags, trimmed."""
    found = F.regexp_extract_all(html, F.lit(r"""(?is)(<a\b[^>]*\bhref=["'][^"'>]*["'][^>]*>.*?</a>)"""), F.lit(1))
    href = lambda x: F.regexp_extract(x, r"""(?is)^<a\b[^>]*\bhref=["']([^"'>]*)["']""", 1)
    return F.transform(found, lambda x: F.struct(href(x).alias("href"), F.btrim(F.regexp_replace(x, "(?s)<[^>]*>", ""), F.lit(" \t\r\n")).alias("text")))


def heading_count(html: Column, level: int = 1) -> Column:
    return F.regexp_count(html, F.lit(f"(?i)<h{level}[ >]"))


def escaped(c: Column) -> Column:
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


def markdown_html(c: Column, heading: bool = False) -> Column:
    """Light markdown as HTML: escaped, then bold, italics, links and line breaks; a heading loses the marks around it and
    is one line."""
    white = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
    text = F.regexp_replace(c, white, "")
    if heading:
        inner = F.when(F.length(text) >= 4, F.regexp_extract(text, r"(?s)^\*\*(.*)\*\*$", 1))
        single = F.when((F.length(text) >= 2) & text.rlike(r"(?s)^\*.*\*$"), F.substr(text, F.lit(2), F.length(text) - 2))
        text = F.regexp_replace(F.when(text.rlike(r"(?s)^\*\*.*\*\*$"), inner).otherwise(F.coalesce(single, text)), white, "")
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(plain), F.lit(entity))
    if heading:
        return F.replace(text, F.lit("\n"), F.lit(" "))
    for mark, tag in (("**", "strong"), ("*", "em")):
        stars, lines = mark.replace("*", r"\*"), mark.replace("*", "_")
        text = F.regexp_replace(text, rf"(?Ud){stars}(?=\S)(.*?)(?<=\S){stars}|{lines}(?=\S)(.*?)(?<=\S){lines}", f"<{tag}>$1$2</{tag}>")
    text = F.regexp_replace(text, r"\[([^\]]+)\]\(([^)]+)\)", '<a href="$2">$1</a>')
    return F.replace(text, F.lit("\n"), F.lit("<br>\n"))


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def link_ids(href: Column) -> Column:
    """(article, section) of ``/article/1`` or ``/article/1/section/2``; null where absent."""
    pattern = r"/article/(\d+)(?:/section/(\d+))?"
    return F.struct(_part(href, pattern, 1).alias("article"), _part(href, pattern, 2).alias("section"))


def anchor_ids(anchor: Column) -> Column:
    """(parent_id, section_id) of ``bnj_a_1_sr_2``; null if it is none."""
    pattern = r"bnj_a_(\d+)_[a-zA-Z]+_(\d+)"
    return F.struct(_part(anchor, pattern, 1).alias("parent_id"), _part(anchor, pattern, 2).alias("section_id"))


def section_anchors(html: Column) -> Column:
    """(anchor, text) of each section anchor that stands in a paragraph without other elements; text is the
    paragraph's."""
    found = F.regexp_extract_all(html, F.lit(r"""(?s)(<p\b[^>]*>[^<]*<a\b[^>]*\bid="bnj_a_\d+_[a-zA-Z]+_\d+[^"]*"[^>]*>[^<]*</a>[^<]*</p>)"""), F.lit(1))
    shown = lambda x: F.btrim(F.regexp_replace(x, "<[^>]*>", ""))
    return F.transform(found, lambda x: F.struct(F.regexp_extract(x, r'\bid="(bnj_a_[^"]*)"', 1).alias("anchor"), shown(x).alias("text")))


def only_references(c: Column, names: list[str]) -> Column:
    """A page in which only the references named count, and only with their semicolon: any other ampersand is text
    (``&amp;``). Parsers know more names, and take ``&amp`` at the end of a cut title for one too."""
    return F.regexp_replace(c, f"&(?!(?:{'|'.join(names)});)", "&amp;")
