"""Operators on the nodes of pages (``sources.nodes.page_nodes``): content, headings by style, tables and labels.

What lies inside an element is a range of numbers, from its node to its last, so that nesting is a matter of
windows and of equal keys, not of walking trees.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docketry.operators.similarity import distinct_words

# Elements that are no content, and parts of class names and ids that mark notes.
SKIPPED = ["script", "style", "meta", "link", "head", "nav"]
NOTE_CLASSES = ["note", "marginal-note", "sidenote", "footnote", "annotation", "comment", "aside", "editorial"]
NOTE_IDS = r"^(note|footnote|marginal[-_]note)"
NAVIGATOR = "navigator"
# Level, least size in pixels, whether a page has one such heading only; all are bold.
BANDS = [("h1", 20, True), ("h2", 18, False), ("h3", 16, False), ("h4", 15, False)]
STYLED = ["span", "div", "p"]
# The elements in which headings are sought, in this order, by strategy.
EXACT_IN = ["p", "b", "strong", "span", "div", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6"]
PREFIX_IN = ["p", "div", "td"]
OVERLAP_IN = ["p", "div", "td", "b", "strong"]
EXTRA_CHARS, MOST_LINES = 50, 6
# Labels of a case's metadata table and their columns.
FIELDS = {
    "Citation": "citation", "Key issues": "key_issues", "Catchwords": "keywords", "Judgment of": "presiding_officer", "Judge": "presiding_officer", "Panelist": "panelist",
    "Orders": "orders", "Decision": "decision", "Decision Date": "judgment_date", "Cases Cited": "cases_cited", "Legislation Cited": "legislation_cited", "Filenumber": "file_no",
    "Hearing Dates": "hearing_date", "Jurisdiction": "matter_type", "Parties": "parties", "Category": "category", "BJS Number": "bjs_number",
}
PLACEHOLDERS = ["n/a", "[not available]", "[n/a]", "not applicable"]

c = F.col


def _attribute(name: str) -> Column:
    return F.coalesce(c("attributes")[name], F.lit(""))


def _has_class(name: str) -> Column:
    return F.array_contains(F.split(_attribute("class"), r"\s+"), name)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def tidy(text: Column) -> Column:
    """White space and no-break spaces to one space each, none at the ends."""
    return F.btrim(F.regexp_replace(F.replace(text, F.lit("&nbsp;"), F.lit(" ")), r"(?U)[\s\x1c-\x1f]+", " "), F.lit(" "))


def cleaned(text: Column) -> Column:
    """Trimmed, white space to one space; null for placeholders and empty values."""
    plain = F.nullif(tidy(text), F.lit(""))
    return F.when(~F.lower(plain).isin(PLACEHOLDERS), plain)


def _along(key: str):
    return Window.partitionBy(key).orderBy("node")


def content_text(nodes: DataFrame, key: str) -> DataFrame:
    """(key, text): the texts of a page in lines, without scripts, heads, navigation and notes. Elements of ``SKIPPED``
    or with a note's class go with all that they hold; of an element with a note's id, or the navigator's, its own
    texts go. The page is ``main`` with the id ``content``, else the body, else all. Texts of one character go.
    A page without content has an empty text."""
    note = F.lower(_attribute("class")).rlike("|".join(NOTE_CLASSES))
    hides = c("tag").isNotNull() & (c("tag").isin(SKIPPED) | note)
    hidden = F.coalesce(F.max(F.when(hides, c("last"))).over(_along(key).rowsBetween(Window.unboundedPreceding, 0)) >= c("node"), F.lit(False))
    whole = Window.partitionBy(key)
    part = F.struct("node", "last")
    marked = nodes.select(key, "node", "parent", "last", "tag", "attributes", "text", hidden.alias("hidden"))
    main = F.min(F.when((c("tag") == "main") & (_attribute("id") == "content") & ~c("hidden"), part)).over(whole)
    body = F.min(F.when((c("tag") == "body") & ~c("hidden"), part)).over(whole)
    marked = marked.withColumn("part", F.coalesce(main, body))
    ids = nodes.where(c("tag").isNotNull() & (F.lower(_attribute("id")).rlike(NOTE_IDS) | (_attribute("id") == NAVIGATOR)))
    ids = ids.select(key, c("node").alias("parent"), F.lit(True).alias("noted"))
    inside = c("part").isNull() | ((c("node") > c("part.node")) & (c("node") <= c("part.last")))
    text = stripped(c("text"))
    kept = c("tag").isNull() & ~c("hidden") & inside & c("noted").isNull() & (F.length(text) > 1)
    lines = F.array_sort(F.collect_list(F.when(kept, F.struct("node", text.alias("text")))))
    joined = F.array_join(F.transform(lines, lambda x: x.text), "\n")
    joined = F.regexp_replace(F.regexp_replace(joined, r"\n{3,}", "\n\n"), " {2,}", " ")
    return marked.join(ids, [key, "parent"], "left").groupBy(key).agg(stripped(joined).alias("text"))


def class_styles(nodes: DataFrame, key: str) -> DataFrame:
    """(key, class, size, bold): the classes that the first style element of a page defines, with their size in pixels
    and weight; of several definitions that tell either the last counts."""
    own = nodes.where((c("tag") == "style") | (c("tag").isNull() & (F.try_element_at("path", F.lit(-1)) == "style")))
    sheets = own.groupBy(key).agg(F.min(F.when(c("tag") == "style", c("node"))).alias("first"), F.collect_list(F.when(c("tag").isNull(), F.struct("parent", "text"))).alias("texts"))
    sheet = sheets.select(key, F.explode(F.filter("texts", lambda x: x.parent == c("first"))).alias("x")).select(key, "x.text")
    pattern = r"\.([a-zA-Z0-9_-]+)\s*\{([^}]+)\}"
    names, rules = (F.regexp_extract_all("text", F.lit(pattern), F.lit(g)) for g in (1, 2))
    each = sheet.select(key, F.posexplode(F.arrays_zip(names.alias("class"), rules.alias("rule"))).alias("at", "x"))
    size = F.nullif(F.regexp_extract("x.rule", r"font-size\s*:\s*(\d+)px", 1), F.lit("")).cast("int")
    bold = F.contains(F.replace(c("x.rule"), F.lit(" ")), F.lit("font-weight:bold"))
    told = each.select(key, c("x.class").alias("class"), "at", size.alias("size"), bold.alias("bold")).where("size IS NOT NULL OR bold")
    return told.groupBy(key, "class").agg(F.max_by(F.struct("size", "bold"), "at").alias("s")).select(key, "class", "s.size", "s.bold")


def style_levels(nodes: DataFrame, key: str, bands=BANDS, tags=STYLED) -> DataFrame:
    """(key, node, level, text): headings by the style of the first class of an element that the page defines. Bands are
    tried in order; one that is the title's only is taken by the first element that fits, and others of its
    size go on to the next band. Elements without text are none; a heading inside another isn't shown.
    ``nodes`` needs the whole text of ``tags``."""
    styles = class_styles(nodes, key)
    elements = nodes.where(c("tag").isin(tags) & (c("tight") != "")).select(key, "node", "last", "tight", F.posexplode(F.split(_attribute("class"), r"\s+")).alias("at", "class"))
    styled = elements.join(styles, [key, "class"]).groupBy(key, "node", "last", "tight").agg(F.min_by(F.struct("size", "bold"), "at").alias("s"))
    fits = styled.where(c("s.bold") & (c("s.size") >= min(size for _, size, _ in bands)))
    level = F.lit(None).cast("string")
    for name, size, once in reversed(bands):
        # The first of a page whose size is in the band.
        first = F.sum((c("s.size") >= size).cast("int")).over(_along(key)) == 1
        level = F.when((c("s.size") >= size) & (first if once else F.lit(True)), name).otherwise(level)
    before = F.max("last").over(_along(key).rowsBetween(Window.unboundedPreceding, -1))
    shown = fits.select(key, "node", level.alias("level"), c("tight").alias("text"), F.coalesce(before < c("node"), F.lit(True)).alias("outer"))
    return shown.where("outer").drop("outer")


def inline_levels(nodes: DataFrame, key: str, tags: list[str]) -> DataFrame:
    """(key, node, tag, level, text): headings among the elements named in ``tags`` by their tag, inline style and bold
    text, level 1 to 6. ``nodes`` needs the whole text of ``tags`` and of ``b``. The text is that of the first
    bold element inside, if there is one."""
    ahead = _along(key).rowsBetween(1, Window.unboundedFollowing)
    bold = F.min(F.when(c("tag") == "b", F.struct("node", c("tight").alias("text")))).over(ahead)
    own = nodes.select(key, "node", "last", "tag", "tight", _attribute("style").alias("style"), bold.alias("b")).where(c("tag").isin(tags))
    has_bold = F.coalesce(c("b.node") <= c("last"), F.lit(False))
    own = own.select(key, "node", "tag", "style", has_bold.alias("bold"), F.when(has_bold, c("b.text")).otherwise(c("tight")).alias("text")).where("text <> ''")
    text, style, p = c("text"), c("style"), c("tag") == "p"
    dots = F.length(text) - F.length(F.replace(text, F.lit("."), F.lit("")))
    size = F.regexp_extract(style, r"font-size\s*:\s*(\d+)%", 1)
    level = (
        F.when(c("tag").rlike("^h[1-6]"), F.substring("tag", 2, 1).cast("int"))
        .when(p & style.contains("font-size:180%"), 1)
        .when(p & style.contains("font-size:147%") & text.contains("PART"), 1)
        .when(p & style.contains("font-size:127%") & text.rlike(r"^Division \d"), 2)
        .when(p & style.contains("font-size:107%") & text.rlike(r"^\d+(\.\d+)*[A-Z]?\s"), F.least(dots + 1, F.lit(5)))
        .when((size != "") & (size.try_cast("decimal(38,0)") >= 150), 1)
        .when(c("bold") & text.rlike(r"(?i)^(PART\s+\d+[A-Z]?|SCHEDULE\s+\d+|ENDNOTES?)\b"), 1)
        .when(c("bold") & text.rlike(r"(?i)^\d+[A-Z]?(\.\d+[A-Z]?)*\s+[A-Z]"), F.least(dots + 2, F.lit(5)))
    )
    return own.select(key, "node", "tag", level.alias("level"), "text").where("level IS NOT NULL")


def section_anchors(nodes: DataFrame, key: str) -> DataFrame:
    """(key, node, anchor, text): each section anchor, wherever it stands, with the text of the element around it.
    ``nodes`` needs the whole text of all elements (``*``)."""
    anchors = nodes.where((c("tag") == "a") & _attribute("id").rlike(r"^bnj_a_\d+_[a-zA-Z]+_\d+")).select(key, "node", c("parent").alias("_up"), _attribute("id").alias("anchor"))
    around = nodes.where("tag IS NOT NULL").select(key, c("node").alias("_up"), c("tight").alias("text"))
    return anchors.join(around, [key, "_up"]).select(key, "node", "anchor", "text")


def _rank(tags: list[str]) -> Column:
    return F.array_position(F.array(*map(F.lit, tags)), c("tag"))


def locate_headings(headings: DataFrame, nodes: DataFrame, key: str, number: str, heading: str) -> DataFrame:
    """(key, number, strategy, node): the element of its page where each heading stands. Strategies in order, each for
    the headings that those before it leave: 1 an element of equal text; 2 one that begins with it and is less than
    ``EXTRA_CHARS`` longer; 3 up to ``MOST_LINES`` paragraphs in a row that give it; 4 one that holds 85 hundredths of its
    words, if it has five or more. In each the kind of element goes before its place. Headings that aren't found have no row.
    (key, number) names a heading; null headings are none. ``nodes`` needs the whole text of ``EXACT_IN``. Each element meets
    the headings of its page once, for all strategies."""
    elements = nodes.where(c("tag").isin(EXACT_IN)).select(key, "node", "tag", tidy(c("text")).alias("text"))
    asked = headings.where(c(heading).isNotNull()).select(key, number, tidy(c(heading)).alias("wanted"))
    words = distinct_words(c("wanted"))
    asked = asked.select(key, number, "wanted", F.when(F.size(words) >= 5, words).alias("words"))
    # A heading's paragraphs are no longer than the page's longest heading: longer ones stand as null in the rows.
    longest = asked.groupBy(key).agg(F.max(F.length("wanted")).alias("longest"))
    elements = elements.join(longest, key)
    short = F.struct(F.when(F.length("text") <= c("longest"), c("text")).alias("x"))
    row = F.collect_list(F.when(c("tag") == "p", short)).over(Window.partitionBy(key, c("tag") == "p").orderBy("node").rowsBetween(0, MOST_LINES - 1))
    elements = elements.select(key, "node", "tag", "text", distinct_words(c("text")).alias("held"), row.alias("row"))

    def joined(k: int) -> Column:
        first = F.slice("row", 1, k)
        whole = (F.size("row") >= k) & F.forall(first, lambda p: p.x.isNotNull())
        return whole & (tidy(F.array_join(F.transform(first, lambda p: p.x), " ")) == c("wanted"))

    begins = F.startswith("text", "wanted")
    in_a_row = (c("tag") == "p") & F.startswith("wanted", "text") & functools.reduce(Column.__or__, map(joined, range(2, MOST_LINES + 1)))
    strategies = [
        (EXACT_IN, c("text") == c("wanted")),
        (PREFIX_IN, begins & (F.length("text") - F.length("wanted") < EXTRA_CHARS)),
        (["p"], in_a_row),
        (OVERLAP_IN, 100 * F.size(F.array_intersect("words", "held")) >= 85 * F.size("words")),
    ]
    place = F.lit(None)
    for strategy, (tags, fits) in reversed(list(enumerate(strategies, 1))):
        place = F.when(c("tag").isin(tags) & F.coalesce(fits, F.lit(False)), F.struct(F.lit(strategy).alias("strategy"), _rank(tags).alias("rank"), "node")).otherwise(place)
    met = elements.join(asked, key).select(key, number, place.alias("place")).where("place IS NOT NULL")
    return met.groupBy(key, number).agg(F.min("place").alias("place")).select(key, number, "place.strategy", "place.node")


def _within(nodes: DataFrame, key: str, tag: str) -> DataFrame:
    """Nodes with each element of this tag that they lie in: up (its number) and nearest (the number of the nearest)."""
    above = F.transform(F.filter(F.arrays_zip("path", "ancestors"), lambda x: x.path == tag), lambda x: x.ancestors)
    inside = nodes.withColumn("_up", above).where(F.size("_up") > 0)
    return inside.select("*", F.explode("_up").alias("up"), F.element_at("_up", -1).alias("nearest")).drop("_up")


def key_values(nodes: DataFrame, key: str, fields: dict[str, str] = FIELDS) -> DataFrame:
    """(key, field, value) of the first table of class ``metadata``: of its rows with two cells the first is a label of
    ``fields`` and the second the value. The last row of a field counts; placeholders and empty values are none.
    ``nodes`` needs the whole text of ``td``."""
    table = nodes.where((c("tag") == "table") & _has_class("metadata")).groupBy(key).agg(F.min(F.struct("node", "last")).alias("t"))
    cells = _within(nodes.where("tag = 'td'"), key, "tr").join(table, key).where((c("up") > c("t.node")) & (c("up") <= c("t.last")))
    rows = cells.groupBy(key, "up").agg(F.array_sort(F.collect_list(F.struct("node", "tight", "spaced"))).alias("c")).where(F.size("c") == 2)
    pairs = rows.select(key, "up", cleaned(F.get("c", F.lit(0))["tight"]).alias("label"), cleaned(F.get("c", F.lit(1))["spaced"]).alias("value"))
    names = F.create_map(*(F.lit(x) for pair in fields.items() for x in pair))
    told = pairs.where("label IS NOT NULL AND value IS NOT NULL").select(key, "up", names[c("label")].alias("field"), "value").where("field IS NOT NULL")
    return told.groupBy(key, "field").agg(F.max_by("value", "up").alias("value"))


def merged_labels(nodes: DataFrame, key: str) -> DataFrame:
    """(key, node, text): list items whose label stands before their first paragraph: the label of class
    ``li-label``, or else the bullet of class ``li-label-bullet``, and the paragraph's text. A label without text, or a first
    paragraph that belongs to an item inside, merges nothing. ``nodes`` needs the whole text of ``inline`` and ``p``."""
    own = _within(nodes.where(c("tag").isin("inline", "p")), key, "li")
    first = lambda cond, *cols: F.min(F.when(cond, F.struct("node", *cols)))
    items = own.groupBy(key, "up").agg(
        first((c("tag") == "inline") & _has_class("li-label"), "tight").alias("label"), first((c("tag") == "inline") & _has_class("li-label-bullet"), "tight").alias("bullet"),
        first(c("tag") == "p", "nearest", "text").alias("p"),
    )
    label = F.when(c("label").isNotNull(), c("label.tight")).otherwise(c("bullet.tight"))
    merged = items.where((label != "") & (c("p.nearest") == c("up")))
    return merged.select(key, c("up").alias("node"), F.concat(label, F.lit(" "), F.ltrim("p.text")).alias("text"))
