"""Heading levels of lines by rules, and where to look for headings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Enumerations, which are no headings.
ENUMERATIONS = [r"^\(\w+\)", r"^\([a-z]\)\s", r"^\(\d+\)\s", r"^[a-z]\.$", r"^\d+\.\d+"]
_ACT = r"(Act|Bill|Regulation|Rules?|Policy)"
# Level, whether case counts, and patterns, by priority; the first that fits decides.
RULES = [
    ("h1", False, [
        r"^Chapter\s+\d+[A-Z]*", r"^Part\s+\d+[A-Z]*\s*$", r"^Part\s+\d+[A-Z]*\s+[A-Z]", r"^Book\s+\d+", r"^Title\s+\d+", r"^Schedule\s+\d+[A-Z]*", r"^Appendix\s+[A-Z0-9]+",
    ]),
    ("h2", False, [
        r"^Division\s+\d+[A-Z]*", r"^Section\s+\d+[A-Z]*", r"^Subdivision\s+[A-Z0-9]+", r"^Clause\s+\d+[A-Z]*", r"^Article\s+\d+[A-Z]*", r"^Regulation\s+\d+[A-Z]*", r"^Rule\s+\d+[A-Z]*",
    ]),
    ("h2", False, [
        rf"^Objects?\s+(of\s+)?(this\s+)?{_ACT}", rf"^Purpose\s+(of\s+)?(this\s+)?{_ACT}", r"^Definitions?\s*$", r"^Interpretation\s*$", r"^Dictionary\s*$", r"^Commencement\s*$",
        rf"^Application\s+(of\s+)?(this\s+)?{_ACT}", r"^Transitional\s+provisions?", r"^Savings?\s+provisions?", r"^Repeals?\s+(and\s+amendments?)?", r"^Consequential\s+amendments?",
        r"^Preliminary\s*$", r"^Citation\s*$", r"^Short\s+title\s*$", rf"^Name\s+(of\s+)?(this\s+)?{_ACT}", rf"^Title\s+(of\s+)?(this\s+)?{_ACT}", rf"^Principal\s+{_ACT}",
        r"^Aims?(,\s+objectives?(\s+etc\.?)?)?.*$", r"^Objectives?\s*$", r"^Amendment(s)?\s+(of|to)\s+", r"^Amendment(s)?\s*$", r"^Schedules?\s*$", r"^Notes?\s*$", r"^Contents?\s*$",
        r"^Table\s+of\s+contents?\s*$", r"^Penalties?\s*$", r"^Offences?\s*$", r"^Enforcement\s*$", r"^Administration\s*$", r"^Miscellaneous\s*$",
    ]),
    ("h3", False, [r"^Subsection\s+\d+[A-Z]*", r"^Subclause\s+\d+[A-Z]*", r"^Subrule\s+\d+[A-Z]*", r"^Subregulation\s+\d+[A-Z]*", r"^Item\s+\d+[A-Z]*"]),
    ("h3", True, [r"^\d{1,3}[A-Z]?\s+\w", r"^\d{1,3}\s+[A-Z]", r"^\d{1,3}[A-Z]?\.\s+\w"]),
    ("h4", False, [r"^Paragraph\s+\d+[A-Z]*", r"^Subparagraph\s+\d+[A-Z]*", r"^Subitem\s+\d+[A-Z]*"]),
]
SHORTEST, LONGEST = 2, 250


def any_of(patterns: list[str], case_counts: bool = True) -> str:
    return ("" if case_counts else "(?i)") + "(?:" + "|".join(patterns) + ")"


def heading_level(c: Column, rules=RULES) -> Column:
    """``h1`` to ``h4`` of a stripped line by the first rule that fits; null for lines shorter or longer than
    headings are, for enumerations and where no rule fits. rules: level, whether case counts, patterns."""
    found = F.when(~F.length(c).between(SHORTEST, LONGEST) | c.rlike(any_of(ENUMERATIONS)), None)
    for level, case_counts, patterns in rules:
        found = found.when(c.rlike(any_of(patterns, case_counts)), level)
    return found


def likely_heading(text: Column, blocks: Column, parent: Column, parent_text: Column) -> Column:
    """Whether an element can be a heading: of a heading's length, with two child blocks at most, and not a
    small part of the paragraph, list item or cell that it stands in."""
    inline = parent.isin("p", "li", "td") & (F.length(parent_text) > 3 * F.length(text))
    return F.length(text).between(SHORTEST, LONGEST) & (blocks <= 2) & ~F.coalesce(inline, F.lit(False))


def structuring_path(html: Column, use_model: Column, chars: Column, rule_headings: Column, most_tokens: int = 100_000, least_chars: int = 7000) -> Column:
    """How a page gets its sections: ``original`` if it has headings; ``model`` if one is used and the page is
    within its limit; else ``rulebased`` if the page is long enough, or its length isn't known, and the rules
    find headings; else ``no rules applied``."""
    by_rules = F.coalesce(chars >= least_chars, F.lit(True)) & (rule_headings > 0)
    return (
        F.when(html.rlike("(?i)<h[1-6][\\s>]"), "original").when(use_model & (F.floor(F.length(html) / 4) <= most_tokens), "model").when(by_rules, "rulebased").otherwise("no rules applied")
    )
