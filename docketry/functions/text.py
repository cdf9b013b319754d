"""Text functions as columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Texts that stand for no value.
PLACEHOLDERS = ["n/a", "[not available]", "[n/a]", "not applicable"]


def norm_verify(c: Column, header: str | None = None) -> Column:
    """Lower case, white space to one space. header: a pattern of a page header, which goes from the beginning of the
    text, in either case, with the white space after it."""
    plain = c if header is None else F.regexp_replace(c, rf"(?i)^(?:{header})\s*", "")
    return F.trim(F.regexp_replace(F.lower(plain), r"[\s\u00a0]+", " "))


def norm_match(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(F.lower(c), PUNCTUATION, ""), r"\s+", " "))


def word_count(c: Column) -> Column:
    return F.size(F.filter(F.split(c, r"[ \t\n\r]+"), lambda x: x != ""))


def est_tokens(c: Column) -> Column:
    return F.floor(F.length(c) / 4)


def token_cost(tokens: Column, per_million: float) -> Column:
    return tokens / F.lit(1e6) * F.lit(per_million)


def time_cost(seconds: Column, per_hour: float) -> Column:
    return seconds / F.lit(3600.0) * F.lit(per_hour)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/:?#]+)", 1)


def derived_names(url: Column) -> tuple[Column, Column]:
    base = F.replace(F.regexp_replace(host(url), r"^www\.", ""), F.lit("."), F.lit("_"))
    return F.concat(base, F.lit(".txt")), F.concat(base, F.lit(".xml"))


def valid_url(url: Column) -> Column:
    return url.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+")


def page_from_url(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"[?&]page=(\d+)", 1).try_cast("int"), F.lit(1))


def abs_url(base: Column, href: Column) -> Column:
    root = F.regexp_extract(base, r"^([a-z]+://[^/]+)", 1)
    folder = F.regexp_extract(base, r"^(.*/)[^/]*$", 1)
    return F.when(href.rlike("^https?://"), href).when(href.startswith("/"), F.concat(root, href)).otherwise(F.concat(folder, href))


def csv_array(c: Column, separator: str = ",") -> Column:
    return F.filter(F.transform(F.split(c, separator), lambda x: F.trim(x)), lambda x: x != "")


def clean_text(c: Column) -> Column:
    flat = F.trim(F.regexp_replace(c, r"\s+", " "))
    return F.when(~F.lower(flat).isin(PLACEHOLDERS), flat)


def snippet(c: Column, words: int = 30) -> Column:
    return F.concat(F.array_join(F.slice(F.split(c, " "), 1, words), " "), F.lit("..."))


def truncate_message(c: Column, most: int = 1024) -> Column:
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("..."))).otherwise(c)


def doc_key(source_id: Column, section_id: Column) -> Column:
    return F.concat_ws("_", source_id.cast("string"), section_id.cast("string"))


def doc_path(*parts: Column) -> Column:
    return F.concat_ws("/", *(p.cast("string") for p in parts))


def strip_bucket(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "^s3://[^/]+/", ""), "^/", "")


def chunks(c: Column, size: int = 1500, overlap: int = 200) -> Column:
    """Overlapping pieces; empty text has none."""
    starts = F.when(F.length(c) > 0, F.sequence(F.lit(0), F.length(c) - 1, F.lit(size - overlap)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda s: F.substring(c, s + 1, size))


def shingles(words: Column, n: int) -> Column:
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.array_join(F.slice(words, i, n), " "))


def shingle_groups(words: Column, least: int = 2, most: int = 3) -> Column:
    """All groups of ``least`` to ``most`` words side by side, shorter ones first."""
    return F.concat(*(shingles(words, n) for n in range(least, most + 1)))


def tag_bucket(c: Column, palette: int) -> Column:
    return F.aggregate(F.transform(F.split(c, ""), F.ascii), F.lit(0), lambda a, x: a + x) % palette


def label_parts(c: Column, palette: int) -> Column:
    """(tag, shown, bucket) of ``Tag: title``, cut at the first colon; without a tag and a title all is shown."""
    parts = F.transform(F.split(c, ":", 2), lambda x: F.trim(x))
    two = (F.size(parts) == 2) & (F.get(parts, F.lit(0)) != "") & (F.get(parts, F.lit(1)) != "")
    tag = F.when(two, F.get(parts, F.lit(0)))
    return F.struct(tag.alias("tag"), F.when(two, F.get(parts, F.lit(1))).otherwise(c).alias("shown"), tag_bucket(tag, palette).alias("bucket"))


def summary_refs(c: Column) -> Column:
    """Numbers of all groups like ``[1, 2]``, in order."""
    groups = F.regexp_extract_all(c, F.lit(r"(\[[\d,\s]+\])"), F.lit(1))
    return F.flatten(F.transform(groups, lambda g: F.transform(F.regexp_extract_all(g, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.cast("int"))))


def nav_path(parts: list[Column], page: Column, joined: str = "/") -> Column:
    """parts and the page, ``a/b/Page/3``, or ``a/b/Page-3`` with a dash."""
    return F.concat_ws("/", *parts, F.concat(F.lit(f"Page{joined}"), page.cast("string")))


def model_input(instruction: str, document: Column) -> Column:
    return F.concat(F.lit(f"{instruction}\n---\n"), document)


def question_input(question: str, name: Column, document: Column) -> Column:
    return F.concat(F.lit(f"{question}\nFile: "), name, F.lit("\n"), document)


#: Letters of the Latin blocks that are an ASCII letter with a mark, and these ASCII letters.
_MARKED = [(chr(i), unicodedata.normalize("NFD", chr(i))[0]) for i in range(0xC0, 0x250)]
MARKED, PLAIN = ("".join(x) for x in zip(*((a, b) for a, b in _MARKED if b.isascii()), strict=True))


def suggestion(c: Column, most: int = 100) -> Column:
    """Lower case without marks, cut to the field's length."""
    return F.left(F.translate(F.lower(c), MARKED, PLAIN), F.lit(most))


def page_offset(key: Column, pages: int) -> Column:
    """Offset of a page key: digits alone count from 0, ``page 3`` and ``pg_3`` from 1; null if it is no page
    key or out of range."""
    digits = F.regexp_extract(F.lower(F.trim(key)), r"^(?:page|pg)?[_ ]*(\d+)$", 1).try_cast("int")
    offset = F.when(F.trim(key).rlike(r"^\d+$"), digits).otherwise(digits - 1)
    return F.when((offset >= 0) & (offset < pages), offset)


def table_rows(c: Column) -> Column:
    """Rows of a pipe table: (header, cells). The rule of dashes marks the row before it as header."""
    lines = F.split(c, "\n")
    rows = F.transform(lines, lambda line, i: F.struct(line.alias("line"), F.contains(F.coalesce(F.get(lines, i + 1), F.lit("")), F.lit("---")).alias("header")))
    kept = F.filter(rows, lambda r: F.contains(r["line"], F.lit("|")) & ~F.contains(r["line"], F.lit("---")))
    return F.transform(kept, lambda r: F.struct(r["header"].alias("header"), F.transform(F.split(r["line"], r"\|"), lambda x: F.trim(x)).alias("cells")))


def extract_json(c: Column) -> Column:
    """JSON of a reply: what its fence holds, else its first object without nested ones; null if that does
    not parse."""
    fenced = F.nullif(F.regexp_extract(c, r"(?s)```(?:json)?\s*(.*?)\s*```", 1), F.lit(""))
    found = F.coalesce(fenced, F.regexp_extract(c, r"(?s)\{[^{}]*\}", 0))
    return F.when(F.try_parse_json(found).isNotNull(), found)
