"""Citations, court codes, parties, members and dates as columns."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.sources.rounds import checkpointed

# Forms of a citation in the order in which they are tried. A year in single or double brackets;
# a court code and a number; or three words of capitals (jurisdiction, court, panel) and a number; or the number
# before the code; or no number; then the date in parentheses and the members, which may be missing.
_YEAR, _MEMBERS = r"^\[{1,2}(\d{4})\]{1,2}\s+", r"(?:\s*\((.*?)\))?"
FORMS = [
    _YEAR + r"([A-Z][A-Za-z0-9]+)\s+(\d+)\s*\((.*?)\)" + _MEMBERS,
    _YEAR + r"([A-Z]+)\s+([A-Z]+)\s+([A-Z]+)\s+(\d+)\s*\((.*?)\)" + _MEMBERS,
    _YEAR + r"(\d+)\s+([A-Z][A-Za-z0-9]+)\s*\((.*?)\)" + _MEMBERS,
    _YEAR + r"([A-Z][A-Za-z0-9]+)\s+.*?\((\d{1,2}\s+\w+\s+\d{4})\)" + _MEMBERS,
]
#: By form, the group of each part; absent parts are null.
PARTS = [
    {"year": 1, "code": 2, "number": 3, "date_text": 4, "members": 5},
    {"year": 1, "jurisdiction": 2, "code": 3, "panel": 4, "number": 5, "date_text": 6, "members": 7},
    {"year": 1, "number": 2, "code": 3, "date_text": 4, "members": 5},
    {"year": 1, "code": 2, "date_text": 3, "members": 4},
]
CITATION = ["year", "jurisdiction", "code", "panel", "number", "date_text", "members"]

# Titles of members in the order in which they are looked for.
TITLES = [
    "Chief Justice", "Justice", "Judge", "Member", "Senior Member", "Deputy President", "President", "Commissioner", "Magistrate", "Principal Member", "General Member", "Expert Member",
]
HONORIFIC = "The Honourable"
ROLES = "Vice-President|Vice President|Deputy President|Acting President"
# Words that are no court codes.
NOT_CODES = [
    "JULY", "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "AUGUST", "SEPTEMBER", "OCTOBER", "NOVEMBER", "DECEMBER", "SUPREME", "COURT", "TRIBUNAL", "PARTIESWHERE", "NCE", "UMBER", "CASSINI", "QD",
]
# Courts of the federation, and of the jurisdictions in the order in which they are tried, where a
# code that begins with the jurisdiction's own belongs to it too.
FEDERAL = [
    "HCA", "FCA", "FCAFC", "FamCA", "FamCAFC", "FedCFamC1F", "FedCFamC2F", "FCCA", "AAT", "AATA", "FWC", "AIRC", "NNTT", "DFDAT", "CTA", "FMCA", "FMCAfam", "FedCFamC1A", "FedCFamC2G", "FedCFamCG2",
    "FEDCFAMC1F", "FamCa",
]
COURTS = [
    ("NZ", ["SC", "CA", "HC", "DC", "FC", "YC", "EC", "EmpC", "ERA", "MLC", "MaoriLC", "MACA", "MaoriAC", "CC", "CSC", "WT", "HRRT", "DT", "TT", "MVDT", "LVT", "IPT", "RSAA", "SSAA", "SAA", "TRA", "LCRO"]),
    ("NSW", ["ADT", "NSWADT", "MHRT"]),
    ("VIC", ["VCAT", "VCC", "VSCA", "VSC", "VMC", "VMHT", "VOCAT"]),
    ("QLD", ["QIRC", "QCAT", "QSC", "QCA", "QDC", "QLC", "QMHRT", "QMC"]),
    ("WA", ["WASAT", "WASC", "WADC", "WAMC", "WAMHRT"]),
    ("SA", ["SASAT", "SASC", "SADC", "SAMC", "SAEOT", "ERD", "SAWC"]),
    ("TAS", ["TASCAT", "TASC", "TASSC", "TASMC", "TASGAB", "TSGAB"]),
    ("ACT", ["ACAT", "ACTSC", "ACTCA", "ACTMC"]),
    ("NT", ["NTCAT", "NTSC", "NTLC", "NTMC", "NTCCA"]),
]
# Courts that follow a jurisdiction's code or its first letter, in the order in which they are tried.
AFTER_CODE = [
    ("NSW", ["ADT", "CTT", "IRComm", "WCC"]), ("VIC", ["CAT", "CC", "SCA"]), ("QLD", ["IRC", "QCAT", "QIRC"]), ("WA", ["SAT", "IRC"]), ("SA", ["SAT", "ERD"]), ("TAS", ["RAT"]), ("ACT", ["AAT"]),
]
LETTERS = {"V": "VIC", "Q": "QLD", "N": "NSW", "S": "SA", "W": "WA", "T": "TAS"}
AFTER_LETTER = ["CAT", "CC", "SCA", "IRC", "SAT", "DC", "SC", "MC"]
# Labels of dates in a context.
DATE_LABELS = "Start date|Currency date|Date published|Date of assent|Date made"
# What stands for no date, and forms of dates in the order in which they are tried.
NO_DATES = ["no date", "not provided", "unknown", "n/a", "nil", "none", "not available", "not specified", "tba", "tbd"]
DATE_FORMS = [
    "d MMMM yyyy", "d MMM yyyy", "MMMM d, yyyy", "MMM d, yyyy", "d/M/yyyy", "M/d/yyyy", "yyyy-M-d", "yyyy/M/d", "d-M-yyyy", "d-MMM-yyyy", "d MMMM yyyy H:m:s", "yyyy-M-d H:m:s", "yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s'Z'",
]


def _none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def _bound(c: Column, use: Callable[[Column], Column]) -> Column:
    """use(c), where c is computed once, however often it is used."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


_MARK = "\x01"


def parse_citation(c: Column) -> Column:
    """A struct of CITATION, all strings, by the first of FORMS that fits; null for citations of bad sources
    (`` null ``) and of no form. The code of three words is its second. Each form is matched once, and turns what it
    fits into all its parts, which no later form fits."""
    text = F.translate(c, _MARK, "")
    found = F.when(~F.contains(F.lower(text), F.lit(" null ")), text)
    for form, parts in zip(FORMS, PARTS, strict=True):
        found = F.regexp_replace(found, form + r"(?s:.*)$", _MARK + _MARK.join(f"${parts[x]}" if x in parts else "" for x in CITATION))
    named = lambda fields: F.struct(*(_none_if_empty(F.btrim(F.get(fields, F.lit(k)))).alias(x) for k, x in enumerate(CITATION, 1)))
    return _bound(F.split(found, _MARK), lambda fields: F.when(F.size(fields) > 1, named(fields)))


def to_date(c: Column) -> Column:
    """First of ``d MMMM yyyy``, ``d MMM yyyy``, ``d/M/yyyy`` and ``yyyy-MM-dd`` that fits."""
    return F.coalesce(*(F.try_to_date(c, form) for form in ("d MMMM yyyy", "d MMM yyyy", "d/M/yyyy", "yyyy-MM-dd")))


def to_iso_date(c: Column) -> Column:
    """``yyyy-MM-dd`` by the first of DATE_FORMS that fits; null for texts that hold one of NO_DATES."""
    text = F.btrim(c.cast("string"))
    dated = F.when(~text.rlike("(?i)" + "|".join(NO_DATES)), text)
    return F.date_format(F.coalesce(*(F.try_to_timestamp(dated, F.lit(form)) for form in DATE_FORMS)), "yyyy-MM-dd")


def infer_jurisdiction(code: Column, hint: Column) -> Column:
    found = F.when(code.isin(FEDERAL), "FED")
    for name, courts in COURTS:
        found = found.when(code.startswith(name) | code.isin(courts), name)
    return found.otherwise(hint)


def valid_code(code: Column) -> Column:
    good = code.rlike("^[A-Za-z][A-Za-z0-9_]*$") & ((F.length(code) > 1) | (code == "O")) & ~F.upper(code).isin(NOT_CODES)
    return F.coalesce(good, F.lit(False))


def deconstruct(codes: DataFrame, known: DataFrame, hint: str | None = None) -> DataFrame:
    """codes: code. known: code and type (jurisdiction, tribunal or panel_or_division). Returns, for each distinct
    code, jurisdiction_code, tribunal_code, panel_or_division: by the longest known tribunal that it begins with;
    else by the longest known jurisdiction before a known tribunal; else by AFTER_CODE; else by one of LETTERS
    before a known tribunal or one of AFTER_LETTER; else the code is the tribunal, of the hint's jurisdiction or, without
    hint, of the shortest known one that it begins with. What follows the tribunal is kept if it is a known panel
    or division."""
    of = lambda kind, name: known.where(F.col("type") == kind).select(F.col("code").alias(name)).distinct()
    # Few codes of many citations: they are parsed out once.
    codes = checkpointed(codes.where("code <> ''").select("code").distinct())
    tribunals = of("tribunal", "part")
    mapped = lambda pairs, c: F.element_at(F.create_map(*(F.lit(x) for pair in pairs for x in pair)), c)
    fixed = [(n + x, n, x) for n, courts in AFTER_CODE for x in courts]
    # All pieces that may be a tribunal, with what stands before them: equal pieces meet, not prefixes.
    longest = F.lit(max(known.agg(F.coalesce(F.max(F.length("code")), F.lit(0))).first()[0], max(len(n + x) for n, courts in AFTER_CODE for x in courts)))
    cuts = codes.select("code", F.explode(F.sequence(F.lit(0), F.least(F.length("code") - 1, longest))).alias("at"))
    cuts = cuts.select("code", "at", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.least(F.length("code") - F.col("at"), longest)))).alias("n"))
    cuts = cuts.select("code", "at", "n", F.left("code", F.col("at")).alias("before"), F.substring(F.col("code"), F.col("at") + 1, F.col("n")).alias("part"))
    letter = mapped(LETTERS.items(), F.col("before"))
    at_fixed, at_after = mapped([(part, k) for k, (part, _, _) in enumerate(fixed)], F.col("part")), mapped([(x, k) for k, x in enumerate(AFTER_LETTER)], F.col("part"))

    def way(rows: DataFrame, rank: int, within: list, jurisdiction: Column, tribunal: Column) -> DataFrame:
        order = F.array(F.lit(rank), *(x.cast("int") for x in within))
        return rows.select("code", order.alias("order"), jurisdiction.alias("jurisdiction_code"), tribunal.alias("tribunal_code"), F.substring(F.col("code"), F.col("at") + F.col("n") + 1, F.lit(2**30)).alias("rest"))

    met = cuts.join(tribunals, "part")
    ways = [
        way(met.where("at = 0"), 0, [-F.col("n")], infer_jurisdiction(F.col("part"), F.lit(hint).cast("string")), F.col("part")),
        way(met.join(of("jurisdiction", "before"), "before"), 1, [-F.col("at"), -F.col("n")], F.col("before"), F.col("part")),
        way(cuts.where((F.col("at") == 0) & at_fixed.isNotNull()), 2, [at_fixed], mapped([(part, n) for part, n, _ in fixed], F.col("part")), mapped([(part, x) for part, _, x in fixed], F.col("part"))),
        way(met.where((F.col("at") == 1) & letter.isNotNull() & (F.col("n") == F.length("code") - 1)), 3, [F.lit(0)], letter, F.col("part")),
        way(cuts.where((F.col("at") == 1) & letter.isNotNull() & at_after.isNotNull()), 4, [at_after], letter, F.col("part")),
    ]
    if hint is None:
        begins = codes.select("code", F.explode(F.sequence(F.lit(1), F.length("code"))).alias("n")).withColumn("before", F.left("code", F.col("n")))
        begins = begins.withColumn("at", F.lit(0)).join(of("jurisdiction", "before"), "before")
        ways.append(way(begins, 5, [F.col("n")], F.col("before"), F.col("code")))
    ways.append(way(codes.select("code", F.lit(0).alias("at"), F.length("code").alias("n")), 6, [], F.lit(hint).cast("string"), F.col("code")))
    # What follows the tribunal in ways 5 and 6 is nothing: all of the code is the tribunal.
    first = functools.reduce(DataFrame.unionByName, ways).groupBy("code").agg(F.min_by(F.struct("jurisdiction_code", "tribunal_code", F.when(F.get("order", F.lit(0)) < 5, F.col("rest")).alias("rest")), "order").alias("f")).select("code", "f.*")
    return first.join(of("panel_or_division", "panel_or_division"), F.col("rest") == F.col("panel_or_division"), "left").drop("rest")


def parties(c: Column) -> tuple[Column, Column]:
    parts = F.split(c, r"\s+[vV]\s+", 2)
    return F.trim(F.get(parts, F.lit(0))), F.trim(F.get(parts, F.lit(1)))


def parse_member(c: Column) -> Column:
    """A struct (honorific, title, name, post_nominal, role): what is found is taken out before the next is
    looked for; the first of TITLES counts, so that ``Member`` comes before ``Senior Member``; what is left is
    the name."""
    def without(text: Column, part: Column) -> Column:
        return F.when(part.isNotNull(), F.btrim(F.replace(text, part, F.lit("")))).otherwise(text)

    def titled(text: Column) -> Column:
        plain = without(text, F.when(F.contains(text, F.lit(HONORIFIC)), HONORIFIC))
        return _bound(plain, lambda plain: F.struct(text.alias("text"), plain.alias("plain"), F.coalesce(*(F.when(F.contains(plain, F.lit(x)), x) for x in TITLES)).alias("title")))

    def named(x: Column) -> Column:
        return _bound(without(x["plain"], x["title"]), lambda plain: F.struct(x["text"].alias("text"), x["title"].alias("title"), _none_if_empty(F.regexp_extract(plain, r"\s+([A-Z]{1,3})$", 1)).alias("post_nominal"), F.btrim(F.regexp_replace(plain, r"\s+[A-Z]{1,3}$", "")).alias("bare")))

    def whole(x: Column) -> Column:
        role = _none_if_empty(F.regexp_extract(x["bare"], f"(?i)({ROLES})", 1))
        honorific = F.when(F.contains(x["text"], F.lit(HONORIFIC)), HONORIFIC)
        return _bound(role, lambda role: F.struct(honorific.alias("honorific"), x["title"].alias("title"), _none_if_empty(without(x["bare"], role)).alias("name"), x["post_nominal"].alias("post_nominal"), role.alias("role")))

    parsed = _bound(_bound(_bound(_none_if_empty(F.btrim(c)), titled), named), whole)
    return F.when(F.btrim(c) != "", parsed)


def context_version(c: Column) -> Column:
    return _none_if_empty(F.regexp_extract(c, r"(?i)Version\s*(\d+)", 1))


def context_date(c: Column) -> Column:
    """The first date after one of DATE_LABELS, by ``d/M/yyyy`` or ``d MMMM yyyy``."""
    day = F.regexp_extract(c, rf"(?i)(?:{DATE_LABELS}):\s*(\d{{1,2}}/\d{{1,2}}/\d{{4}}|\d{{1,2}}\s+\w+\s+\d{{4}})", 1)
    return F.coalesce(F.try_to_date(day, "d/M/yyyy"), F.try_to_date(day, "d MMMM yyyy"))
