"""Derived views on the driver's tables, one text for Spark and for SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]


def _choice(number: str, values: list[str]) -> str:
    return f"CASE {number} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in enumerate(values[:-1])) + f" ELSE '{values[-1]}' END"


_SPOKEN = ["HCA", "NSWSC", "NSWCA", "FCAFC", "VSC", "NZHC", "QCATA", "FamCAFC", "WASAT", "NSWCATAP", "JULY", "SAERD", "VCAT", "XYZ", "TRA", "QIRCX"]
_CODE = _choice("o_orderkey % 16", _SPOKEN)
_MEMBER = _choice("o_orderkey % 8", ["Justice Brown J", "Ms Ann Grey, Senior Member", "Deputy President Lee DP", "Dr Kim Vo", "The Honourable Justice Cronin", "Member J Prentice", "K Dordevic SM", "Vice-President Hill VP"])
_YEAR = "CAST(year(o_orderdate) AS VARCHAR(4))"
_KEY = "CAST(o_orderkey AS VARCHAR(20))"
_DAY = "CAST(day(o_orderdate) AS VARCHAR(2))"
_LONG = f"{_DAY}, ' ', {_choice('month(o_orderdate) - 1', _MONTHS)}, ' ', {_YEAR}"
_SLASHED = f"{_DAY}, '/', CAST(month(o_orderdate) AS VARCHAR(2)), '/', {_YEAR}"
#: (code, type): the codes that the queries know; a stand-in for the code lists of an installation.
CODES = [(x, "jurisdiction") for x in ("NSW", "VIC", "QLD", "WA", "SA", "TAS", "ACT", "NT", "NZ")]
CODES += [(x, "tribunal") for x in ("HCA", "FCA", "FCAFC", "FamCA", "FamCAFC", "SC", "CA", "HC", "CAT", "SAT", "WCC", "VSC", "VSCA", "QCA", "QCAT", "TRA")]
CODES += [(x, "panel_or_division") for x in ("AP", "PD", "FC", "A")]

#: name: (table, columns, condition)
VIEWS: dict[str, tuple[str, list[str], str | None]] = {
    "registry_v": (
        "documents",
        [
            "doc_id AS source_id",
            "CASE lang WHEN 'en' THEN 'NSW' WHEN 'fr' THEN 'VIC' WHEN 'de' THEN 'QLD' WHEN 'es' THEN 'WA' END AS jurisdiction_code",
            "CAST(2000 + doc_id % 25 AS INT) AS year",
            "source AS book_name",
            "CASE WHEN doc_id % 11 = 0 THEN 'failed' ELSE 'pass' END AS status_content_download",
            "CASE WHEN doc_id % 13 = 0 THEN 'failed' ELSE 'pass' END AS status_registration",
        ],
        None,
    ),
    "status_v": (
        "labels",
        ["doc_id AS source_id", "CASE WHEN doc_id % 17 = 0 THEN 'failed' ELSE 'pass' END AS status_text_processor", "CASE WHEN quality = 1 THEN 'pass' WHEN toxic = 1 THEN 'failed' END AS status_step"],
        None,
    ),
    "citations_v": (
        "orders",
        [
            "o_orderkey AS source_id",
            f"CASE WHEN o_orderkey % 23 = 0 THEN 'null' WHEN o_orderkey % 29 = 0 THEN concat('[', {_YEAR}, '] null ', {_KEY}, ' (', {_LONG}, ')') WHEN o_orderkey % 19 = 0 THEN 'no citation here'"
            f" WHEN o_orderkey % 11 = 0 THEN concat('[[', {_YEAR}, ']] ', {_CODE}, ' ', {_KEY}, ' (', {_SLASHED}, ')') WHEN o_orderkey % 17 = 0 THEN concat('[', {_YEAR}, '] NSW WCC PD ', {_KEY}, ' (', {_LONG}, ') (', {_MEMBER}, ')')"
            f" WHEN o_orderkey % 13 = 0 THEN concat('[', {_YEAR}, '] ', {_KEY}, ' ', {_CODE}, ' (', {_LONG}, ')') WHEN o_orderkey % 31 = 0 THEN concat('[', {_YEAR}, '] ', {_CODE}, ' unreported (', {_LONG}, ') (', {_MEMBER}, ')')"
            f" ELSE concat('[', {_YEAR}, '] ', {_CODE}, ' ', {_KEY}, ' (', {_LONG}, ') (', {_MEMBER}, ')') END AS citation",
        ],
        None,
    ),
    "versions_v": ("orders", ["o_orderkey AS id", "o_custkey AS title", "o_orderdate AS start_date", "CASE WHEN o_orderkey % 7 = 0 THEN CAST(o_orderkey % 5 + 1 AS BIGINT) END AS version"], "o_orderstatus <> 'P'"),
    "contexts_v": (
        "orders",
        [
            "o_orderkey AS id",
            f"concat({_choice('o_orderkey % 4', ['Version 00', 'VERSION  1', 'version', 'Edition '])}, CAST(o_orderkey % 10 AS VARCHAR(2)), ' - ', {_choice('o_orderkey % 7', ['Start date', 'Currency date', 'Date published', 'Date of assent', 'Date made', 'START DATE', 'Effective'])}, ': ', CASE WHEN o_orderkey % 3 = 0 THEN concat({_LONG}) ELSE concat({_SLASHED}) END) AS context",
        ],
        None,
    ),
    "inventory_v": (
        "(SELECT page_id, html, 'excerpt.html' AS name FROM pages UNION ALL SELECT page_id, html, 'reading.html' AS name FROM pages UNION ALL SELECT page_id, html, 'summary.html' AS name FROM pages UNION ALL SELECT page_id, html, 'structured.html' AS name FROM pages WHERE page_id % 3 = 0)",
        ["page_id AS source_id", "name", "CASE WHEN page_id % 7 = 0 AND name = 'summary.html' THEN 0 ELSE length(html) END AS size", "html AS body"],
        "NOT (page_id % 13 = 0 AND name = 'excerpt.html')",
    ),
    "sections_v": ("conversations", ["conv_id AS source_id", "turn AS section_id", "CASE WHEN role = 'user' THEN 1 ELSE 0 END AS is_head", "role", "text"], None),
}


def tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    table, columns, where = VIEWS[name]
    if table.startswith("("):
        pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
        names = ["excerpt.html", "reading.html", "summary.html"]
        parts = [pages.selectExpr("page_id", "html", f"'{n}' AS name") for n in names] + [pages.where("page_id % 3 = 0").selectExpr("page_id", "html", "'structured.html' AS name")]
        df = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    else:
        df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return (df.where(where) if where else df).selectExpr(*columns)


def with_views(sql: str) -> str:
    """The SQL after the definitions of the views that it names."""
    used = [f"{name} AS (SELECT {', '.join(c)} FROM {t}{f' WHERE {w}' if w else ''})" for name, (t, c, w) in VIEWS.items() if name in sql]
    if not used:
        return sql
    head = "WITH " + ", ".join(used)
    body = sql.strip()
    return f"{head}, {body[5:]}" if body.upper().startswith("WITH ") else f"{head} {body}"
