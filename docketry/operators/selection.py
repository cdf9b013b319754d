"""Work selection: which documents a step still has to do."""

from __future__ import annotations

import functools
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARISONS = {
    "=": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "in": lambda c, v: c.isin(list(v)),
}


def not_passed(status: Column, null_is_pending: bool) -> Column:
    """Status other than pass. A null status is unknown: it is selected only if the operator says so."""
    return status.isNull() | (status != "pass") if null_is_pending else status != "pass"


def pending(
    registry: DataFrame,
    status: DataFrame,
    step: str,
    *,
    jurisdictions: Iterable[str] = (),
    years: Iterable[int] = (),
    required: Iterable[str] = (),
    missing_row_is_pending: bool = True,
    null_is_pending: bool = False,
) -> DataFrame:
    """Rows of the registry that the step still has to do. An empty list is no filter; ``required`` columns
    must be pass; a document without status row is pending if ``missing_row_is_pending``, else left out."""
    joined = registry.join(status.withColumn("_has", F.lit(True)), "source_id", "left" if missing_row_is_pending else "inner")
    if jurisdictions := list(jurisdictions):
        joined = joined.where(F.col("jurisdiction_code").isin(jurisdictions))
    if years := list(years):
        joined = joined.where(F.col("year").isin(years))
    for column in required:
        joined = joined.where(F.col(column) == "pass")
    return joined.where(F.col("_has").isNull() | not_passed(F.col(step), null_is_pending)).drop("_has")


def where_from_config(df: DataFrame, conditions: Iterable[Mapping[str, Any]]) -> DataFrame:
    """Rows that meet all {column, operator, value} conditions; operators are those of COMPARISONS."""
    tests = [COMPARISONS[c["operator"].lower()](F.col(c["column"]), c["value"]) for c in conditions]
    return df.where(functools.reduce(lambda a, b: a & b, tests)) if tests else df


def new_or_failed(source: DataFrame, done: DataFrame, key: str = "source_id") -> DataFrame:
    """Source rows whose key has not passed."""
    return source.join(done.select(key), key, "left_anti")


def default_domain(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) != "")).select(column).distinct()


def bad_source(citation: Column) -> Column:
    return F.coalesce(F.contains(F.lower(citation), F.lit("null")), F.lit(False))


def missing_fields(fields: Iterable[str]) -> Column:
    """Names of the fields that are null or empty, in their order, comma-joined."""
    tests = [F.when(F.col(f).isNull() | (F.col(f).cast("string") == ""), F.lit(f)) for f in fields]
    return F.array_join(F.array_compact(F.array(*tests)), ", ")


def failure_reasons(missing: Column, *others: Column) -> Column:
    """Why a record fails: the missing mandatory fields and then other reasons, joined by `; `; null if it doesn't.
    missing: of ``missing_fields``; reasons that are null don't count."""
    named = F.when(missing != "", F.concat(F.lit("Missing mandatory fields: "), missing))
    return F.nullif(F.concat_ws("; ", named, *others), F.lit(""))


def grown(new: Column, baseline: Column) -> Column:
    """Whether content has more bytes than its baseline; -1 stands for no baseline."""
    return F.when(baseline == -1, "missing").when(F.octet_length(new) > baseline, "pass").otherwise("failed")


def pending_sites(requests: DataFrame, sites: DataFrame, key: str, status: str) -> DataFrame:
    """Outcome of each requested id: ``run`` for a pending site, else ``handled``; ids without site and sites
    of another status are no work."""
    joined = requests.join(sites.select(key, status), key, "left")
    return joined.withColumn("outcome", F.when(F.col(status) == "pending", "run").otherwise("handled"))


def steps_to_run(json_status: Column, html_status: Column) -> tuple[Column, Column, Column]:
    """Whether the stored JSON is loaded, the JSON is built, the HTML is built. A null status isn't pass."""
    done = F.coalesce(json_status == "pass", F.lit(False))
    return done, ~done, ~F.coalesce(html_status == "pass", F.lit(False))
