"""JSON in replies and fields: the first JSON of a text, values as text, trees as rows."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from docketry.sources.rounds import checkpointed

FENCED = re.compile(r"```json\s*(\{[\s\S]*?\}|\[[\s\S]*?\])\s*```")
_OPEN = re.compile(r"[\[{]")


def first_json(text: str) -> str | None:
    """The object or array of a fence; else what begins with the first bracket, up to where it is balanced. Brackets in
    strings don't count. Null if that isn't JSON."""
    if found := FENCED.search(text):
        return found[1].strip()
    if not (start := _OPEN.search(text)):
        return None
    try:
        _, end = json.JSONDecoder(strict=True).raw_decode(text, start.start())
    except (ValueError, RecursionError):
        return None
    return text[start.start() : end]


@F.pandas_udf(StringType())
def extract_json(text: pd.Series) -> pd.Series:
    return text.map(lambda x: first_json(x) if isinstance(x, str) else None)


def flattened(value: Column) -> Column:
    """A VARIANT as text for a column: a list of scalars (text, numbers, booleans) is joined by a comma, other lists and
    objects are compact JSON, booleans are in lower case (in lists they begin with a capital), the rest is its own text;
    null stays null."""
    kind = F.schema_of_variant(value)
    items = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: F.struct(F.schema_of_variant(x).alias("kind"), x.cast("string").alias("text")))
    scalar = F.forall(items, lambda x: ~F.startswith(x.kind, F.lit("OBJECT")) & ~F.startswith(x.kind, F.lit("ARRAY")) & (x.kind != "VOID"))
    shown = F.transform(items, lambda x: F.when(x.kind == "BOOLEAN", F.initcap(x.text)).otherwise(x.text))
    is_list = F.startswith(kind, F.lit("ARRAY"))
    return (
        F.when(kind == "VOID", None)
        .when(is_list & scalar, F.array_join(shown, ", "))
        .when(is_list | F.startswith(kind, F.lit("OBJECT")), F.to_json(value))
        .when(kind == "BOOLEAN", F.lower(value.cast("string")))
        .otherwise(value.cast("string"))
    )


def flattened_fields(record: Column) -> Column:
    """A JSON object's fields as a map of texts; null if the text is no object."""
    value = F.try_parse_json(record)
    fields = F.when(F.startswith(F.schema_of_variant(value), F.lit("OBJECT")), F.try_variant_get(value, "$", "map<string,variant>"))
    return F.transform_values(fields, lambda _, v: flattened(v))


def flatten_tree(trees: DataFrame, key: str, tree: str, children: str = "children", fields: tuple[str, ...] = ("id", "type", "title")) -> DataFrame:
    """(key, node, parent, depth, place, fields): a row for each node of a nested JSON tree, of any depth. node is the
    path of places from the root (``0``, ``0.2``, ``0.2.1``), place the node's among its siblings. Null trees, and what isn't
    JSON, have no rows; nodes that are null are none. A round opens one more level."""
    empty = F.lit("0")
    level = trees.select(key, empty.alias("node"), F.lit(None).cast("string").alias("parent"), F.lit(0).alias("place"), F.try_parse_json(F.col(tree)).alias("v"))
    found, depth = None, 0
    while True:
        # Variants go through stored rounds as text.
        level = checkpointed(level.where(F.col("v").isNotNull() & (F.schema_of_variant("v") != "VOID")).select(key, "node", "parent", "place", F.to_json("v").alias("v")))
        if level.isEmpty():
            break
        value = F.parse_json("v")
        told = level.select(key, "node", "parent", F.lit(depth).alias("depth"), "place", *(F.try_variant_get(value, f"$.{x}", "string").alias(x) for x in fields))
        found = told if found is None else found.unionByName(told)
        below = level.select(key, F.col("node").alias("parent"), F.posexplode(F.try_variant_get(value, f"$.{children}", "array<variant>")).alias("place", "v"))
        level, depth = below.select(key, F.concat("parent", F.lit("."), F.col("place").cast("string")).alias("node"), "parent", "place", "v"), depth + 1
    if found is None:
        return trees.select(key).where("false").select(key, *(F.lit(None).cast("string").alias(x) for x in ("node", "parent")), F.lit(0).alias("depth"), F.lit(0).alias("place"), *(F.lit(None).cast("string").alias(x) for x in fields))
    return found


def tree_paths(nodes: DataFrame, key: str, node: str, parent: str, label: str) -> DataFrame:
    """(key, node, root, depth, path): the labels from the root to each node of trees given by parents, joined by ``/``.
    Each round doubles the way that is known, so that a tree of depth d takes log2(d) rounds. A node whose
    parent isn't there is a root; nodes on a loop, and below one, have no row."""
    own = nodes.select(key, F.col(node).alias("node"), F.col(parent).alias("up"), F.coalesce(F.col(label).cast("string"), F.lit("")).alias("path"))
    there = own.select(key, F.col("node").alias("up"), F.lit(True).alias("known")).distinct()
    known = own.join(there, [key, "up"], "left").select(key, "node", F.when(F.col("known"), F.col("up")).alias("up"), F.col("node").alias("root"), F.lit(0).alias("depth"), "path")
    known, open_before = checkpointed(known), None
    while True:
        still = known.where("up IS NOT NULL").count()
        if still in (0, open_before):
            break
        above = known.select(key, F.col("node").alias("up"), F.col("up").alias("_up"), F.col("root").alias("_root"), F.col("depth").alias("_depth"), F.col("path").alias("_path"))
        met = known.join(above, [key, "up"], "left")
        further = F.col("_root").isNotNull()
        known = checkpointed(
            met.select(
                key, "node", F.when(further, F.col("_up")).otherwise(F.col("up")).alias("up"), F.coalesce("_root", "root").alias("root"),
                F.when(further, F.col("depth") + F.col("_depth") + 1).otherwise(F.col("depth")).alias("depth"), F.when(further, F.concat_ws("/", "_path", "path")).otherwise(F.col("path")).alias("path"),
            )
        )
        open_before = still
    return known.where("up IS NULL").drop("up")
