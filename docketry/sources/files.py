"""Reading and writing: text bodies, JSON lines, CSV, artefacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.citations import to_iso_date
from docketry.functions.text import csv_array, doc_key


def read_source(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def run_query(df: DataFrame, sql: str, args: dict) -> DataFrame:
    """SQL over the frame {df} with named markers; a list is used with array_contains."""
    return df.sparkSession.sql(sql, args=args, df=df)


def read_bodies(spark: SparkSession, root: str) -> DataFrame:
    """(path, body) of all text files under a folder."""
    return spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def split_records(df: DataFrame, content: str, longest: int) -> DataFrame:
    """Records whose JSON line has more than ``longest`` characters as several, in order: each with all other fields and as
    many characters of the content as a line has room for beside them. ``part`` numbers them from 0. Records whose
    other fields leave no room are an error; marks that JSON escapes aren't counted, as in a plain cut."""
    fields = df.columns
    whole = F.length(F.to_json(F.struct(*fields)))
    room = longest - F.length(F.to_json(F.struct(*(F.lit("").alias(x) if x == content else F.col(x) for x in fields))))
    size = F.length(content)
    starts = F.when(whole <= longest, F.array(F.lit(1))).when(room <= 0, F.raise_error(F.lit(f"fields beside {content} exceed {longest} characters")).cast("array<int>"))
    starts = starts.otherwise(F.sequence(F.lit(1), F.greatest(size, F.lit(1)), F.greatest(room, F.lit(1))))
    each = df.select("*", F.when(whole > longest, room).alias("_room"), F.posexplode(starts).alias("part", "_start"))
    cut = F.when(F.col("_room").isNull(), F.col(content)).otherwise(F.substr(content, F.col("_start"), F.col("_room")))
    return each.select(*(cut.alias(x) if x == content else x for x in fields), "part")


def export_jsonl(df: DataFrame, path: str, most_records: int = 5000, longest_line: int | None = None, content: str | None = None) -> None:
    """A JSON object a line, ``most_records`` a file. Of lines of more characters than ``longest_line`` the field ``content``
    is split over several records; without such a field they are left out."""
    if longest_line is not None and content is not None:
        df, longest_line = split_records(df, content, longest_line).drop("part"), None
    lines = df.select(F.to_json(F.struct(*df.columns)).alias("value"))
    kept = lines if longest_line is None else lines.where(F.length("value") <= longest_line)
    kept.write.option("maxRecordsPerFile", most_records).mode("errorifexists").text(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("escape", '"').csv(path)


def write_index(df: DataFrame, path: str, source_id: str, section_id: str | None = None, batch: int = 100) -> DataFrame:
    """Bulk files of a search index, ``batch`` documents a file: an action line with the id, then the document of
    the column ``document``. Returns what was written: (id, indexed), where documents without JSON aren't."""
    key = doc_key(F.col(source_id), F.col(section_id) if section_id else F.lit(None))
    keyed = df.select(key.alias("id"), F.try_parse_json("document").isNotNull().alias("indexed"), "document")
    action = F.to_json(F.struct(F.struct(F.col("id").alias("_id")).alias("index")))
    keyed.where("indexed").select(F.concat(action, F.lit("\n"), "document").alias("value")).write.option("maxRecordsPerFile", batch).text(path)
    return keyed.select("id", "indexed")


def write_vectors(df: DataFrame, path: str) -> None:
    """Rows of ``vector_docs`` as a table; their vectors are arrays of floats."""
    df.select("doc_id", "doc_type", F.col("vector").cast("array<float>").alias("vector")).write.mode("append").parquet(path)


def write_artifact(df: DataFrame, path: str, partition: str) -> None:
    df.write.partitionBy(partition).parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def content_complete(inventory: DataFrame, required: list[str]) -> DataFrame:
    """pass where all required files are there and not empty."""
    present = F.count_if(F.col("name").isin(required) & (F.col("size") > 0))
    return inventory.groupBy("source_id").agg(F.when(present == len(required), "pass").otherwise("failed").alias("status_content"))


def resolve_artifact(inventory: DataFrame, names: list[str]) -> DataFrame:
    """The first of the names that each document has."""
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("name"))
    return inventory.where(F.col("name").isin(names)).groupBy("source_id").agg(F.min_by("name", rank).alias("name"))


def record_json(*columns: Column) -> Column:
    """A JSON object without its null fields."""
    return F.to_json(F.struct(*columns))


def row_text(columns: list[str], number: Column) -> Column:
    """``Row i: header=value, ...``."""
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns]
    return F.concat(F.lit("Row "), number.cast("string"), F.lit(": "), F.concat_ws(", ", *parts))


def to_document(df: DataFrame, kind: str, required: list[str], optional: list[str] = (), lists: list[str] = (), dates: list[str] = ()) -> DataFrame:
    """df with a column ``document``, JSON for a search index: the required fields, the kind, the content and its
    length; optional fields only where they aren't empty, comma lists as arrays, dates as ``yyyy-MM-dd``."""
    fields = [F.col(x) for x in required] + [F.lit(kind).alias("document_type"), F.col("content"), F.coalesce(F.length("content"), F.lit(0)).alias("content_length")]
    fields += [F.nullif(F.col(x), F.lit("")).alias(x) for x in optional]
    fields += [F.when(F.size(csv_array(F.col(x))) > 0, csv_array(F.col(x))).alias(x) for x in lists] + [to_iso_date(F.col(x)).alias(x) for x in dates]
    return df.withColumn("document", F.to_json(F.struct(*fields)))
