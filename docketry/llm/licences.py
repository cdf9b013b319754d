"""License scans: canonical digests of entire texts, hash-joined to the digests of known licences.

A text is brought to a canonical form: lower case, equal spellings, no copyright lines, words with single
spaces, no blank lines. A known text is found wherever a run of whole lines holds its words, however they are
wrapped: each line that begins with the first word of a known text is a start, and as many words as that text
has from there on, ending with a line, are digested and looked up. A whole document is such a run too.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm.licence_texts import NOTICES

# Spellings that count as equal, after lower case.
SPELLINGS = [("licence", "license"), ("licenced", "licensed"), ("licences", "licenses"), ("organisation", "organization"), ("v.", "version"), ("http:", "https:")]
#: A line that tells whose work it is and of which year, after lower case.
COPYRIGHT = r"(?m)^[^a-z0-9\n]*(?:copyright[ \t]*(?:\(c\)|©|[<\[]?(?:[0-9]{4}|year|yyyy))|\(c\)[ \t]|©)[^\n]*$"
#: Most known texts whose first words are looked for in place and whose digests are broadcast; more are joined
#: by shuffle, and then each line is a start.
BROADCAST_TEXTS = 10_000


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text; null has none."""
    plain = F.regexp_replace(F.lower(text), COPYRIGHT, "")
    for other, usual in SPELLINGS:
        plain = F.regexp_replace(plain, rf"\b{other.replace('.', chr(92) + '.')}(?![a-z])", usual)
    plain = F.regexp_replace(plain, r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    lines = F.filter(F.transform(F.split(plain, "\n"), lambda x: F.trim(x)), lambda x: x != "")
    return F.coalesce(lines, F.array().cast("array<string>"))


def canonical(text: Column) -> Column:
    return F.array_join(canonical_lines(text), " ")


def known_notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(NOTICES, "licence string, notice string")


def _first_word(line: Column) -> Column:
    return F.substring_index(line, " ", 1)


def matches(docs: DataFrame, known: DataFrame, text: str = "notice") -> DataFrame:
    """known: licence and a text column. Returns the places where a known text stands: doc_id, version (a hash
    of the document's text), line (from 1, canonical lines), n_words, licence, whole (it is all of the document)."""
    form = known.select("licence", canonical(F.col(text)).alias("form")).where("form <> ''").withColumn("n_words", F.size(F.split("form", " ")))
    known = form.groupBy(F.sha2("form", 256).alias("digest")).agg(F.min("licence").alias("licence"), F.first("n_words").alias("n_words"), F.first(_first_word(F.col("form"))).alias("lead"))
    size, longest = known.agg(F.count("*"), F.coalesce(F.max("n_words"), F.lit(1))).first()
    small = size <= BROADCAST_TEXTS
    shared = F.broadcast if small else (lambda df: df)
    leads = [x["lead"] for x in known.select("lead").distinct().collect()] if small else None
    start = (lambda line: _first_word(line).isin(leads)) if small else (lambda line: F.lit(True))
    lined = docs.where("doc_id IS NOT NULL").select("doc_id", version().alias("version"), canonical_lines(F.col("text")).alias("lines"))
    # A known text of n words has n lines at most.
    body = lambda at: F.array_join(F.slice("lines", at + 1, F.lit(longest + 1)), "\n")
    starts = F.transform("lines", lambda line, at: F.when(start(line), F.struct((at + 1).alias("line"), body(at).alias("body"))))
    found = lined.select("doc_id", "version", F.explode(F.array_compact(starts)).alias("s")).select("doc_id", "version", "s.line", "s.body")
    found = found.withColumns({"words": F.split("body", "[ \n]"), "lead": F.regexp_extract("body", "^[^ \n]*", 0)})
    words = F.array_join(F.slice("words", F.lit(1), F.col("n_words")), " ")
    sized = found.join(shared(known.select("lead", "n_words").distinct()), "lead").where(F.size("words") >= F.col("n_words"))
    after = F.substring(F.col("body"), F.length(words) + 1, F.lit(1))
    ended = sized.where(after.isin("\n", "")).select("doc_id", "version", "line", "n_words", F.sha2(words, 256).alias("digest"), ((F.col("line") == 1) & (after == "")).alias("whole"))
    return ended.join(shared(known.drop("n_words", "lead")), "digest").select("doc_id", "version", "line", "n_words", "licence", "whole").distinct()


def version() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def licences(docs: DataFrame, known: DataFrame, text: str = "notice") -> DataFrame:
    """known: licence and a text column. Returns, for each distinct doc_id that isn't null, doc_id, n_matches
    (places where a known text stands), licences (sorted, comma-joined, empty if none), whole (the document is
    one licence text and nothing else). Null and empty texts match nothing; of rows with the same doc_id one
    counts, by a hash of its text; other columns of docs are not read. No documents give no rows."""
    each = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(version()).alias("version"))
    met = matches(docs, known, text).groupBy("doc_id", "version").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("licence")).alias("found"), F.max("whole").alias("whole"))
    joined = each.join(met, ["doc_id", "version"], "left")
    return joined.select("doc_id", F.coalesce("n", F.lit(0)).alias("n_matches"), F.coalesce(F.array_join("found", ","), F.lit("")).alias("licences"), F.coalesce("whole", F.lit(False)).alias("whole"))
