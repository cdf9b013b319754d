"""The operators' queries, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.llm import licences as licence_scan
from docketry.llm.chat import repaired
from docketry.llm.decontaminate import contamination
from docketry.llm.fingerprints import fingerprints
from docketry.llm.hard_negatives import hard_negatives
from docketry.llm.near_dedup import near_duplicates
from docketry.llm.packing import pack
from docketry.llm.periodic import periodic
from docketry.llm.quality import quality
from docketry.llm.repeats import repeats
from docketry.llm.secrets import findings
from docketry.llm.sentencepieces import round_trip
from docketry.llm.toxicity import toxicity


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repaired(_read(spark, sf_dir, "conversations"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_read(spark, sf_dir, "documents"), tokenizer_path)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.licences(_read(spark, sf_dir, "documents"), licence_scan.known_notices(spark))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("items")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(_read(spark, sf_dir, "documents"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(_read(spark, sf_dir, "documents"))


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(_read(spark, sf_dir, "documents"))


def _with_periods(docs: DataFrame) -> DataFrame:
    """In one of ten documents, by the checksum of doc_id, the words from one place on repeat with a period."""
    check = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(check / 10)
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda x: x != "")
    chosen = F.when(check % 10 == 0, words)
    n = F.size("w")
    put = docs.select("doc_id", "text", chosen.alias("w"), g.alias("g"))
    put = put.select("doc_id", "text", "w", "g", F.when(n > 0, F.col("g") % n).alias("a"))
    put = put.select("doc_id", "text", "w", "a", (1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))).alias("p"))
    at = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")
    periods = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("w", at(i))), " ")
    return put.select("doc_id", F.when(n > 0, periods).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic(_with_periods(_read(spark, sf_dir, "documents")))
    # The exponents of two runs are compared exactly.
    order = lambda x, y: F.when(x.length * y.period != y.length * x.period, F.when(x.length * y.period > y.length * x.period, -1).otherwise(1)).when(x.start != y.start, F.when(x.start < y.start, -1).otherwise(1)).otherwise(F.signum(x.period - y.period).cast("int"))  # noqa: E731, E501
    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    digests = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return digests.select("doc_id", "n_runs", "b.start", "b.length", "b.period", F.floor(1000 * F.col("b.length") / F.col("b.period")).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = round_trip(_read(spark, sf_dir, "documents"), lambda: tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _read(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    return hard_negatives(rows.where(finite).select("vec_id", label.alias("label"), vector.alias("vector"), (F.col("vec_id") % 50 == 0).alias("anchor")))


QUERIES = {
    "op11_periodic_runs": op11_periodic_runs,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_hard_negatives": op13_hard_negatives,
    "op1_chat_formatting": op1_chat_formatting,
    "op7_suffix_array_dedup": op7_suffix_array_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op10_fingerprints": op10_fingerprints,
    "op3_license_scan": op3_license_scan,
    "op4_quality_classifier": op4_quality_classifier,
    "op9_toxicity": op9_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op5_decontamination": op5_decontamination,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
}

_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _lines_sql(text: str) -> str:
    plain = f"regexp_replace(lower({text}), '{licence_scan.COPYRIGHT}', '', 'g')"
    for other, usual in licence_scan.SPELLINGS:
        # RE2 has no look-ahead: the character after the spelling is kept.
        plain = f"regexp_replace({plain}, '\\b{other.replace('.', chr(92) + '.')}([^a-z]|$)', '{usual}\\1', 'g')"
    plain = f"regexp_replace({plain}, '[\\x00-\\x09\\x0B-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', ' ', 'g')"
    return f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"


_NOTICES_SQL = ", ".join("('{}', '{}')".format(licence, notice.replace("'", "''")) for licence, notice in licence_scan.NOTICES)

ORACLE_SQL = {
    "op3_license_scan": f"""
WITH forms AS (SELECT licence, array_to_string({_lines_sql('notice')}, ' ') AS form FROM (VALUES {_NOTICES_SQL}) v(licence, notice)),
known AS (SELECT form, min(licence) AS licence, len(string_split(form, ' ')) AS k FROM forms GROUP BY form),
lined AS (SELECT doc_id, {_lines_sql("coalesce(text, '')")} AS lines FROM documents),
bodies AS (SELECT doc_id, i, array_to_string(lines[i:], chr(10)) AS body FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM lined)),
met AS (
  SELECT doc_id, i, licence, i = 1 AND length(body) = length(form) AS whole FROM bodies JOIN known ON starts_with(replace(body, chr(10), ' '), form)
  WHERE length(body) = length(form) OR body[length(form) + 1] = chr(10))
SELECT doc_id, count(licence) AS n_matches, coalesce(string_agg(DISTINCT licence, ',' ORDER BY licence), '') AS licences, coalesce(bool_or(whole), false) AS whole
FROM documents LEFT JOIN met USING (doc_id) GROUP BY doc_id""",
    "op5_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s : s + 12], ' ') AS t, least(13, len(w)) AS n
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS t
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT DISTINCT doc_id, s, win.n AS n, item_id FROM dw JOIN win ON dw.t = win.t AND dw.n = win.n),
hits AS (SELECT doc_id, count(DISTINCT p) AS h FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS c, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(h, 0) AS BIGINT) AS n_hit, CAST(coalesce(c, 0) AS BIGINT) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256, coalesce(h, 0) > 0 AND 20 * coalesce(h, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op8_minhash_near_dedup": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_UPPER}, {_LOWER}), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS sh FROM d),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
t AS (SELECT doc_id, unnest(sh) AS g FROM s),
both_in AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n_shingles + y.n_shingles - c)),
arcs AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(node, other) AS (SELECT doc_id, doc_id FROM n UNION SELECT node, arcs.b FROM reach JOIN arcs ON arcs.a = other)
SELECT n.doc_id, n_shingles, min(other) AS component_id, n.doc_id = min(other) AS kept FROM n JOIN reach ON node = n.doc_id GROUP BY n.doc_id, n_shingles""",
    "op13_hard_negatives": """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS k FROM s WHERE same) x WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, s.id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
}
