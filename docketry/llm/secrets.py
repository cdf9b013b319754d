"""Secret scans: candidates by shape, then a random forest that removes false positives.

DataFrame functions and Spark's own tree ensemble only. A text is split at white space; a candidate is a
run of at least 16 letters, digits and ``_ + / -`` in one of its tokens, so its neighbouring words are the
tokens around it. Of any length and with any symbols, the value assigned to a name with one of KEY_WORDS and
the password or token in the user part of a URL are candidates too.

The forest looks at a candidate's length, at how likely its character transitions are in the corpus's words,
at the share of it that the corpus's dictionary covers, at the path and at the neighbouring words. It is trained
from labelled findings: reviewed ones where there are any, else planted ones, strings of known kind set into
passages of the corpus, so that their labels come from how they were made and not from what the forest sees.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.store import free_name, stored

RUN = r"(?<![A-Za-z0-9_+/-])(?=[_+/-]*+[A-Za-z0-9])[A-Za-z0-9_+/-]{16,}+={0,2}"
#: Most labelled findings that the forest is trained on, and most passages that findings are planted in.
SAMPLE = 10_000
MASK = "[SECRET]"
#: How many characters on each side of a candidate count as beside it.
NEAR = 256
#: A name with a key word, read once from its start, a sign of assignment on the same line, and the value: quoted, or up to white space
#: without the marks that end it. Groups: what leads
#: to the value, the value in either quotes, a quote that is not closed, the value without quotes.
ASSIGNED = (
    r"""((?<![\w.-])(?=[\w.-]*?(?i:pass|pwd|token|secret|api|key|auth|credential|bearer))[\w.-]++["'\]]*+[^\S\n]*+(?:=>|:=|={1,3}|:)[^\S\n]*+(?:(?i:bearer|basic)[^\S\n]++)?)"""
    r"""(?:"(?=[^\S\n]*+[^"\s])([^"\n]++)"|'(?=[^\S\n]*+[^'\s])([^'\n]++)'|(["']?)([^\s"'](?:\S*[^\s.,;:)\]}>"'])?))"""
)
#: The user part of a URL: the password if there is one, else the name, which may be a token.
IN_URL = r"([A-Za-z][A-Za-z0-9+.-]{0,30}+://(?:[^\s/:@]*+:)?)([^\s/]+)@"
#: Words beside a secret that tell of one.
KEY_WORDS = r"(?i)(pass|pwd|token|secret|api|key|auth|credential|bearer)"
#: How often a word must stand in the corpus to be in its dictionary.
LEAST = 5
#: Kinds of characters for transitions: other, a to z, digits.
KINDS = 28
FEATURES = [
    "length", "digits", "capitals", "vowels", "changes", "transitions", "covered", "distinct", "hexadecimal", "key_before", "key_beside", "assigned", "quoted", "path_depth",
    "path_test", "symbols", "in_url",
]


_MARK = "\x01"
_FOUND = "array<struct<at:int,secret:string,lead:string,spans:int>>"


def _at_places(pattern: str, marked: str, lead: Column, value: Column) -> Column:
    """Of each match of pattern in _text: at (the token in which the secret begins), secret, what leads to it, and the
    number of tokens it spans. marked puts _MARK in front of the secret; the tokens of the text with marks tell the
    places of all matches in one pass."""
    found = F.regexp_extract_all("_text", F.lit(f"({pattern})"), F.lit(1))
    marks = F.transform(F.split(F.regexp_replace("_text", pattern, marked), r"\s+"), lambda t, i: F.array_repeat(i, F.length(t) - F.length(F.replace(t, F.lit(_MARK), F.lit("")))))
    one = lambda x, at: F.struct(at.alias("at"), value(x).alias("secret"), lead(x).alias("lead"), F.regexp_count(value(x), F.lit(r"\s+")).alias("spans"))
    return F.zip_with(found, F.flatten(marks), one)


def _assigned() -> Column:
    group = lambda x, k: F.regexp_extract(x, ASSIGNED, k)
    value = lambda x: F.concat(group(x, 2), group(x, 3), group(x, 5))
    lead = lambda x: F.concat(group(x, 1), F.when(group(x, 2) != "", '"').when(group(x, 3) != "", "'").otherwise(group(x, 4)))
    return F.when(F.col("_text").rlike(ASSIGNED), _at_places(ASSIGNED, f"$1$4{_MARK}$2$3$5", lead, value))


def _in_url() -> Column:
    group = lambda k: lambda x: F.regexp_extract(x, IN_URL, k)
    return F.when(F.contains("_text", F.lit("://")) & F.col("_text").rlike(IN_URL), _at_places(IN_URL, f"$1{_MARK}$2@", group(1), group(2)))


def candidates(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """(doc_id, at, secret, before, token, after, path, lead, context): at is the number of the token in which
    the secret begins, lead what stands before it in this token, all of these to NEAR characters, and context what is looked for to mask it: a run
    by itself, a value after what leads to it. Null and empty texts have none; without a path column, or where it
    is null, the path is empty. The work grows with the length of a text, whatever it holds."""
    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path and path in docs.columns else F.lit("")
    # The mark is no white space; where a text has it, another such character takes its place.
    texts = docs.where("doc_id IS NOT NULL").select("doc_id", place.alias("path"), F.translate(F.coalesce("text", F.lit("")), _MARK, "\x02").alias("_text"))
    tokens = texts.select("doc_id", "path", "_text", F.split("_text", r"\s+").alias("tokens"))
    # Tokens beside a candidate are looked up within arrays, so that no row carries those of the whole text.
    beside = lambda at, n, cut=F.left: cut(F.coalesce(F.when(at + n >= 0, F.get("tokens", at + n)), F.lit("")), F.lit(NEAR))
    before = lambda at: F.concat_ws(" ", beside(at, F.lit(-2), F.right), beside(at, F.lit(-1), F.right)).alias("before")
    near = F.transform("tokens", lambda t, i: F.when((F.length(t) >= 16) & t.rlike(RUN), F.struct(i.alias("at"), before(i), t.alias("token"), beside(i, F.lit(1)).alias("after"))))
    near = tokens.select("doc_id", "path", F.explode(F.filter(near, lambda x: x.isNotNull())).alias("x")).select("doc_id", "path", "x.*")
    runs = near.select("doc_id", "at", F.explode(F.array_distinct(F.regexp_extract_all("token", F.lit(f"({RUN})"), F.lit(1)))).alias("secret"), "before", "token", "after", "path")
    lead = F.right(F.call_function("substring_index", F.col("token"), F.col("secret"), F.lit(1)), F.lit(NEAR))
    runs = runs.withColumns({"lead": lead, "token": F.left("token", F.lit(NEAR)), "context": F.col("secret")})
    empty = F.array().cast(_FOUND)
    # A value that is a run as a whole is one of the runs already.
    values = F.filter(F.concat(F.coalesce(_assigned(), empty), F.coalesce(_in_url(), empty)), lambda v: ~v["secret"].rlike(f"^{RUN}$"))
    own = lambda v: F.right(F.regexp_extract(v["lead"], r"\S*$", 0), F.lit(NEAR))
    values = F.transform(
        values, lambda v: F.struct(
            v["at"].alias("at"), v["secret"].alias("secret"), before(v["at"]), beside(v["at"], F.lit(0)).alias("token"), beside(v["at"], v["spans"] + 1).alias("after"), own(v).alias("lead"),
            F.concat(v["lead"], v["secret"]).alias("context"),
        ),
    )
    found = tokens.select("doc_id", "path", F.explode(values).alias("v")).select("doc_id", "v.at", "v.secret", "v.before", "v.token", "v.after", "path", "v.lead", "v.context").distinct()
    return runs.unionByName(found)


def dictionary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of three letters or more that stand LEAST times or more in all documents."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}{3,})"), F.lit(1))).alias("word"))
    return stored(words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST), "dictionary")


def _kind(letter: Column) -> Column:
    return F.when(letter.between("a", "z") & (F.octet_length(letter) == 1), F.ascii(letter) - 96).when(letter.between("0", "9") & (F.octet_length(letter) == 1), 27).otherwise(0)


def transitions(words: DataFrame) -> list[float]:
    """log P(next kind | kind) over the dictionary, kind by kind; KINDS squared numbers, whatever the corpus."""
    pairs = words.select("n", "word", F.explode(F.sequence(F.lit(1), F.length("word") - 1)).alias("i")).select(
        _kind(F.substring(F.col("word"), F.col("i"), F.lit(1))).alias("x"), _kind(F.substring(F.col("word"), F.col("i") + 1, F.lit(1))).alias("y"), "n"
    )
    counts = {(r["x"], r["y"]): r["n"] for r in pairs.groupBy("x", "y").agg(F.sum("n").alias("n")).collect()}
    rows = [[counts.get((x, y), 0) + 1 for y in range(KINDS)] for x in range(KINDS)]
    return [math.log(n / sum(row)) for row in rows for n in row]


def described(found: DataFrame, words: DataFrame, likely: list[float]) -> DataFrame:
    """found with FEATURES."""
    parts = found.select("secret").distinct().select("secret", F.explode(F.regexp_extract_all("secret", F.lit(r"(\p{Lu}?\p{Ll}{2,}|\p{Lu}{3,})"), F.lit(1))).alias("part"))
    covered = parts.select("secret", F.lower("part").alias("word")).join(words.select("word"), "word").groupBy("secret").agg(F.sum(F.length("word")).alias("_covered"))
    s, n = F.col("secret"), F.length("secret").cast("double")
    count = lambda pattern: F.regexp_count(s, F.lit(pattern)) / n
    lead = F.col("lead")
    yes = lambda c: c.cast("double")
    kinds = F.transform(F.split(F.lower(s), ""), _kind)
    steps = F.zip_with(F.slice(kinds, 1, F.size(kinds) - 1), F.slice(kinds, 2, F.size(kinds)), lambda x, y: F.element_at(F.lit(likely), x * KINDS + y + 1))
    columns = {
        "length": n,
        "digits": count("[0-9]"),
        "capitals": count("[A-Z]"),
        "vowels": count("[aeiouAEIOU]"),
        "changes": count("(?<=[a-z])[0-9A-Z]|(?<=[0-9])[A-Za-z]|(?<=[A-Z])[0-9a-z]"),
        "transitions": F.when(n > 1, F.aggregate(steps, F.lit(0.0), lambda have, x: have + x) / (n - 1)),
        "covered": F.col("_covered") / n,
        "distinct": F.size(F.array_distinct(F.split(s, ""))) / n,
        "hexadecimal": yes(s.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
        "key_before": yes(F.col("before").rlike(KEY_WORDS)),
        "key_beside": yes(lead.rlike(KEY_WORDS)),
        "assigned": yes(lead.rlike("[=:]") | F.col("before").rlike("[=:]$")),
        "quoted": yes(lead.rlike("[\"']$")),
        "path_depth": F.size(F.split("path", "[/.]")).cast("double"),
        "path_test": yes(F.col("path").rlike("(?i)(test|example|sample|doc)")),
        "symbols": count("[^A-Za-z0-9_+/=-]"),
        "in_url": yes(lead.rlike("://[^/]*$")),
    }
    return found.join(covered, "secret", "left").withColumns({f"f_{k}": F.coalesce(c.cast("double"), F.lit(0.0)) for k, c in columns.items()})


# What is planted. X and Y stand for words of the passage, NAME for one of the names; the rest in
# braces for random strings: hexadecimal, digits, letters and digits of either case or capitals, a password.
NAMES = ["token", "api_key", "SECRET", "access_token", "auth-token", "password"]
SECRET_KINDS = [
    ('{NAME} = "', "{hex40}", '"'), ("{NAME}: ", "{mixed32}", ""), ("{NAME}=", "{hex32}", ""), ("https://{X}:", "{mixed16}", "@{Y}.example/"), ("", "AKIA{capitals16}", ""), ("", "ghp_{mixed36}", ","),
    ('{NAME} = "', "{password}", '"'), ("Authorization: Bearer ", "{mixed40}", ""), ('{X}="', "{mixed40}", '"'), ("{NAME} = '", "{hex64}", "'"), ('"{NAME}": "', "{capitals32}", '"'),
]
OTHER_KINDS = [
    ("commit ", "{hex40}", ""), ("", "{digits16}", ""), ("id ", "{uuid}", ""), ("", "{X}{Y}{X}{Y}", ","), ("{X}/", "{Y}/{X}/{Y}/{X}", "/{Y}"), ("sha256:", "{hex64}", ""), ("{NAME}: ", "{X}", ","),
    ('key = "', "{X} {Y}", '"'), ("checksum ", "{hex32}", "."), ("", "{X}-{Y}-{X}-{Y}-2024", ""), ("{NAME} = ", "{Y}", ""), ("call ", "{digits20}", ""), ("", "{X}_{Y}_{X}_{Y}", "()"),
]


def _filled(pattern: Column, x: Column, y: Column, salt: Column) -> Column:
    """pattern with its braces filled; random strings follow from salt."""
    hexadecimal = F.sha2(salt, 256)
    mixed = F.regexp_replace(F.base64(F.unhex(F.concat(hexadecimal, F.sha2(hexadecimal, 256)))), "[+/=]", "")
    digits = F.translate(hexadecimal, "abcdef", "012345")
    capitals = F.regexp_replace(F.upper(mixed), "[^0-9A-Z]", "")
    part = lambda *at: F.concat_ws("-", *(F.substring(hexadecimal, i, n) for i, n in at))
    values = {
        "X": x, "Y": y, "NAME": F.element_at(F.lit(NAMES), F.pmod(F.xxhash64(salt), F.lit(len(NAMES))).cast("int") + 1), "uuid": part((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)),
        "hex32": F.left(hexadecimal, F.lit(32)), "hex40": F.left(hexadecimal, F.lit(40)), "hex64": hexadecimal, "digits16": F.left(digits, F.lit(16)), "digits20": F.left(digits, F.lit(20)),
        "mixed16": F.left(mixed, F.lit(16)), "mixed32": F.left(mixed, F.lit(32)), "mixed36": F.left(mixed, F.lit(36)), "mixed40": F.left(mixed, F.lit(40)), "capitals16": F.left(capitals, F.lit(16)), "capitals32": F.left(capitals, F.lit(32)),
        "password": F.concat(F.left(mixed, F.lit(5)), F.translate(F.substring(hexadecimal, 1, 1), "0123456789abcdef", "!@#$%^&*!@#$%^&*"), F.substring(mixed, 9, 4)),
    }
    for name, value in values.items():
        pattern = F.replace(pattern, F.lit("{" + name + "}"), value)
    return pattern


def planted(docs: DataFrame, path: str | None = "source", most: int = SAMPLE, seed: int = 1) -> DataFrame:
    """Labelled findings made from at most ``most`` passages of the corpus, chosen by a hash: candidates with
    label 1.0 for the secrets set into them and 0.0 for other strings."""
    place = F.coalesce(F.col(path).cast("string"), F.lit("")) if path and path in docs.columns else F.lit("")
    chance = F.xxhash64("doc_id", F.lit(seed))
    begin = F.pmod(chance, F.greatest(F.length("text") - 160, F.lit(1))).cast("int") + 1
    passages = docs.where("doc_id IS NOT NULL AND length(text) > 0").select("doc_id", place.alias("path"), F.substring(F.col("text"), begin, F.lit(160)).alias("passage"), chance.alias("chance"))
    passages = passages.orderBy("chance", "doc_id", "passage").limit(most).withColumn("tokens", F.filter(F.split("passage", r"\s+"), lambda x: x != "")).where(F.size("tokens") > 3)
    patterns = [(*p, 1.0) for p in SECRET_KINDS] + [(*p, 0.0) for p in OTHER_KINDS]
    kind = F.pmod(F.xxhash64("chance", F.lit(seed)), F.lit(len(patterns))).cast("int") + 1
    chosen = F.element_at(F.array(*(F.struct(F.lit(a).alias("lead"), F.lit(v).alias("value"), F.lit(z).alias("rest"), F.lit(y).alias("label")) for a, v, z, y in patterns)), kind)
    letters = F.filter(F.transform("tokens", lambda t: F.regexp_replace(t, r"[^\p{L}]", "")), lambda t: t != "")
    word = lambda i: F.coalesce(F.get(letters, F.lit(i)), F.lit("word"))
    salt = F.concat_ws(" ", "chance", "passage")
    fill = lambda field: _filled(F.col("k")[field], word(1), word(2), salt)
    made = passages.withColumn("k", chosen).withColumns({"lead": fill("lead"), "value": fill("value"), "rest": fill("rest")})
    text = F.concat_ws(" ", F.array_join(F.slice("tokens", 1, 3), " "), F.concat("lead", "value", "rest"), F.array_join(F.slice("tokens", 4, 100), " "))
    made = stored(made.select(F.col("chance").alias("doc_id"), "path", text.alias("text"), "value", F.col("k.label").alias("label")), "planted")
    return candidates(made.select("doc_id", "path", "text"), "path").join(made.select("doc_id", F.col("value").alias("secret"), "label"), ["doc_id", "secret"])


def train(found: DataFrame, words: DataFrame, likely: list[float]) -> RandomForestClassificationModel | None:
    """found: labelled findings (label 1.0 for secrets). None if there is only one kind."""
    assemble = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features")
    rows = stored(assemble.transform(described(found, words, likely)).select("features", "label"), "labelled")
    if rows.select("label").distinct().count() < 2:
        return None
    return RandomForestClassifier(numTrees=20, maxDepth=8, seed=7, featureSubsetStrategy="sqrt").fit(rows)


def _reviewed(found: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """The candidates of reviewed findings (doc_id, at, is_secret); of each label at most half of ``most``, by a hash."""
    known = found.join(labels.select("doc_id", "at", F.col("is_secret").cast("double").alias("label")), ["doc_id", "at"])
    parts = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id", "at", "secret"), "doc_id", "at", "secret").limit(most // 2) for k in (0.0, 1.0)]
    return parts[0].unionByName(parts[1])


def _scored(docs: DataFrame, labels: DataFrame | None, path: str | None, most: int) -> DataFrame:
    words = dictionary(docs)
    likely = transitions(words)
    found = stored(candidates(docs, path), "found")
    model = train(planted(docs, path, most) if labels is None else _reviewed(found, labels, most), words, likely)
    if model is None:
        return found.select("doc_id", "at", "secret", "context", F.lit(0.0).alias("p_secret"), F.lit(False).alias("is_secret"))
    assemble = VectorAssembler(inputCols=[f"f_{k}" for k in FEATURES], outputCol="features")
    scored = model.transform(assemble.transform(described(found, words, likely)))
    p = F.round(vector_to_array("probability")[1], 6)
    return scored.select("doc_id", "at", "secret", "context", p.alias("p_secret"), (p >= 0.5).alias("is_secret"))


def findings(docs: DataFrame, labels: DataFrame | None = None, path: str | None = "source", most: int = SAMPLE) -> DataFrame:
    """Each candidate of docs: doc_id, at, secret, p_secret, is_secret (p_secret >= 0.5). labels: reviewed
    findings (doc_id, at, is_secret); without them planted ones are made. If there are labels of one kind only,
    or no documents to plant in, p_secret is 0. Repeated rows are scanned each."""
    return _scored(docs, labels, path, most).drop("context")


def masked(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """docs with each secret in the text replaced by MASK, a run wherever it stands and a value after what leads
    to it; all columns and all documents stay. Rows with the same doc_id share their secrets; a row without
    doc_id goes by the hash of its text."""
    secret = F.struct("context", F.length("secret").alias("n"))
    mine = free_name("secrets", docs.columns)
    key = free_name("secrets_of", docs.columns)
    docs_key = F.coalesce("doc_id", F.xxhash64("text").cast(docs.schema["doc_id"].dataType))
    columns, docs = docs.columns, docs.withColumn(key, docs_key)
    found = _scored(docs.withColumn("doc_id", F.col(key)), labels, "source", SAMPLE).where("is_secret")
    found = found.groupBy(F.col("doc_id").alias(key)).agg(F.array_sort(F.collect_set(secret)).alias(mine))
    # Longer ones first: one may hold another.
    size = lambda x: F.length(x["context"])
    order = F.array_sort(F.coalesce(mine, F.array().cast("array<struct<context:string,n:int>>")), lambda a, b: F.when(size(a) > size(b), -1).when(size(a) < size(b), 1).otherwise(0))
    text = F.aggregate(order, F.col("text"), lambda t, s: F.replace(t, s["context"], F.concat(F.left(s["context"], size(s) - s["n"]), F.lit(MASK))))
    return docs.join(found, key, "left").withColumn("text", text).select(*columns)
