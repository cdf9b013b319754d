import difflib
import json
import random

import pytest
from pyspark.sql import functions as F

from docketry.functions import citations as cite
from docketry.functions import headings as head
from docketry.functions import html as page
from docketry.functions import text as txt
from docketry.operators import search as index
from docketry.operators import selection as sel
from docketry.operators import similarity as sim
from docketry.operators import tables as tab
from docketry.operators import vectors as vec
from docketry.operators import windows as win
from docketry.sources import files
from docketry.streaming.arrivals import stream_documents


def one(spark, column, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


def test_null_status_follows_the_operator(spark):
    registry = spark.createDataFrame([(1,), (2,), (3,), (4,)], "source_id int")
    status = spark.createDataFrame([(1, "pass"), (2, None), (3, "failed")], "source_id int, step string")
    ids = lambda **k: sorted(r.source_id for r in sel.pending(registry, status, "step", **k).collect())
    assert ids() == [3, 4]
    assert ids(null_is_pending=True) == [2, 3, 4]
    assert ids(null_is_pending=True, missing_row_is_pending=False) == [2, 3]


def test_conditions_reject_unknown_operators(spark):
    with pytest.raises(KeyError):
        sel.where_from_config(spark.range(3), [{"column": "id", "operator": "; drop", "value": 1}])


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("[2022] AATA 2108 (20 April 2022) (Member J Prentice)", ("2022", None, "AATA", None, "2108", "20 April 2022", "Member J Prentice")),
        ("[[2021]] HCA 7 (1/2/2021)", ("2021", None, "HCA", None, "7", "1/2/2021", None)),
        ("[2010] NSW WCC PD 12 (1 March 2010) (Roche DP)", ("2010", "NSW", "WCC", "PD", "12", "1 March 2010", "Roche DP")),
        ("[1999] 14 VSC (2 May 1999)", ("1999", None, "VSC", None, "14", "2 May 1999", None)),
        ("[2003] FamCA unreported (2 May 2003) (Kay J)", ("2003", None, "FamCA", None, None, "2 May 2003", "Kay J")),
        ("[2003] null 7 (2 May 2003)", None),
        ("[2021] HCA 7", None),
        ("nothing", None),
        ("", None),
    ],
)
def test_citation(spark, text, parts):
    found = one(spark, cite.parse_citation(F.col("t")), t=text)
    assert (tuple(found) if found else None) == parts


@pytest.mark.parametrize(
    ("text", "parts"),
    [
        ("Member J Prentice", (None, "Member", "J Prentice", None, None)),
        ("The Honourable Justice Cronin", ("The Honourable", "Justice", "Cronin", None, None)),
        ("K Dordevic SM", (None, None, "K Dordevic", "SM", None)),
        ("Deputy President Lee DP", (None, "Deputy President", "Lee", "DP", None)),
        ("Senior Member Ann Grey", (None, "Member", "Senior  Ann Grey", None, None)),
        ("Vice-president Hill VP", (None, None, "Hill", "VP", "Vice-president")),
        ("  ", None),
    ],
)
def test_member(spark, text, parts):
    found = one(spark, cite.parse_member(F.col("t")), t=text)
    assert (tuple(found) if found else None) == parts


def test_jurisdictions_and_codes(spark):
    want = {"FCA": "FED", "FamCa": "FED", "NZHC": "NZ", "TRA": "NZ", "SC": "NZ", "NSWSC": "NSW", "MHRT": "NSW", "VSC": "VIC", "VICX": "VIC", "VX": "hint", "QCAT": "QLD", "QX": "hint", "WASAT": "WA", "SAERD": "SA", "TASSC": "TAS", "TX": "hint", "ACAT": "ACT", "NTSC": "NT"}
    frame = spark.createDataFrame([(x,) for x in want], "t string")
    assert {r.t: r.j for r in frame.select("t", cite.infer_jurisdiction(F.col("t"), F.lit("hint")).alias("j")).collect()} == want
    valid = {"JULY": False, "July": False, "Qd": False, "X": False, "O": True, "HCA": True, "9A": False, "A B": False, "A_B": True, "": False}
    frame = spark.createDataFrame([(x,) for x in valid], "t string")
    assert {r.t: r.v for r in frame.select("t", cite.valid_code(F.col("t")).alias("v")).collect()} == valid


def test_deconstruct(spark):
    known = [("NSW", "jurisdiction"), ("WA", "jurisdiction"), ("NSWX", "jurisdiction"), ("CAT", "tribunal"), ("CATA", "tribunal"), ("HCA", "tribunal"), ("SAT", "tribunal"), ("FamCA", "tribunal"), ("AP", "panel_or_division"), ("FC", "panel_or_division")]
    want = {
        "HCA": ("FED", "HCA", None), "FamCAFC": ("FED", "FamCA", "FC"), "FamCAX": ("FED", "FamCA", None), "NSWCATAP": ("NSW", "CATA", None), "NSWXCAT": ("NSWX", "CAT", None), "WASAT": ("WA", "SAT", None),
        "NSWCTTAP": ("NSW", "CTT", "AP"), "VICSCAX": ("VIC", "SCA", None), "QLDQCAT": ("QLD", "QCAT", None), "VCAT": ("VIC", "CAT", None), "VSCAP": ("VIC", "SCA", None), "VDCAP": ("VIC", "DC", "AP"), "QIRC": ("QLD", "IRC", None), "XYZ": (None, "XYZ", None), "V": (None, "V", None),
    }
    codes = spark.createDataFrame([(x,) for x in [*want, "HCA", None, ""]], "code string")
    got = {r.code: tuple(r)[1:] for r in cite.deconstruct(codes, spark.createDataFrame(known, "code string, type string")).collect()}
    assert got == want
    assert {r.jurisdiction_code for r in cite.deconstruct(codes, spark.createDataFrame(known, "code string, type string"), "TAS").where("code = 'XYZ'").collect()} == {"TAS"}


def test_contexts_and_dates(spark):
    rows = [
        ("Start date: 08/08/2025", None, "2025-08-08"), ("Currency date: 01 January 2005", None, "2005-01-01"), ("Version 003 - Start date: 23/11/2019", "003", "2019-11-23"), ("Date of assent: 23/07/2025", None, "2025-07-23"),
        ("date made: 01/01/2021 version7", "7", "2021-01-01"), ("Effective: 01/01/2021", None, None), ("Start date: 31/02/2021", None, None),
    ]
    frame = spark.createDataFrame([(x,) for x, _, _ in rows], "t string")
    got = {r.t: (r.v, r.d and str(r.d)) for r in frame.select("t", cite.context_version(F.col("t")).alias("v"), cite.context_date(F.col("t")).alias("d")).collect()}
    assert got == {t: (v, d) for t, v, d in rows}
    days = {
        "21 December 2018": "2018-12-21", "21 Dec 2018": "2018-12-21", "December 21, 2018": "2018-12-21", "Dec 21, 2018": "2018-12-21", "21/12/2018": "2018-12-21", "12/21/2018": "2018-12-21", "03/04/2018": "2018-04-03", "2018-12-21": "2018-12-21",
        "2018/12/21": "2018-12-21", "21-12-2018": "2018-12-21", "21-Dec-2018": "2018-12-21", "21 December 2018 14:30:00": "2018-12-21", "2018-12-21T14:30:00Z": "2018-12-21", " 2018-12-21 14:30:00 ": "2018-12-21", "TBA": None, "Not Provided": None, "": None, "soon": None,
    }
    frame = spark.createDataFrame([(x,) for x in days], "t string")
    assert {r.t: r.d for r in frame.select("t", cite.to_iso_date(F.col("t")).alias("d")).collect()} == days


def test_heading_levels(spark):
    want = {
        "Chapter 1": "h1", "PART 5": "h1", "Part 2A Introduction": "h1", "Schedule 2A": "h1", "Appendix B": "h1", "Division 2A": "h2", "SUBDIVISION B": "h2", "Rule 10A": "h2", "Objects of this Act": "h2", "Definitions": "h2", "Name of this Policy": "h2",
        "Aims, objectives etc.": "h2", "Table of Contents": "h2", "Subsection 2A": "h3", "ITEM 100": "h3", "1 Name of Act": "h3", "2A Proceedings": "h3", "1. This Act": "h3", "Subparagraph 2A": "h4", "(a) x": None, "1.1 x": None, "a.": None, "x": None, "Chapter 1 " + "x" * 250: None,
        "Some prose": None,
    }
    frame = spark.createDataFrame([(x,) for x in want], "t string")
    assert {r.t: r.h for r in frame.select("t", head.heading_level(F.col("t")).alias("h")).collect()} == want


def test_labels_and_references(spark):
    assert tuple(one(spark, txt.label_parts(F.col("t"), 5), t="Tag : title: x")) == ("Tag", "title: x", sum(map(ord, "Tag")) % 5)
    assert tuple(one(spark, txt.label_parts(F.col("t"), 5), t="no tag:")) == (None, "no tag:", None)
    assert one(spark, txt.summary_refs(F.col("t")), t="a [1, 2] b [x] [3] []") == [1, 2, 3]
    assert tuple(one(spark, page.anchor_ids(F.col("t")), t="bnj_a_403369_sr_2168")) == ("403369", "2168")
    assert tuple(one(spark, page.link_ids(F.col("t")), t="/article/5/section/9")) == ("5", "9") and tuple(one(spark, page.link_ids(F.col("t")), t="/x/5")) == (None, None)


def test_porter_stems():
    # The published examples, step by step.
    want = {
        "caresses": "caress", "ponies": "poni", "ties": "ti", "caress": "caress", "cats": "cat", "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat", "troubled": "troubl",
        "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "rational": "ration",
        "valenci": "valenc", "hesitanci": "hesit", "digitizer": "digit", "conformabli": "conform", "radicalli": "radic", "differentli": "differ", "vileli": "vile", "analogousli": "analog", "vietnamization": "vietnam", "predication": "predic", "operator": "oper",
        "feudalism": "feudal", "decisiveness": "decis", "hopefulness": "hope", "callousness": "callous", "formaliti": "formal", "sensitiviti": "sensit", "sensibiliti": "sensibl", "triplicate": "triplic", "formative": "form", "formalize": "formal",
        "electriciti": "electr", "electrical": "electr", "hopeful": "hope", "goodness": "good", "revival": "reviv", "allowance": "allow", "inference": "infer", "airliner": "airlin", "gyroscopic": "gyroscop", "adjustable": "adjust", "defensible": "defens",
        "irritant": "irrit", "replacement": "replac", "adjustment": "adjust", "dependent": "depend", "adoption": "adopt", "homologou": "homolog", "communism": "commun", "activate": "activ", "angulariti": "angular", "homologous": "homolog", "effective": "effect",
        "bowdlerize": "bowdler", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll", "für": "für", "at": "at",
    }
    assert {w: index.porter_stem(w) for w in want} == want


def test_sections_and_anchors(spark):
    rows = [(1, 0, None, " "), (1, 1, 1, "A"), (1, 2, 2, "a"), (1, 3, 1, "B"), (2, 0, None, "lead"), (2, 1, 2, "C"), (2, 2, 3, "c"), (3, 0, None, ""), (3, 1, None, None), (4, 0, 3, "x"), (4, 1, None, "y")]
    df = spark.createDataFrame(rows, "d int, p int, l int, t string")
    got = {(r.d, r.section): r.body for r in win.sections(df, "d", "p", "l", "t").collect()}
    assert got == {(1, 1): "A\na", (1, 2): "B", (2, 1): "lead", (2, 2): "C\nc", (3, 1): win.NO_TEXT, (4, 1): "x\ny"}
    heads = spark.createDataFrame([(1, 0, 1, None), (1, 1, 2, None), (1, 2, 2, "own"), (1, 3, 2, ""), (1, 4, 1, "mine"), (1, 5, 1, None)], "d int, p int, l int, a string")
    assert {r.p: r.a for r in win.anchor_ids(heads, "d", "p", "l", "a").collect()} == {0: "section_1", 1: "section-h2-1", 2: "own", 3: "section-h2-2", 4: "mine", 5: "section_3"}
    found = one(spark, page.links(F.col("t")), t="<a class='x' href='/a'> A <b>b</b></a><a>no</a><A HREF=\"/c\">C</A>")
    assert [tuple(x) for x in found] == [("/a", "A b"), ("/c", "C")]


def test_nearest_against_all_pairs(spark):
    r = random.Random(3)
    rows = [(k, [float(r.randint(-3, 3)) for _ in range(3)]) for k in range(120)] + [(500, None)]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(5)
    size = lambda x: sum(a * a for a in x) ** 0.5
    want = {}
    for i, x in rows:
        if i % 10 == 0 and x and size(x):
            near = sorted((-round(sum(a * b for a, b in zip(x, y, strict=True)) / size(x) / size(y), 6), j) for j, y in rows if y and size(y) and j != i)
            want |= {(i, k + 1): (j, -s) for k, (s, j) in enumerate(near[:4])}
    got = {(x.query, x.place): (x.id, x.cosine) for x in vec.knn(df.where("id % 10 = 0"), df, "id", "v", 4).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-9 for k in want)


def test_overlap_match_against_all_pairs(spark):
    words = ["one", "two", "three", "four", "five", "six", "seven", "eight"]
    heads = [(1, "One two three four five six seven"), (2, "one two three four"), (3, "eight seven six five four"), (4, "nine ten eleven twelve thirteen")]
    lines = [(d, i, " ".join(w for k, w in enumerate(words) if (d * 7 + i * 3 + k * k) % 5)) for d in range(6) for i in range(8)] + [(9, 1, "one two three four five six"), (8, 1, "EIGHT seven six five four")]
    want = {}
    for key, text in heads:
        w = set(text.lower().split())
        fit = [(d, i) for d, i, t in lines if len(w) > 4 and len(w & set(t.lower().split())) / len(w) >= 0.85]
        if fit:
            want[key] = min(fit)
    got = sim.overlap_match(spark.createDataFrame(heads, "id int, h string"), spark.createDataFrame(lines, "d int, i int, t string"), "id", "h", "t", ["d", "i"])
    assert {r.id: (r.d, r.i) for r in got.collect()} == want and want


def test_folders_and_counts(spark):
    ids = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    got = tab.map_folders(ids, [(ids.where("id < 3"), "a"), (ids.where("id = 2"), "b")], "id").collect()
    assert {r.id: (r.folder, r.status) for r in got} == {1: ("a", "pass"), 2: ("b", "pass"), 3: (None, "fail_mapping")}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a\nb", 2.5), (2, "c, \"d\"", None)], "id int, text string, x double")
    files.export_jsonl(rows, str(tmp_path / "j"))
    assert sorted(map(tuple, spark.read.schema(rows.schema).json(str(tmp_path / "j")).collect())) == sorted(map(tuple, rows.collect()))
    files.export_jsonl(rows, str(tmp_path / "short"), longest_line=29)
    assert [r.id for r in spark.read.json(str(tmp_path / "short")).collect()] == [2]
    files.export_csv(rows, str(tmp_path / "c"))
    assert sorted(map(tuple, spark.read.schema(rows.schema).csv(str(tmp_path / "c"), header=True, multiLine=True, escape='"').collect())) == sorted(map(tuple, rows.collect()))
    files.append(rows, str(tmp_path / "a"))
    files.append(rows, str(tmp_path / "a"))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 4
    files.write_artifact(rows, str(tmp_path / "p"), "id")
    assert spark.read.parquet(str(tmp_path / "p")).where("id = 2").first().text == 'c, "d"'


def test_index_and_vector_sinks(spark, tmp_path):
    docs = spark.createDataFrame([(k, k % 3, f'{{"n": {k}}}' if k else "{") for k in range(250)], "source int, section int, document string")
    report = files.write_index(docs, str(tmp_path / "i"), "source", "section")
    assert {r.id for r in report.where("NOT indexed").collect()} == {"0_0"} and report.count() == 250
    lines = [line for f in (tmp_path / "i").glob("part-*") for line in f.read_text().splitlines()]
    assert max(len(f.read_text().splitlines()) for f in (tmp_path / "i").glob("part-*")) <= 200
    assert dict(zip(lines[::2], lines[1::2], strict=True)) == {f'{{"index":{{"_id":"{k}_{k % 3}"}}}}': f'{{"n": {k}}}' for k in range(1, 250)}
    rows = vec.vector_docs(spark.createDataFrame([(1, [0.5, 1.0])], "id int, v array<double>"), F.col("id"), F.lit("caselaw"), F.col("v"))
    files.write_vectors(rows, str(tmp_path / "v"))
    assert tuple(spark.read.parquet(str(tmp_path / "v")).first()) == ("1", "caselaw", [0.5, 1.0])


def test_index_documents(spark):
    df = spark.createDataFrame([("1", "text", "", "a,, b", "21 Dec 2018"), ("2", None, "x", "", "TBA")], "source_id string, content string, court string, areas string, day string")
    got = [json.loads(r.document) for r in files.to_document(df, "caselaw", ["source_id"], ["court"], ["areas"], ["day"]).orderBy("source_id").collect()]
    assert got == [{"source_id": "1", "document_type": "caselaw", "content": "text", "content_length": 4, "areas": ["a", "b"], "day": "2018-12-21"}, {"source_id": "2", "document_type": "caselaw", "content_length": 0, "court": "x"}]


def test_dates_and_text(spark):
    assert str(one(spark, cite.to_date(F.col("t")), t="1 march 2022")) == "2022-03-01"
    assert one(spark, cite.to_date(F.col("t")), t="31 February 2022") is None
    assert one(spark, txt.norm_verify(F.col("t")), t="  A b\n c ") == "a b c"
    assert one(spark, txt.clean_text(F.col("t")), t=" N/A ") is None
    assert one(spark, page.html_text(F.col("t")), t="<p>a &amp; b</p><script>x</script> c") == "a & b c"


@pytest.mark.parametrize("text", ["", "x", "ab" * 700, "\U0001f600" * 1500, "y" * 1301])
def test_chunks_rebuild_the_text(spark, text):
    parts = one(spark, txt.chunks(F.col("t")), t=text)
    assert "".join([*(p[:1300] for p in parts[:-1]), *parts[-1:]]) == text


def test_upsert_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    batch = spark.createDataFrame([(2, None), (3, "c")], "k int, v string")
    keep = tab.upsert_keep(target, batch, "k", ["v"])
    assert sorted(map(tuple, keep.collect())) == sorted(map(tuple, tab.upsert_keep(keep, batch, "k", ["v"]).collect()))
    assert {r.k: r.v for r in keep.collect()} == {1: "a", 2: "b", 3: "c"}
    assert {r.k: r.v for r in tab.upsert_replace(target, batch, "k", ["v"]).collect()} == {1: "a", 2: None, 3: "c"}
    assert tab.delete_where(spark.createDataFrame([("a",), (None,)], "v string"), "v", "a").count() == 1


def test_versions_have_no_gap(spark):
    df = spark.createDataFrame([(i, 1, f"2020-01-{i:02d}", None) for i in range(1, 6)], "id int, title int, start_date string, version long")
    assert sorted(r.version for r in win.assign_versions(df).collect()) == [1, 2, 3, 4, 5]


def test_verify(spark):
    df = spark.createDataFrame([("a b c", "A  b c"), ("a b", ""), (None, "x")], "o string, r string")
    assert [r.verification for r in sim.verify(df, "o", "r").collect()] == ["pass", "failed", "not started"]


@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnopqrstuvwxyz       ", "".join(chr(200 + k) for k in range(300))])
def test_ratio_is_that_of_difflib(letters):
    r = random.Random(2)
    for _ in range(60):
        x = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 50, 199, 200, 600])))
        k = r.randint(0, len(x))
        for y in (x, x[k:] + x[:k], x + x[:k], x[:k] + "q" + x[k + 3 :], "".join(r.choice(letters) for _ in range(300))):
            assert sim.matching_ratio(x, y) == (difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0)


def test_verify_long_texts(spark):
    r = random.Random(3)
    words = ["".join(r.choice("etaoinshrdlucmfw") for _ in range(r.randint(2, 9))) + r.choice(["", "", "", *"qzxyvkjbgp0123456789"]) for _ in range(900)]
    text = " ".join(r.choice(words) for _ in range(4500))
    third = len(text) // 3
    rebuilt = [text, text[third:] + text[:third], text + " " + text, text + " " + " ".join(r.choice(words) for _ in range(4500)), text[:third] + "\n\n" + text[third:]]
    assert len(text) > 21_000
    got = sim.verify(spark.createDataFrame([(k, text, t) for k, t in enumerate(rebuilt)], "k int, o string, r string"), "o", "r").orderBy("k").collect()
    assert [x.verification for x in got] == ["pass", "failed", "failed", "failed", "pass"]
    assert [x.score for x in got] == [difflib.SequenceMatcher(None, " ".join(text.split()), " ".join(t.split())).ratio() for t in rebuilt]


def test_contains_check_reads_the_whole_text(spark):
    start = "the same first forty characters of an item "
    rows = [(start + "END, here", f"x {start.upper()} end here!", True), (start + "other", start + "end", True), (None, "page", True), ("a", " ", True), ("a", "a", False)]
    df = spark.createDataFrame(rows, "i string, p string, h boolean")
    got = [r.x for r in df.select(sim.contains_check(F.col("i"), F.col("p"), F.col("h")).alias("x")).collect()]
    assert got == ["Verified (Direct Text Match)", "Failed (Direct Text Mismatch)", "Failed (Invalid Or Empty Content Field)", "Skipped (No Direct Text)", "Not Verified"]


def test_whole_tables(spark):
    from docketry.plans import registry

    at = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{at}/documents.parquet")
    assert registry.QUERIES["g2_union_sources_whole"](spark, at).count() == docs.count()
    langs = registry.QUERIES["l10_positions_whole"](spark, at).select("doc_id").distinct().join(docs, "doc_id").select("lang").distinct().count()
    assert langs == docs.select("lang").distinct().count() > 1


def test_stream_handles_each_file_once(spark, tmp_path):
    source, target, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.range(5).write.parquet(source)
    for _ in range(2):
        stream_documents(spark, source, spark.range(1).schema, lambda b: b.where("id > 1"), target, state)
    assert spark.read.parquet(target).count() == 3
    spark.range(5, 7).write.mode("append").parquet(source)
    stream_documents(spark, source, spark.range(1).schema, lambda b: b.where("id > 1"), target, state)
    assert spark.read.parquet(target).count() == 5


def test_lists_are_trimmed_of_spaces_only(spark):
    # transform() would hand the element's index to trim() as the characters to take off.
    assert one(spark, F.array_join(txt.csv_array(F.col("t")), "|"), t="10, 21 ,,32") == "10|21|32"
    assert one(spark, F.to_json(txt.table_rows(F.col("t"))), t="a|b\n---|---\n10|11\nno table") == '[{"header":true,"cells":["a","b"]},{"header":false,"cells":["10","11"]}]'


def test_headings(spark):
    rows = [(1, i, level, text) for i, (level, text) in enumerate([(None, "lead"), (1, "A"), (3, "B"), (2, "Long"), (None, "title"), (1, "C")])]
    df = spark.createDataFrame(rows, "k int, at long, lvl int, text string")
    assert [r.parent for r in win.nest_headings(df, "k", "at", "lvl").orderBy("at").collect()] == [None, None, 1, 1, 3, None]
    assert [(r["at"], r["lines"]) for r in win.match_multiline(df, "k", "at", "text", F.lit("Long title")).collect()] == [(3, 2)]
    assert sorted((r.top, r.nested) for r in win.outline(df, "k", "at", "lvl").collect()) == [(1, [3]), (5, [])]
    assert win.outline(df.limit(0), "k", "at", "lvl").count() == 0


def test_replies_pages_and_marks(spark):
    assert one(spark, txt.extract_json(F.col("t")), t='so:\n```json\n{"a": {"b": 1}}\n```') == '{"a": {"b": 1}}'
    assert one(spark, txt.extract_json(F.col("t")), t="no {json") is None
    assert [one(spark, txt.page_offset(F.col("t"), 3), t=t) for t in ("Page1", "pg_3", "2", "page 4", "3", "x1", "")] == [0, 2, 2, None, None, None, None]
    assert one(spark, txt.suggestion(F.col("t"), 6), t="\u00c9t\u00e9 \u0160kola") == "ete sk"


def test_step_start_is_set_once(spark):
    target = spark.createDataFrame([(1, 5, None, "x"), (2, None, None, None)], "k int, start int, end int, status string")
    batch = spark.createDataFrame([(1, 7, 8, "pass"), (2, 7, 8, None), (3, 7, 8, "pass")], "k int, start int, end int, status string")
    assert sorted(map(tuple, tab.touch(target, batch, "k").collect())) == [(1, 5, 8, "pass"), (2, 7, 8, None), (3, 7, 8, "pass")]


def test_neighbours_in_blocks(spark, monkeypatch):
    from docketry.operators import vectors as vec

    df = spark.createDataFrame([(i, [float(i % 7), 1.0]) for i in range(30)], "id int, v array<double>")
    whole = sorted(map(tuple, vec.knn(df.where("id < 9"), df, "id", "v", 3).collect()))
    monkeypatch.setattr(vec, "BLOCK_QUERIES", 2)
    assert sorted(map(tuple, vec.knn(df.where("id < 9"), df, "id", "v", 3).collect())) == whole


def test_overlap_match_with_many_probes_and_without_moved_texts(spark, capsys):
    heads = spark.createDataFrame([(i, f"w{i} common a b c d e") for i in range(20)], "id int, h string")
    lines = spark.createDataFrame([(i % 7, i, f"common a b c d w{i % 13} x{i}") for i in range(60)] + [(None, 1, "w3 common a b c d e")], "d int, i int, t string")
    found = [sim.overlap_match(heads, lines, "id", "h", "t", ["d", "i"], few=few) for few in (0, 100_000)]
    got = [sorted(map(str, x.collect())) for x in found]
    assert got[0] == got[1] and len(got[0]) == 20
    found[1].explain()
    assert not [line for line in capsys.readouterr().out.split("\n") if "Exchange" in line and "_word" in line]


def test_a_task_gives_its_best_neighbours_only(spark, monkeypatch):
    import numpy as np
    import pandas as pd

    monkeypatch.setattr(vec, "BLOCK_ROWS", 7)
    rows = pd.DataFrame({"id": range(100), "v": [[1.0, 0.0]] * 100})
    got = pd.concat(vec._nearest(np.array([[1.0, 0.0]]), np.array([3]), "id", "v", 4)(iter([rows[::-1], rows[:0]])))
    assert got.values.tolist() == [[3, 0, 1.0], [3, 1, 1.0], [3, 2, 1.0], [3, 4, 1.0]]


def test_search_against_plain_scores(spark, monkeypatch):
    import math

    monkeypatch.setattr(index, "BLOCK_DOCS", 4)
    monkeypatch.setattr(index, "BLOCK_QUERIES", 2)
    r = random.Random(8)
    docs = [(i, " ".join(r.choices("alpha beta gamma delta eps zeta the".split(), k=r.randint(0, 9)))) for i in range(40)] + [(90, None), (91, "gamma beta"), (92, "gamma beta")]
    queries = [(1, "alpha The beta beta"), (2, "gamma"), (3, "zeta, eps"), (4, "nowhere"), (5, None)]
    words = {i: [w for w in (t or "").split() if w != "the"] for i, t in docs}
    mean = sum(map(len, words.values())) / (len(words) - 1)
    want = set()
    for q, t in queries:
        scores = {}
        for w in {x.strip(",") for x in (t or "").lower().split()} - {"the"}:
            df = sum(w in x for x in words.values())
            for i, x in words.items():
                if tf := x.count(w):
                    scores[i] = scores.get(i, 0) + math.log(1 + (len(words) - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean))
        want |= {(q, i, k + 1) for k, (_, i) in enumerate(sorted((-round(s, 6), i) for i, s in scores.items())[:5])}
    docs = spark.createDataFrame([d for d in docs if d[1] is not None], "doc long, text string").unionByName(spark.createDataFrame([(90, None)], "doc long, text string"))
    found = index.search(docs.repartition(3), spark.createDataFrame(queries, "q int, text string"), "doc", "q", "text", 5)
    assert {(x.q, x.doc, x.place) for x in found.collect()} == want
