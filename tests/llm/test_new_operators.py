"""Periodic runs, sentence pieces and hard negatives against plain versions."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import hard_negatives as hard
from docketry.llm import periodic, queries, sentencepieces

# ---- periodic runs


def plain_runs(x):
    """Every period at every place."""
    found = {}
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def planted(r):
    n = r.randint(0, 160)
    x = [r.randrange(r.choice([1, 2, 3, 6])) for _ in range(n)]
    for _ in range(r.randint(0, 3)):
        if n > 8:
            at, q = r.randrange(n), r.randint(1, max(1, n // 5))
            for i in range(at + q, min(n, at + q * r.randint(3, 8) + r.randint(0, q))):
                x[i] = x[i - q]
    return x


def test_runs_are_those_of_a_plain_search():
    r = random.Random(8)
    for _ in range(1500):
        x = planted(r)
        assert [tuple(y) for y in periodic.periodic_runs(np.array(x, np.int64)).tolist()] == plain_runs(x)


def test_runs_of_long_texts():
    for x, want in ((np.zeros(300_000, int), [(0, 300_000, 1)]), (np.arange(300_000) % 70_001, [(0, 300_000, 70_001)]), (np.arange(300_000), []), (np.append(np.arange(100_000) % 3, np.arange(100_000) % 5 + 9), [(0, 100_000, 3), (100_000, 100_000, 5)])):
        assert [tuple(y) for y in periodic.periodic_runs(x).tolist()] == want


def test_transform_is_the_sum_and_goes_back():
    r = np.random.default_rng(1)
    for prime, root, _ in periodic.PRIMES:
        x = r.integers(0, prime, (3, 16)).astype(np.uint64)
        w = pow(root, (prime - 1) // 16, prime)
        want = [[sum(int(v) * pow(w, i * k, prime) for i, v in enumerate(row)) % prime for k in range(16)] for row in x]
        assert periodic.transform(x, prime, root).tolist() == want
        assert (periodic.transform(periodic.transform(x, prime, root), prime, root, inverse=True) == x).all()
        blocks, windows = r.integers(0, 99, (2, 8)), r.integers(0, 99, (2, 15))
        got = periodic.differences(blocks, windows, prime, root)
        assert got.tolist() == [[int(((b - w[d : d + 8]) ** 2).sum()) for d in range(8)] for b, w in zip(blocks, windows, strict=True)]


def test_occurrences_are_exact_where_one_prime_is_too_small():
    top = 1 << 40  # the sums exceed the first prime, two and three
    x = np.array([top, 5, 7, 7 + periodic.PRIMES[0][0], 5, 7, 1, 5, 7 + periodic.PRIMES[0][0] * periodic.PRIMES[1][0], 0, 0, 0], np.int64)
    with pytest.raises(ValueError):
        periodic.occurrences(x * 1000, np.arange(4), 2)
    small = np.array([5, 7, 1, 5, 7, 5, 7 + periodic.PRIMES[0][0], 2, 3], np.int64)
    start, distance = periodic.occurrences(small, np.array([0, 3]), 2)
    assert list(zip(start.tolist(), distance.tolist(), strict=True)) == [(0, 3)]


def test_periodic_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a a a a a a"), (5, "a a a a a"), (6, "x a b a b a b a b y"), (6, "x a b a b a b a b y"), (None, "a " * 9), (7, long), (8, "é " * 6 + "ü")]
    df = spark.createDataFrame([(*x, "z", i) for i, x in enumerate(rows)], "doc_id long, text string, runs string, n_words int")
    got = periodic.periodic(df).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: (r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got}
    assert by[1] == by[2] == by[3] == (0, [], "")
    assert by[4] == (6, [(0, 6, 1)], "a") and by[5] == (5, [], "a a a a a") and by[6] == (10, [(1, 8, 2)], "x a b y")
    assert by[None] == (9, [(0, 9, 1)], "a") and by[8] == (7, [(0, 6, 1)], "é ü")
    assert by[7][1] == [(0, 40_000, 977)] and by[7][2] == " ".join(f"w{i}" for i in range(977))
    assert periodic.periodic(df.limit(0)).count() == 0


def write(spark, folder, **tables):
    for name, df in tables.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def test_op11(spark, tmp_path):
    r = random.Random(4)
    docs = [(i, " \n".join(f"w{x}" for x in planted(r)) + "\x0b") for i in range(400)] + [(400, None), (401, ""), (402, "one"), (9_999_999_999, "a b " * 30)]
    folder = write(spark, tmp_path, documents=spark.createDataFrame(docs, "doc_id long, text string"))
    got = {row["doc_id"]: tuple(row) for row in queries.op11_periodic_runs(spark, folder).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(w), zlib.crc32(str(i).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(n)]
        runs = plain_runs(w)
        gone = {k for s, length, q in runs for k in range(s + q, s + length)}
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        assert got[i] == (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha(lines), sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


# ---- sentence pieces


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))


ODD = ["", " ", "  ", " a", "a  b ", "\x00a", "▁a", "▁▁ ▁x", " " * 50, "x" + " " * 33 + "y", "a" * 1000, "ab" * 300, "<s>hi</s>", "<0x41>", "a\tb\r\n", "​﻿", "梦见", "🎉🎉", "�", "⁇", "Straße ÀÉ", "x" * 60 + " " + "y" * 60]


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_encoding_is_the_librarys(library):
    own, r = sentencepieces.Model(queries.tokenizer_path("piece_bpe_32k.model")), random.Random(6)
    alphabets = ["ab ", "  ▁a", "etaoinshrdlu ,.", "0123456789abcdef", "".join(map(chr, [*range(32, 127), *range(0xA0, 0x250), *range(0x4E00, 0x4E40), 0x1F389, 9, 10, 0]))]
    texts = ODD + ["".join(r.choices(r.choice(alphabets), k=r.randint(0, 120))) for _ in range(3000)]
    want = library.encode(texts, add_bos=True, add_eos=True)
    assert list(map(ids, own.encode(texts))) == want
    assert [own.decode(np.array(x, "<u4").tobytes()) for x in want] == [library.decode(x) for x in want]


def test_long_texts_and_a_full_cache(library, monkeypatch):
    monkeypatch.setattr(sentencepieces, "CACHED", 50)
    monkeypatch.setattr(sentencepieces, "SLICE", 1000)
    own, r = sentencepieces.Model(queries.tokenizer_path("piece_bpe_32k.model")), random.Random(7)
    texts = ["".join(r.choices("abcdefg  \n", k=20_000)), "", "z" * 5000, " " * 3000 + "x", "one two", "".join(r.choices("etao", k=4000))]
    assert list(map(ids, own.encode(texts))) == library.encode(texts, add_bos=True, add_eos=True)


def test_decoding_any_ids(library):
    own, r = sentencepieces.Model(queries.tokenizer_path("piece_bpe_32k.model")), random.Random(9)
    for _ in range(3000):
        some = [r.choice([r.randint(0, 4), r.randint(3, 258), r.randint(0, 31_999), 28705]) for _ in range(r.randint(1, 9))]
        assert own.decode(np.array(some, "<u4").tobytes()) == library.decode(some)
    with pytest.raises(ValueError):
        own.decode(np.array([32_000], "<u4").tobytes())


def test_other_models_are_refused(monkeypatch):
    class Odd:
        def __init__(self, model_file):
            pass

        get_piece_size = bos_id = eos_id = lambda self: 1
        is_byte = is_control = is_unknown = is_unused = lambda self, i: False
        id_to_piece, normalize = lambda self, i: "a", lambda self, x: x.lower()

    monkeypatch.setattr("sentencepiece.SentencePieceProcessor", Odd)
    with pytest.raises(ValueError):
        sentencepieces.Model("any")


def test_op12(spark, tmp_path, library):
    docs = [*enumerate(ODD), (100, None), (101, "again"), (101, "again"), (None, "no number"), (102, "long text " * 20_000)]
    folder = write(spark, tmp_path, documents=spark.createDataFrame([(*x, "i") for x in docs], "doc_id long, text string, ids string"))
    want = []
    for i, text in docs:
        x = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((i, len(x), sha(np.array(x, "<u4").tobytes()), sha(library.decode(x))))
    got = [tuple(x) for x in queries.op12_sentencepiece(spark, folder).collect()]
    key = lambda x: (x[0] is None, x[0] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)
    rows = sentencepieces.round_trip(spark.createDataFrame([(1, " a  b"), (2, None)], "doc_id int, text string"), queries.tokenizer_path("piece_bpe_32k.model"))
    assert rows.schema["doc_id"].dataType.simpleString() == "int"
    again = sentencepieces.decoded(rows.unionByName(rows.select("doc_id", F.lit(None).cast("binary").alias("ids"), "decoded")), queries.tokenizer_path("piece_bpe_32k.model"))
    assert sorted(map(tuple, again.collect()), key=str) == sorted([(1, " a  b"), (1, None), (2, ""), (2, None)], key=str)


# ---- hard negatives


def plain_negatives(rows, positives=5, negatives=3, low=50, high=95):
    """rows: (vec_id, label, vector, anchor), all valid and of distinct vec_id."""
    found = []
    for a, label, v, anchor in rows:
        if anchor:
            scored = sorted(((sum(x * y for x, y in zip(v, w, strict=False)), i, other) for i, other, w, _ in rows if i != a), key=lambda x: (-x[0], x[1]))
            for score, p, _ in [x for x in scored if x[2] == label][:positives]:
                fits = [x for x in scored if x[2] != label and low * score <= 100 * x[0] <= high * score][:negatives]
                found += [(a, p, k, i, score, s) for k, (s, i, _) in enumerate(fits, 1)]
    return sorted(found)


SCHEMA = "vec_id long, label long, vector array<long>, anchor boolean"


def clustered(r, n, d=6, spread=3, ends=100):
    middles = [[r.randint(-ends, ends) for _ in range(d)] for _ in range(8)]
    rows = []
    for i in range(n):
        m = r.choice(middles)
        rows.append((i, r.randint(0, 3), [x + r.randint(-spread, spread) for x in m], i % 9 == 0))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_negatives_are_those_of_a_plain_search(spark, seed):
    r = random.Random(seed)
    rows = clustered(r, 400, spread=seed * 5, ends=[100, 10, 40][seed - 1])
    rows += [(1000 + i, 1, [5, 5, 5, 5, 5, 5], i % 4 == 0) for i in range(60)]  # many equal vectors
    got = hard.hard_negatives(spark.createDataFrame(rows, SCHEMA), sizes=hard.Sizes(block=16, group=5, page=4, seen=4, held=50)).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)


def test_awkward_vectors(spark):
    rows = [(0, 1, [3, 4], True), (2, 1, [3, 4], True), (3, 2, [2, 2, 9], False), (4, 1, [1], False), (5, 2, [], True), (6, 2, [3, 3], False), (7, 3, [-5, -5], True), (8, 3, [-5, 5], False)]
    bad = [(None, 1, [1, 1], True), (9, None, [9, 9], True), (10, 1, None, True), (11, 1, [None, 1], True), (6, 2, [9, 9], True), (6, 5, [1, 1], True)]
    got = hard.hard_negatives(spark.createDataFrame([(*x, "c", 7) for x in rows + bad], SCHEMA + ", group string, n int")).collect()
    assert sorted(map(tuple, got)) == plain_negatives(rows)
    assert hard.hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    assert hard.hard_negatives(spark.createDataFrame([(1, 1, [], True), (2, 2, [], None)], SCHEMA)).count() == 0
    assert hard.hard_negatives(spark.createDataFrame([(1, 1, [1, 1], None), (2, 1, [1, 1], False), (3, 2, [1, 1], False)], SCHEMA)).count() == 0
    large = 1 << 30
    rows = [(0, 1, [large, 3], True), (1, 1, [large, 5], False), (2, 2, [large // 2 + 1, 1], False), (3, 2, [large // 10 * 9, 1], True), (4, 2, [large - 1, -7], False)]
    assert sorted(map(tuple, hard.hard_negatives(spark.createDataFrame(rows, SCHEMA)).collect())) == plain_negatives(rows)


def test_products_and_bounds():
    r = np.random.default_rng(3)
    for size in (10, 1 << 14, 1 << 28):
        a, b = r.integers(-size, size, (5, 7)), r.integers(-size, size, (40, 7))
        exact = a.astype(object) @ b.T.astype(object)
        assert (hard.products(a, b) == exact).all()
        low, high = b.reshape(4, 10, 7).min(axis=1), b.reshape(4, 10, 7).max(axis=1)
        least, most = hard.bounds(a, low, high)
        by_block = exact.reshape(5, 4, 10)
        assert (least <= by_block.min(axis=2).astype(float)).all() and (most >= by_block.max(axis=2).astype(float)).all()
    with pytest.raises(OverflowError):
        hard.products(np.array([[1 << 40]]), np.array([[1 << 40]]))


def test_the_curve_takes_single_steps():
    for d, bits in ((2, 4), (3, 3), (5, 2)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        keys = hard.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(side**d))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_leave_blocks_out(spark):
    """Where vectors lie in groups far apart, few of all blocks are read."""
    r, sizes = random.Random(5), hard.Sizes(block=32, group=8)
    rows = []
    for i in range(2000):
        axis = r.randrange(6)
        rows.append((i, r.randint(0, 1), [1000 * (k == axis) + r.randint(-9, 9) for k in range(6)], i % 9 == 0))
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = hard.in_blocks(df, sizes.block)
    groups = blocks.select("n", "width", "ids", "labels", "vectors", "anchors").mapInPandas(hard._groups(5, sizes), hard._GROUP)
    asks = groups.drop("seen").mapInPandas(hard._first_asks, hard._ASKS)
    pages = blocks.select(F.lit(0).alias("page"), F.struct("block", "low", "high", "kinds").alias("zone")).groupBy("page").agg(F.collect_list("zone").alias("zones"))
    wanted = asks.select("group", "n", "width", "labels", "vectors", "of", "low", "high", F.lit(0).alias("page")).join(pages, "page")
    asked = wanted.mapInPandas(hard._chosen(True), "group long, block long").count()
    assert 0 < asked < 0.3 * blocks.count() * groups.count()
    assert sorted(map(tuple, hard.hard_negatives(df, sizes=sizes).collect())) == plain_negatives(rows)


def test_op13(spark, tmp_path):
    r = random.Random(6)
    rows = [(i, r.randint(0, 9), [r.gauss(0, 0.3) for _ in range(8)]) for i in range(600)]
    bad = [(700, 1, None), (750, None, [0.1] * 8), (800, 1, [None] * 8), (850, 2, [float("nan")] * 8), (900, 2, [float("inf")] * 8), (None, 1, [0.1] * 8)]
    folder = write(spark, tmp_path, embeddings=spark.createDataFrame(rows + bad, "vec_id long, label int, embedding array<float>"))
    floats = [(i, label, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int).tolist()) for i, label, v in rows]
    want = plain_negatives([(i, (label + 1) % 10 if i % 7 == 0 else label, v, i % 50 == 0) for i, label, v in floats])
    assert sorted(map(tuple, queries.op13_hard_negatives(spark, folder).collect())) == want


# ---- fingerprints: stretches


def plain_next(rows):
    """(doc_id, digest of the edited text) of each row, in descending doc_id and by compressed text."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=3)
    order = sorted(rows, key=lambda x: (-x[0], packer.compress((x[1] or "").encode())))
    found = []
    for k, (i, text) in enumerate(order):
        text, after = text or "", order[(k + 1) % len(order)][1] or ""
        found.append((i, len(text), sha(text[: len(text) - len(text) // 2] + after[: len(text) // 2])))
    return sorted(found)


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_fingerprints_of_all_rows_however_the_plan_runs(spark, reuse):
    from docketry.llm.fingerprints import fingerprints

    r = random.Random(12)
    rows = [(r.choice([i, i * i, 7]), " ".join(f"w{r.randint(0, 50)}" for _ in range(r.randint(0, 30)))) for i in range(500)]
    rows += [(10**15, None), (-5, "the end of all"), (7, ""), (8, "long text of the words " * 20_000)]
    df = spark.createDataFrame([(*x, "s", 1) for x in rows] + [(None, "no number", "s", 1)], "doc_id long, text string, stretch string, packed int").repartition(7)
    settings = {"spark.sql.exchange.reuse": reuse, "spark.sql.adaptive.enabled": reuse}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = sorted((x["doc_id"], x["n_chars"], x["edited_sha256"]) for x in fingerprints(df).collect())
        assert got == plain_next(rows)
        alone = fingerprints(df.where(f"doc_id = {10**15}")).collect()
        assert [x["near_next"] for x in alone] == [1.0] and fingerprints(df.limit(0)).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


# ---- secret scans: long texts


def test_candidates_of_long_texts_in_one_pass(spark):
    import time

    from docketry.llm import secrets

    cases = [
        (1, "key" * 1_000_000, 1), (2, "a key=x1 " * 100_000, 100_000), (3, "key=" * 200_000 + "z", 1), (4, "-" * 500_000 + " " + "_" * 40, 0), (5, "http://" * 100_000, 0), (6, ("x" * 30 + " ") * 50_000, 50_000),
        (7, 'key="' * 50_000, None), (8, "a://b:c@d " * 50_000, 50_000), (9, "key=" + "." * 300_000, 1), (10, "\x01key=a\x01b", 1),
    ]
    for i, text, want in cases:
        began = time.perf_counter()
        n = secrets.candidates(spark.createDataFrame([(i, text, "s")], "doc_id long, text string, source string")).count()
        assert time.perf_counter() - began < 40, i
        assert want is None or n == want, (i, n)


def test_rows_without_number_are_masked(spark):
    from docketry.llm import secrets

    r = random.Random(3)
    word = lambda: "".join(r.choices("abcdefgh", k=6))
    token = lambda: "".join(r.choices("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", k=40))
    rows = [(i, " ".join(word() for _ in range(60))) for i in range(300)]
    hidden = [token(), token()]
    rows += [(None, f'{word()} token = "{hidden[0]}" {word()}'), (None, None), (5000, f'{word()} token = "{hidden[1]}" {word()}')]
    got = secrets.masked(spark.createDataFrame([(*x, "s") for x in rows], "doc_id long, text string, secrets string"))
    assert got.columns == ["doc_id", "text", "secrets"] and got.count() == len(rows)
    assert not got.where(f"text LIKE '%{hidden[0]}%' OR text LIKE '%{hidden[1]}%'").count()


# ---- packing: the program


def test_the_program_places_most_pieces():
    from docketry.llm import packing

    r = np.random.default_rng(5)
    sizes = np.minimum(np.round(np.exp(r.normal(6, 1.2, 6000))).astype(int) + 1, packing.CAPACITY)
    for times in (1, 50):
        lengths, counts = np.unique(sizes, return_counts=True)
        left = counts * times
        chosen = packing.program(lengths, left, packing.CAPACITY)
        assert all(int(column @ lengths) == packing.CAPACITY for column, _ in chosen)
        assert (left >= 0).all() and (sum(n * column for column, n in chosen) + left == counts * times).all()
        assert left.sum() < 0.05 * counts.sum() * times
        n = sum(n for _, n in packing.configurations(lengths, counts * times))
        least = -(-int(lengths @ counts) * times // packing.CAPACITY)
        assert least <= n <= 1.002 * least + 1


def test_knapsack_fills_as_much_as_any_multiset():
    from docketry.llm import packing

    lengths = np.array([7, 11, 13])
    fill, choice = packing.knapsack(lengths, np.ones(3), 60, np.random.default_rng(2))
    best = [max(7 * a + 11 * b + 13 * k for a in range(9) for b in range(6) for k in range(5) if 7 * a + 11 * b + 13 * k <= room) for room in range(61)]
    assert fill.tolist() == best
    for room in range(61):
        total, left = 0, room
        while left > 0:
            if choice[left] >= 0:
                total, left = total + lengths[choice[left]], left - lengths[choice[left]]
            else:
                left -= 1
        assert total == best[room]
    assert packing.configurations([], []) == []


# ---- ordinal regression and candidates: by plain loops


def plain_fit(rows, grades, dimensions, steps, rate):
    """The same loss and steps, text by text and word by word, for words that all take part."""
    import math

    top, n = max(grades), len(rows)
    share = [min(max(sum(g >= k for g in grades) / n, 1e-3), 1 - 1e-3) for k in range(1, top + 1)]
    t, pull = [-math.log(p / (1 - p)) for p in share], [0.0] * top
    w, m, v = {}, {}, {}
    for f, s in rows:
        for x in [*f, *s]:
            w[int(x)] = m[int(x)] = v[int(x)] = 0.0
    for step in range(1, steps + 1):
        slope, down = dict.fromkeys(w, 0.0), [0.0] * top
        for (f, s), grade in zip(rows, grades, strict=True):
            parts = [(int(x), 1 / math.sqrt(max(1, len(f)))) for x in f] + [(int(x), 1.0) for x in s]
            score = sum(w[x] * value for x, value in parts)
            for k in range(top):
                gap = (1 / (1 + math.exp(-(score - t[k]))) - (grade >= k + 1)) / n
                down[k] += gap
                for x, value in parts:
                    slope[x] += gap * value
        for x in w:
            m[x] += 0.1 * (slope[x] - m[x])
            v[x] += 0.01 * (slope[x] ** 2 - v[x])
            pace = 0.1 if x >= dimensions else 1.0
            w[x] -= rate / step**0.25 * pace * (m[x] / (1 - 0.9**step)) / (math.sqrt(v[x] / (1 - 0.99**step)) + 1e-12)
        pull = [0.9 * a + b for a, b in zip(pull, down, strict=True)]
        t = sorted(a + 0.2 * b for a, b in zip(t, pull, strict=True))
    return w, t


def test_the_fit_is_that_of_plain_loops():
    import math

    from docketry.llm import ordinal

    r = random.Random(21)
    texts = [" ".join(r.choices(["good", "bad", "text", "of", "words", "x1", "AND", "!!"], k=r.randint(0, 12))) for _ in range(14)]
    grades = [r.randint(0, 3) for _ in texts]
    dimensions = 1 << 12
    rows = ordinal.features(texts, dimensions)
    model = ordinal.fitted(rows, grades, dimensions=dimensions, steps=40, least_texts=0, least_z=0.0)
    w, t = plain_fit(rows, grades, dimensions, 40, 4.0)
    assert np.allclose(model.thresholds, t, atol=1e-6) and np.flatnonzero(model.weights).size <= len(w)
    assert all(math.isclose(model.weights[x], value, rel_tol=1e-5, abs_tol=1e-6) for x, value in w.items())
    tails = model.tails(texts)
    for (f, s), own in zip(rows, tails, strict=True):
        score = sum(w[int(x)] for x in f) / math.sqrt(max(1, len(f))) + sum(w[int(x)] for x in s)
        assert np.allclose(own, [1 / (1 + math.exp(-(score - k))) for k in t], atol=1e-5)
    assert (np.diff(tails, axis=1) <= 0).all()


def plain_candidates(text):
    """Token by token and match by match, with Python's own patterns."""
    from docketry.llm import secrets

    text = text.replace("\x01", "\x02")
    tokens, found = re.split(r"\s+", text, flags=re.ASCII), []
    for i, token in enumerate(tokens):
        if len(token) >= 16:
            found += [(i, x) for x in dict.fromkeys(m.group(0) for m in re.finditer(secrets.RUN, token, re.ASCII))]
    values = set()
    for pattern, parts in ((secrets.ASSIGNED, (2, 3, 5)), (secrets.IN_URL, (2,))):
        for m in re.finditer(pattern, text, re.ASCII):
            k = next((k for k in parts if m.group(k)), None)
            secret = "" if k is None else m.group(k)
            before = text[: m.start(k)] if k else text[: m.end()]
            if not re.fullmatch(secrets.RUN, secret, re.ASCII):
                values.add((len(re.findall(r"\s+", before, re.ASCII)), secret, m.group(0)))
    return sorted(found) + sorted((i, x) for i, x, _ in values)


def test_candidates_are_those_of_a_plain_search(spark):
    from docketry.llm import secrets

    r = random.Random(31)
    parts = ["key", "api_key", "=", ": ", '"', "'", " ", "\n", "token", "word", "a1B2c3D4e5F6g7H8", "x" * 20, "https://", "user:", "pa ss", "@", "/", "==", "é", "-" * 17, ".", "my.secret", "\x01"]
    texts = ["", "key", "key = ", 'key="a b" c', "a://b:c@d e://f@g", "password: hunter2.", "  token=x", "key='unclosed", "k" * 40] + ["".join(r.choices(parts, k=r.randint(1, 25))) for _ in range(700)]
    rows = secrets.candidates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "at", "secret").collect()
    got: dict[int, list] = {}
    for row in rows:
        got.setdefault(row["doc_id"], []).append((row["at"], row["secret"]))
    for i, text in enumerate(texts):
        assert sorted(got.get(i, [])) == sorted(plain_candidates(text)), text


# ---- awkward rows of earlier operators


def test_rows_without_number_and_empty_tables(spark):
    from docketry.llm import licences, repeats, toxicity
    from docketry.llm.decontaminate import contamination

    schema = "doc_id long, text string"
    docs = spark.createDataFrame([(None, "no number " * 30), (1, "no number " * 30), (2, None), (3, "")], schema)
    got = {r["doc_id"]: r for r in licences.licences(docs, licences.known_notices(spark)).collect()}
    assert set(got) == {1, 2, 3} and all(r["n_matches"] == 0 for r in got.values())
    cut = {r["doc_id"]: (r["n_bytes"], r["n_removed"]) for r in repeats.repeats(docs).collect()}
    assert set(cut) == {1, 2, 3} and cut[2] == cut[3] == (0, 0) and cut[1][0] == 300
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0 and toxicity.accepted(docs, labels).count() == 4
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen"), (2, "lone")], "item_id long, text string")
    long = "filler words here " * 60_000 + "one two three four five six seven eight nine ten eleven twelve thirteen lone " + "more filler " * 60_000
    row = contamination(spark.createDataFrame([(5, long)], schema), items).first()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (300_014, 14, 2, False)


def test_repeats_of_a_text_of_several_pieces(spark):
    """A text longer than a piece: what it shares with an earlier document goes, wherever it stands."""
    from docketry.llm import repeats

    r = random.Random(17)
    shared = "".join(r.choices("abcdefghijklmnop ", k=120))
    filler = np.random.default_rng(3).integers(97, 123, 17_500_000).astype(np.uint8).tobytes().decode()
    text = filler[:100] + shared + filler[100:17_000_000] + shared + filler[17_000_000:]
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"]) for x in repeats.repeats(spark.createDataFrame([(1, shared), (2, text)], "doc_id long, text string")).collect()}
    assert got[1] == (120, 0, 0) and got[2][0] == len(text) and got[2][2] == 2 and 240 <= got[2][1] <= 244
