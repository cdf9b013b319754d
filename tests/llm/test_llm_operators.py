import hashlib
import itertools
import random
import re
import string
import textwrap
import time
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler

from docketry.llm import chat, fingerprints, licences, near_dedup, ordinal, packing, repeats, secrets, store, wordhash
from docketry.llm import components as components_module
from docketry.llm.components import components
from docketry.llm.decontaminate import clean, contamination
from docketry.llm.near_dedup import keep_one, near_duplicates
from docketry.llm.queries import tokenizer_path
from docketry.llm.quality import quality
from docketry.llm.toxicity import accepted, toxicity

WORDS = [a + b for a in "bcdfgh" for b in ("an", "el", "or", "ut", "im")]
AWKWARD = [(1, None), (2, ""), (3, "   \n"), (4, "one"), (5, "one"), (6, "Ünï \U0001f600 text"), (None, "lost"), (8, "x " * 30_000), (8, "x " * 30_000)]
CLASH = "doc_id long, text string, kept boolean, n_words string, component_id string, batch int, region int"


def frame(spark, rows):
    """With further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, True, "x", "y", 1, 2) for i, t in rows], CLASH)


def empty(spark):
    return spark.createDataFrame([], CLASH)


def near_copies(seed=1, groups=12):
    r = random.Random(seed)
    rows, n = [], 0
    for _ in range(groups):
        base = [r.choice(WORDS) for _ in range(r.randint(20, 120))]
        for _ in range(r.randint(1, 6)):
            own = list(base)
            for _ in range(r.randint(0, 4)):
                own[r.randrange(len(own))] = r.choice(WORDS)
            rows.append((n, " ".join(own)))
            n += 1
    return rows


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def test_near_duplicates_against_all_pairs(spark):
    rows = near_copies()
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for i, j in itertools.combinations(sets, 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {i: (len(s), find(i), find(i) == i) for i, s in sets.items()}


def test_near_duplicates_awkward(spark):
    got = {r.doc_id: r.component_id for r in near_duplicates(frame(spark, AWKWARD)).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 6, 8: 8}
    assert near_duplicates(empty(spark)).count() == 0
    assert sorted((r.doc_id or -1) for r in keep_one(frame(spark, AWKWARD)).collect()) == [-1, 1, 2, 3, 4, 6, 8]


def test_near_duplicates_repeated_ids(spark):
    """Of rows with the same doc_id one counts, in its set, its links and its text."""
    a, b = " ".join(f"a{k}" for k in range(30)), " ".join(f"b{k}" for k in range(40))
    rows = [(1, b), (1, a), (2, a + " end"), (3, b + " end")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(frame(spark, rows)).collect()}
    assert got == {1: (26, 1), 2: (27, 1), 3: (37, 3)}
    assert sorted((r.doc_id, r.text) for r in keep_one(frame(spark, rows)).collect()) == [(1, a), (3, b + " end")]


def test_heads_follow_the_size_of_regions():
    region = np.repeat([5, 7, 9], [3, 200, 70])
    deeper = np.concatenate([[0, 0, 1 << 24], np.sort(np.repeat(np.arange(4) << 16, 50)), np.zeros(70)]).astype(np.int32)
    head, common, with_before = near_dedup._heads(region, deeper)
    assert common[:3].tolist() == [4, 4, 4] and with_before[:3].tolist() == [4, 8, 4] and common[5] == 6 and with_before[53] == 5
    assert head[:3].tolist() == [0, 0, 0]
    # 200 are more than a block: they are split by their deeper values, and block heads go to the region's first.
    assert (head[3:203].reshape(4, 50)[:, 1:] == np.array([[3], [53], [103], [153]])).all() and (head[[3, 53, 103, 153]] == 3).all()
    # 70 equal ones are split by place.
    assert (head[203:267] == 203).all() and head[267] == 203 and (head[268:] == 267).all()


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(50, 40), (40, 45), (40, 50)], "a long, b long")
    assert {r.node: r.component for r in components(links).collect()} == {**{i: 0 for i in range(1, 21)}, 45: 40, 50: 40}


def _sizes(monkeypatch, module) -> list[tuple[str, int]]:
    """Gets the label and the number of exchanges of each table that ``module`` stores."""
    seen, plain = [], module.stored

    def told(df, label):
        seen.append((label, len(re.findall(r"\bExchange \w", df._jdf.queryExecution().executedPlan().toString()))))
        return plain(df, label)

    monkeypatch.setattr(module, "stored", told)
    return seen


def test_components_of_random_links_and_small_plans(spark, monkeypatch):
    seen = _sizes(monkeypatch, components_module)
    draw = random.Random(3)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(170)] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2001 + i) for i in range(50)]
    least = {x: x for link in links for x in link}
    for _ in least:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    found = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.component for r in found.collect()} == {x: m for x, m in least.items() if x != m}
    # The driver plans a query anew after each exchange: a step of a round is a query of its own.
    assert max(n for _, n in seen) <= 4


def test_near_dedup_plans_stay_small_and_stars_go_on(spark, monkeypatch):
    seen, given = _sizes(monkeypatch, near_dedup), []

    def told(links):
        given.append(sorted(map(tuple, links.collect())))
        return components(links)

    monkeypatch.setattr(near_dedup, "components", told)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:200] + [f"x{i}"])) for i in range(12)] + [(100 + i, " ".join(words[200:] + [f"y{i}"])) for i in range(3)] + [(200, "alone in this table with no other")]
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.doc_id: r.component_id for r in found.collect()} == {**{i: 0 for i in range(12)}, 100: 100, 101: 100, 102: 100, 200: 200}
    assert {"rest", "met"} <= {label for label, _ in seen}
    # The second call gets the stars of the first, an edge for each node, not its links.
    assert given[1] == [*((i, 0) for i in range(1, 12)), (101, 100), (102, 100)]


def test_contamination(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    items = spark.createDataFrame([(1, passage), (2, "Alpha beta"), (3, None), (1, passage)], "item_id long, text string")
    rows = [(1, "start " + passage.upper() + " end"), (2, " ".join(f"w{i}" for i in range(12))), (3, None), (4, ""), (5, "an alpha, BETA! " + "x " * 100), (5, "an alpha, BETA! " + "x " * 100)]
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r["items"], r.contaminated) for r in contamination(frame(spark, rows), items).collect()}
    assert got == {1: (22, 20, 1, ["1"], True), 2: (12, 0, 0, [], False), 3: (0, 0, 0, [], False), 4: (0, 0, 0, [], False), 5: (103, 2, 1, ["2"], False)}
    assert contamination(empty(spark), items).count() == 0
    assert not contamination(frame(spark, rows), items.limit(0)).where("contaminated").count()
    assert sorted(r.doc_id for r in clean(frame(spark, rows), items).collect()) == [2, 3, 4, 5, 5]


def test_contamination_of_repeated_ids(spark):
    """Of rows with the same doc_id one counts, whole."""
    items = spark.createDataFrame([(1, "alpha beta")], "item_id long, text string")
    one, two = "alpha beta", "zz alpha beta q q q q q"
    got = {r.doc_id: (r.n_words, r.n_hit) for r in contamination(frame(spark, [(1, one), (1, two), (2, one), (3, two)]), items).collect()}
    assert got[2] == (2, 2) and got[3] == (8, 2) and got[1] in (got[2], got[3])


def test_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = ["Hello, World's 12 ½ x!!", "", " \n", "ÀÉß don't we'll ŒUVRE", "東京 \U0001f600 mixed", "a<|endoftext|>b", "İstanbul ΣΑΣ", "non breaking\u0085x\x1cy", "éte"]
    # Every character below U+0250 in the contexts that split words, and random strings of them.
    low, r = [chr(k) for k in range(0x250)], random.Random(12)
    texts += [f"a{x}b {x}{x} {x}'s 1{x}" for x in low] + ["".join(r.choices(low, k=r.randint(1, 30))) for _ in range(4000)] + ["ABŞ Əliyev", "Ɔkɔ Ɛve ȺȾ Ʉ"]
    words = packing._Words(tokenizer)
    assert list(packing.ids_of(texts, tokenizer, words)) == [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_packing(spark):
    from tokenizers import Tokenizer

    r = random.Random(3)
    rows = [(i, " ".join(r.choice(WORDS) for _ in range(r.choice([1, 3, 40, 400])))) for i in range(300)] + AWKWARD
    got = packing.pack(frame(spark, rows), tokenizer_path(), 512).toPandas()
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = []
    for i, t in rows:
        if i is not None:
            ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
            want += [(i, k, at, len(ids[at : at + 512]), zlib.crc32(ids[at : at + 512].tobytes())) for k, at in enumerate(range(0, len(ids), 512))]
    assert sorted(got[["doc_id", "piece", "start", "length", "ids_crc32"]].itertuples(index=False, name=None)) == sorted(want)
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 512
    bins: list[int] = []
    for length in sorted(got["length"], reverse=True):
        k = next((k for k, used in enumerate(bins) if used + length <= 512), None)
        if k is None:
            bins.append(length)
        else:
            bins[k] += length
    assert got["sequence_id"].nunique() <= len(bins)
    assert packing.pack(empty(spark), tokenizer_path()).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_configurations_use_each_piece_once(seed):
    r = np.random.default_rng(seed)
    lengths = np.sort(r.choice(np.arange(1, 101), 30, replace=False))
    counts = r.integers(1, 50, 30)
    made = packing.configurations(lengths, counts, 100, rounds=40)
    assert (sum(c * n for c, n in made) == counts).all() and all((c * lengths).sum() <= 100 for c, _ in made)


def test_places_keep_few_numbers_of_each_configuration():
    import tracemalloc

    r = np.random.default_rng(3)
    lengths = np.arange(1, 1501)
    counts = r.integers(1, 40, len(lengths))
    tracemalloc.start()
    made = packing._places(lengths.tolist(), counts.tolist(), 1500)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert made.assign(n=made["high"] - made["low"]).groupby("length")["n"].sum().tolist() == counts.tolist()
    assert peak < 30e6


def brute_repeats(rows):
    seen, found = {}, {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        mask = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if seen.setdefault(b[p : p + 50], i) < i:
                mask[p : p + 50] = True
        kept = np.frombuffer(b, np.uint8)[~mask].tobytes()
        found[i] = (len(b), int(mask.sum()), repeats._runs(mask), hashlib.sha256(kept).hexdigest())
    return found


def test_repeats_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(repeats, "BATCH", 2000)
    r = random.Random(5)
    common = " ".join(r.choice(WORDS) for _ in range(60))
    rows = near_copies(7) + [(500 + i, r.choice(WORDS) * r.randint(1, 9) + common[r.randint(0, 50) :] + r.choice(WORDS)) for i in range(40)]
    rows += [(600, None), (601, ""), (602, "é" * 40), (603, "é" * 30), (604, "aaaa" * 40), (605, "a" * 200), (606, "short")]
    got = {r.doc_id: tuple(r)[1:] for r in repeats.repeats(frame(spark, rows + rows[:3])).collect()}
    assert got == brute_repeats(rows)
    assert repeats.repeats(empty(spark)).count() == 0


def repeats_by_hand(rows, buckets):
    """The steps of repeats, with each batch and bucket as a task has it."""
    packed = next(repeats._pack(iter([pd.DataFrame(rows, columns=["doc_id", "text"]).sort_values("doc_id")])))
    samples = {x.batch: repeats._Sample(x, buckets) for part in repeats._gather(iter([packed])) for x in part.itertuples()}

    def answers(sent, sort):
        found = {b: [] for b in samples}
        for _, group in pd.concat(sent).groupby("bucket"):
            for x in sort(group).itertuples():
                found[x.batch].append({"bucket": x.bucket, "bits": x.bits})
        return found

    names = answers([repeats._sent(b, *s.payload()) for b, s in samples.items()], repeats._sort_names)
    settled = {b: s.settle(names[b]) for b, s in samples.items()}
    suffixes = {b: s.suffixes(settled[b][1]) for b, s in samples.items()}
    bits = answers([repeats._sent(b, bucket, name.astype("<u8")) for b, (_, _, name, bucket, _, _) in suffixes.items()], repeats._sort_suffixes)
    found = {}
    for b, s in samples.items():
        whole, (place, doc, _, bucket, first, inverse) = settled[b][0], suffixes[b]
        again = place[repeats._bits(bits[b], bucket, 1)[:, 0][inverse] | (doc > first[inverse])]
        for i, t, m in zip(s.ids, s.cover.texts, s.cover.removed(np.r_[s.cover.low[whole], again], np.r_[s.cover.high[whole], again]), strict=True):
            found[i] = (len(t), int(m.sum()), repeats._runs(m), hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest())
    return found, len(samples)


@pytest.mark.parametrize(("batch", "piece", "letters"), [(300, 50, "ab"), (300, 64, "abcdefgh "), (2000, 101, "a"), (2000, 1 << 16, "aé€ "), (1 << 20, 300, "abc")])
def test_repeats_in_small_batches_and_pieces(monkeypatch, batch, piece, letters):
    monkeypatch.setattr(repeats, "BATCH", batch)
    monkeypatch.setattr(repeats, "PIECE", piece)
    for seed in range(4):
        r = random.Random(seed)
        pool = ["".join(r.choices(letters, k=r.randint(0, 200))) for _ in range(12)]
        rows = [(i, "".join(r.choice(pool)[r.randint(0, 20) :] for _ in range(r.randint(0, 6)))) for i in range(60)]
        rows += [(100, None), (101, ""), (102, "x" * 49), (103, "x" * 50), (104, "x" * 50), (105, "x" * 51)]
        got, batches = repeats_by_hand(rows, 7)
        assert got == brute_repeats(rows) and (batches > 3 or batch > 2000)


def test_order_of_names_that_differ_in_lower_bits():
    r = np.random.default_rng(2)
    for n, high, low in [(0, 1, 1), (1, 1, 1), (2, 1, 2), (1000, 3, 1), (100_000, 50, 1 << 14), (100_000, 1 << 30, 4)]:
        names = (r.integers(0, high, n).astype(np.uint64) << np.uint64(30)) | r.integers(0, low, n).astype(np.uint64)
        assert (repeats._order(names) == np.argsort(names, kind="stable")).all()


def test_cover_of_a_batch_is_small_work():
    """A cover sample takes less time than a hash of each place would, and its arrays lie in small pieces."""
    data = np.random.default_rng(1).integers(97, 123, 4 << 20).astype(np.uint8)
    texts = [data[i : i + 4096].tobytes() for i in range(0, len(data), 4096)]
    place = np.arange(len(data) - 49)

    def seconds(work):
        took = []
        for _ in range(5):
            began = time.process_time()
            work()
            took.append(time.process_time() - began)
        return min(took)

    assert seconds(lambda: repeats.Cover(texts)) < seconds(lambda: wordhash.Spans(data).hash(place, place + 50))
    tracemalloc.start()
    repeats.Cover(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6


def test_fingerprints(spark):
    rows = near_copies(2) + [(900, None), (901, ""), (902, "a\U0001f600b" * 7)]
    got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, rows)).collect()}
    order = sorted(rows, reverse=True, key=lambda x: x[0])
    assert len(got) == len(rows)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        own, changed, other = fingerprints.signatures([t, edited, n])
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == fingerprints.shown(own) and got[i].edited_fingerprint == fingerprints.shown(changed)
        assert got[i].near_edited == fingerprints.likeness(own, changed) and got[i].near_next == fingerprints.likeness(own, other)
    assert fingerprints.fingerprints(empty(spark)).count() == 0
    alone = fingerprints.fingerprints(frame(spark, [(1, "the cat sat on the mat")])).first()
    assert alone.near_next == 1.0


def spot_signatures(text):
    """SpotSigs by plain loops: each anchor with the CHAIN content words after it; content words in no chain
    start their own (the last ones end with the text); too few words: the text."""
    found = re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text)
    tokens = ["".join(c.lower() if c in string.ascii_uppercase else c for c in w) for w in found]
    content = [w for w in tokens if w not in fingerprints.ANCHORS]
    if len(content) < fingerprints.CHAIN:
        return {("", text)}
    chains, covered, k = set(), set(), 0
    for w in tokens:
        if w not in fingerprints.ANCHORS:
            k += 1
        elif k + fingerprints.CHAIN <= len(content):
            chains.add((w, *content[k : k + fingerprints.CHAIN]))
            covered |= set(range(k, k + fingerprints.CHAIN))
    for k in set(range(len(content))) - covered:
        k = min(k, len(content) - fingerprints.CHAIN)
        chains.add(("", *content[k : k + fingerprints.CHAIN]))
    return chains


def anchored_copies():
    r = random.Random(21)
    return near_copies(2) + [(1000 + i, " ".join(r.choice(WORDS + fingerprints.ANCHORS[:6] * 3) for _ in range(r.randint(1, 60)))) for i in range(60)]


def test_fingerprints_against_plain_spotsigs(spark):
    rows = anchored_copies() + [(900, None), (901, ""), (902, "a\U0001f600b" * 7), (903, "THE Cat Ünï the dog of")]
    got = {r.doc_id: r for r in fingerprints.fingerprints(frame(spark, rows)).collect()}
    order = sorted(rows, reverse=True, key=lambda x: x[0])
    jaccard = lambda a, b: len(a & b) / len(a | b)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        own, changed, other = (spot_signatures(x) for x in (t, t[: len(t) - len(t) // 2] + n[: len(t) // 2], n))
        assert got[i].near_edited == pytest.approx(jaccard(own, changed)) and got[i].near_next == pytest.approx(jaccard(own, other))
        assert got[i].fingerprint.startswith(f"{len(own)}:")


def test_near_pairs_against_all_pairs(spark):
    r = random.Random(22)
    rows = anchored_copies()
    rows += [(2000 + i, " ".join(w if r.random() > 0.05 else r.choice(WORDS) for w in t.split())) for i, t in rows] + [(5000, rows[0][1]), (5001, None), (5002, "")]
    sets = {i: frozenset(spot_signatures(t or "")) for i, t in rows}
    heads = {}
    for i in sorted(sets):
        heads.setdefault(sets[i], i)
    links = {h: sum(4 * len(s & o) >= 3 * len(s | o) for o in heads if o != s) for s, h in heads.items()}
    got = {x.doc_id: (x.class_id, x.n_links) for x in fingerprints.near_pairs(frame(spark, rows + rows[:4])).collect()}
    assert got == {i: (heads[s], links[heads[s]]) for i, s in sets.items()} and sum(links.values()) > 20
    assert fingerprints.near_pairs(empty(spark)).count() == 0


def test_likeness_of_long_texts_is_exact():
    r = random.Random(11)
    names = [a + b + c for a in WORDS for b in WORDS for c in "xyz"]
    base = [w for _ in range(4000) for w in ("the", r.choice(names), r.choice(names))]
    other = list(base)
    for k in range(1, len(other), 30):
        other[k] = r.choice(names)
    sets = [{tuple(x[k : k + 3]) for k in range(0, len(x), 3)} for x in (base, other)]
    a, b = fingerprints.signatures([" ".join(base), " ".join(other)])
    assert (len(a), len(b)) == (len(sets[0]), len(sets[1])) and len(a) > 10 * fingerprints.SKETCH
    assert fingerprints.likeness(a, b) == len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    most = np.concatenate([a[:-1], [a[-1] + np.uint64(1)]])
    assert fingerprints.shown(a) != fingerprints.shown(most)


def test_each_content_word_is_in_a_signature():
    menu = [f"item{k}" for k in range(60)]
    own = fingerprints.signatures([" ".join(["the", *menu])])[0]
    for k in range(len(menu)):
        changed = menu[:k] + ["other"] + menu[k + 1 :]
        assert fingerprints.likeness(own, fingerprints.signatures([" ".join(["the", *changed])])[0]) < 1.0


@pytest.mark.parametrize("roles", [r for n in range(4) for r in itertools.product(range(4), repeat=n) if n])
def test_least_cost(roles):
    costs, _ = chat._forward(list(roles), chat.START)
    assert min(costs[s] + chat.INSERT * len(chat._CLOSE[s]) for s in range(4)) == chat.least_cost(list(roles))


def test_chat_repair(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 3)
    r = random.Random(4)
    names = ["system", "user", "assistant", "other", None]
    rows = [(c, t, r.choice(names), r.choice(["hi", "", None])) for c in range(8) for t in range(r.randint(1, 11))]
    rows += [(None, 0, "user", "lost"), (99, None, "user", "late"), (99, 0, "USER ", "first"), (99, 0, "user", "first")]
    got = chat.repaired(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).toPandas()
    assert set(got["conv_id"]) == {*range(8), 99}
    for conv, own in got.sort_values(["segment", "place"]).groupby("conv_id"):
        roles = [r for r, a in zip(own["role"], own["action"], strict=True) if a not in ("merge", "relabel+merge")]
        assert roles[-1] == "assistant" and "system" not in roles[1:]
        assert all(a != b for a, b in itertools.pairwise(roles)) and roles[roles[0] == "system"] == "user"
        text = "".join(own["rendered"])
        assert text.count("<|end|>") == len(roles) and text.endswith("<|end|>\n")
        # The rows explain the cost.
        assert own["action"].map({"keep": 0, "relabel": 2, "merge": 1, "relabel+merge": 3, "insert": 3}).sum() == own["cost"].iloc[0]
        if (n := sum(x[0] == conv for x in rows)) <= 6:
            codes = [chat._CODES.get((x[2] or "").strip().lower(), 0) for x in sorted((x for x in rows if x[0] == conv), key=lambda x: (x[1] is None, x[1] or 0, x[2] or ""))]
            assert own["cost"].iloc[0] == chat.least_cost(codes), n


def test_chat_odd_tables(spark, monkeypatch):
    monkeypatch.setattr(chat, "SEGMENT", 3)
    schema = "conv_id long, turn long, role string, text string, cost string, steps int, piece int"
    assert chat.repaired(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, 5, "user", "same", "x", 1, 2)] * 20 + [(1, None, "user", None, None, None, None)] * 4 + [(2, 0, None, "x " * 50_000, "x", 1, 2)]
    got = chat.repaired(spark.createDataFrame(rows, schema)).toPandas().sort_values(["conv_id", "segment", "place"])
    one, two = (got[got["conv_id"] == c] for c in (1, 2))
    assert list(one["action"]) == ["keep"] + ["merge"] * 22 + ["relabel"] and set(one["cost"]) == {22 * chat.MERGE + chat.RELABEL}
    assert "".join(one["rendered"]) == "<|user|>\n" + "\n".join(["same"] * 20 + [""] * 3) + "<|end|>\n<|assistant|>\n<|end|>\n"
    assert "x " * 50_000 in "".join(two["rendered"]) and two["role"].iloc[-1] == "assistant"


def test_ordinal_on_held_out():
    r = random.Random(6)
    marks = ["vile", "nasty", "cruel"]
    texts, grades = [], []
    for _ in range(900):
        g = r.choice([0, 0, 0, 1, 2])
        w = [r.choice(WORDS) for _ in range(60)] + r.sample(marks, 1) * (2 * (g > 0)) + ["horrid"] * (g > 1)
        r.shuffle(w)
        texts.append(" ".join(w))
        grades.append(g)
    model = ordinal.fit(pd.Series(texts[:600]), grades[:600])
    tails = model.tails(pd.Series(texts[600:]))
    truth = np.array(grades[600:])
    assert ((tails >= 0.5).sum(axis=1) == truth).mean() > 0.95
    assert (np.diff(tails, axis=1) <= 1e-12).all()
    assert model.tails(pd.Series([None, ""])).shape == (2, 2)


def test_classifier_queries(spark):
    r = random.Random(8)
    rows = [(i, " ".join([r.choice(WORDS) for _ in range(30)] + ["vile"] * (i % 4 == 0))) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows + [(300, None), (301, "")])
    got = {x.doc_id: x.rejected for x in toxicity(docs, labels).collect()}
    assert got == {**{i: i % 4 == 0 for i in range(200)}, 300: False, 301: False}
    assert accepted(docs, labels).columns == docs.columns and accepted(docs, labels).count() == 152
    assert not toxicity(docs, labels.limit(0)).where("rejected").count()
    assert quality(docs, labels).count() == 202 and quality(empty(spark), labels).count() == 0
    assert quality(docs, labels.limit(0)).where("selected").count() == 0


def test_licences(spark):
    known = licences.known_notices(spark)
    rows = [(1, "LICENSED under the  Apache Licence, version 2.0!\nprose"), (2, "Released under the MIT License."), (3, None), (4, "prose"), (5, "Copyright 2020 me\nReleased under the MIT license")]
    got = {r.doc_id: (r.n_matches, r.licences, r.whole) for r in licences.licences(frame(spark, rows), known).collect()}
    assert got == {1: (1, "Apache-2.0", False), 2: (1, "MIT", True), 3: (0, "", False), 4: (0, "", False), 5: (1, "MIT", True)}
    assert licences.licences(empty(spark), known).count() == 0


def test_licence_texts_of_many_lines(spark, monkeypatch):
    texts = dict(reversed(licences.NOTICES))
    known = licences.known_notices(spark)
    rows = [(k, text) for k, (_, text) in enumerate(licences.NOTICES)]
    want = {k: (name, True) for k, (name, _) in enumerate(licences.NOTICES)}
    wrapped = textwrap.fill(" ".join(texts["MIT"].split()), 40)
    rows += [(100, "Tool 1.0\n\nThe MIT Licence\n\nCopyright (c) 2020 Someone\n\n" + wrapped + "\n\nThe rest of a README."), (101, wrapped.replace("granted", "given")), (102, wrapped + " and more"), (103, "x " + wrapped)]
    rows += [(104, "y\n" * 500 + " ".join(texts["ISC"].split()) + "\n" + texts["Zlib"].replace("This", "  * This")), (105, None), (105, texts["MIT"]), (106, wrapped), (106, wrapped)]
    want |= {100: ("MIT", False), 101: ("", False), 102: ("", False), 103: ("", False), 104: ("ISC,Zlib", False), 106: ("MIT", True)}
    got = {r.doc_id: (r.licences, r.whole) for r in licences.licences(frame(spark, rows), known).collect()}
    assert got.pop(105) in (("", False), ("MIT", True)) and got == want
    monkeypatch.setattr(licences, "BROADCAST_TEXTS", 0)
    assert {r.doc_id: (r.licences, r.whole) for r in licences.licences(frame(spark, rows[-12:-6]), known).collect()} == {k: want[k] for k, _ in rows[-12:-6]}


def test_licence_on_a_long_line(spark):
    grant = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, " + "to deal in it without restriction, " * 20
    known = spark.createDataFrame([("MIT", grant)], "licence string, notice string")
    rows = [(1, f"prose\n{grant}\nmore"), (2, "prose\n" + grant.replace(", ", " ,  ").upper()), (3, "prose\n" + grant + " not"), (4, "prose\n" + "-" * 500 + " " + grant)]
    got = {r.doc_id: (r.n_matches, r.licences, r.whole) for r in licences.licences(frame(spark, rows), known).collect()}
    assert got == {1: (1, "MIT", False), 2: (1, "MIT", False), 3: (0, "", False), 4: (1, "MIT", False)}


def test_secrets_held_out(spark):
    r = random.Random(9)
    digits = "0123456789abcdef"
    rows, truth = [], {}
    for i in range(300):
        kind = i % 3
        value = "".join(r.choice(digits) for _ in range(40)) if kind == 0 else "AKIA" + "".join(r.choice("ABCDEFGHIJ234567") for _ in range(16)) if kind == 1 else "".join(r.choice(WORDS) for _ in range(8))
        rows.append((i, f"some words {'token = ' if kind == 0 else 'and '}\"{value}\" more words"))
        truth[i] = kind < 2
    docs = frame(spark, [*rows, (900, None), (901, "")])
    reviewed = spark.createDataFrame([(r.doc_id, r.at, int(truth[r.doc_id])) for r in secrets.candidates(docs).collect() if r.doc_id < 200], "doc_id long, at int, is_secret int")
    got = {r.doc_id: r.is_secret for r in secrets.findings(docs, reviewed).collect()}
    assert sum(got[i] == truth[i] for i in range(200, 300)) >= 98
    masked = secrets.masked(docs, reviewed)
    assert masked.columns == docs.columns and masked.count() == 302
    assert masked.where(f"text LIKE '%{secrets.MASK}%'").count() >= 195
    assert secrets.findings(empty(spark)).count() == 0


def test_secrets_from_planted_findings(spark):
    """Trained on planted findings of one seed, held against those of another and against hand-made lines."""
    r = random.Random(31)
    words = [a + b for a in WORDS for b in ("", "el", "tor", "ing")]
    docs = frame(spark, [(i, " ".join(r.choice(words) for _ in range(120))) for i in range(1500)])
    known = secrets.dictionary(docs)
    likely = secrets.transitions(known)
    model = secrets.train(secrets.planted(docs), known, likely)
    assemble = VectorAssembler(inputCols=[f"f_{k}" for k in secrets.FEATURES], outputCol="features")

    def judged(found):
        return model.transform(assemble.transform(secrets.described(found, known, likely)))

    held = judged(secrets.planted(docs, seed=2)).groupBy("label", "prediction").count().collect()
    n = {(x["label"], x["prediction"]): x["count"] for x in held}
    assert n[1.0, 1.0] / (n[1.0, 1.0] + n.get((0.0, 1.0), 0)) > 0.95 and n[1.0, 1.0] / (n[1.0, 1.0] + n.get((1.0, 0.0), 0)) > 0.95
    value = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    # The same string is a secret or not by its neighbours, and a key word alone makes no secret.
    lines = [f'ban gel token = "{value}" cut', f"ban gel commit {value} cut", "ban password: required cut", "ban gel 9807915762804490 cut", "ban " + "fanelgorutbim" * 2 + " cut", 'the password = "Tr0u$4dor" cut']
    got = {x.doc_id: x.prediction for x in judged(secrets.candidates(frame(spark, list(enumerate(lines))))).collect()}
    assert got == {0: 1.0, 1: 0.0, 2: 0.0, 3: 0.0, 4: 0.0, 5: 1.0}


def test_secrets_awkward(spark):
    """Columns that clash, repeated rows, long texts, nulls, empty tables."""
    rows = [*AWKWARD, (9, 'a token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" b'), (9, 'a token = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8" b')]
    docs = spark.createDataFrame([(i, t, "s", "x", "y", 1) for i, t in rows], "doc_id long, text string, secrets string, secret string, context string, at int")
    assert secrets.masked(docs).columns == docs.columns and secrets.masked(docs).count() == len(rows)
    assert secrets.findings(docs).where("doc_id = 9").count() == 2
    assert secrets.findings(docs.limit(0)).count() == 0 and secrets.masked(docs.limit(0)).count() == 0


def test_short_secrets(spark):
    texts = [
        'a\n password = "Tr0ub4dor3" end', "pwd: h!u@n$t.e4r, then", 'say "api_key" : \'two words 7\'  and', "see postgres://bob:s3c!ret@db.example/x now", "https://t0ken@host/", "Authorization: Bearer ab12 x",
        "monkey: banana author: Jane rapid: river", "password = ", "token=x1 and key=x1", "access_token=0123456789abcdef0123", "secret = \"un2closed",
    ]
    docs = frame(spark, list(enumerate(texts)))
    got = sorted((r.doc_id, r["at"], r.secret) for r in secrets.candidates(docs).collect())
    want = [(0, 3, "Tr0ub4dor3"), (1, 1, "h!u@n$t.e4r"), (2, 3, "two words 7"), (3, 1, "s3c!ret"), (4, 0, "t0ken"), (5, 2, "ab12"), (8, 0, "x1"), (8, 2, "x1"), (9, 0, "0123456789abcdef0123"), (10, 2, "un2closed")]
    assert [x for x in got if x[0] != 6] == want
    reviewed = spark.createDataFrame([(i, at, 1) for i, at, _ in got if i != 6] + [(6, at, 0) for i, at, _ in got if i == 6], "doc_id long, at int, is_secret int")
    texts_out = {r.doc_id: r.text for r in secrets.masked(docs, reviewed).collect()}
    assert texts_out[0] == 'a\n password = "[SECRET]" end' and texts_out[3] == "see postgres://bob:[SECRET]@db.example/x now"
    assert texts_out[8] == "token=[SECRET] and key=[SECRET]"


def test_pipeline_keeps_the_columns(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        n = docs.count()
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and 0.5 * n < docs.count() <= n
    last = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert last.select("doc_id").distinct().count() == docs.count()


def pipeline_tables(spark, folder, rows):
    r = random.Random(41)
    rated = [(10_000 + i, " ".join([r.choice(WORDS) + r.choice(WORDS) for _ in range(40)] + ["vile"] * (2 * (i % 4 == 0)))) for i in range(160)]
    docs = spark.createDataFrame([(i, t, "en", "src", len(t or ""), "x", 1) for i, t in [*rows, *rated]], "doc_id long, text string, lang string, source string, n_chars long, component_id string, kept int")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(10_000 + i, 1, int(i % 4 == 0)) for i in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, " ".join(f"q{k}" for k in range(20))), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_pipeline_on_an_awkward_table(spark, tmp_path):
    """Nulls in any column, empty and very long texts, repeated rows, copies, clashing columns, through all stages."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    copied = " ".join(WORDS[k % 30] + str(k) for k in range(60))
    value = "9b0b3c6a43eb78aa99cbd7049c572391524f37a8"
    rows = [*AWKWARD, (20, copied), (21, copied), (22, copied + " end"), (23, "so " + " ".join(f"q{k}" for k in range(20))), (24, f'ban gel token = "{value}" cut and some more words here'), (25, "a vile vile " + "x " * 30)]
    docs = pipeline_tables(spark, str(tmp_path), rows)
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    kept = {x for x in got["doc_id"]}
    # Packing leaves out rows without doc_id; of the copies the smallest stays; the benchmark's passage and toxic ones go.
    want = {1, 2, 3, 4, 6, 8, 20, 24} | {10_000 + i for i in range(160) if i % 4}
    assert kept == want
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = np.array([*tokenizer.encode("ban gel token = \"[SECRET]\" cut and some more words here", add_special_tokens=False).ids, 1], "<u4")
    assert got.set_index("doc_id").loc[24, "ids_crc32"] == zlib.crc32(ids.tobytes())
    for _, s in got.groupby("sequence_id"):
        s = s.sort_values("offset")
        assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= packing.CAPACITY
    stage = docs
    for _, step in corpus_pipeline.STAGES[:-1]:
        stage = step(spark, stage, str(tmp_path))
        assert stage.columns == docs.columns


def test_pipeline_on_an_empty_table(spark, tmp_path):
    import corpus_pipeline

    docs = pipeline_tables(spark, str(tmp_path), []).limit(0)
    for _, step in corpus_pipeline.STAGES:
        out = step(spark, docs, str(tmp_path))
        assert out.count() == 0


def test_quality_on_held_out(spark):
    """Grades of documents that the fit didn't see; tails fall and add up to the expected grade."""
    r = random.Random(51)
    marks = [["junk", "vile"], ["junk"], ["good", "vile"], ["good"]]
    truth = {i: r.randrange(4) for i in range(800)}
    docs = frame(spark, [(i, " ".join(r.sample([r.choice(WORDS) for _ in range(40)] + 2 * marks[g], 40 + 2 * len(marks[g])))) for i, g in truth.items()] + [(900, None), (901, ""), (5, "x " * 30_000)])
    labels = spark.createDataFrame([(i, int(g >= 2), int(g % 2 == 0)) for i, g in truth.items() if i < 500] + [(3, 0, 1), (None, 1, 0), (950, None, None)], "doc_id long, quality int, toxic int")
    got = quality(docs, labels).toPandas()
    held = got[(got["doc_id"] >= 500) & (got["doc_id"] < 800)].set_index("doc_id")
    assert len(got) == 803 and len(held) == 300
    assert sum(held.loc[i, "selected"] == (truth[i] >= 2) for i in held.index) >= 285
    assert sum(abs(held.loc[i, "expected_grade"] - truth[i]) < 1 for i in held.index) >= 270
    assert (got["p_best"] <= got["p_good"] + 1e-9).all() and (got["expected_grade"] >= got["p_good"] + got["p_best"] - 1e-9).all()


def most_to_python(docs):
    """The most bytes of texts that a Python worker gets at once."""

    def sizes(batches):
        for batch in batches:
            yield pd.DataFrame({"n": [batch["text"].str.len().sum()]})

    return docs.mapInPandas(sizes, "n long").agg({"n": "max"}).first()[0]


@pytest.mark.parametrize("step", ["toxicity", "near_dedup", "packing"])
def test_texts_go_to_python_in_small_batches(spark, step):
    """20 MB of one partition: one batch by Spark's default. A session's own limit stays."""
    docs = spark.range(0, 2000, 1, 1).selectExpr("id AS doc_id", "repeat(concat('word', id % 2, ' '), 1700) AS text")
    labels = spark.range(2000).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 2 AS int) AS toxic")
    run = {"toxicity": lambda: accepted(docs, labels, most=50), "near_dedup": lambda: keep_one(docs.limit(10)), "packing": lambda: packing.pieces(docs, tokenizer_path)}[step]
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    assert most_to_python(docs) > 15e6
    run()
    assert most_to_python(docs) < store.BATCH_BYTES + 20_000
    spark.conf.set(name, "1m")
    run()
    assert spark.conf.get(name) == "1m"
    spark.conf.unset(name)


def test_hashing_holds_a_small_slice_at_once():
    """4 MB of texts take less than 20 MB of arrays beside them, and give what each text gives by itself."""
    r = random.Random(61)
    texts = [" ".join(r.choices(WORDS, k=600)) for _ in range(1700)]
    for hashed in (wordhash.shingle_sets, lambda x: ordinal.features([t.decode() for t in x], 1 << 16)):
        plain = [t.encode() for t in texts]
        hashed(plain[:100])
        tracemalloc.start()
        found = hashed(plain)
        kept, most = tracemalloc.get_traced_memory()
        tracemalloc.stop()
        assert most - kept < 20e6
        for i in r.sample(range(len(texts)), 20):
            assert all((a == b).all() for a, b in zip(found[i], hashed(plain[i : i + 1])[0], strict=True))
