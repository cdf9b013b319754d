"""SpotSigs document fingerprints.

A signature is a common word (the anchor) and the chain of the next content words after it. Content words that
no anchor's chain holds start chains of their own, so each content word is in a signature; a text of too few
words is a signature as a whole. Likeness is taken over all signatures. A printed fingerprint holds their number,
the smallest SKETCH of their hashes and a digest of all of them.

``fingerprints`` compares given pairs, each document with its edited text and with the next document.
``near_pairs`` searches all pairs: sets are partitioned by their size into bands, so that alike sets are in the
same band or in neighbouring ones, and the Jaccard comparison is pruned by size, by the rarest signatures and
by the place where two sets first meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docketry.llm.store import shuffle_width, stored
from docketry.llm.wordhash import NOT_WORD, U, mix, slices, utf8, words

CHAIN, SKETCH, STRETCHES = 2, 256, 8
# Common words of four languages.
ANCHORS = (
    "a an and are as at be by for from has in is it of on or that the this to was were which with "
    "au aux avec dans de des du elle en est et il la le les ou par pas pour que qui sur un une "
    "auf das dem den der des die ein eine er es für ist mit nicht sich sie und von zu "
    "al como con del el ella los las lo más no o para por se ser su una y"
).split()


def _anchor_hashes() -> np.ndarray:
    return np.sort(words([w.encode() for w in ANCHORS], NOT_WORD)[0])


def signatures(texts) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its signatures; never empty."""
    anchors, found = _anchor_hashes(), []
    plain = utf8(texts)
    for i, j in slices(plain):
        hashes, bounds = words(plain[i:j], NOT_WORD)
        common = anchors[np.minimum(np.searchsorted(anchors, hashes), len(anchors) - 1)] == hashes
        for k in range(j - i):
            own, is_anchor = hashes[bounds[k] : bounds[k + 1]], common[bounds[k] : bounds[k + 1]]
            content = np.flatnonzero(~is_anchor)
            if len(content) < CHAIN:
                digest = hashlib.sha256(plain[i + k]).digest()
                found.append(np.frombuffer(digest[:8], ">u8").astype(U))
                continue
            starts = np.flatnonzero(is_anchor)
            first = np.searchsorted(content, starts)
            ok = first + CHAIN <= len(content)
            lead, first = own[starts[ok]], first[ok]
            covered = np.zeros(len(content), bool)
            for step in range(CHAIN):
                covered[first + step] = True
            # The last words have too few after them: their chain ends with the text.
            bare = np.unique(np.minimum(np.flatnonzero(~covered), len(content) - CHAIN))
            lead, first = np.concatenate([lead, np.zeros(len(bare), U)]), np.concatenate([first, bare])
            chain = mix(lead)
            for step in range(CHAIN):
                chain = mix(chain + own[content[first + step]] * U(2 * step + 3))
            found.append(np.unique(chain))
    return found


def shown(own: np.ndarray) -> str:
    """Number of signatures, the upper halves of the smallest SKETCH of their hashes, digest of all hashes."""
    smallest = (own[:SKETCH] >> U(32)).astype(">u4").tobytes().hex()
    return f"{len(own)}:{smallest}:{hashlib.sha256(own.astype('>u8').tobytes()).hexdigest()}"


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Exact Jaccard likeness of two sorted sets of signatures."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compared(ids: list[int], texts: list[str], nexts: list[str], own: list[np.ndarray] | None = None, own_next: list[np.ndarray] | None = None) -> pd.DataFrame:
    edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(texts, nexts, strict=True)]
    own = own if own is not None else signatures(texts)
    own_next = own_next if own_next is not None else signatures(nexts)
    changed = signatures(edited)
    return pd.DataFrame(
        {
            "doc_id": ids,
            "n_chars": [len(t) for t in texts],
            "edited_sha256": [hashlib.sha256(x).hexdigest() for x in utf8(edited)],
            "fingerprint": [shown(x) for x in own],
            "edited_fingerprint": [shown(x) for x in changed],
            "near_edited": [likeness(x, y) for x, y in zip(own, changed, strict=True)],
            "near_next": [likeness(x, y) for x, y in zip(own, own_next, strict=True)],
        }
    )


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each document of a sorted stretch compared with the one after it; the last of a stretch has none here."""
    held: tuple[int, int, str, np.ndarray] | None = None
    for batch in batches:
        if not len(batch):
            continue
        stretch, ids, texts = batch["stretch"].tolist(), batch["doc_id"].tolist(), _unpacked(batch["packed"])
        own = signatures(texts)
        if held is not None:
            stretch, ids, texts, own = [held[0], *stretch], [held[1], *ids], [held[2], *texts], [held[3], *own]
        held = stretch[-1], ids[-1], texts[-1], own[-1]
        if inner := [k for k in range(len(ids) - 1) if stretch[k] == stretch[k + 1]]:
            of = lambda x, step=0, at=inner: [x[k + step] for k in at]
            yield _compared(of(ids), of(texts), of(texts, 1), of(own), of(own, 1))


def _ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of each stretch its first text and its last document."""
    first = last = None
    for batch in batches:
        for row in batch.itertuples(index=False):
            if last is not None and last.stretch != row.stretch:
                yield pd.DataFrame([(last.stretch, first, last.doc_id, last.packed)], columns=["stretch", "first", "doc_id", "packed"])
                first = None
            first, last = row.packed if first is None else first, row
    if last is not None:
        yield pd.DataFrame([(last.stretch, first, last.doc_id, last.packed)], columns=["stretch", "first", "doc_id", "packed"])


def _pack(bounds: np.ndarray) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Compressed texts with the number of their stretch, which follows from doc_id and the given bounds alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            stretch = -np.searchsorted(bounds, batch["doc_id"].to_numpy(np.int64))
            yield pd.DataFrame({"stretch": stretch, "doc_id": batch["doc_id"], "packed": [packer.compress(x) for x in utf8(batch["text"])]})

    return run


def _unpacked(packed: pd.Series) -> list[str]:
    plain = zstandard.ZstdDecompressor()
    return [plain.decompress(x).decode("utf-8", "surrogatepass") for x in packed]


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield _compared(batch["doc_id"].tolist(), _unpacked(batch["packed"]), _unpacked(batch["next"]))


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row for each row of docs that has a doc_id; null texts are empty. The next document of the one with
    the smallest doc_id is the one with the largest; of a single document, itself. Rows of the same doc_id
    follow each other in the order of their compressed texts. No documents give no rows."""
    plain, width = docs.where("doc_id IS NOT NULL").select("doc_id", "text"), shuffle_width(docs.sparkSession)
    # Stretches of doc_id between quantiles, some for each partition: numbers of the driver, so that whatever reads the
    # documents, once or again, sees the same stretches.
    n = STRETCHES * width
    bounds = plain.select(F.percentile_approx(F.col("doc_id").cast("long"), [k / n for k in range(1, n)], 20 * n)).first()[0] or []
    packed = plain.mapInPandas(_pack(np.unique(np.array(bounds, np.int64))), "stretch int, doc_id long, packed binary")
    placed = packed.repartition(width, "stretch").sortWithinPartitions("stretch", F.col("doc_id").desc(), "packed")
    inner = placed.mapInPandas(_neighbours, _RESULT)
    # Where stretches meet: their numbers are put in order; then the last document of each and the first text of
    # the one after it come to an equal number.
    ends = placed.mapInPandas(_ends, "stretch int, first binary, doc_id long, packed binary")
    along = Window.orderBy("stretch")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    order = ends.select("stretch", F.coalesce(F.lag("stretch").over(along), F.last("stretch").over(whole)).alias("before"))
    none = F.lit(None)
    sides = F.array(F.struct(F.col("stretch").alias("at"), "doc_id", "packed", none.cast("binary").alias("next")), F.struct(F.col("before").alias("at"), none.cast("long").alias("doc_id"), none.cast("binary").alias("packed"), F.col("first").alias("next")))
    each = ends.join(order, "stretch").select(F.explode(sides).alias("x")).select("x.*")
    met = each.groupBy("at").agg(*(F.first(x, ignorenulls=True).alias(x) for x in ("doc_id", "packed", "next"))).drop("at")
    return inner.unionByName(met.mapInPandas(_joined, _RESULT))


def near_pairs(docs: DataFrame, percent: int = 75) -> DataFrame:
    """Returns (doc_id, class_id, n_links), a row for each distinct doc_id: documents with equal signatures
    form a class, named by its smallest doc_id; n_links is the number of other classes whose likeness is
    ``percent`` hundredths or more. Rows without doc_id are left out, null texts are empty, of rows with the
    same doc_id the smallest text counts. No documents give no rows."""

    def signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = signatures(batch["text"])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "digest": [hashlib.sha256(s.tobytes()).digest() for s in sets], "n": [len(s) for s in sets], "signatures": [s.view(np.int64) for s in sets]})

    plain = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    sets = stored(plain.mapInPandas(signed, "doc_id long, digest binary, n int, signatures array<long>"), "signatures")
    classes = stored(sets.groupBy("digest").agg(F.min("doc_id").alias("class_id")), "classes")
    heads = sets.join(classes.select(F.col("class_id").alias("doc_id")), "doc_id", "left_semi")
    each = heads.select("doc_id", "n", F.explode("signatures").alias("signature"))
    counts = each.groupBy("signature").agg(F.count("*").alias("df")).where("df > 1")
    # A set's signatures in the order of rarity; those of no other set come first of all.
    ranked = each.join(counts, "signature").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "signature"))).alias("shared"))
    alone = F.col("n") - F.size("shared")
    prefix = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * percent / 100).cast("int") + 1 - alone)
    # Sizes of alike sets differ by at most one band.
    band = F.floor(F.log("n") / np.log(100 / percent) + 1e-9).cast("int")
    first = ranked.select("doc_id", "n", band.alias("band"), alone.alias("alone"), F.posexplode(F.slice("shared", F.lit(1), prefix)).alias("at", "x"))
    first = stored(first.select("doc_id", "n", "band", (F.col("alone") + F.col("at")).alias("at"), F.col("x.signature").alias("signature")), "prefixes")
    small = first.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"), "signature", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("band"))
    large = first.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"), "signature", "band")
    ordered = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b")))
    enough = (100 + percent) * F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) >= percent * (F.col("n_a") + F.col("n_b"))
    met = small.join(large, ["signature", "band"]).where(ordered & (100 * F.col("n_a") >= percent * F.col("n_b")) & enough).select("a", "b").distinct()
    for end in ("a", "b"):
        met = met.join(heads.select(F.col("doc_id").alias(end), F.col("signatures").alias(f"of_{end}")), end)
    both = F.size(F.array_intersect("of_a", "of_b"))
    links = met.where(100 * both >= percent * (F.size("of_a") + F.size("of_b") - both)).select(F.explode(F.array("a", "b")).alias("class_id"))
    links = links.groupBy("class_id").agg(F.count("*").alias("n_links"))
    return sets.select("doc_id", "digest").join(classes, "digest").join(links, "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
