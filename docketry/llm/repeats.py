"""Repeated passages by blockwise suffix sorting over a cover sample.

A byte is removed if a string of WINDOW bytes that covers it also starts in a document of smaller doc_id, so
suffixes need to be told apart to WINDOW bytes only. A cover sample holds, of each WINDOW bytes, one place
that the bytes alone decide (the least hash of GRAM bytes): wherever the same WINDOW bytes stand, the same
place of them is in the sample. It does what a difference cover's residues do, with 6 % of all places where
residues modulo 31 would take 19 %.

First the samples are named and sorted, one bucket of names at a time: a name that an earlier batch of
documents has too settles all suffixes of its range (a long tie) at once. Only where samples agree and their
surroundings differ are suffixes sorted themselves, again one bucket at a time. A bucket gets each name once
from a batch, and answers with a bit for each; no task holds more than its bucket or its batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.store import shuffle_width, stored, stored_in_buckets
from docketry.llm.wordhash import U, Spans, mix, utf8

WINDOW, GRAM = 50, 20
#: Bytes of text in a batch of documents; a longer document is a batch by itself.
BATCH = 4 << 20
#: Bytes of a batch that are hashed at once, 1 << 16 at most: the arrays stay in the processor's cache.
PIECE = 1 << 16
_PLACE = np.uint32((1 << 16) - 1)


class Cover:
    """The cover sample of a batch of documents: for each range of suffixes [low, high] of one sample, by place
    in the batch, its document, the sample's name and the name of all bytes of the range's windows."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(x) for x in texts])
        self.step = PIECE - WINDOW + 1
        found = [self._ranges(begin) for begin in range(0, len(self.data) - WINDOW + 1, self.step)]
        empty = [np.zeros(0, np.int64)] * 3 + [np.zeros(0, U)] * 2
        self.low, self.high, self.doc, self.name, self.around = [np.concatenate(x) for x in zip(*found, strict=True)] if found else empty

    def _ranges(self, begin: int) -> tuple[np.ndarray, ...]:
        """The ranges of the windows that start in the piece; those that go on in the next piece are cut."""
        data = self.data[begin : begin + PIECE]
        spans, n = Spans(data), len(data) - GRAM + 1
        grams = spans.sums[GRAM:] - spans.sums[:-GRAM]
        grams *= spans.down[:n]
        # The upper bits depend on all bytes and choose; of equal ones the leftmost counts.
        least = (grams >> U(32)).astype(np.uint32)
        least &= ~_PLACE
        least |= np.arange(n, dtype=np.uint32)
        width, want = 1, WINDOW - GRAM + 1
        while 2 * width <= want:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
        new = np.ones(len(least), bool)
        np.not_equal(least[1:], least[:-1], out=new[1:])
        starts = self.ends[np.searchsorted(self.ends, begin, "right") : np.searchsorted(self.ends, begin + len(least))] - begin
        new[starts] = True
        low = np.flatnonzero(new)
        at, high = (least[low] & _PLACE).astype(np.int64), np.r_[low[1:], len(least)] - 1
        doc = np.searchsorted(self.ends, begin + low, "right")
        high = np.minimum(high, self.ends[doc] - begin - WINDOW)
        own = low <= high
        low, high, doc, at = low[own], high[own], doc[own], at[own]
        return begin + low, begin + high, doc, mix(grams[at]), spans.hash(low, high + WINDOW)

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, doc, name) of all windows of the chosen ranges."""
        own = np.flatnonzero(chosen)
        piece = self.low[own] // self.step
        found = []
        for part in np.split(own, np.flatnonzero(np.diff(piece)) + 1) if len(own) else ():
            begin = int(self.low[part[0]]) // self.step * self.step
            counts = self.high[part] - self.low[part] + 1
            place = np.repeat(self.low[part] - begin - np.cumsum(np.r_[0, counts[:-1]]), counts) + np.arange(counts.sum())
            found.append((begin + place, np.repeat(self.doc[part], counts), Spans(self.data[begin : begin + PIECE]).hash(place, place + WINDOW)))
        empty = [np.zeros(0, np.int64)] * 2 + [np.zeros(0, U)]
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else tuple(empty)

    def removed(self, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
        """For each text the mask of bytes that the windows starting at low to high cover. No two ranges share a
        window, so that a byte lies in WINDOW of them at most."""
        change = np.zeros(len(self.data) + 1, np.int8)
        change[low] += 1
        change[high + WINDOW] -= 1
        return np.split(np.cumsum(change[:-1], dtype=np.int8) > 0, self.ends[:-1])


def _order(names: np.ndarray) -> np.ndarray:
    """As a stable argsort, several times as fast: the upper bits are sorted with the index below them, then
    those that need their lower bits."""
    below = U((1 << max(1, len(names) - 1).bit_length()) - 1)
    packed = (names & ~below) | np.arange(len(names), dtype=U)
    packed.sort()
    order = (packed & below).astype(np.int64)
    packed &= ~below
    found = names[order]
    new = packed[1:] != packed[:-1]
    several = ~new & (found[1:] != found[:-1])
    if several.any():
        run = np.cumsum(np.r_[False, new])
        at = np.flatnonzero(np.isin(run, run[1:][several]))
        order[at] = order[at][np.argsort(found[at], kind="stable")]
    return order


def _distinct(names: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(an index of each distinct name in ascending order, each one's first document, the inverse); documents
    ascend."""
    order = _order(names)
    found = names[order]
    new = np.ones(len(names), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    index, inverse = order[new], np.empty(len(names), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return index, docs[index], inverse


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each name, by its upper half; it ascends with the names."""
    return (((names >> U(32)) * U(buckets)) >> U(32)).astype(np.int64)


def _texts(row) -> list[bytes]:
    plain, at, found = zstandard.ZstdDecompressor(), 0, []
    for size in row.sizes:
        found.append(plain.decompress(row.blob[at : at + size]))
        at += size
    return found


def _pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = utf8(batch["text"])
        yield pd.DataFrame({"doc_id": batch["doc_id"], "n": [len(x) for x in texts], "packed": [packer.compress(x) for x in texts]})


def _gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents in the order of doc_id to batches, each named by its first doc_id."""
    ids: list[int] = []
    blobs: list[bytes] = []
    size, last = 0, None

    def row():
        return pd.DataFrame({"batch": [ids[0]], "ids": [ids], "sizes": [[len(x) for x in blobs]], "blob": [b"".join(blobs)]})

    for batch in batches:
        for doc_id, n, packed in zip(batch["doc_id"], batch["n"], batch["packed"], strict=True):
            if doc_id == last:
                continue
            if ids and size + n > BATCH:
                yield row()
                ids, blobs, size = [], [], 0
            last = doc_id
            ids.append(int(doc_id))
            blobs.append(packed)
            size += n
    if ids:
        yield row()


def _stretches(bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each bucket, where it begins) of ascending buckets."""
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[first], first


def _sent(batch: int, bucket: np.ndarray, payload: np.ndarray) -> pd.DataFrame:
    """A row for each bucket; the payload's rows are in the order of buckets."""
    found, first = _stretches(bucket)
    parts = np.split(payload, first[1:]) if len(found) else []
    return pd.DataFrame({"batch": [batch] * len(found), "bucket": found.astype(np.int64), "payload": [x.tobytes() for x in parts]})


_NAME = np.dtype([("name", "<u4"), ("around", "<u4"), ("more", "u1")])
_LOW = U((1 << 24) - 1)


class _Sample:
    """A batch's cover with its distinct names in the order in which buckets get them."""

    def __init__(self, row, buckets: int):
        self.ids, self.cover, self.buckets = list(row.ids), Cover(_texts(row)), buckets
        c = self.cover
        index, self.first, self.inverse = _distinct((c.name & ~_LOW) | (c.around & _LOW), c.doc)
        self.name, self.around = c.name[index], c.around[index]
        self.bucket = _bucket(self.name, buckets)

    def payload(self) -> tuple[np.ndarray, np.ndarray]:
        out = np.zeros(len(self.name), _NAME)
        out["name"], out["around"] = self.name & U(0xFFFFFFFF), self.around & U(0xFFFFFFFF)
        out["more"] = (self.around >> U(32)) & U(0xFF)
        return self.bucket, out

    def settle(self, answers) -> tuple[np.ndarray, np.ndarray]:
        """For each range: it is repeated as a whole; its suffixes have to be sorted."""
        seen, mixed = _bits(answers, self.bucket, 2).T
        whole = seen[self.inverse] | (self.cover.doc > self.first[self.inverse])
        return whole, mixed[self.inverse] & ~whole

    def suffixes(self, sorted_too: np.ndarray):
        """(place, doc) of the suffixes to be sorted, (name, bucket, first document) of the distinct ones, the inverse."""
        place, doc, name = self.cover.windows(sorted_too)
        index, first, inverse = _distinct(name, doc)
        return place, doc, name[index], _bucket(name[index], self.buckets), first, inverse


def _bits(answers, bucket: np.ndarray, width: int) -> np.ndarray:
    """The buckets' answers in the order in which the names were sent."""
    out = np.zeros((len(bucket), width), bool)
    found, first = _stretches(bucket)
    count = np.diff(np.r_[first, len(bucket)])
    place = dict(zip(found.tolist(), zip(first.tolist(), count.tolist(), strict=True), strict=True))
    for answer in answers if answers is not None else ():
        at, n = place[int(answer["bucket"])]
        out[at : at + n] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=n * width).reshape(n, width)
    return out


def _answered(group: pd.DataFrame, dtype) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """(the rows by batch, their names one after the other, where each row's names end); a stable order of the
    names is by batch too."""
    group = group.sort_values("batch")
    parts = [np.frombuffer(x, dtype) for x in group["payload"]]
    return group, np.concatenate(parts), np.cumsum([len(x) for x in parts])


def _reply(group: pd.DataFrame, bits: np.ndarray, ends: np.ndarray) -> pd.DataFrame:
    return pd.DataFrame({"batch": group["batch"].tolist(), "bucket": group["bucket"].tolist(), "bits": [np.packbits(x).tobytes() for x in np.split(bits, ends[:-1])]})


def _sort_names(group: pd.DataFrame) -> pd.DataFrame:
    group, names, ends = _answered(group, _NAME)
    key, more = (names["name"].astype(U) << U(32)) | names["around"], names["more"]
    order = _order(key)
    if (same := key[order][1:] == key[order][:-1]).any() and (same & (more[order][1:] != more[order][:-1])).any():
        order = np.lexsort((more, key))
    n, a, m = names["name"][order], names["around"][order], more[order]
    new_name = np.r_[True, n[1:] != n[:-1]]
    new = new_name | np.r_[True, (a[1:] != a[:-1]) | (m[1:] != m[:-1])]
    kinds = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_name))
    bits = np.zeros((len(names), 2), bool)
    bits[order, 0] = ~new
    bits[order, 1] = kinds[np.cumsum(new_name) - 1] > 1
    return _reply(group, bits, ends)


def _sort_suffixes(group: pd.DataFrame) -> pd.DataFrame:
    group, names, ends = _answered(group, "<u8")
    order = _order(names)
    bits = np.zeros((len(names), 1), bool)
    bits[order, 0] = np.r_[False, names[order][1:] == names[order][:-1]]
    return _reply(group, bits, ends)


def _runs(mask: np.ndarray) -> int:
    return int(np.count_nonzero(np.diff(np.r_[False, mask].astype(np.int8)) == 1))


def repeats(docs: DataFrame) -> DataFrame:
    """docs: doc_id, text; further columns are not read. Returns (doc_id, n_bytes, n_removed, n_spans,
    kept_sha256), a row for each doc_id. Null and short texts lose nothing; rows without doc_id are left out;
    of rows with the same doc_id one counts; no documents give no rows."""
    spark = docs.sparkSession
    width = shuffle_width(spark)
    packed = docs.select("doc_id", "text").where("doc_id IS NOT NULL").mapInPandas(_pack, "doc_id long, n long, packed binary")
    rows = packed.repartitionByRange(width, "doc_id").sortWithinPartitions("doc_id", "packed").mapInPandas(_gather, "batch long, ids array<long>, sizes array<long>, blob binary")
    # Kept in buckets by batch: the answers come to the batches, which don't move again.
    batches = stored_in_buckets(rows, "batches", width, "batch")
    size = batches.agg(F.sum(F.length("blob"))).first()[0] or 0
    buckets = max(width, int(size) >> 23)

    def send_names(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                yield _sent(row.batch, *_Sample(row, buckets).payload())

    def send_suffixes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                sample = _Sample(row, buckets)
                _, _, name, bucket, *_ = sample.suffixes(sample.settle(row.names)[1])
                yield _sent(row.batch, bucket, name.astype("<u8"))

    def finish(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for row in part.itertuples():
                sample = _Sample(row, buckets)
                whole, sorted_too = sample.settle(row.names)
                cover = sample.cover
                place, doc, _, bucket, first, inverse = sample.suffixes(sorted_too)
                again = place[_bits(row.suffixes, bucket, 1)[:, 0][inverse] | (doc > first[inverse])]
                masks = cover.removed(np.r_[cover.low[whole], again], np.r_[cover.high[whole], again])
                kept = [np.frombuffer(t, np.uint8)[~m].tobytes() for t, m in zip(cover.texts, masks, strict=True)]
                yield pd.DataFrame(
                    {
                        "doc_id": sample.ids,
                        "n_bytes": [len(t) for t in cover.texts],
                        "n_removed": [int(m.sum()) for m in masks],
                        "n_spans": [_runs(m) for m in masks],
                        "kept_sha256": [hashlib.sha256(t).hexdigest() for t in kept],
                    }
                )

    sent, replied = "batch long, bucket long, payload binary", "batch long, bucket long, bits binary"

    def answers(sender: DataFrame, label: str, sort) -> DataFrame:
        return stored(sender.groupBy("bucket").applyInPandas(sort, replied), label).groupBy("batch").agg(F.collect_list(F.struct("bucket", "bits")).alias(label))

    names = answers(batches.mapInPandas(send_names, sent), "names", _sort_names)
    known = batches.join(names.hint("shuffle_hash"), "batch", "left")
    suffix_bits = answers(known.mapInPandas(send_suffixes, sent), "suffixes", _sort_suffixes)
    both = known.join(suffix_bits.hint("shuffle_hash"), "batch", "left")
    return both.mapInPandas(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
