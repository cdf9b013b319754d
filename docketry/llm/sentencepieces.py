"""SentencePiece encoding and decoding of byte-pair models by vectorised merge rounds.

A text is cut where no piece can lie: before each run of word marks, and between two characters that no piece
holds side by side. The distinct segments of a batch are one flat array of symbols. In a round each segment finds
the best rank among its neighbouring pairs (a segmented minimum), all pairs of that rank merge at once from the
left, and the array is compacted; segments without a pair leave it. Where a merge makes a pair that comes before
pairs of the round that still wait (runs of word marks, whose pieces all have one score), the segment is merged one
pair at a time from a heap. Characters without a piece become byte pieces.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

MARK = "▁"
CACHED, CACHED_CHARS, SLICE = 400_000, 48, 1 << 21
_NONE = np.iinfo(np.int64).max
_SEGMENT_START = re.compile(f"(?<!{MARK}){MARK}")

codecs.register_error("docketry.each_byte", lambda e: ("�", e.start + 1))


class Model:
    """The pieces of a model and the table of pairs that merge. Models must be byte-pair models that keep text
    as it is but for a leading word mark, and have neither unused nor user-defined pieces."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        own = SentencePieceProcessor(model_file=path)
        n, self.begin, self.end = own.get_piece_size(), own.bos_id(), own.eos_id()
        kept = [own.normalize(x) == (MARK + x.replace(" ", MARK) if x else "") for x in ("", " ﬁ  Ａ ", "a\tb\r\n")]
        plain = [i for i in range(n) if not (own.is_byte(i) or own.is_control(i) or own.is_unknown(i))]
        names = {i: own.id_to_piece(i) for i in plain}
        if not all(kept) or any(own.is_unused(i) for i in plain) or any(MARK in x.lstrip(MARK) for x in names.values()):
            raise ValueError("only byte-pair models without normalisation, and with word marks at the start of pieces, are read")
        self.byte = np.zeros(256, np.uint32)
        self.control, self.surface = np.zeros(n, bool), []
        for i in range(n):
            self.control[i] = own.is_control(i)
            if own.is_byte(i):
                value = int(own.id_to_piece(i)[3:5], 16)
                self.byte[value] = i
                self.surface.append(bytes([value]))
            elif own.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.surface.append(b"" if self.control[i] else names[i].replace(MARK, " ").encode())
        self.marked = np.zeros(n, bool)
        self.marked[[i for i, x in names.items() if x.startswith(MARK)]] = True
        self.n = n
        # Single characters that pieces hold are symbols too, those without a piece of their own from n on.
        symbol = {x: i for i, x in names.items()}
        for c in sorted({c for x in names.values() for c in x} - symbol.keys()):
            symbol[c] = len(symbol) + n
        self.width = max(symbol.values()) + 2
        self.of_char = np.full(0x110000, -1, np.int64)
        for x, i in symbol.items():
            if len(x) == 1:
                self.of_char[ord(x)] = i
        order = {s: k for k, s in enumerate(sorted({own.get_score(i) for i in plain}, reverse=True))}
        table, touching = [], set()
        for i, x in names.items():
            rank = order[own.get_score(i)]
            for k in range(1, len(x)):
                touching.add(symbol[x[k - 1]] * self.width + symbol[x[k]])
                if x[:k] in symbol and x[k:] in symbol:
                    table.append((symbol[x[:k]] * self.width + symbol[x[k:]], rank, i))
        self.keys, self.ranks, self.made = np.array(sorted(table), np.int64).reshape(-1, 3).T.copy()
        self.touching = np.array(sorted(touching), np.int64)
        # Characters that no longer piece holds stand alone.
        joined = "".join(map(re.escape, sorted({c for x in names.values() if len(x) > 1 for c in x} - {MARK})))
        self.segments = re.compile(f"{MARK}*[{joined}]+|{MARK}+|[^{joined}{MARK}]+").findall
        self.pairs = {key: (rank, i) for key, rank, i in table}
        self.known: dict[str, bytes] = {}

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rank of each pair, ``_NONE`` where it doesn't merge, and its place in the table."""
        key = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE), at

    def _one_by_one(self, symbols: list[int]) -> list[tuple[int, int]]:
        """(place of its first symbol, symbol) of what is left when the best pair, the leftmost of equals, merges
        again and again."""
        after, before, alive = [*range(1, len(symbols)), -1], [*range(-1, len(symbols) - 1)], [True] * len(symbols)
        heap = []
        for i, (left, right) in enumerate(zip(symbols, symbols[1:], strict=False)):
            if (key := left * self.width + right) in self.pairs:
                rank, made = self.pairs[key]
                heap.append((rank, i, left, right, made))
        heapq.heapify(heap)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j < 0 or symbols[i] != left or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = made, False, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0:
                    key = symbols[a] * self.width + symbols[b]
                    if key in self.pairs:
                        rank, made = self.pairs[key]
                        heapq.heappush(heap, (rank, a, symbols[a], symbols[b], made))
        return [(i, s) for i, s in enumerate(symbols) if alive[i]]

    def _merged(self, segments: list[str]) -> list[bytes]:
        """The ids of each segment, packed. Segments aren't empty."""
        chars = np.frombuffer("".join(segments).encode("utf-32-le"), "<u4").astype(np.int64)
        bounds = np.cumsum([0, *map(len, segments)])
        symbol, start = self.of_char[chars], np.arange(len(chars))
        key = symbol[:-1] * self.width + symbol[1:]
        cut = self.touching[np.minimum(np.searchsorted(self.touching, key), len(self.touching) - 1)] != key
        first = np.concatenate([[True], cut])
        first[bounds[:-1]] = True
        group = np.cumsum(first) - 1
        rank, at = np.full(len(chars), _NONE), np.zeros(len(chars), np.int64)
        rank[:-1], at[:-1] = self._pairs(symbol[:-1], symbol[1:])
        rank[:-1][first[1:]] = _NONE
        done_start, done_symbol = [], []
        while len(symbol):
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
            sizes = np.diff(np.append(edges, len(symbol)))
            best = np.repeat(np.minimum.reduceat(rank, edges), sizes)
            going = best != _NONE
            done_start.append(start[~going])
            done_symbol.append(symbol[~going])
            symbol, start, group, rank, at, best = (x[going] for x in (symbol, start, group, rank, at, best))
            if not len(symbol):
                break
            hits = np.flatnonzero(rank == best)
            # Of hits that overlap in a row, every other one from the left merges.
            fresh = np.concatenate([[True], np.diff(hits) > 1])
            place = np.arange(len(hits))
            taken = hits[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            old = symbol
            symbol = symbol.copy()
            symbol[taken] = self.made[at[taken]]
            stays = np.ones(len(symbol), bool)
            stays[taken + 1] = False
            new_at = np.cumsum(stays) - 1
            slim = {"symbol": symbol[stays], "start": start[stays], "group": group[stays], "rank": rank[stays], "at": at[stays], "best": best[stays]}
            touched = np.zeros(len(slim["group"]) + 1, bool)
            touched[new_at[taken]] = touched[new_at[taken] - 1] = True
            changed = np.flatnonzero(touched[:-1])
            slim["rank"][changed] = _NONE
            inner = changed[changed + 1 < len(slim["group"])]
            inner = inner[slim["group"][inner] == slim["group"][inner + 1]]
            slim["rank"][inner], slim["at"][inner] = self._pairs(slim["symbol"][inner], slim["symbol"][inner + 1])
            early = slim["group"][inner[slim["rank"][inner] <= slim["best"][inner]]]
            if len(early):
                # A new pair comes before hits that wait, if its segment had more than one.
                early, of_hits = np.unique(early), group[hits]
                n_hits = np.searchsorted(of_hits, early, "right") - np.searchsorted(of_hits, early)
                for g in early[n_hits > 1].tolist():
                    low, high = np.searchsorted(group, [g, g + 1])
                    left = self._one_by_one(old[low:high].tolist())
                    done_start.append(start[low + np.array([i for i, _ in left])])
                    done_symbol.append(np.array([s for _, s in left]))
                    keep = slim["group"] != g
                    slim = {k: x[keep] for k, x in slim.items()}
            symbol, start, group, rank, at = (slim[k] for k in ("symbol", "start", "group", "rank", "at"))
        start, symbol = np.concatenate(done_start), np.concatenate(done_symbol)
        order = np.argsort(start)
        start, symbol = start[order], symbol[order]
        # Characters without a piece are spelt in bytes.
        bare = (symbol < 0) | (symbol >= self.n)
        code = chars[start]
        size = np.where(bare, 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000), 1)
        ends = np.cumsum(size)
        ids = np.repeat(symbol, size).astype("<u4")
        for i in np.flatnonzero(bare).tolist():
            ids[ends[i] - size[i] : ends[i]] = self.byte[list(chr(code[i]).encode())]
        edges = 4 * np.concatenate([[0], ends])[np.searchsorted(start, bounds)]
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text with begin and end ids, as little-endian unsigned 32-bit numbers."""
        out = []
        begin, end = np.array([self.begin], "<u4").tobytes(), np.array([self.end], "<u4").tobytes()
        for part in _slices(texts):
            marked = [(MARK + x.replace(" ", MARK)) if x else "" for x in part]
            done: list[list[bytes]] = [[] for _ in part]
            for k, text in enumerate(marked) if len(part) == 1 else [(-1, "")]:
                for window in _windows(text):
                    done[k].append(b"".join(self._looked_up([self.segments(window)])[0]))
            if len(part) > 1:
                done = self._looked_up(list(map(self.segments, marked)))
            out += [b"".join([begin, *x, end]) for x in done]
        return out

    def _looked_up(self, cut: list[list[str]]) -> list[list[bytes]]:
        fresh = list(set().union(*cut) - self.known.keys())
        if len(self.known) + len(fresh) > CACHED:
            self.known = {}
            fresh = list(set().union(*cut))
        if fresh:
            self.known.update(zip(fresh, self._merged(fresh), strict=True))
        found = [list(map(self.known.__getitem__, c)) for c in cut]
        for x in fresh:
            if len(x) > CACHED_CHARS:
                del self.known[x]
        return found

    def decode(self, packed: bytes) -> str:
        """The text of packed ids: control pieces are silent, the first word mark goes, bytes that are no
        UTF-8 become one replacement character each."""
        ids = np.frombuffer(packed, "<u4")
        if len(ids) and int(ids.max()) >= self.n:
            raise ValueError("an id lies outside the model")
        # Bytes on two sides of a control piece are no one character.
        parts, edges = [], np.flatnonzero(np.concatenate([[True], self.control[ids], [True]]))
        for low, high in zip(edges[:-1], edges[1:] - 1, strict=True):
            if low < high:
                plain = b"".join(map(self.surface.__getitem__, ids[low:high].tolist()))
                parts.append((plain[1:] if not parts and self.marked[ids[low]] else plain).decode("utf-8", "docketry.each_byte"))
        return "".join(parts)


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """Texts in runs of at most SLICE characters; a longer one stands alone."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > SLICE:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


def _windows(text: str) -> Iterator[str]:
    """Parts of a text that end where a segment ends."""
    at = 0
    while len(text) - at > SLICE and (found := _SEGMENT_START.search(text, at + SLICE)):
        yield text[at : found.start()]
        at = found.start()
    yield text[at:]


@functools.cache
def model(path: str) -> Model:
    return Model(path)


def _at(path: str | Callable[[], str]) -> Model:
    return model(path() if callable(path) else path)


def round_trip(docs: DataFrame, path: str | Callable[[], str]) -> DataFrame:
    """docs: doc_id, text; further columns are not read. Returns (doc_id, ids, decoded), a row for each row: ids
    is a binary of little-endian unsigned 32-bit ids with begin and end, decoded their text. A null text is empty,
    an empty text has the two ids alone. path may be a function, which tells each executor its own path."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _at(path)
        for batch in batches:
            keys, at = batch["doc_id"], 0
            for part in _slices([x if isinstance(x, str) else "" for x in batch["text"]]):
                ids = own.encode(part)
                yield pd.DataFrame({"doc_id": keys.iloc[at : at + len(part)].array, "ids": ids, "decoded": [own.decode(x) for x in ids]})
                at += len(part)

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids binary, decoded string")


def decoded(rows: DataFrame, path: str | Callable[[], str]) -> DataFrame:
    """rows: doc_id, ids as ``round_trip`` gives them. Returns (doc_id, text); null ids give a null text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = _at(path)
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": [None if x is None else own.decode(bytes(x)) for x in batch["ids"]]})

    return rows.select("doc_id", "ids").mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
