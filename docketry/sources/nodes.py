"""Nodes of HTML pages as rows, from a scanner with a stack of open tags."""

from __future__ import annotations

from bisect import bisect_right as bisect
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame

# Elements without an end tag, and elements whose text isn't part of the text around them.
VOID = "area base br col embed hr img input link meta param source track wbr".split()
SILENT = ("script", "style", "template")
#: A task gives its rows when it holds so many, or those of pages of so many characters.
HELD_ROWS, HELD_CHARS = 2000, 1_000_000
COLUMNS = "node int, parent int, last int, tag string, attributes map<string,string>, path array<string>, ancestors array<int>, text string, tight string, spaced string"
_NAMES = [x.split()[0] for x in COLUMNS.split(", ")]


class _Scanner(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.held: list[str] = []

    def _add(self, tag: str | None, attributes: dict, text: str | None) -> int:
        node = len(self.rows)
        self.rows.append([node, self.open[-1] if self.open else None, node, tag, attributes, [self.rows[i][3] for i in self.open], list(self.open), text, None, None])
        return node

    def _end_text(self) -> None:
        if self.held:
            text, self.held = "".join(self.held), []
            self._add(None, {}, text)

    def handle_starttag(self, tag, attrs):
        self._end_text()
        attributes: dict[str, str] = {}
        for name, value in attrs:
            attributes[name] = value or ""
        node = self._add(tag, attributes, None)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self._end_text()
        at = next((k for k in range(len(self.open) - 1, -1, -1) if self.rows[self.open[k]][3] == tag), None)
        if at is not None:
            for node in self.open[at:]:
                self.rows[node][2] = len(self.rows) - 1
            del self.open[at:]

    def handle_data(self, data):
        self.held.append(data)

    def handle_comment(self, data):
        self._end_text()

    handle_decl = handle_pi = unknown_decl = handle_comment


def scanned(html: str) -> list[list]:
    """Rows of COLUMNS, in the order of the page. An end tag closes all down to the nearest open element of its name,
    and nothing if there is none; what is open at the end lasts to the end."""
    scanner = _Scanner()
    scanner.feed(html)
    scanner.close()
    scanner._end_text()
    rows = scanner.rows
    for node in scanner.open:
        rows[node][2] = len(rows) - 1
    return rows


def _with_texts(rows: list[list], whole: frozenset[str]) -> list[list]:
    strings = [r for r in rows if r[3] is None]
    places = [r[0] for r in strings]
    # For each text the depth of the deepest silent element around it.
    silent = [max((k for k, tag in enumerate(r[5]) if tag in SILENT), default=-1) for r in strings]
    for row in rows:
        if row[3] in whole or row[3] is not None and "*" in whole:
            i, j = bisect(places, row[0]), bisect(places, row[2])
            depth = len(row[6]) + 1  # what lies above the element itself doesn't silence its text
            shown = [r[7] for r, deepest in zip(strings[i:j], silent[i:j], strict=True) if deepest < depth]
            bare = [x for x in map(str.strip, shown) if x]
            row[7], row[8], row[9] = "".join(shown), "".join(bare), " ".join(bare)
    return rows


def page_nodes(pages: DataFrame, key: str, html: str, whole: tuple[str, ...] = (), only: tuple[str, ...] = ()) -> DataFrame:
    """A row for each element and each text of a page: node (its number), parent, last (the last node inside it), tag
    (null for a text), attributes, path and ancestors (tags and numbers from the top) and text. Elements named in ``whole`` (all of them if it holds ``*``)
    have the text of all they hold, but for scripts and styles, as text; tight and spaced are its trimmed pieces, joined
    by nothing or by a space. Null and empty pages have no rows; comments have none. Where ``only`` is
    given, there are rows for the elements of these names and the texts right in them alone, numbered as all are."""
    shown, wanted, kind = frozenset(only), frozenset(whole), pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            held, keys, size = [], [], 0
            for own, text in zip(batch[key], batch[html], strict=True):
                rows = _with_texts(scanned(text), wanted) if isinstance(text, str) else []
                if shown:
                    rows = [r for r in rows if (r[3] or (r[5][-1] if r[5] else None)) in shown]
                held += rows
                keys += [own] * len(rows)
                size += len(text) if isinstance(text, str) else 0
                if len(held) > HELD_ROWS or size > HELD_CHARS:
                    if held:
                        yield _frame(key, keys, held)
                    held, keys, size = [], [], 0
            if held:
                yield _frame(key, keys, held)

    return pages.select(key, html).mapInPandas(run, f"{key} {kind}, {COLUMNS}")


def _frame(key: str, keys: list, rows: list[list]) -> pd.DataFrame:
    found = pd.DataFrame(rows, columns=_NAMES)
    found["parent"] = found["parent"].astype("Int32")
    found.insert(0, key, keys)
    return found
