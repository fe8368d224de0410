"""Text of HTML pages, as a chain of rules over a page's events inside an Arrow-batched function.

Python's parser turns a page into rows of (kind, name, value): tags that open and close,
text, and lines that are done. Each rule is a generator with one state of its own. It
takes the events it is about out of the stream, puts finished lines in, and lets all
others pass; the order of the rules says which of them a text reaches first.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from itertools import zip_longest

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements whose content is left out, and those that end a line.
SILENT = {"script", "style", "noscript", "iframe", "svg", "button", "input", "select", "textarea", "option", "label", "form", "nav", "aside", "header", "footer"}
BREAKING = {"p", "div", "li", "blockquote", "title", "caption", "pre", "section", "article", "figure", "figcaption", "td", "th", "tr", "tbody", "thead", "tfoot"}
LEVELS = {"h1": 1, "h2": 2, "h3": 3, "h4": 4, "h5": 5, "h6": 6}
OPEN, CLOSE, TEXT, DONE, END = "open", "close", "text", "done", "end"
Events = Iterator[tuple[str, str, object]]


class Reader(HTMLParser):
    """A page as a list of events."""

    def __init__(self, page: str) -> None:
        super().__init__(convert_charrefs=True)
        self.events: list[tuple[str, str, object]] = []
        self.handle_starttag = lambda tag, attrs: self.events.append((OPEN, tag, attrs))
        self.handle_endtag = lambda tag: self.events.append((CLOSE, tag, None))
        self.handle_data = lambda data: self.events.append((TEXT, "", data))
        self.feed(page)
        # what the parser holds back for want of an end is no longer read by headings
        self.events.append((END, "", None))
        self.close()


def heard(events: Iterable) -> Events:
    """Without the text and pictures of silent elements. An element that is never closed
    silences the rest."""
    depth = 0
    for kind, name, value in events:
        if name in SILENT:
            depth = depth + 1 if kind == OPEN else max(0, depth - 1)
        if depth and (kind == TEXT or name == "img"):
            continue
        if kind != TEXT or value.strip():
            yield kind, name, value


def pictured(events: Events) -> Events:
    """Pictures with a source become lines."""
    for kind, name, value in events:
        if kind == OPEN and name == "img":
            given = {k: (v or "").strip() for k, v in value}
            if given.get("src"):
                yield DONE, "", f"\n![{given.get('alt', '')}]({given['src']})\n"
        else:
            yield kind, name, value


def titled(events: Events) -> Events:
    """Headings become lines. An empty one stays open and takes in the text that follows, up
    to the next heading; that quirk is part of the contract."""
    level, parts = 0, []
    for kind, name, value in events:
        if level and kind == TEXT:
            parts.append(value.rstrip())
            continue
        if parts and (kind == END or name in LEVELS):
            yield DONE, "", f"\n{'#' * level} {' '.join(parts).strip()}\n"
            level, parts = 0, []
        if kind == OPEN and name in LEVELS:
            level = LEVELS[name]
        yield kind, name, value


def gridded(events: Events) -> Events:
    """Outermost tables become Markdown when they are closed; what is inside a table within
    a table belongs to the cell around it. Cells and rows without text are left out."""
    depth, rows = 0, []
    for kind, name, value in events:
        if name == "table":
            depth += 1 if kind == OPEN else -1 if depth else 0
            if depth == 0 and rows:
                yield DONE, "", grid(rows)
            if depth == 0 or not rows:
                rows = [[[]]] if depth else []
        elif depth == 1 and name == "tr":
            rows.append([[]])
        elif depth == 1 and name in ("td", "th"):
            rows[-1].append([])
        elif depth and kind == TEXT:
            rows[-1][-1].append(value)
            continue
        yield kind, name, value


def grid(rows: list[list[list[str]]]) -> str:
    """A Markdown table of rows of cells of texts, padded to the longest row."""
    cells = [[" ".join(texts).strip() for texts in row if texts] for row in rows]
    columns = list(zip_longest(*filter(None, cells), fillvalue=""))
    if not columns:
        return ""
    head, *body = zip(*columns, strict=True)
    return "".join(f"| {' | '.join(row)} |\n" for row in (head, ["---"] * len(columns), *body))


def spelled(events: Events) -> Iterator[str]:
    """Lines and texts, and the line ends of breaking elements."""
    for kind, name, value in events:
        if kind == DONE:
            yield value
        elif kind == TEXT:
            yield value.strip()
        elif name in BREAKING or (kind, name) == (OPEN, "br"):
            yield "\n"


def only(page: str, references: tuple[str, ...]) -> str:
    """The page with every ampersand escaped that begins none of these references, closed by a semicolon."""
    return re.sub(rf"&(?!(?:{'|'.join(references)});)", "&amp;", page)


def page_text(page: str | None, references: tuple[str, ...] | None = None) -> str:
    """Non-blank lines of a page's text, a blank line between each two. All character references
    are read as browsers do, `&amp` at a cut too, or only the named ones, where a semicolon closes them."""
    page = page or ""
    text = "".join(spelled(gridded(titled(pictured(heard(Reader(page if references is None else only(page, references)).events))))))
    return "\n\n".join(filter(None, map(str.strip, text.splitlines())))


def text_of(page: Column, references: tuple[str, ...] | None = None) -> Column:
    @F.pandas_udf("string")
    def extract(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: page_text(p, references))

    return extract(page)
