"""DOCX and PPTX by the standard library: text, Markdown and metadata.

A file that cannot be read gives an empty text and no metadata.
"""

from __future__ import annotations

import io
import itertools
import re
import time
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
DRAWING = "{http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing}"
RELS = "{http://schemas.openxmlformats.org/package/2006/relationships}"
DC, DCT = "{http://purl.org/dc/elements/1.1/}", "{http://purl.org/dc/terms/}"
CP = "{http://schemas.openxmlformats.org/package/2006/metadata/core-properties}"
CORE = {"title": f"{DC}title", "author": f"{DC}creator", "created": f"{DCT}created", "modified": f"{DCT}modified", "subject": f"{DC}subject", "keywords": f"{CP}keywords"}


def run_text(element: ElementTree.Element, prefix: str) -> str:
    """Text of a paragraph: runs, tabs and breaks."""
    signs = {f"{prefix}tab": "\t", f"{prefix}br": "\n", f"{prefix}cr": "\n"}
    return "".join((x.text or "") if x.tag == f"{prefix}t" else signs.get(x.tag, "") for x in element.iter())


def table_lines(rows: list[list[str]]) -> list[str]:
    width = max(map(len, rows), default=0)
    lines = ["| " + " | ".join([*r, *[""] * (width - len(r))]) + " |" for r in rows]
    return [*lines[:1], "| " + " | ".join(["---"] * width) + " |", *lines[1:]] if lines else []


@dataclass
class Level:
    """A level of a list: how it counts (`bullet`, `decimal`, ...) and from where."""

    kind: str = "bullet"
    start: int = 1


def part(z: zipfile.ZipFile, name: str) -> ElementTree.Element | None:
    return ElementTree.fromstring(z.read(name)) if name in z.namelist() else None


def value(element: ElementTree.Element | None, path: str, default: str = "") -> str:
    found = element.find(path) if element is not None else None
    return default if found is None else found.get(f"{W}val", default)


class Numbering:
    """The lists of a Word file: concrete ones refer to abstract ones, whose levels they may begin elsewhere or replace.

    Counters belong to abstract lists, so that concrete lists of one go on where another ended,
    unless they say where they begin.
    """

    def __init__(self, numbering: ElementTree.Element | None, styles: ElementTree.Element | None) -> None:
        self.abstract: dict[str, dict[int, Level]] = {}
        self.concrete: dict[str, str] = {}
        self.own: dict[str, dict[int, Level | int]] = {}
        for a in numbering.findall(f"{W}abstractNum") if numbering is not None else ():
            self.abstract[a.get(f"{W}abstractNumId", "")] = {int(x.get(f"{W}ilvl", "0")): self.level(x) for x in a.findall(f"{W}lvl")}
        for n in numbering.findall(f"{W}num") if numbering is not None else ():
            name = n.get(f"{W}numId", "")
            self.concrete[name] = value(n, f"{W}abstractNumId")
            for o in n.findall(f"{W}lvlOverride"):
                replaced, begin = o.find(f"{W}lvl"), value(o, f"{W}startOverride")
                if replaced is not None or begin:
                    self.own.setdefault(name, {})[int(o.get(f"{W}ilvl", "0"))] = self.level(replaced) if replaced is not None else int(begin)
        # styles may carry a list, and take it from the style they are based on
        self.styles, self.based = {}, {}
        for s in styles.findall(f"{W}style") if styles is not None else ():
            name, number = s.get(f"{W}styleId", ""), s.find(f"{W}pPr/{W}numPr")
            self.based[name] = value(s, f"{W}basedOn")
            if number is not None:
                self.styles[name] = (value(number, f"{W}numId"), int(value(number, f"{W}ilvl", "0")))
        self.counts: dict[tuple[str, int], int] = {}
        self.begun: set[tuple[str, int]] = set()

    @staticmethod
    def level(x: ElementTree.Element) -> Level:
        return Level(value(x, f"{W}numFmt", "decimal"), int(value(x, f"{W}start", "1")))

    def of(self, paragraph: ElementTree.Element, style: str) -> tuple[str, int] | None:
        """(list, level) of a paragraph, by itself or by its style; list 0 takes a paragraph out."""
        number = paragraph.find(f"{W}pPr/{W}numPr")
        found, seen = None, set()
        while found is None and style and style not in seen:
            seen.add(style)
            found, style = self.styles.get(style), self.based.get(style, "")
        if number is not None:
            name = value(number, f"{W}numId") or (found[0] if found else "")
            found = (name, int(value(number, f"{W}ilvl") or (found[1] if found else 0)))
        return None if found is None or found[0] == "0" else found

    def mark(self, name: str, depth: int) -> str:
        """What stands before the next item of a list at a level; counts it, and begins deeper levels anew."""
        abstract, own = self.concrete.get(name, ""), self.own.get(name, {}).get(depth)
        level = own if isinstance(own, Level) else self.abstract.get(abstract, {}).get(depth, Level())
        key = (abstract or f"#{name}", depth)
        begin = own if isinstance(own, int) else level.start
        if isinstance(own, int) and (name, depth) not in self.begun:
            self.counts.pop(key, None)
        self.begun.add((name, depth))
        self.counts[key] = self.counts.get(key, begin - 1) + 1
        for deeper in [k for k in self.counts if k[0] == key[0] and k[1] > depth]:
            del self.counts[deeper]
        return "-" if level.kind in ("bullet", "none") else f"{self.counts[key]}."


def marked(text: str, sign: str) -> str:
    """A text between signs, blanks at its ends outside of them."""
    inner = text.strip()
    return text if not inner or not sign else text.replace(inner, f"{sign}{inner}{sign}", 1)


class Word:
    def __init__(self, content: bytes) -> None:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            self.body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{W}body")
            self.numbering, self.styles = part(z, "word/numbering.xml"), part(z, "word/styles.xml")
            relations = part(z, "word/_rels/document.xml.rels")
        self.targets = {r.get("Id"): r.get("Target", "") for r in relations.iter(f"{RELS}Relationship")} if relations is not None else {}

    def spans(self, element: ElementTree.Element) -> Iterator[tuple[str, str]]:
        """(text, sign) of the runs of a paragraph, links and pictures as Markdown; the sign says bold or italic."""
        for x in element:
            if x.tag == f"{W}r":
                on = lambda n, x=x: x.find(f"{W}rPr/{W}{n}") is not None and value(x, f"{W}rPr/{W}{n}", "1") not in ("0", "false", "off")
                sign = "**" * on("b") + "*" * on("i")
                yield run_text(x, W), sign
                for image in x.iter(f"{A}blip"):
                    label = next((d.get("descr") or d.get("name") or "" for d in x.iter(f"{DRAWING}docPr")), "")
                    yield f"![{label}]({self.targets.get(image.get(f'{R}embed'), '')})", ""
            elif x.tag == f"{W}hyperlink":
                text = "".join(marked(t, s) for t, s in self.joined(x))
                target = self.targets.get(x.get(f"{R}id"), "") or ("#" + x.get(f"{W}anchor") if x.get(f"{W}anchor") else "")
                yield f"[{text.strip()}]({target})" if text.strip() and target else text, ""
            elif x.tag in (f"{W}ins", f"{W}smartTag", f"{W}sdt", f"{W}sdtContent"):
                yield from self.spans(x)

    def joined(self, element: ElementTree.Element) -> Iterator[tuple[str, str]]:
        """spans() with neighbours of one sign as one."""
        for sign, run in itertools.groupby(self.spans(element), lambda x: x[1]):
            yield "".join(t for t, _ in run), sign

    def line(self, paragraph: ElementTree.Element, plain: bool = False) -> str:
        return "".join(t if plain else marked(t, s) for t, s in self.joined(paragraph)).strip()

    def cell(self, cell: ElementTree.Element) -> list[str]:
        return [run_text(p, W) for p in cell.findall(f"{W}p")]

    def tables(self) -> Iterator[list[list[list[str]]]]:
        for t in self.body.findall(f"{W}tbl"):
            yield [[self.cell(c) for c in row.findall(f"{W}tc")] for row in t.findall(f"{W}tr")]

    def text(self) -> str:
        out = [t for p in self.body.findall(f"{W}p") if (t := run_text(p, W).strip())]
        for table in self.tables():
            for row in table:
                cells = [t for c in row if (t := "\n".join(c).strip())]
                if cells:
                    out.append(" | ".join(cells))
        return "\n".join(out).strip()

    def markdown(self) -> str:
        """Headings by style; lists with their numbers and levels, bold and italic type, links and
        pictures; tables once more at the end."""
        numbering, out, in_list = Numbering(self.numbering, self.styles), [], False
        for p in self.body.iter(f"{W}p"):
            style = value(p, f"{W}pPr/{W}pStyle")
            level = re.fullmatch(r"[Hh]eading\s?([1-6])", style)
            text = self.line(p, plain=bool(level))
            if not text:
                continue
            item = None if level else numbering.of(p, style)
            if level:
                line = "#" * int(level[1]) + " " + text
            elif item:
                line = "   " * item[1] + f"{numbering.mark(*item)} {text}"
            else:
                line = f"- {text.removeprefix('•').strip()}" if style.startswith("List") else text
            # items of a list are lines of one block
            listed = bool(item) or (not level and style.startswith("List"))
            if listed and in_list:
                out[-1] += f"\n{line}"
            else:
                out.append(line)
            in_list = listed
        tables = ["\n".join(table_lines([[" ".join(t for x in c if (t := x.strip())) for c in row] for row in table])) for table in self.tables()]
        return "\n\n".join([*out, *tables]).strip()


class Slides:
    def __init__(self, content: bytes) -> None:
        self.zip = zipfile.ZipFile(io.BytesIO(content))
        show = ElementTree.fromstring(self.zip.read("ppt/presentation.xml"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(self.zip.read("ppt/_rels/presentation.xml.rels")).iter(f"{RELS}Relationship")}
        self.names = [f"ppt/{targets[s.get(f'{R}id')]}".replace("ppt//ppt/", "ppt/") for s in show.iter(f"{P}sldId")]

    def slides(self) -> Iterator[list[tuple[str, list[list[str]]]]]:
        """For each slide its shapes as (text, table rows)."""
        for name in self.names:
            shapes = []
            tree = ElementTree.fromstring(self.zip.read(name)).find(f"{P}cSld/{P}spTree")
            for shape in tree:
                body = shape.find(f"{P}txBody")
                table = shape.find(f".//{A}tbl")
                if body is not None:
                    shapes.append(("\n".join(run_text(p, A) for p in body.findall(f"{A}p")).strip(), []))
                elif table is not None:
                    rows = [[" ".join(t for p in c.iter(f"{A}p") if (t := run_text(p, A).strip())) for c in r.findall(f"{A}tc")] for r in table.findall(f"{A}tr")]
                    shapes.append(("", rows))
            yield shapes

    def text(self) -> str:
        parts = ["\n".join([f"Слайд {i}", *[t for t, _ in shapes if t]]) for i, shapes in enumerate(self.slides(), 1)]
        return "\n\n".join(parts).strip()

    def markdown(self) -> list[dict]:
        """Shapes in order, for the heading and noise rules to be applied as expressions."""
        return [{"texts": [t for t, rows in shapes if t and not rows], "tables": ["\n".join(table_lines(rows)) for _, rows in shapes if rows]} for shapes in self.slides()]


def core(content: bytes) -> dict[str, str]:
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        properties = ElementTree.fromstring(z.read("docProps/core.xml"))
        found = {k: (properties.findtext(tag) or "").strip() for k, tag in CORE.items()}
        kind = "pptx" if "ppt/presentation.xml" in z.namelist() else "docx"
    if kind == "pptx":
        found.pop("keywords")
        found["slide_count"] = str(len(Slides(content).names))
    return {k: v for k, v in found.items() if v}


def _applied(content: Column, read: Callable[[bytes], object], kind: str, default: object) -> Column:
    """read(content), `default` for what cannot be read."""

    @F.pandas_udf(kind)
    def apply(contents: pd.Series) -> pd.Series:
        def one(x: bytes) -> object:
            try:
                return read(x)
            except Exception:  # noqa: BLE001 - unreadable files give nothing
                return default

        return contents.map(one)

    return apply(content)


def told(read: Callable[[bytes], tuple[str, int]], content: Column) -> Column:
    """(text, pages, error, seconds): what read(content) gives, or why it fails."""

    @F.pandas_udf("struct<text:string,pages:int,error:string,seconds:double>")
    def apply(contents: pd.Series) -> pd.DataFrame:
        def one(x: bytes) -> tuple:
            began = time.perf_counter()
            try:
                found = (*read(x), None)
            except Exception as e:  # noqa: BLE001 - a file that cannot be read is a row with its error
                found = ("", 0, f"{type(e).__name__}: {e}"[:1000])
            return (*found, round(time.perf_counter() - began, 3))

        return pd.DataFrame([one(x) for x in contents], columns=["text", "pages", "error", "seconds"])

    return apply(content)


def docx_read(content: Column) -> Column:
    return told(lambda x: (Word(x).text(), 1), content)


def pptx_read(content: Column) -> Column:
    return told(lambda x: (Slides(x).text(), 1), content)


def docx_text(content: Column) -> Column:
    return _applied(content, lambda x: Word(x).text(), "string", "")


def docx_markdown(content: Column) -> Column:
    return _applied(content, lambda x: Word(x).markdown(), "string", "")


def pptx_text(content: Column) -> Column:
    return _applied(content, lambda x: Slides(x).text(), "string", "")


def pptx_slides(content: Column) -> Column:
    """array of (texts, tables), one for each slide."""
    return _applied(content, lambda x: Slides(x).markdown(), "array<struct<texts:array<string>,tables:array<string>>>", [])


def pptx_markdown(slides: Column) -> Column:
    """Slides from pptx_slides as Markdown: marks, headings, tables after the text, no noise."""
    from folioscope.functions.text import PPTX_NOISE, slide_heading, strip, without_noise

    noise = "|".join(PPTX_NOISE)

    def shaped(s: Column, i: Column) -> Column:
        texts = F.transform(F.filter(s["texts"], lambda t: ~strip(t).rlike(f"(?iU){noise}")), lambda t: F.coalesce(slide_heading(t), t))
        parts = F.filter(F.array(F.array_join(texts, "\n"), F.array_join(s["tables"], "\n")), lambda p: p != "")
        return F.concat(F.lit("<!-- slide "), (i + 1).cast("string"), F.lit(" -->\n"), F.array_join(parts, "\n\n"))

    return without_noise(F.array_join(F.transform(slides, shaped), "\n\n"), PPTX_NOISE)


def metadata(content: Column) -> Column:
    """map of title, author, created, modified, subject, and keywords or slide_count."""
    return _applied(content, lambda x: list(core(x).items()), "array<struct<key:string,value:string>>", [])
