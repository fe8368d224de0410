"""DOCX files of document blocks. Standard library only."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
from pyspark.sql import DataFrame

from folioscope.sinks.drawings import LINK, MEDIA, picture_size, region_size, suffix_of

W = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
A, PIC = "http://schemas.openxmlformats.org/drawingml/2006/main", "http://schemas.openxmlformats.org/drawingml/2006/picture"
WP, R = "http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
#: Type sizes in half points, widths in twentieths of a point.
BODY, HEADING, TABLE = 24, 28, 9638
#: pictures' dots an inch, and their most in cm.
DPI, MOST = 150.0, (17.0, 24.0)


def paragraph(text: str, style: str = "", bold: bool = False, size: int = BODY, extra: str = "") -> str:
    kind = f'<w:pStyle w:val="{style}"/>' if style else ""
    lines = '</w:t><w:br/><w:t xml:space="preserve">'.join(escape(x) for x in text.split("\n"))
    run = f'<w:rPr><w:rFonts w:ascii="Times New Roman" w:hAnsi="Times New Roman" w:cs="Times New Roman"/>{"<w:b/>" * bold}<w:sz w:val="{size}"/></w:rPr>'
    return f'<w:p><w:pPr>{kind}{extra}</w:pPr><w:r>{run}<w:t xml:space="preserve">{lines}</w:t></w:r></w:p>'


def picture(number: int, path: str, content: bytes, region: Sequence[float] | None = None) -> str:
    """A picture in the line, as large as its region says, else at its own size or as large as a page takes."""
    wide, high = picture_size(content)
    w, h = (v * 2.54 for v in region_size(wide, high, region) or (wide / DPI, high / DPI))
    scale = min(MOST[0] / w, MOST[1] / h, 1.0) if not region_size(wide, high, region) else 1.0
    size = " ".join(f'{k}="{round(v * scale * 360_000)}"' for k, v in (("cx", w), ("cy", h)))
    name = quoteattr(path.rpartition("/")[2])
    box = f'<pic:spPr><a:xfrm><a:off x="0" y="0"/><a:ext {size}/></a:xfrm><a:prstGeom prst="rect"><a:avLst/></a:prstGeom></pic:spPr>'
    shown = f'<pic:pic xmlns:pic="{PIC}"><pic:nvPicPr><pic:cNvPr id="{number}" name={name}/><pic:cNvPicPr/></pic:nvPicPr><pic:blipFill><a:blip xmlns:r="{R}" r:embed="rIdP{number}"/><a:stretch><a:fillRect/></a:stretch></pic:blipFill>{box}</pic:pic>'
    return f'<w:r><w:drawing><wp:inline xmlns:wp="{WP}"><wp:extent {size}/><wp:docPr id="{number}" name={name}/><a:graphic xmlns:a="{A}"><a:graphicData uri="{PIC}">{shown}</a:graphicData></a:graphic></wp:inline></w:drawing></w:r>'


def run(text: str, italic: bool = False) -> str:
    lines = '</w:t><w:br/><w:t xml:space="preserve">'.join(escape(x) for x in text.split("\n"))
    return f'<w:r><w:rPr><w:rFonts w:ascii="Times New Roman" w:hAnsi="Times New Roman" w:cs="Times New Roman"/>{"<w:i/>" * italic}<w:sz w:val="{BODY}"/></w:rPr><w:t xml:space="preserve">{lines}</w:t></w:r>' if text else ""


def linked(text: str, pictures: dict[str, bytes], media: list[tuple[str, bytes]], regions: Mapping[str, Sequence[float]] | None = None) -> str:
    """A paragraph with links to pictures: those known are put in, others told by their name;
    handwriting is in italics. Pictures by themselves are centred."""
    out, at, plain = [], 0, False
    for m in LINK.finditer(text):
        path, note = m[2] or m[4], m[3]
        out.append(run(text[at : m.start()]))
        plain |= bool(text[at : m.start()].strip()) or note is not None
        content = pictures.get(path)
        if content and suffix_of(path) in MEDIA and all(picture_size(content)):
            media.append((path, content))
            out.append(picture(len(media), path, content, (regions or {}).get(path.rpartition("/")[2])))
        elif m[1]:
            out.append(run(f"[{m[1]}]"))
        out.append(run(note or "", True))
        at = m.end()
    out.append(run(text[at:]))
    plain |= bool(text[at:].strip())
    return f'<w:p><w:pPr>{"" if plain else '<w:jc w:val="center"/>'}</w:pPr>{"".join(out)}</w:p>'


def table(rows: list[list[str]]) -> str:
    columns = max(map(len, rows), default=0)
    weights = [max(4, min(48, max((len(r[c]) for r in rows if c < len(r)), default=0))) for c in range(columns)]
    widths = [TABLE * w // sum(weights) for w in weights]
    grid = "".join(f'<w:gridCol w:w="{w}"/>' for w in widths)
    cells = lambda r, head: "".join(f'<w:tc><w:tcPr><w:tcW w:w="{w}" w:type="dxa"/></w:tcPr>{paragraph(r[c] if c < len(r) else "", bold=head)}</w:tc>' for c, w in enumerate(widths))
    body = "".join(f"<w:tr>{cells(r, k == 0)}</w:tr>" for k, r in enumerate(rows))
    edges = "".join(f'<w:{e} w:val="single" w:sz="4"/>' for e in ("top", "left", "bottom", "right", "insideH", "insideV"))
    return f"<w:tbl><w:tblPr><w:tblBorders>{edges}</w:tblBorders></w:tblPr><w:tblGrid>{grid}</w:tblGrid>{body}</w:tbl>"


def package(blocks: list[dict], pictures: dict[str, bytes] | None = None, regions: Mapping[str, Sequence[float]] | None = None) -> bytes:
    """A .docx file with blocks (kind, level, text, rows, items) in order, pictures taken by their paths,
    their regions by file name."""
    out: list[str] = []
    media: list[tuple[str, bytes]] = []
    for b in blocks:
        match b["kind"]:
            case "page_break":
                if out:
                    out.append('<w:p><w:r><w:br w:type="page"/></w:r></w:p>')
            case "heading":
                out.append(paragraph(b["text"], f"Heading{min(max(int(b['level']), 1), 6)}", True, HEADING))
            case "list":
                out += [paragraph(f"• {item}", "ListBullet", extra='<w:ind w:left="360" w:hanging="260"/>') for item in b["items"]]
            case "table":
                out.append(table([list(r) for r in b["rows"]]))
            case "paragraph":
                out.append(linked(b["text"], pictures or {}, media, regions) if LINK.search(b["text"]) else paragraph(b["text"]))
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    styles = "".join(f'<w:style w:type="paragraph" w:styleId="Heading{i}"><w:name w:val="heading {i}"/></w:style>' for i in range(1, 7)) + '<w:style w:type="paragraph" w:styleId="ListBullet"><w:name w:val="List Bullet"/></w:style>'
    kind = "application/vnd.openxmlformats-officedocument.wordprocessingml"
    relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    files = {
        "[Content_Types].xml": f'{head}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>{"".join(f'<Default Extension="{x}" ContentType="{MEDIA[x][1]}"/>' for x in sorted({suffix_of(p) for p, _ in media}))}<Override PartName="/word/document.xml" ContentType="{kind}.document.main+xml"/><Override PartName="/word/styles.xml" ContentType="{kind}.styles+xml"/></Types>',
        "_rels/.rels": f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{relation}/officeDocument" Target="word/document.xml"/></Relationships>',
        "word/_rels/document.xml.rels": f'{head}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{relation}/styles" Target="styles.xml"/>{"".join(f'<Relationship Id="rIdP{k}" Type="{relation}/image" Target="media/image{k}.{suffix_of(p)}"/>' for k, (p, _) in enumerate(media, 1))}</Relationships>',
        "word/styles.xml": f'{head}<w:styles xmlns:w="{W}">{styles}</w:styles>',
        "word/document.xml": f'{head}<w:document xmlns:w="{W}"><w:body>{"".join(out)}<w:sectPr/></w:body></w:document>',
    }
    files |= {f"word/media/image{k}.{suffix_of(p)}": c for k, (p, c) in enumerate(media, 1)}
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as z:
        for name, content in files.items():
            z.writestr(zipfile.ZipInfo(name), content)
    return blob.getvalue()


def written(documents: DataFrame, key: str = "file") -> DataFrame:
    """(key, content): a .docx file for each row of (key, blocks)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "content": [package(list(b)) for b in f["blocks"]]})

    return documents.select(key, "blocks").mapInPandas(run, f"`{key}` {documents.schema[key].dataType.simpleString()}, content binary")
