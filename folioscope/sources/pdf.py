"""PDF text and page images: by PyMuPDF where a worker has it, else by the standard library."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.sources import pdf_objects
from folioscope.sources.images import enlarged_file, sharpened_file
from folioscope.sources.ooxml import told


def _open(content: bytes):
    try:
        import fitz
    except ImportError:
        return None
    return fitz.open(stream=content, filetype="pdf")


def read(content: bytes) -> tuple[str, int]:
    """Text of the pages, joined by form feeds, and their number; ('', 0) of a file whose text cannot
    be read: whether its pages can be shown is another question, which rendered() answers."""
    try:
        return text_of_pages(content)
    except Exception:  # noqa: BLE001 - see above
        return "", 0


def text_of_pages(content: bytes) -> tuple[str, int]:
    document = _open(content)
    if document is not None:
        return "\f".join(p.get_text() for p in document), len(document)
    file = pdf_objects.File(content)
    pages = [pdf_objects.page_text(file, p) for p in file.pages()]
    return "\f".join(pages), len(pages)


def pdf_read(content: Column) -> Column:
    """(text, pages, error, seconds) of PDF files."""
    return told(read, content)


def rendered(content: bytes, dpi: int = 200, most: int = 2000, scale: int = 1) -> list[bytes]:
    """Images of the pages at dpi, enlarged `scale` times and then sharpened, no side longer than `most`
    pixels. Without a library that draws pages, the picture that each page of a scan is; other pages are an error."""
    document = _open(content)
    if document is None:
        file = pdf_objects.File(content)
        pictures = [pdf_objects.page_picture(file, p) for p in file.pages()]
        if not pictures or not all(pictures):
            raise RuntimeError("no library to render PDF pages with")
        return [enlarged_file(p, scale) for p in pictures] if scale > 1 else pictures
    import fitz

    out = []
    for p in document:
        zoom = min(dpi / 72.0 * scale, most / max(p.rect.width, p.rect.height))
        page = p.get_pixmap(matrix=fitz.Matrix(zoom, zoom), alpha=False).tobytes("png")
        out.append(sharpened_file(page) if scale > 1 else page)
    return out


def page_images(content: Column, dpi: int = 200, most: int = 2000) -> Column:
    """array of (page, png): pages rendered whatever text they have; none of unreadable files."""

    @F.pandas_udf("array<struct<page:int,png:binary>>")
    def render(contents: pd.Series) -> pd.Series:
        def one(x: bytes) -> list[dict]:
            try:
                return [{"page": i, "png": png} for i, png in enumerate(rendered(x, dpi, most), 1)]
            except Exception:  # noqa: BLE001 - no library, or an unreadable file
                return []

        return contents.map(one)

    return render(content)
