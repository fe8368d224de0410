"""PDF files of document blocks by the standard library.

Western letters use the fonts that every reader has. Others, such as Cyrillic ones, are dealt
to further fonts of up to 224 letters each, which name their letters by code point and say
what they mean, so a reader shows them with a font of its own and copies them rightly; no
font is embedded.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator, Mapping, Sequence
from contextlib import suppress

import pandas as pd
from pyspark.sql import DataFrame

from folioscope.sinks.drawings import A4, LINE, Shape, laid_out, picture_size
from folioscope.sinks.fonts import Font
from folioscope.sources.images import channels_of

FIRST, CODES = 32, 224


def western(c: str) -> bool:
    try:
        c.encode("cp1252")
    except UnicodeEncodeError:
        return False
    return True


def further_letters(pages: list[list[Shape]]) -> dict[str, tuple[int, int]]:
    """(font, code) of each letter that the usual fonts lack."""
    letters = sorted({c for p in pages for s in p for c in s.text if c != "\n" and not western(c) and c <= "\uffff"})
    return {c: (i // CODES, FIRST + i % CODES) for i, c in enumerate(letters)}


def shown(line: str, style: str, size: float, letters: dict[str, tuple[int, int]]) -> str:
    """Operators that show a line: a string for each run of letters of one font."""

    def escaped(codes: bytes) -> str:
        return "(" + "".join(f"\\{c:03o}" if c in b"()\\" or not 32 <= c < 127 else chr(c) for c in codes) + ")"

    out = []
    for font, run in itertools.groupby(line, lambda c: letters[c][0] if c in letters else -1):
        text = "".join(run)
        codes = text.encode("cp1252", "replace") if font < 0 else bytes(letters[c][1] for c in text)
        out.append(f"/{style if font < 0 else f'X{font}'} {size:.2f} Tf {escaped(codes)} Tj")
    return " ".join(out)


def content(shapes: list[Shape], letters: dict[str, tuple[int, int]], images: dict[bytes, int]) -> bytes:
    """Drawing operators of a page: filled cells with outlines and their lines of text, and pictures."""
    out = []
    for s in shapes:
        box = " ".join(f"{72 * v:.2f}" for v in (s.left, s.bottom, s.width, s.height))
        if s.fill:
            red, green, blue = (int(s.fill[i : i + 2], 16) / 255 for i in (1, 3, 5))
            out.append(f"{red:.3f} {green:.3f} {blue:.3f} rg 0 G {box} re B 0 g")
        if s.picture:
            out.append(f"q {72 * s.width:.2f} 0 0 {72 * s.height:.2f} {72 * s.left:.2f} {72 * s.bottom:.2f} cm /I{images[s.picture]} Do Q")
            continue
        size = s.size * 72
        y = 72 * (s.bottom + s.height) - size * 1.05
        for line in s.text.split("\n"):
            out.append(f"BT {72 * s.left + 3:.2f} {y:.2f} Td {shown(line, 'B' if s.bold else 'R', size, letters)} ET")
            y -= size * LINE
    return "\n".join(out).encode("ascii")


def stream(body: bytes) -> bytes:
    packed = zlib.compress(body)
    return f"<< /Length {len(packed)} /Filter /FlateDecode >>\nstream\n".encode() + packed + b"\nendstream"


def picture_object(picture: bytes) -> tuple[str, bytes, bytes]:
    """(entries, data, data of the mask) of a picture as a PDF file holds it; ValueError for one it cannot hold.

    JPEG files are held as they are. So are the compressed rows of PNG files, whose filters
    readers know, but for those that are interlaced; transparency becomes a mask.
    """
    wide, high = picture_size(picture)
    if not wide or not high:
        raise ValueError("not a picture")
    shape = f"/Width {wide} /Height {high}"
    if picture[:2] == b"\xff\xd8":
        at = 2
        while picture[at + 1] not in (0xC0, 0xC1, 0xC2):
            at += 2 + struct.unpack_from(">H", picture, at + 2)[0]
        space = {1: "/DeviceGray", 3: "/DeviceRGB", 4: "/DeviceCMYK /Decode [1 0 1 0 1 0 1 0]"}[picture[at + 9]]
        return f"{shape} /BitsPerComponent 8 /ColorSpace {space} /Filter /DCTDecode", picture, b""
    depth, color, _, _, laced = picture[24:29]
    if laced:
        raise ValueError("an interlaced picture")
    if color in (4, 6):
        values = channels_of(picture)
        seen, mask = values[..., :-1], values[..., -1]
        space = "/DeviceGray" if color == 4 else "/DeviceRGB"
        return f"{shape} /BitsPerComponent 8 /ColorSpace {space} /Filter /FlateDecode", zlib.compress(seen.tobytes()), zlib.compress(mask.tobytes())
    at, rows, palette = 8, [], b""
    while at + 8 <= len(picture):
        size, kind = struct.unpack_from(">I4s", picture, at)
        body = picture[at + 8 : at + 8 + size]
        rows += [body] * (kind == b"IDAT")
        palette = body if kind == b"PLTE" else palette
        at += size + 12
    colors = 3 if color == 2 else 1
    space = f"[/Indexed /DeviceRGB {len(palette) // 3 - 1} <{palette.hex()}>]" if color == 3 else "/DeviceRGB" if color == 2 else "/DeviceGray"
    read = f"/Filter /FlateDecode /DecodeParms << /Predictor 15 /Colors {colors} /BitsPerComponent {depth} /Columns {wide} >>"
    return f"{shape} /BitsPerComponent {depth} /ColorSpace {space} {read}", b"".join(rows), b""


def holdable(pictures: dict[str, bytes]) -> dict[str, tuple[str, bytes, bytes]]:
    """Picture objects by path, of those that a PDF file can hold."""
    out = {}
    for path, c in pictures.items():
        with suppress(ValueError, KeyError, IndexError, struct.error, zlib.error):
            out[path] = picture_object(c)
    return out


def meanings(codes: list[tuple[int, str]]) -> bytes:
    """A map from codes to what they stand for."""
    blocks = "".join(f"{len(part)} beginbfchar\n" + "".join(f"<{code:02X}> <{ord(c):04X}>\n" for code, c in part) + "endbfchar\n" for part in (codes[k : k + 100] for k in range(0, len(codes), 100)))
    head = "/CIDInit /ProcSet findresource begin 12 dict begin begincmap /CMapName /Letters def /CMapType 2 def 1 begincodespacerange <00> <FF> endcodespacerange\n"
    return stream(f"{head}{blocks}endcmap end end".encode())


def package(blocks: list[dict], page: tuple[float, float] = A4, pictures: dict[str, bytes] | None = None, font: Font | None = None, regions: Mapping[str, Sequence[float]] | None = None) -> bytes:
    """A .pdf file with blocks (kind, level, text, rows, items) in order, pictures taken by their paths. What
    cannot be held is told by its name. With a font texts are measured by it: type is shrunk and rows are
    split where they would not fit."""
    held = holdable(pictures or {})
    shown = {p: c for p, c in (pictures or {}).items() if p in held}
    pages = laid_out(blocks, page, pictures=shown, font=font, regions=regions)
    objects_of = {shown[p]: o for p, o in held.items()}
    used = list(dict.fromkeys(s.picture for p in pages for s in p if s.picture))
    images = {c: k for k, c in enumerate(used)}
    letters = further_letters(pages)
    fonts: dict[int, list[tuple[int, str]]] = {}
    for c, (number, code) in letters.items():
        fonts.setdefault(number, []).append((code, c))
    usual = "<< /Type /Font /Subtype /Type1 /BaseFont /Times-{0} /Encoding /WinAnsiEncoding >>"
    # objects: catalogue, pages, two fonts, what all further fonts share, two for each of them, two for each page, two for each picture
    first_font, first_page = 6, 6 + 2 * len(fonts)
    first_image = first_page + 2 * len(pages)
    shows = " ".join(f"/I{k} {first_image + 2 * k} 0 R" for k in range(len(used)))
    kids = " ".join(f"{first_page + 2 * i} 0 R" for i in range(len(pages)))
    named = " ".join(["/R 3 0 R /B 4 0 R", *(f"/X{k} {first_font + 2 * k} 0 R" for k in fonts)])
    objects = [
        b"<< /Type /Catalog /Pages 2 0 R >>",
        f"<< /Type /Pages /Kids [{kids}] /Count {len(pages)} >>".encode(),
        usual.format("Roman").encode(),
        usual.format("Bold").encode(),
        b"<< /Type /FontDescriptor /FontName /TimesNewRoman /Flags 34 /FontBBox [-568 -307 2000 1007] /ItalicAngle 0 /Ascent 891 /Descent -216 /CapHeight 662 /StemV 80 >>",
    ]
    for k, codes in fonts.items():
        names = " ".join(f"/uni{ord(c):04X}" for _, c in codes)
        widths = " ".join(f"{font.widths.get(ord(c), font.missing):.0f}" if font else "500" for _, c in codes)
        objects.append(
            f"<< /Type /Font /Subtype /TrueType /BaseFont /TimesNewRoman /FirstChar {FIRST} /LastChar {codes[-1][0]} /Widths [{widths}] /FontDescriptor 5 0 R "
            f"/Encoding << /Type /Encoding /Differences [{FIRST} {names}] >> /ToUnicode {first_font + 2 * k + 1} 0 R >>".encode()
        )
        objects.append(meanings(codes))
    for i, shapes in enumerate(pages):
        size = " ".join(f"{72 * v:.2f}" for v in page)
        objects.append(f"<< /Type /Page /Parent 2 0 R /MediaBox [0 0 {size}] /Contents {first_page + 2 * i + 1} 0 R /Resources << /Font << {named} >> /XObject << {shows} >> >> >>".encode())
        objects.append(stream(content(shapes, letters, images)))
    for k, c in enumerate(used):
        entries, data, mask = objects_of[c]
        soft = f" /SMask {first_image + 2 * k + 1} 0 R" if mask else ""
        objects.append(f"<< /Type /XObject /Subtype /Image {entries}{soft} /Length {len(data)} >>\nstream\n".encode() + data + b"\nendstream")
        wide, high = picture_size(c)
        objects.append(f"<< /Type /XObject /Subtype /Image /Width {wide} /Height {high} /BitsPerComponent 8 /ColorSpace /DeviceGray /Filter /FlateDecode /Length {len(mask)} >>\nstream\n".encode() + mask + b"\nendstream" if mask else b"null")
    out, places = bytearray(b"%PDF-1.4\n"), []
    for n, body in enumerate(objects, 1):
        places.append(len(out))
        out += f"{n} 0 obj\n".encode() + body + b"\nendobj\n"
    table = len(out)
    out += f"xref\n0 {len(objects) + 1}\n0000000000 65535 f \n".encode() + b"".join(f"{p:010d} 00000 n \n".encode() for p in places)
    out += f"trailer\n<< /Size {len(objects) + 1} /Root 1 0 R >>\nstartxref\n{table}\n%%EOF\n".encode()
    return bytes(out)


def written(documents: DataFrame, key: str = "file") -> DataFrame:
    """(key, content): a .pdf file for each row of (key, blocks)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({key: f[key], "content": [package(list(b)) for b in f["blocks"]]})

    return documents.select(key, "blocks").mapInPandas(run, f"`{key}` {documents.schema[key].dataType.simpleString()}, content binary")
