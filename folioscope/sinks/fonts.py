"""Advance widths of letters, read from TrueType files. Standard library only."""

from __future__ import annotations

import os
import struct
from dataclasses import dataclass

#: Where common fonts with serifs lie, the first that is there counts.
USUAL = (
    "/usr/share/fonts/truetype/msttcorefonts/Times_New_Roman.ttf",
    "/usr/share/fonts/truetype/liberation/LiberationSerif-Regular.ttf",
    "/usr/share/fonts/truetype/dejavu/DejaVuSerif.ttf",
    "C:/Windows/Fonts/times.ttf",
    "/Library/Fonts/Times New Roman.ttf",
)


@dataclass
class Font:
    """Widths in thousandths of the type size, by code point; `missing` is that of letters the font lacks."""

    widths: dict[int, float]
    missing: float

    def width(self, text: str, size: float) -> float:
        """Of a line, in the unit of `size`."""
        return sum(self.widths.get(ord(c), self.missing) for c in text) * size / 1000


def segments(table: bytes) -> dict[int, int]:
    """Code points and glyphs of a table of runs of 16-bit codes (format 4)."""
    n = struct.unpack_from(">H", table, 6)[0] // 2
    ends, starts, deltas, offsets = (struct.unpack_from(f">{n}H", table, at) for at in (14, 16 + 2 * n, 16 + 4 * n, 16 + 6 * n))
    found = {}
    for k, (first, last, delta, offset) in enumerate(zip(starts, ends, deltas, offsets, strict=True)):
        for code in range(first, min(last, 0xFFFE) + 1):
            at = 16 + 6 * n + 2 * k + offset + 2 * (code - first)
            glyph = code if not offset else struct.unpack_from(">H", table, at)[0] if at + 2 <= len(table) else 0
            if glyph or not offset:
                found[code] = (glyph + delta) & 0xFFFF
    return {c: g for c, g in found.items() if g}


def groups(table: bytes) -> dict[int, int]:
    """Code points and glyphs of a table of groups of 32-bit codes (format 12)."""
    n = struct.unpack_from(">I", table, 12)[0]
    found = {}
    for k in range(n):
        first, last, glyph = struct.unpack_from(">III", table, 16 + 12 * k)
        found.update((c, glyph + c - first) for c in range(first, min(last, 0x10FFFF) + 1))
    return found


def parsed(content: bytes) -> Font:
    """The font of a TrueType file: unit of its design, advance of each glyph, glyph of each code point."""
    n = struct.unpack_from(">H", content, 4)[0]
    tables = {}
    for k in range(n):
        tag, _, at, size = struct.unpack_from(">4sIII", content, 12 + 16 * k)
        tables[tag] = content[at : at + size]
    unit = struct.unpack_from(">H", tables[b"head"], 18)[0]
    count = struct.unpack_from(">H", tables[b"hhea"], 34)[0]
    # the last advance counts for all further glyphs
    advances = struct.unpack(f">{2 * count}H", tables[b"hmtx"][: 4 * count])[::2]
    kinds: dict[int, bytes] = {}
    for k in range(struct.unpack_from(">H", tables[b"cmap"], 2)[0]):
        platform, encoding, at = struct.unpack_from(">HHI", tables[b"cmap"], 4 + 8 * k)
        kind = struct.unpack_from(">H", tables[b"cmap"], at)[0]
        if (platform, encoding) in ((0, 3), (0, 4), (3, 1), (3, 10)) and kind in (4, 12):
            kinds[kind] = tables[b"cmap"][at:]
    glyphs = groups(kinds[12]) if 12 in kinds else segments(kinds[4]) if 4 in kinds else {}
    if not glyphs:
        raise ValueError("a font without a table of Unicode letters")
    wide = lambda g: advances[min(g, count - 1)] * 1000 / unit
    return Font({c: wide(g) for c, g in glyphs.items()}, wide(0))


#: Fonts that a worker has read, by path.
READ: dict[str, Font | None] = {}


def font_at(path: str | None = None) -> Font | None:
    """The font of a file, or the first usual one there is; None where there is none or it cannot be read."""
    path = path or next((p for p in USUAL if os.path.isfile(p)), "")
    if path not in READ:
        try:
            with open(path, "rb") as f:
                READ[path] = parsed(f.read())
        except (OSError, ValueError, KeyError, IndexError, struct.error):
            READ[path] = None
    return READ[path]
