"""Entries of zip archives whose directory is lost."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL = struct.Struct("<4sHHHHHIIIHH")


def entries(blob: bytes) -> Iterator[tuple[str, bytes]]:
    """(name, content) of the stored and deflated entries whose checksum holds."""
    at = blob.find(b"PK\x03\x04")
    while at >= 0 and at + LOCAL.size <= len(blob):
        _, _, flags, method, _, _, crc, packed, size, n_name, n_extra = LOCAL.unpack_from(blob, at)
        begin = at + LOCAL.size + n_name + n_extra
        name = blob[at + LOCAL.size : at + LOCAL.size + n_name].decode("utf-8" if flags & 0x800 else "cp437", "replace")
        content, end = None, at + 4
        if method in (0, 8) and 0xFFFFFFFF not in (packed, size) and not name.endswith("/") and not flags & 0x8 and begin + packed <= len(blob):
            raw = blob[begin : begin + packed]
            try:
                content = raw if method == 0 else zlib.decompressobj(-15).decompress(raw)
            except zlib.error:
                content = None
            if content is not None and len(content) == size and zlib.crc32(content) == crc:
                yield name, content
                end = begin + packed
        at = blob.find(b"PK\x03\x04", end)


def salvaged(content: Column) -> Column:
    """array of (name, content)."""

    @F.pandas_udf("array<struct<name:string,content:binary>>")
    def scan(contents: pd.Series) -> pd.Series:
        return contents.map(lambda x: [{"name": n, "content": c} for n, c in entries(x or b"")])

    return scan(content)
