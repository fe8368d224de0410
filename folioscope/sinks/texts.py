"""Plain text files, one for each document, and zip archives of them."""

from __future__ import annotations

import os
import shutil
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import BinaryIO

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import strip
from folioscope.operators.relational import export_names
from folioscope.sources.reader import content_of

#: A form, as tasks take it along.
LOCAL = "<IHHHHHIIIHH"
CENTRAL = struct.Struct("<IHHHHHHIIIHHHHHII")
END = struct.Struct("<IHHHHIIH")
END64, LOCATOR64 = struct.Struct("<IQHHIIQQQQ"), struct.Struct("<IIQI")
#: 1980-01-01, UTF-8 names, deflate.
DATE, UTF8, DEFLATE, MOST32, MOST16 = 0x21, 0x800, 8, 0xFFFFFFFF, 0xFFFF


def documents(results: DataFrame) -> DataFrame:
    """(name, body): a text for each document of the results, <stem>_<i> where there are
    several; a result without documents has one empty text."""
    named = export_names(results.where("status = 'ok'").withColumn("stem", F.regexp_replace(F.regexp_extract("file", r"([^/]*)$", 1), r"\.[^.]*$", "")), "stem", ["size_bytes", "file"])
    rows = named.select("name", F.size("documents").alias("n"), F.posexplode_outer("documents").alias("pos", "document"))
    name = F.when(F.col("n") > 1, F.concat("name", F.lit("_"), (F.col("pos") + 1).cast("string"))).otherwise(F.col("name"))
    return rows.select(name.alias("name"), F.concat(strip(F.coalesce("document.text", F.lit(""))), F.lit("\n")).alias("body"))


def write_files(texts: DataFrame, folder: str) -> None:
    """Write each (name, body) as folder/txts/<name>.txt, on a file system that all executors share.
    A file is complete once it has its name."""

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.makedirs(f"{folder}/txts", exist_ok=True)
        for f in frames:
            for name, body in zip(f["name"], f["body"], strict=True):
                temporary = f"{folder}/txts/.{name}.{os.getpid()}"
                with open(temporary, "w", encoding="utf-8") as out:
                    out.write(body)
                os.replace(temporary, f"{folder}/txts/{name}.txt")
            yield pd.DataFrame({"n": [len(f)]})

    texts.select("name", "body").mapInPandas(put, "n bigint").agg(F.sum("n")).collect()


def zip_time(at: Column) -> Column:
    """A time as zip archives have it: date and time of day in 16 bits each, two seconds apart,
    from 1980 to 2107."""
    year = F.greatest(F.least(F.year(at), F.lit(2107)), F.lit(1980))
    late, early = F.year(at) > 2107, F.year(at) < 1980
    date = ((year - 1980) * 16 + F.when(early, 1).when(late, 12).otherwise(F.month(at))) * 32 + F.when(early, 1).when(late, 31).otherwise(F.day(at))
    time = F.when(early | late, 0).otherwise((F.hour(at) * 64 + F.minute(at)) * 32 + F.floor(F.second(at) / 2))
    return date.cast("long") * 65536 + time.cast("long")


def local(name: bytes, crc: int, packed: int, size: int, time: int) -> bytes:
    """What stands before an entry's content."""
    extra = struct.pack("<HHQQ", 1, 16, size, packed) if max(size, packed) >= MOST32 else b""
    sizes = (MOST32, MOST32) if extra else (packed, size)
    return struct.pack(LOCAL, 0x04034B50, 45 if extra else 20, UTF8, DEFLATE, time & 0xFFFF, time >> 16, crc, *sizes, len(name), len(extra)) + name + extra


def sharded(files: DataFrame, folder: str, opened: Callable[[str], bytes] = content_of) -> DataFrame:
    """(name, shard, at, crc, packed, size, time) of (name, content) or (name, path) and, if there, `modified`.
    Each task deflates its files, which it opens itself if paths are given, into a shard below `folder`: entries of an archive, one behind the other."""
    source = "content" if "content" in files.columns else "path"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{shard}", "wb") as out:
            for f in frames:
                entries = []
                for name, given, time in zip(f["name"], f[source], f["time"], strict=True):
                    content = opened(given) if source == "path" else given
                    squeeze = zlib.compressobj(6, zlib.DEFLATED, -15)
                    packed, crc, title = squeeze.compress(content) + squeeze.flush(), zlib.crc32(content), name.encode()
                    entries.append((name, shard, out.tell(), crc, len(packed), len(content), time))
                    out.write(local(title, crc, len(packed), len(content), time) + packed)
                out.flush()
                yield pd.DataFrame(entries, columns=["name", "shard", "at", "crc", "packed", "size", "time"])

    time = F.coalesce(zip_time(F.col("modified")), F.lit(DATE << 16)) if "modified" in files.columns else F.lit(DATE << 16)
    return files.select("name", source, time.cast("long").alias("time")).orderBy("name").mapInPandas(run, "name string, shard string, at bigint, crc bigint, packed bigint, size bigint, time bigint")


def wide(*values: int) -> bytes:
    """The ZIP64 field with those of the values that 32 bits cannot hold."""
    over = [v for v in values if v >= MOST32]
    return struct.pack(f"<HH{len(over)}Q", 1, 8 * len(over), *over) if over else b""


def streamed(out, name: bytes, parts: Iterable[bytes]) -> tuple[int, int, int]:
    """Write an entry of unknown size and put its header right afterwards: (crc, packed, size).
    Its sizes have 64 bits, as they are not known before."""
    begin = out.tell()
    out.write(b"\0" * (struct.calcsize(LOCAL) + len(name) + 20))
    squeeze, crc, size, packed = zlib.compressobj(6, zlib.DEFLATED, -15), 0, 0, 0
    for part in parts:
        crc, size = zlib.crc32(part, crc), size + len(part)
        packed += out.write(squeeze.compress(part))
    packed += out.write(squeeze.flush())
    end = out.tell()
    out.seek(begin)
    out.write(struct.pack(LOCAL, 0x04034B50, 45, UTF8, DEFLATE, 0, DATE, crc, MOST32, MOST32, len(name), 20) + name + struct.pack("<HHQQ", 1, 16, size, packed))
    out.seek(end)
    return crc, packed, size


def central(name: bytes, crc: int, packed: int, size: int, at: int, time: int = DATE << 16) -> bytes:
    """An entry of the directory."""
    limit = lambda v: min(v, MOST32)
    more = wide(size, packed, at)
    return CENTRAL.pack(0x02014B50, 45, 45 if more else 20, UTF8, DEFLATE, time & 0xFFFF, time >> 16, crc, limit(packed), limit(size), len(name), len(more), 0, 0, 0, 0, limit(at)) + name + more


def joined(out: BinaryIO, files: DataFrame, folder: str, opened: Callable[[str], bytes]) -> list[bytes]:
    """Put the shards of files behind one another into an archive: their entries of the directory."""
    shards: dict[str, list] = {}
    for r in sharded(files, folder, opened).toLocalIterator():
        shards.setdefault(r["shard"], []).append(r)
    directory = []
    for shard in sorted(shards):
        base = out.tell()
        with open(f"{folder}/{shard}", "rb") as part:
            shutil.copyfileobj(part, out, 1 << 20)
        directory += [central(r["name"].encode(), r["crc"], r["packed"], r["size"], base + r["at"], r["time"]) for r in shards[shard]]
    return directory


def ended(out: BinaryIO, directory: list[bytes], n: int, comment: bytes) -> None:
    """Write the directory of n entries and the end of an archive."""
    at, size = out.tell(), sum(map(len, directory))
    out.writelines(directory)
    if n >= MOST16 or at >= MOST32 or size >= MOST32:
        out.write(END64.pack(0x06064B50, END64.size - 12, 45, 45, 0, 0, n, n, size, at) + LOCATOR64.pack(0x07064B50, 0, at + size, 1))
    out.write(END.pack(0x06054B50, 0, 0, min(n, MOST16), min(n, MOST16), min(size, MOST32), min(at, MOST32), len(comment)) + comment)


def write_zip(files: DataFrame, path: str, streams: Iterable[tuple[str, Iterable[bytes]]] = (), comment: bytes = b"", opened: Callable[[str], bytes] = content_of) -> int:
    """Write (name, content) or (name, path) rows, in order of name, and then `streams` (name, parts) as a zip
    archive; ZIP64 where it must be. Returns the number of entries.

    Executors write deflated shards beside the archive, which are put behind one another here
    without being looked into; `streams` are compressed as they come. Only the directory is
    held. The archive takes its name when it is whole.
    """
    temporary, folder = f"{path}.tmp", f"{path}.{uuid.uuid4().hex}.shards"
    try:
        with open(temporary, "wb") as out:
            directory = joined(out, files, folder, opened)
            for name, parts in streams:
                at = out.tell()
                directory.append(central(name.encode(), *streamed(out, name.encode(), parts), at))
            ended(out, directory, len(directory), comment)
        os.replace(temporary, path)
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    return len(directory)


def directory_of(path: str, comment: bytes) -> tuple[int, int, bytes]:
    """(number of entries, place, bytes) of the directory of an archive with this comment."""
    with open(path, "rb") as f:
        end = f.seek(-END.size - len(comment), os.SEEK_END)
        _, _, _, _, n, size, at, _ = END.unpack(f.read(END.size))
        if n == MOST16 or size == MOST32 or at == MOST32:
            f.seek(end - LOCATOR64.size)
            f.seek(LOCATOR64.unpack(f.read(LOCATOR64.size))[2])
            *_, n, size, at = END64.unpack(f.read(END64.size))
        f.seek(at)
        return n, at, f.read(size)


def extend_zip(files: DataFrame, path: str, comment: bytes, opened: Callable[[str], bytes] = content_of) -> int:
    """Put files (as for write_zip) behind the entries of an archive, whose comment stays. What it held
    is neither read nor moved, but for its directory. If this is cut off the archive has no
    directory, and so cannot be read until it is written anew. Returns the number of new entries."""
    folder = f"{path}.{uuid.uuid4().hex}.shards"
    n, at, held = directory_of(path, comment)
    try:
        with open(path, "r+b") as out:
            out.seek(at)
            directory = joined(out, files, folder, opened)
            if directory:
                ended(out, [held, *directory], n + len(directory), comment)
                out.truncate()
    finally:
        shutil.rmtree(folder, ignore_errors=True)
    return len(directory)
