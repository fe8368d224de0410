"""The archive of a run's text files and journals: what it lacks is appended, and it is built
anew where its journals are old or it cannot be read.

A journal is a folder of parts or a file; in the archive it is one entry. A digest of the
names, sizes and times of all parts stands in the archive's comment, so whether the journals
have changed is known without reading them. Archives lie on a file system that the
driver shares; text files are compressed into shards on executors, which it puts together.
"""

from __future__ import annotations

import glob
import hashlib
import logging
import os
import zipfile
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.relational import JOURNALS, missing
from folioscope.sinks.texts import extend_zip, write_zip
from folioscope.sources.reader import content_of

log = logging.getLogger(__name__)
NAME = "results.zip"


def parts_of(output: str, journal: str) -> list[str]:
    """Files that make up a journal, in order."""
    path = f"{output}/{journal}"
    return sorted(glob.glob(f"{glob.escape(path)}/part-*")) if os.path.isdir(path) else [path] if os.path.isfile(path) else []


def state_of(output: str) -> bytes:
    """Digest of the journals' names, sizes and times."""
    digest = hashlib.sha256()
    for p in (p for j in JOURNALS for p in parts_of(output, j)):
        s = os.stat(p)
        digest.update(f"{os.path.relpath(p, output)}:{s.st_size}:{s.st_mtime_ns}\n".encode())
    return digest.hexdigest().encode()


def read_in_parts(paths: list[str], size: int = 1 << 20) -> Iterator[bytes]:
    for p in paths:
        with open(p, "rb") as f:
            while part := f.read(size):
                yield part


def journals(output: str) -> list[tuple[str, Iterator[bytes]]]:
    return [(j, read_in_parts(found)) for j in JOURNALS if (found := parts_of(output, j))]


def manifest(path: str) -> tuple[list[str], bytes] | None:
    """Names of an archive's entries and its comment; None if there is none or it cannot be read."""
    try:
        with zipfile.ZipFile(path) as z:
            return z.namelist(), z.comment
    except (OSError, zipfile.BadZipFile):
        return None


def text_files(spark: SparkSession, output: str) -> DataFrame:
    """(name, path, modified) of the text files, none of which is read; names are relative to output."""
    if not os.path.isdir(f"{output}/txts"):
        return spark.createDataFrame([], "name string, path string, modified timestamp")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(f"{output}/txts")
    return found.select(F.concat(F.lit("txts/"), F.regexp_extract("path", r"([^/]+)$", 1)).alias("name"), "path", F.col("modificationTime").alias("modified"))


def refreshed(spark: SparkSession, output: str, full: bool = True, opened: Callable[[str], bytes] = content_of) -> str:
    """Bring output/results.zip up to date: "built", "extended" or "kept".

    Always appends text files that it lacks: names are compared first, and only those files are
    opened, by the executors. With `full` it is built anew if it cannot be read, is gone, or its
    journals are not the present ones. A failure is logged, and the next call tries again; one
    while the archive is built leaves the old one.
    """
    path = f"{output}/{NAME}"
    held, state, files = manifest(path), state_of(output), text_files(spark, output)
    try:
        if held is None or (full and held[1] != state):
            if held is None and not os.path.exists(path) and not parts_of(output, JOURNALS[0]) and files.isEmpty():
                return "kept"
            n = write_zip(files, path, journals(output), state, opened)
            log.info("archive %s built: %d files", path, n)
            return "built"
        names = spark.createDataFrame([(n,) for n in held[0]], "name string")
        # the comment stays: it tells which state of the journals the archive holds
        return "extended" if extend_zip(missing(files, names), path, held[1], opened) else "kept"
    except Exception:
        log.exception("archive %s could not be brought up to date", path)
        return "kept"
