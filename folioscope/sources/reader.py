"""Contents of wanted files, and of no others.

A listing has names and sizes. Wanted documents are rows with the paths of their files; tasks
are planned by their sizes, and each opens its files one by one, reads the text, and lets
the content go. So a batch opens what is pending, however large the folder is, and no
content crosses between processes. Paths are what a listing gives: local or mounted folders, and
what pyarrow.fs opens by its URI.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions.text import meaningful
from folioscope.sources import html, ooxml, pdf

#: Bytes of files that a task reads, about; rows and bytes of text that it hands over at once.
TASK_BYTES, BATCH_ROWS, BATCH_TEXT = 128 << 20, 256, 4 << 20
IMAGES = ("png", "jpg", "jpeg")
PARTS = "array<struct<path:string,relative:string,size:bigint>>"
READ = "file string, size_bytes bigint, text string, pages int, error string, seconds double, path string"


#: Stores that a worker has open, and what their own paths begin with.
STORES: dict[str, tuple[fs.FileSystem, str]] = {}


def content_of(path: str) -> bytes:
    """The bytes of a file by its path or URI."""
    parts = urlsplit(path)
    if parts.scheme in ("", "file"):
        with open("/" + path[5:].lstrip("/") if parts.scheme else path, "rb") as f:
            return f.read()
    root = f"{parts.scheme}://{parts.netloc}/"
    if root not in STORES:
        STORES[root] = fs.FileSystem.from_uri(root)
    held, base = STORES[root]
    inner = path[len(parts.scheme) + 3 + len(parts.netloc) :]
    with held.open_input_stream(base.rstrip("/") + inner) as f:
        return f.read()


def wanted_files(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """(file, is_dir, bytes, parts) of wanted (path, is_dir): the files that make up each document, by
    name. A collection has the HTML files below it in order of their paths; .htm counts only where
    there is no .html. files are a listing (path, relative, size)."""
    part = F.struct("path", "relative", "size")
    single = wanted.where("not is_dir").select(F.col("path").alias("relative"))
    single = files.join(single, "relative").select(F.col("relative").alias("file"), F.lit(False).alias("is_dir"), F.array(part).alias("parts"))
    folders = wanted.where("is_dir").select(F.col("path").alias("root"))
    steps = F.split("relative", "/", -1)
    above = F.transform(F.sequence(F.lit(1), F.size(steps) - 1), lambda i: F.array_join(F.slice(steps, 1, i), "/"))
    pages = files.where(F.col("relative").rlike(r"/[^/]*\.html?$")).select(F.explode(above).alias("root"), F.col("relative").endswith(".htm").cast("int").alias("kind"), part.alias("part"))
    held = pages.join(folders, "root").groupBy("root").agg(F.min("kind").alias("best"), F.collect_list(F.struct(F.col("part.relative").alias("at"), "kind", "part")).alias("found"))
    parts = F.transform(F.filter(F.array_sort("found"), lambda x: x["kind"] == F.col("best")), lambda x: x["part"])
    joined = folders.join(held, "root", "left").select(F.col("root").alias("file"), F.lit(True).alias("is_dir"), F.coalesce(parts, F.array().cast(PARTS)).alias("parts"))
    return single.unionByName(joined).select("file", "is_dir", F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + F.coalesce(p["size"], F.lit(0))).alias("bytes"), "parts")


def tasks_for(files: int, size: int, cores: int) -> int:
    """How many tasks read so much: each TASK_BYTES, but no core idles while there are files."""
    return max(1, -(-size // TASK_BYTES), min(files, cores))


def dealt(documents: DataFrame, files: int, size: int) -> DataFrame:
    """documents over as many partitions as their bytes call for; large and small ones are mixed, as rows in order of size are dealt in turn."""
    return documents.repartition(tasks_for(files, size, documents.sparkSession.sparkContext.defaultParallelism))


READERS: dict[str, Callable[[bytes], tuple[str, int]]] = {
    "html": lambda x: (html.page_text(x.decode("utf-8", "replace")), 1),
    "htm": lambda x: (html.page_text(x.decode("utf-8", "replace")), 1),
    "docx": lambda x: (ooxml.Word(x).text(), 1),
    "pptx": lambda x: (ooxml.Slides(x).text(), 1),
    "pdf": pdf.read,
}


def suffix_of(name: str) -> str:
    return name.rpartition("/")[2].rpartition(".")[2].lower()


def text_of(file: str, is_dir: bool, parts: list[dict], opened: Callable[[str], bytes]) -> tuple[str, int, int]:
    """(text, pages, bytes read) of a document. Pictures are not opened: what they say is the model's."""
    if is_dir:
        pages = [(p["relative"].rpartition("/")[2], html.page_text(opened(p["path"]).decode("utf-8", "replace"))) for p in parts]
        return "\n\n".join(f"<!-- file: {name} -->\n{text}" for name, text in pages if text), 1, 0
    kind = suffix_of(file)
    if kind not in READERS:
        return "", 0, parts[0]["size"]
    content = opened(parts[0]["path"])
    return *READERS[kind](content), len(content)


def read(documents: DataFrame, opened: Callable[[str], bytes] = content_of) -> DataFrame:
    """READ rows of (file, is_dir, bytes, parts): each file is opened once. A document that cannot
    be read has its error; `path` is set for scans, which have no text of their own: pictures, and PDF files
    without text. HTML with little content has an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0

        def handed() -> pa.RecordBatch:
            names = [c.split()[0] for c in READ.split(", ")]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.float64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for r in batch.to_pylist():
                began, error, text, pages, held = time.perf_counter(), None, "", 0, 0
                try:
                    text, pages, held = text_of(r["file"], r["is_dir"], r["parts"], opened)
                except Exception as e:  # noqa: BLE001 - a file that cannot be read is a row with its error
                    error, held = f"{type(e).__name__}: {e}"[:1000], 0 if r["is_dir"] else r["bytes"]
                scan = not error and not r["is_dir"] and not text.strip() and suffix_of(r["file"]) in (*IMAGES, "pdf")
                rows.append((r["file"], held, text, pages, error, round(time.perf_counter() - began, 3), r["parts"][0]["path"] if scan else None))
                size += len(text)
                if len(rows) >= BATCH_ROWS or size >= BATCH_TEXT:
                    yield handed()
                    rows, size = [], 0
        if rows:
            yield handed()

    out = documents.select("file", "is_dir", "bytes", "parts").mapInArrow(run, READ)
    page = F.lower("file").rlike(r"\.html?$") & (F.col("size_bytes") > 0)  # collections have no size
    return out.withColumn("text", F.when(page & ~meaningful(F.col("text")), "").otherwise(F.col("text")))
