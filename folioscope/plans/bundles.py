"""Bundles of a document's text, layout and pictures, rebuilt as DOCX, PDF and Visio files.

A bundle is a folder with text.txt, perhaps layout.json and meta.json, and pictures below images/. All
bundles below a root are one plan: their files are gathered by folder, their texts become
blocks by expressions, and a file of each format is made for each bundle.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.operators.segment import blocks, joined_links
from folioscope.plans.extraction import layout_blocks
from folioscope.sinks import drawings, pdf, word
from folioscope.sinks.fonts import font_at
from folioscope.sources import files as sources

META = "struct<regions:array<struct<name:string,bbox:array<double>>>>"
FORMATS, CONTENTS = ("docx", "pdf", "vsdx"), ("pages", "sheet", "document")
NAME = r"^(.*?)/?(text\.txt|layout\.json|meta\.json|images/[^/]+\.(?:png|jpe?g))$"


def bundles(spark: SparkSession, root: str) -> DataFrame:
    """(bundle, blocks, layout, pictures) of the folders below root, root itself included, that hold a
    text.txt. `layout` are the blocks of layout.json, null without one or if it has none; pictures
    (path, content, bbox) have the region of their name in meta.json, if it tells one."""
    parts = sources.contents(spark, root).select(F.regexp_extract("relative", NAME, 1).alias("bundle"), F.regexp_extract("relative", NAME, 2).alias("name"), "content").where("name <> ''")
    text = F.make_valid_utf8(F.col("content").cast("string"))
    texts = parts.where("name = 'text.txt'").select("bundle", blocks(joined_links(text)).alias("blocks"))
    read = parts.where("name = 'layout.json'").select("bundle", layout_blocks(text).alias("layout")).where(F.size("layout") > 0)
    regions = parts.where("name = 'meta.json'").select("bundle", F.posexplode(F.from_json(text, META)["regions"]).alias("position", "region"))
    regions = regions.select(F.concat_ws("/", "bundle", F.regexp_extract("region.name", r"([^/]*)$", 1)).alias("name"), "position", F.col("region.bbox").alias("bbox"))
    links = parts.where("name like 'images/%'").select("bundle", "name", "content", F.concat_ws("/", "bundle", F.regexp_extract("name", r"([^/]*)$", 1)).alias("key"))
    # a picture's region: the last of its name within the bundle
    last = regions.groupBy("name").agg(F.max_by("bbox", "position").alias("bbox")).withColumnRenamed("name", "key")
    known = links.join(last, "key", "left")
    shown = known.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct(F.col("name").alias("path"), "content", "bbox"))).alias("pictures"))
    return texts.join(read, "bundle", "left").join(shown, "bundle", "left")


def made(kind: str, bundle: str, parts: list[dict], layout: list[dict] | None, pictures: dict[str, bytes], content: str, regions: dict[str, list[float]] | None = None) -> bytes:
    if kind == "docx":
        return word.package(parts, pictures, regions)
    if kind == "pdf":
        return pdf.package(parts, pictures=pictures, font=font_at(), regions=regions)
    title = bundle.rpartition("/")[2]
    if layout is not None or content == "document":
        return drawings.package(drawings.laid_out(parts if layout is None else layout, pictures=pictures, regions=regions), title)
    own = [(p, c) for p, c in sorted(pictures.items()) if p.rpartition("/")[2].startswith("page_") and p.endswith(".png")]
    pages, sizes = drawings.pictured(own or sorted(pictures.items()), sheet=content == "sheet")
    return drawings.package(pages, title, sizes)


def rebuilt(found: DataFrame, formats: tuple[str, ...] = FORMATS, content: str = "pages") -> DataFrame:
    """(bundle, format, content, error): a file of each format, or why there is none. A layout
    decides what a drawing holds; without one `content` does."""
    if unknown := set(formats) - set(FORMATS):
        raise ValueError(f"unknown formats: {', '.join(sorted(unknown))}")
    if content not in CONTENTS:
        raise ValueError(f"unknown content: {content}")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for bundle, parts, layout, shown in zip(f["bundle"], f["blocks"], f["layout"], f["pictures"], strict=True):
                pictures = {x["path"]: bytes(x["content"]) for x in ([] if shown is None else shown)}
                regions = {x["path"].rpartition("/")[2]: list(x["bbox"]) for x in ([] if shown is None else shown) if x["bbox"] is not None}
                for kind in formats:
                    try:
                        out.append((bundle, kind, made(kind, bundle, list(parts), None if layout is None else list(layout), pictures, content, regions), None))
                    except ValueError as e:  # such as a drawing of pictures without pictures
                        out.append((bundle, kind, None, str(e)))
            yield pd.DataFrame(out, columns=["bundle", "format", "content", "error"])

    return found.select("bundle", "blocks", "layout", "pictures").mapInPandas(run, "bundle string, format string, content binary, error string")


def write(spark: SparkSession, root: str, formats: tuple[str, ...] = FORMATS, content: str = "pages") -> list[tuple[str, str]]:
    """Put reconstruct.<format> into each bundle below root, on a file system that all executors share.
    Returns (path, error or '') for each."""

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            paths = [os.path.join(root, b, f"reconstruct.{k}") for b, k in zip(f["bundle"], f["format"], strict=True)]
            for path, body in zip(paths, f["content"], strict=True):
                if body is not None:
                    with open(f"{path}.tmp", "wb") as out:
                        out.write(bytes(body))
                    os.replace(f"{path}.tmp", path)
            yield pd.DataFrame({"path": paths, "error": f["error"].fillna("")})

    done = rebuilt(bundles(spark, root), formats, content).mapInPandas(put, "path string, error string")
    return [(r["path"], r["error"]) for r in done.orderBy("path").toLocalIterator()]
