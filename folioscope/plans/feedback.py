"""Operator corrections: recent ones as a prompt block, corrected ones as fine-tuning samples."""

from __future__ import annotations

import glob
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.functions.text import is_blank, strip
from folioscope.operators.relational import last_rows
from folioscope.sinks import ledger

#: Fixed values.
INTRODUCTION = "Recent corrections from operator (VLM was wrong, operator corrected it — follow the operator's values, they are authoritative):\n"
MOST = 800


def example(markdown: Column, number: Column) -> Column:
    n, t = number.cast("string"), strip(F.coalesce(markdown, F.lit("")))
    shown = F.when(F.length(t) <= MOST, t).otherwise(F.concat(F.substring(t, 1, MOST), F.lit("\n... [truncated]")))
    body = F.when(F.coalesce(markdown, F.lit("")) == "", "").otherwise(F.concat(F.lit("Corrected markdown:\n"), shown, F.lit("\n")))
    return F.concat(F.lit("<EXAMPLE "), n, F.lit(">\n"), body, F.lit("</EXAMPLE "), n, F.lit(">"))


def block(recent: DataFrame, position: str = "position", markdown: str = "markdown") -> DataFrame:
    """(block): one row for a few recent corrections (as many as the prompt's limit), '' without any."""
    gathered = recent.agg(F.array_sort(F.collect_list(F.struct(position, markdown))).alias("r"))
    examples = F.transform("r", lambda x, i: example(x[markdown], i + 1))
    return gathered.select(F.when(F.size("r") == 0, "").otherwise(F.concat(F.lit(INTRODUCTION), F.array_join(examples, "\n\n"))).alias("block"))


def placed(corrections: DataFrame) -> DataFrame:
    """(position, markdown) of a ledger's rows as read: batches by the time of their last part, then by
    part and by place in it. The parts of a batch are written side by side, so their own times tell nothing."""
    name = F.col("_metadata.file_name")
    number = lambda pattern: F.regexp_extract(name, pattern, 1).try_cast("long")
    batch = F.coalesce(F.nullif(F.regexp_extract(name, r"^part-\d+-(.+?)(?:-c\d+)?\.", 1), F.lit("")), name).alias("batch")
    last = corrections.select(batch, F.col("_metadata.file_modification_time").alias("at")).groupBy("batch").agg(F.max("at").alias("at"))
    place = (number(r"^part-(\d+)").alias("part"), number(r"-c(\d+)\.").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    rows = corrections.select(batch, *place, "markdown").join(last, "batch")
    return rows.select(F.struct("at", "batch", "part", "file", "start", "row").alias("position"), "markdown")


#: The last block made, by ledger and number of corrections, and what the ledger's files were then.
_made: dict[tuple[str, int], tuple[str, str]] = {}


def current_block(spark: SparkSession, path: str, limit: int) -> str:
    """The block of the last `limit` corrections in the ledger at path, on a file system that the
    driver shares; made anew only if its files have changed. '' without any. Corrections stand in the
    order in which they were added, whatever their timestamps."""
    parts = sorted(glob.glob(f"{glob.escape(path)}/part-*")) if os.path.isdir(path) else [path] * os.path.isfile(path)
    state = ";".join(f"{p}:{os.stat(p).st_size}:{os.stat(p).st_mtime_ns}" for p in parts)
    if limit <= 0 or not parts:
        return ""
    if _made.get((path, limit), ("", ""))[0] != state:
        _made[path, limit] = state, block(last_rows(placed(ledger.read(spark, path, ledger.CORRECTION)), "position", limit)).first()["block"]
    return _made[path, limit][1]


def corrected(markdown: Column, seen: Column, fixed: Column) -> Column:
    """Did the operator leave some Markdown, or change the entities?"""
    return ~is_blank(markdown) | F.coalesce(seen != fixed, F.lit(False))


def target(markdown: Column, fixed: Column) -> Column:
    return F.to_json(F.struct(F.coalesce(markdown, F.lit("")).alias("markdown"), fixed.alias("entities")))


def samples(corrections: DataFrame, prompt: str, images: bool = True) -> DataFrame:
    """(images, text, target) of the corrections that changed something."""
    kept = corrections.where(corrected(F.col("markdown"), F.col("vlm_entities"), F.col("operator_corrected_entities")))
    image = F.array(F.coalesce("page_image", F.lit(""))) if images else F.array().cast("array<string>")
    return kept.select(image.alias("images"), F.lit(prompt).alias("text"), target(F.col("markdown"), F.col("operator_corrected_entities")).alias("target"))
