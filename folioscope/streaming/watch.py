"""Watching a folder: batches of what the ledger lacks.

The ledger is the state. A file stream would mark files as seen when it lists them,
and so lose those that must settle first or be tried again; each trigger therefore
lists the folder anew and joins it against the ledger. A rate stream gives the
triggers. Whatever a batch writes can be written again; its ledger rows come last
and commit it, so a batch that was cut off is found pending again. Files with an
error stay pending too, and each attempt is a row.
"""

from __future__ import annotations

import logging
import shutil
import time
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioscope.functions.text import document_type, is_blank
from folioscope.operators.codes import extracted as codes_of
from folioscope.operators.relational import by_size, pending, settled
from folioscope.operators.segment import articles
from folioscope.plans.extraction import SCAN_TASK
from folioscope.plans.model import CALLS, Post, over_http, read_scans
from folioscope.sinks import archive, ledger, texts
from folioscope.sources import files as sources
from folioscope.sources import reader

log = logging.getLogger(__name__)
#: Results of documents (file, is_dir, bytes, parts); the folder takes tables of the batch.
Extract = Callable[[DataFrame, str], DataFrame]


def documents_of(text: Column) -> Column:
    """array of (text, rubricators, page): a text's articles with their codes."""
    return F.transform(articles(text), lambda d: F.struct(d["text"].alias("text"), codes_of(d["text"], d["page"]).alias("rubricators"), d["page"].alias("page")))


@lru_cache(maxsize=1)
def result_columns(application: str) -> tuple[Column, ...]:
    """The columns of a ledger row. They are some thousand calls to build, and the same in each batch of an application."""
    failed, blank = F.col("error").isNotNull(), is_blank(F.col("text"))
    suffix = F.lower(F.regexp_extract("file", r"(\.[^./]+)$", 1))
    none = F.array().cast(ledger.RESULT["documents"].dataType)
    return (
        F.col("file"),
        F.regexp_replace(suffix, r"^\.", "").alias("type"),
        F.col("size_bytes").cast("long").alias("size_bytes"),
        F.col("pages").cast("int").alias("pages"),
        F.coalesce("seconds", F.lit(0.0)).alias("duration_sec"),
        F.when(failed, "error").when(blank, "skip").otherwise("ok").alias("status"),
        F.col("error"),
        F.when(failed | blank, none).otherwise(documents_of(F.col("text"))).alias("documents"),
        F.when(failed | blank, "other").otherwise(document_type(F.col("text"), suffix)).alias("document_type"),
    )


def results(extracted: DataFrame) -> DataFrame:
    """Ledger rows of (file, size_bytes, text, pages, error, seconds): errors have no documents, blank texts are skipped."""
    return extracted.select(*result_columns(extracted.sparkSession.sparkContext.applicationId))


def extract_from(endpoints: list[str] | None = None, post: Post = over_http, prompt: str = SCAN_TASK, pages_of: Callable[[bytes, str], list[bytes]] | None = None, calls: int = CALLS, opened: Callable[[str], bytes] = reader.content_of) -> Extract:
    """Read and extract documents (file, is_dir, bytes, parts). PDF files and images without text go to
    the model at `endpoints`, `calls` requests at once; without any they are errors, and so tried
    again. What was read is a table in the batch's folder before the model is asked."""

    def run(documents: DataFrame, folder: str) -> DataFrame:
        return read_scans(kept(reader.read(documents, opened), f"{folder}/read"), endpoints or [], post, prompt, pages_of, calls=calls)

    return run


def kept(rows: DataFrame, path: str) -> DataFrame:
    """rows as a table, so that what made them is done once, whatever executors are lost."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def batch(spark: SparkSession, root: str, output: str, settle: float = 0.0, force: bool = False, extract: Extract | None = None, full: bool = True) -> int:
    """Process what is pending once: text files, statistics, and then the ledger rows that commit them;
    after these the readable snapshot and the archive, which are made from what is there. Returns how
    many documents were pending.

    The folder is listed once, without contents. How many documents there are, are pending, were
    processed, failed, and had how many pages is observed by the jobs that do the work.
    """
    files = sources.listed(spark, root).cache()
    seen, done = Observation(), Observation()
    found = sources.documents(files).withColumn("file", F.col("path")).observe(seen, F.count(F.lit(1)).alias("found"))
    wanted = by_size(pending(settled(found, F.current_timestamp(), settle), ledger.read(spark, f"{output}/results.jsonl"), force))
    folder = f"{output}/_batches/{uuid.uuid4().hex}"
    try:
        # names and sizes of what is to be read; the task counts follow from their sums
        table = kept(reader.wanted_files(wanted.select("path", "is_dir"), files), f"{folder}/wanted")
        n, size = table.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
        if n:
            rows = results((extract or extract_from())(reader.dealt(table.orderBy("bytes", "file"), n, size), folder))
            figures = [F.count_if(F.col("status") == s).alias(s) for s in ("ok", "skip", "error")]
            rows = kept(rows.observe(done, *figures, F.coalesce(F.sum("pages"), F.lit(0)).alias("pages")), f"{folder}/results")
            texts.write_files(texts.documents(rows), output)
            ledger.append(ledger.statistics(rows), f"{output}/stats.jsonl")
            with ledger.snapshot_follows(f"{output}/results.jsonl", f"{output}/results_readable.json", rows):
                ledger.append(rows, f"{output}/results.jsonl")
            archive.refreshed(spark, output, full)
            counted = done.get
            log.info("found %d, pending %d, processed %d, without text %d, failed %d, pages %d", seen.get["found"], n, counted["ok"], counted["skip"], counted["error"], counted["pages"])
    finally:
        files.unpersist()
        shutil.rmtree(folder, ignore_errors=True)
    return n


def watch(spark: SparkSession, root: str, output: str, checkpoint: str, interval: float = 5.0, settle: float = 5.0, extract: Extract | None = None, sync: float = 60.0) -> StreamingQuery:
    """Process new files every `interval` seconds until the query is stopped. A batch that
    fails is logged; its files stay pending for the next one. The archive is reconciled at the
    start and then every `sync` seconds; in between it gets what it lacks."""
    archive.refreshed(spark, output)
    last = [time.monotonic()]

    def once(_: DataFrame, number: int) -> None:
        due = time.monotonic() - last[0] >= sync
        try:
            n = batch(spark, root, output, settle, extract=extract, full=due)
            log.info("batch %d: %d files", number, n)
            if due and not n:
                archive.refreshed(spark, output)
            last[0] = time.monotonic() if due else last[0]
        except Exception:
            log.exception("batch %d failed", number)

    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(processingTime=f"{interval} seconds").start()


def stopped(query: StreamingQuery, spark: SparkSession, output: str, patience: float = 600.0) -> None:
    """Stop a watch: the batch under way may end within `patience` seconds (one that is cut off is
    found pending again), and the snapshot and archive are brought up to date."""
    until = time.monotonic() + patience
    while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
        time.sleep(0.05)
    query.stop()
    ledger.snapshot_checked(spark, f"{output}/results.jsonl", f"{output}/results_readable.json")
    archive.refreshed(spark, output)
