"""Ledgers and their readable snapshots, statistics, corrections and quarantined replies."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in kinds.items()])


TEXT, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
RUBRICATOR = _struct(type=TEXT, value=TEXT, number=TEXT, evidence=TEXT, page=INT)
DOCUMENT = _struct(text=TEXT, rubricators=T.ArrayType(RUBRICATOR), page=INT)
STATS = _struct(file=TEXT, type=TEXT, size_bytes=LONG, pages=INT, duration_sec=DOUBLE, status=TEXT, error=TEXT)
RESULT = T.StructType([*STATS.fields, T.StructField("documents", T.ArrayType(DOCUMENT)), T.StructField("document_type", TEXT)])
ENTITY = _struct(type=TEXT, value=TEXT, normalized_value=TEXT, page=INT, paragraph=INT, evidence=TEXT, confidence=DOUBLE, handwritten=T.BooleanType(), comment=TEXT)
CORRECTION = _struct(page_image=TEXT, markdown=TEXT, vlm_entities=T.ArrayType(ENTITY), operator_corrected_entities=T.ArrayType(ENTITY), timestamp=DOUBLE)


def append(rows: DataFrame, path: str) -> None:
    """Add rows to a JSON ledger; one batch is one commit."""
    rows.write.mode("append").json(path)


def read(spark: SparkSession, path: str, schema: T.StructType = RESULT) -> DataFrame:
    """A ledger's rows; none where there is no ledger yet. Broken lines are left out."""
    try:
        return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def statistics(results: DataFrame) -> DataFrame:
    """The flat part of result rows: one row for each attempt, failed ones too."""
    return results.select(*STATS.fieldNames())


def counts(results: DataFrame, by: list[str] | None = None, size: str = "size_bytes") -> DataFrame:
    """Files, those processed, and their sizes, by group or in all."""
    return results.groupBy(*(by or [])).agg(F.count("*").alias("files"), F.count_if(F.col("status") == "ok").alias("processed"), F.sum(size).alias("bytes"))


CLOSING = b"\n]\n"


def parts_state(ledger: str) -> list[int]:
    """Number and bytes of the ledger's parts, from their names and sizes alone."""
    found = [e.stat().st_size for e in os.scandir(ledger) if e.name.startswith("part-")] if os.path.isdir(ledger) else []
    return [len(found), sum(found)]


def _marked(path: str) -> dict | None:
    try:
        with open(f"{path}.mark", encoding="utf-8") as f:
            mark = json.load(f)
        return mark if os.path.getsize(path) >= mark["length"] else None
    except (OSError, ValueError, KeyError):
        return None


def _mark(path: str, length: int, rows: int, state: list[int]) -> None:
    temporary = f"{path}.mark.{uuid.uuid4().hex}"
    with open(temporary, "w", encoding="utf-8") as f:
        json.dump({"length": length, "rows": rows, "state": state}, f)
    os.replace(temporary, f"{path}.mark")


def _put(out: BinaryIO, rows: DataFrame, n: int) -> tuple[int, int]:
    """Write rows where `out` stands, n rows being before them, and the closing bracket: (length without it, rows)."""
    shown = rows.select(F.to_json(F.struct(*RESULT.fieldNames()), {"ignoreNullFields": "false", "pretty": "true"}).alias("row"))
    for r in shown.toLocalIterator():
        out.write((",\n" if n else "\n").encode() + r["row"].encode())
        n += 1
    length = out.tell()
    out.write(CLOSING)
    out.truncate()
    out.flush()
    os.fsync(out.fileno())
    return length, n


def snapshot(spark: SparkSession, ledger: str, path: str) -> int:
    """The whole ledger as one JSON array, written row by row and put in place of the old one by a
    rename, on a file system that the driver shares. Returns the number of rows."""
    temporary, state = f"{path}.{uuid.uuid4().hex}", parts_state(ledger)
    with open(temporary, "wb") as out:
        out.write(b"[")
        length, n = _put(out, read(spark, ledger), 0)
    os.replace(temporary, path)
    _mark(path, length, n, state)
    return n


def snapshot_checked(spark: SparkSession, ledger: str, path: str) -> bool:
    """Write the snapshot anew unless it is whole and holds the ledger as it is. Returns whether it was written."""
    mark = _marked(path)
    current = mark is not None and mark["state"] == parts_state(ledger) and os.path.getsize(path) == mark["length"] + len(CLOSING)
    if not current and os.path.isdir(ledger):
        snapshot(spark, ledger, path)
        return True
    return False


@contextmanager
def snapshot_follows(ledger: str, path: str, rows: DataFrame) -> Iterator[None]:
    """Within it `rows` are added to the ledger; then they are added to the snapshot, in place of its
    closing bracket, so a batch writes its own rows only.

    A mark beside the snapshot has its length without the bracket and the ledger's state. What lies
    behind that length was cut off and is written over; where the mark, the snapshot and the
    ledger before the batch do not agree, the snapshot is written anew.
    """
    mark, before = _marked(path), parts_state(ledger)
    yield
    if mark is None or mark["state"] != before:
        snapshot(rows.sparkSession, ledger, path)
        return
    with open(path, "r+b") as out:
        out.seek(mark["length"])
        length, n = _put(out, rows, mark["rows"])
    _mark(path, length, n, parts_state(ledger))


def upserted(held: DataFrame, new: DataFrame, key: str = "file") -> DataFrame:
    """held with the rows of `new` in place of those of the same key; of several new rows of a
    key the greatest stays, so that one does."""
    rest = F.struct(*[c for c in new.columns if c != key])
    # maps have no order; rows with any are compared as JSON
    order = F.to_json(rest) if "map<" in new.drop(key).schema.simpleString() else rest
    one = new.groupBy(key).agg(F.max_by(rest, order).alias("row")).select(key, "row.*").select(*new.columns)
    return held.join(one.select(key), key, "left_anti").unionByName(one)


def extended(vocabulary: DataFrame, new: DataFrame, key: str = "name") -> DataFrame:
    """vocabulary and the new rows whose names it lacks, the least description of each."""
    fresh = new.where(F.coalesce(F.trim(key), F.lit("")) != "").groupBy(key).agg(*[F.min(c).alias(c) for c in vocabulary.columns if c != key])
    return vocabulary.unionByName(fresh.join(vocabulary.select(key), key, "left_anti").select(*vocabulary.columns))
