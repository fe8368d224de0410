"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Only where that is unset and the master is local, a temporary folder is
    made and set; on a cluster an unset folder is an error.
    """
    name = spark.conf.get("spark.checkpoint.dir", None)
    if not name:
        if spark.sparkContext.getCheckpointDir():
            return spark.sparkContext.getCheckpointDir()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        name = tempfile.mkdtemp(prefix="shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(name)
    return name


def free(df: DataFrame, name: str) -> str:
    """The name, or the first longer one that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame) -> DataFrame:
    """Write df as Parquet under the shared folder and read it back: cuts lineage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*tables: DataFrame) -> None:
    """Remove tables that written() made, once nothing reads them any more."""
    for t in tables:
        spark = t.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def worker_state() -> types.ModuleType:
    """A namespace that lives as long as the Python worker does, for caches."""
    return sys.modules.setdefault("_worker_state", types.ModuleType("_worker_state"))


def utf8(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All bytes of a string column, nulls as empty, and the row offsets into them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    if data is None:
        return b"", np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return data[int(off[0]) : int(off[-1])].to_pybytes(), off - off[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[tuple[pa.RecordBatch, bytes, np.ndarray]]:
    """Cut batches so that each holds about `limit` bytes of text, one row at least."""
    for batch in batches:
        data, off = utf8(batch.column(column))
        a, n = 0, batch.num_rows
        while a < n:
            b = max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1)
            b = min(b, n)
            yield batch.slice(a, b - a), data[off[a] : off[b]], off[a : b + 1] - off[a]
            a = b


#: Bytes of a batch that an operator works on at once, about. Spark itself hands over at most
#: spark.sql.execution.arrow.maxBytesPerBatch (64 MB) and a row.
BATCH_BYTES = 4 << 20


def smaller(batches: Iterator[pa.RecordBatch], limit: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches, cut into runs of rows of about `limit` bytes, without a copy."""
    for batch in batches:
        step = max(1, batch.num_rows * limit // max(batch.nbytes, 1))
        for k in range(0, batch.num_rows, step):
            yield batch.slice(k, step)


def give_back() -> None:
    """Let what this process leaves unused go back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; then what the task leaves unused goes back to the system, as workers live on."""
    try:
        yield from batches
    finally:
        clear = getattr(worker_state(), "clear", None)
        if clear is not None:
            clear()
        give_back()


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], ddl: str) -> DataFrame:
    """mapInArrow with batches bounded by bytes, and memory given back at the end of each task."""
    return df.mapInArrow(lambda batches: released(run(smaller(batches))), ddl)
