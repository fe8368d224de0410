"""A table of rows by key on disk, hashed into buckets, of which an update rewrites those that it touches.

Each update writes the buckets it touches into a folder of its own. A manifest names the folder
that holds each bucket; the update counts from when its manifest has taken the place of the old
one, by a rename. An update that is killed leaves the store as it was, and folders that no
manifest names, which the next update removes. A reader goes by the manifest of its time; so
a folder goes only with the second update after the one that replaced it. The store lies on a
file system that the driver and all executors share; one update runs at a time.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.sinks.ledger import upserted

MANIFEST, BUCKETS = "manifest.json", 64


def manifest(path: str) -> dict | None:
    """What the store holds: key, schema, number of buckets, folder of each that has rows, folders that were replaced last; None without a store."""
    try:
        with open(f"{path}/{MANIFEST}", encoding="utf-8") as f:
            return json.load(f)
    except FileNotFoundError:
        return None


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _rows(spark: SparkSession, path: str, state: dict, wanted: list[str] | None = None) -> DataFrame:
    schema = T.StructType.fromJson(state["schema"])
    parts = [f"{path}/{folder}/__bucket={b}" for b, folder in state["held"].items() if wanted is None or b in wanted]
    return spark.read.schema(schema).parquet(*parts) if parts else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, keys: list | None = None) -> DataFrame:
    """The rows of the store, or those of some keys, for which only their buckets are read."""
    state = manifest(path)
    if state is None:
        raise FileNotFoundError(path)
    if keys is None:
        return _rows(spark, path, state)
    key = T.StructType.fromJson(state["schema"])[state["key"]]
    asked = spark.createDataFrame([(k,) for k in keys], T.StructType([key]))
    wanted = [str(r[0]) for r in asked.select(bucket_of(key.name, state["buckets"])).distinct().collect()]
    return _rows(spark, path, state, wanted).join(F.broadcast(asked.distinct()), key.name, "left_semi")


def update(new: DataFrame, path: str, key: str = "file", buckets: int = BUCKETS) -> list[int]:
    """Put rows into the store in place of those of the same keys; of several new rows of a key the greatest
    stays. A null key is ignored. The first update says the key, the schema and the number of buckets, which
    should be so large that a task holds one. Returns the buckets that were rewritten."""
    spark = new.sparkSession
    state = manifest(path) or {"key": key, "schema": new.schema.jsonValue(), "buckets": buckets, "held": {}, "replaced": []}
    schema = T.StructType.fromJson(state["schema"])
    if state["key"] != key or schema.fieldNames() != new.columns:
        raise ValueError(f"the store holds {schema.fieldNames()} by {state['key']}")
    folder = uuid.uuid4().hex
    os.makedirs(path, exist_ok=True)
    # written first, since what made the rows may be dear, and they are read twice
    staged = f"{path}/{folder}.new"
    try:
        new.where(F.col(key).isNotNull()).write.parquet(staged)
        rows = spark.read.schema(new.schema).parquet(staged)
        touched = sorted(r[0] for r in rows.select(bucket_of(key, state["buckets"])).distinct().collect())
        if not touched:
            return []
        old = _rows(spark, path, state, [str(b) for b in touched])
        whole = upserted(old, rows, key).select(*schema.fieldNames(), bucket_of(key, state["buckets"]).alias("__bucket"))
        whole.repartition(len(touched), "__bucket").write.partitionBy("__bucket").parquet(f"{path}/{folder}")
        before = set(state["held"].values())
        held = state["held"] | {str(b): folder for b in touched}
        gone = sorted(before - set(held.values()))
        _put(path, state | {"held": held, "replaced": gone})
        _swept(path, {*held.values(), *gone})
        return touched
    finally:
        shutil.rmtree(staged, ignore_errors=True)


def _put(path: str, state: dict) -> None:
    temporary = f"{path}/{MANIFEST}.{uuid.uuid4().hex}"
    with open(temporary, "w", encoding="utf-8") as f:
        json.dump(state, f)
        f.flush()
        os.fsync(f.fileno())
    os.replace(temporary, f"{path}/{MANIFEST}")


def _swept(path: str, wanted: set[str]) -> None:
    """Remove what no manifest names: folders of updates that were cut off, and those long replaced."""
    for name in os.listdir(path):
        if name != MANIFEST and name not in wanted and not name.endswith(".new"):
            shutil.rmtree(f"{path}/{name}", ignore_errors=True) if os.path.isdir(f"{path}/{name}") else os.remove(f"{path}/{name}")


def exported(spark: SparkSession, path: str, out: str) -> int:
    """The store as one JSON object, rows by their keys in order, put in place by a rename. Returns the number of rows."""
    state = manifest(path)
    key, temporary, n = state["key"], f"{out}.{uuid.uuid4().hex}", 0
    rest = [c for c in T.StructType.fromJson(state["schema"]).fieldNames() if c != key]
    rows = read(spark, path).select(F.col(key).cast("string").alias("k"), F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("v"))
    with open(temporary, "w", encoding="utf-8") as f:
        f.write("{")
        for r in rows.orderBy("k").toLocalIterator():
            f.write(("," if n else "") + f"\n{json.dumps(r['k'], ensure_ascii=False)}: {r['v']}")
            n += 1
        f.write("\n}\n")
    os.replace(temporary, out)
    return n
