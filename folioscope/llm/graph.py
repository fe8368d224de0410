"""Connected components of a link table, distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, forget, written

#: Links that a task contracts at once, about.
CHUNK = 1 << 17


def hung(u: pa.Array, v: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Links (u, v) as stars: every node but the smallest of its component, and that smallest one."""
    both = pc.dictionary_encode(pa.concat_arrays([u, v]))
    order = pc.array_sort_indices(both.dictionary)
    nodes, rank = both.dictionary.take(order), np.argsort(order.to_numpy())
    ends = rank[both.indices.to_numpy()].tolist()
    root = list(range(len(nodes)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(ends[: len(u)], ends[len(u) :], strict=True):
        x, y = find(x), find(y)
        root[max(x, y)] = min(x, y)
    top = np.array([find(x) for x in range(len(root))], np.int64)
    low = np.flatnonzero(top != np.arange(len(top)))
    return nodes.take(pa.array(low)), nodes.take(pa.array(top[low]))


def contracted(pairs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Links (u, v) that connect what those of pairs do: the stars of each `chunk` of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stars() -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            return pa.RecordBatch.from_arrays(list(hung(*(t.column(c).combine_chunks() for c in ("u", "v")))), names=["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= chunk:
                yield stars()
                held = []
        if sum(x.num_rows for x in held):
            yield stars()

    return arrow_map(pairs, run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema))


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, contract: bool = False) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Alternating large-star and small-star steps; every step hangs nodes below the
    smallest neighbour known, so hubs never gather their neighbours in one row:
    the minimum is a pre-aggregated aggregate. Each round is written to the
    shared folder, and only the number of links and a checksum come to the
    driver. Self links and repeated links are allowed; nulls are dropped. With
    `contract`, tasks hang their own links first: few links, in one task, then take
    one round, which finds them settled, and the driver plans fewer.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null and u <> v").distinct()
    state = written(contracted(pairs) if contract else pairs)
    checksum = lambda: state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    seen = checksum() if contract else None
    for _ in range(rounds):
        both = state.select("u", "v").unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u")
        small = small.select("v", "m").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        last, state = state, written(small)
        forget(last)
        now = checksum()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    # settled links are stars: u hangs below its root v
    return state.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
