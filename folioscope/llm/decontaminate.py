"""Benchmark decontamination by SimHash over item-sized windows.

Texts and benchmark items become words (letters, digits and bytes above 127,
ASCII lower-cased) and 5-word shingles, hashed to 64 bits. A window of a text,
as many words long as an item, gets a SimHash in which each shingle counts as
often as it occurs; prefix sums over the shingles' bits give all windows of a
text at once. Items are found by a multi-index over eight 8-bit blocks of their
fingerprints: two fingerprints at most 23 bits apart agree in some block up to two
bits, so looking up every block's neighbours of distance two misses none of them.
Each candidate is then verified by the exact weighted similarity of shingle
multisets (sum of minima over sum of maxima), 0.8 or more.

Windows without any shingle of an item of their size have similarity 0 with all of
them; they are passed over, which loses nothing. The index travels as a broadcast of
flat arrays, of at most `block_bytes` in all (an item at least); more items take further
passes. Windows meet the items of their size in blocks of `MEETINGS` pairs.

Items of fewer than five words have no shingle and never match; so do null and
empty texts. A text with fewer words than an item is one window. Very long texts go
through whole, a text at a time. Windows of one item that tie are told by the first of
them, and repeated items are told once. Repeated rows keep a row each; an empty table gives
an empty one, and an empty benchmark finds nothing. contamination() replaces a column named like
its result; clean() leaves all columns as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, free, pieces, worker_state

WORDS, SIMILARITY, RADIUS, NEAR = 5, 0.8, 23, 2
ODD, INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
STEP = np.uint64(0xD6E8FEB86659FD93)
FILTER_BITS = 20
#: Windows times items that are compared at once.
MEETINGS = 1 << 22


def word_bytes() -> np.ndarray:
    out = np.zeros(256, np.uint8)
    for a, b in (("a", "z"), ("0", "9")):
        out[ord(a) : ord(b) + 1] = np.arange(ord(a), ord(b) + 1)
    out[ord("A") : ord("Z") + 1] = out[ord("a") : ord("z") + 1]
    out[128:] = np.arange(128, 256)
    return out


FOLD = word_bytes()
CODES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * STEP
    x = (x ^ (x >> np.uint64(29))) * ODD
    return x ^ (x >> np.uint64(32))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ODD and of its inverse, kept by the worker."""
    state = worker_state()
    if len(getattr(state, "powers", ((),))[0]) < n:
        both = []
        for base in (ODD, INVERSE):
            a = np.full(n + n // 4, base, np.uint64)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        state.powers = tuple(both)
    return state.powers


def shingles(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 5-word runs (of neighbouring texts' words too), one for each
    word, and the number of words before each text."""
    raw = FOLD[np.frombuffer(data, np.uint8)]
    n = len(raw)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = raw > 0
    first = offsets[:-1][offsets[:-1] < n]
    begin = solid[1:-1] & ~solid[:-2]
    begin[first] |= solid[1:-1][first]
    finish = solid[1:-1] & ~solid[2:]
    before = first[first > 0] - 1
    finish[before] |= solid[1:-1][before]
    a, b = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(CODES[raw] * up[:n], out=total[1:])
    word = mixed((total[b] - total[a]) * down[a])
    out = np.zeros(len(word), np.uint64)
    if len(word) >= WORDS:
        run = word[: len(word) - WORDS + 1].copy()
        for j in range(1, WORDS):
            run = run * STEP + word[j : len(word) - WORDS + 1 + j]
        out[: len(run)] = mixed(run)
    return out, np.searchsorted(a, offsets)


def simhashes(hashes: np.ndarray, width: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of hashes[s : s + width] for each s; a window may end early."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(hashes) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:], dtype=np.int32)
    ends = np.minimum(starts + width, len(hashes))
    return np.packbits((total[ends] - total[starts]) * 2 > (ends - starts)[:, None], axis=1, bitorder="little").view("<u8").ravel()


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller over sum of larger multiplicities of two shingle lists."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    both = np.minimum(n[i], m[j]).sum()
    return float(both / (len(a) + len(b) - both)) if len(a) + len(b) else 0.0


@dataclass
class Index:
    """Items by size in words: their shingles, fingerprints and block tables."""

    ids: dict[int, list] = field(default_factory=dict)
    hashes: dict[int, np.ndarray] = field(default_factory=dict)  # items x shingles: as many for each item of a size
    prints: dict[int, np.ndarray] = field(default_factory=dict)
    tables: dict[int, np.ndarray] = field(default_factory=dict)
    known: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    places: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))  # of each known shingle in `sizes`
    sizes: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))  # sizes that hold each known shingle
    filter: np.ndarray = field(default_factory=lambda: np.zeros(1 << FILTER_BITS, bool))


def item_shingles(text: str) -> np.ndarray:
    data = text.encode()
    h, words = shingles(data, np.array([0, len(data)])) if data else (np.zeros(0, np.uint64), np.zeros(2, np.int64))
    return h[: max(0, int(words[1]) - WORDS + 1)]


def weight(text: str) -> int:
    """Bytes of the index that an item of this text takes, at most: a shingle, its place and
    size for each word, block tables, and its name."""
    return 24 * (text.count(" ") + len(text) // 2 + 1) + 8 * 256 + 200


def indexed(items: list[tuple[object, str]]) -> Index:
    index = Index()
    near = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :]) <= NEAR
    lists: dict[int, list[np.ndarray]] = {}
    for item, text in items:
        h = item_shingles(text or "")
        if len(h):
            index.ids.setdefault(len(h) + WORDS - 1, []).append(item)
            lists.setdefault(len(h) + WORDS - 1, []).append(h)
    if not lists:
        return index
    for n, some in lists.items():
        index.hashes[n] = np.stack(some)
        index.prints[n] = np.concatenate([simhashes(h, len(h), np.zeros(1, np.int64)) for h in some])
        blocks = index.prints[n].view(np.uint8).reshape(-1, 8)
        index.tables[n] = np.stack([near[:, blocks[:, k]] for k in range(8)])
    held = np.unique(np.concatenate([np.stack([h.ravel(), np.full(h.size, n, np.uint64)], 1) for n, h in index.hashes.items()]), axis=0)
    index.known, first = np.unique(held[:, 0], return_index=True)
    index.places, index.sizes = np.append(first, len(held)), held[:, 1].astype(np.int32)
    index.filter[index.known >> np.uint64(64 - FILTER_BITS)] = True
    return index


def hits(hashes: np.ndarray, n_words: int, seeds: np.ndarray, index: Index) -> list[tuple[object, int, int, float]]:
    """(item, first word, words, similarity) of one text; `hashes` are its shingles."""
    out = []
    by_size: dict[int, list[int]] = {}
    for p, k in zip(seeds.tolist(), np.searchsorted(index.known, hashes[seeds]).tolist(), strict=True):
        for n in index.sizes[index.places[k] : index.places[k + 1]].tolist():
            by_size.setdefault(n, []).append(p)
    for n, places in by_size.items():
        width = n - WORDS + 1
        last = max(0, n_words - n)
        cover = np.zeros(last + 2, np.int32)  # windows that hold a seed
        p = np.array(places)
        np.add.at(cover, np.clip(p - width + 1, 0, last), 1)
        np.add.at(cover, np.clip(p, 0, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        block = max(1, MEETINGS // len(index.ids[n]))
        for k in range(0, len(starts), block):
            part = starts[k : k + block]
            a = part[0]
            fps = simhashes(hashes[a : part[-1] + width], width, part - a)
            blocks = fps.view(np.uint8).reshape(-1, 8)
            tables = index.tables[n]
            found = tables[0][blocks[:, 0]].copy()
            for b in range(1, 8):
                found |= tables[b][blocks[:, b]]
            w, q = np.nonzero(found)
            apart = np.bitwise_count(fps[w] ^ index.prints[n][q])
            close = apart <= RADIUS
            w, q, apart = w[close], q[close], apart[close]
            order = np.lexsort((w, apart, q))
            done = set()
            for i in order.tolist():
                if (item := int(q[i])) in done:
                    continue
                s = int(part[w[i]])
                sim = weighted_similarity(hashes[s : s + width], index.hashes[n][item])
                if sim >= SIMILARITY:
                    done.add(item)
                    out.append((index.ids[n][item], s, min(n, n_words), sim))
    best: dict = {}
    for x in out:
        if x[0] not in best or x[3] > best[x[0]][3]:
            best[x[0]] = x
    return list(best.values())


def blocks_of(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """Items in blocks whose index is bounded, streamed to the driver."""
    part, size = [], 0
    for r in benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").toLocalIterator():
        own = weight(r["text"])
        if part and size + own > block_bytes:
            yield part
            part, size = [], 0
        part.append((r["item_id"], r["text"]))
        size += own
    if part:
        yield part


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", block_bytes: int = 64 << 20, name: str = "hits") -> DataFrame:
    """docs with `name`: array of (item_id, start_word, n_words, similarity), empty for clean texts."""
    kind = next(f.dataType.simpleString() for f in benchmark.schema if f.name == "item_id")
    empty = f"array<struct<item_id:{kind},start_word:int,n_words:int,similarity:double>>"
    out = docs.withColumn(name, F.expr(f"cast(array() as {empty})"))
    for part in blocks_of(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(indexed(part))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch, data, off in pieces(batches, text):
                place = batch.schema.get_field_index(name)
                column = batch.column(place)
                if data and len(index.known):
                    h, words = shingles(data, off)
                    maybe = np.flatnonzero(index.filter[h >> np.uint64(64 - FILTER_BITS)])
                    at = np.minimum(np.searchsorted(index.known, h[maybe]), len(index.known) - 1)
                    maybe = maybe[index.known[at] == h[maybe]]
                    row = np.searchsorted(words, maybe, "right") - 1
                    inside = maybe + WORDS <= words[row + 1]  # shingles end within their text
                    maybe, row = maybe[inside], row[inside]
                    lists = None
                    for r in np.unique(row).tolist():
                        a, b = int(words[r]), int(words[r + 1])
                        found = hits(h[a : b - WORDS + 1], b - a, maybe[row == r] - a, index)
                        if found:
                            lists = lists or column.to_pylist()
                            lists[r] = lists[r] + [dict(zip(("item_id", "start_word", "n_words", "similarity"), x, strict=True)) for x in found]
                    if lists:
                        column = pa.array(lists, column.type)
                yield pa.RecordBatch.from_arrays([*batch.columns[:place], column, *batch.columns[place + 1 :]], names=batch.schema.names)

        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)
        out = arrow_map(out, run, ddl)
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of docs, as they are, that hold no benchmark item."""
    name = free(docs, "__hits")
    return contamination(docs, benchmark, name=name).where(F.size(name) == 0).select(*docs.columns)
