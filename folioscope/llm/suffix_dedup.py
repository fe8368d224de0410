"""Exact removal of repeated passages by merged Burrows-Wheeler orders.

A byte goes if a string of `length` bytes that covers it starts anywhere else.
Sorting all suffixes and refining their interleave unaligned would take up to
`length` passes over every byte of the corpus, so equal strings are first brought
into line:

1. Every string of `length` bytes has an anchor: among its `anchor`-byte substrings
   the leftmost one of least hash. Neighbouring strings of one text that share an
   anchor form a segment, so each string lies in exactly one segment, and equal
   strings have equal anchors at equal places in their segments.
2. Segments are counted by (anchor, hash of the segment). An anchor that occurs
   once holds no repeat. Equal segments are kept once, with their number.
3. The unlike segments of an anchor are shards that stand in line at the anchor.
   Each column of theirs is one step of the Burrows-Wheeler order: the interleave
   of all shards, sorted by what follows a column, is refined by a stable partition
   on the bytes of the column before it, and common prefixes of neighbours follow
   from range minima of the previous ones. No suffix is compared or sorted again,
   and a byte is touched once. Neighbours with a common prefix of `length` or more
   are an interval of repeats.
4. The intervals go back to all occurrences of each segment, and to the texts.

An anchor with more than `MOST` unlike segments would fill a task. Its segments are
laid out string by string instead, each `length`-byte string its own anchor, and
counted in a pre-aggregated sum; those that occur twice give the same intervals.

Texts travel twice: to where strings are cut out of them, and to where what repeats
is taken out. Both times they are compressed before the exchange.

Segments and texts are told apart by 128 bits of hash. Null texts count as empty;
texts shorter than `length` lose nothing. Very long texts are read in overlapping
parts. Repeated rows repeat one another and so lose their texts, if long enough;
each keeps its output row. Strings that tie for an anchor share it; the leftmost
place wins. An empty table gives an empty one; columns other than doc_id and the
text are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, forget, pieces, worker_state, written

LENGTH, ANCHOR = 400, 128
ODD, INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CODES = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
PLACE = np.uint64(24)
#: Bytes hashed at once, and strings merged at once unless one anchor has more.
CHUNK, MERGE = 1 << 20, 6000
#: Unlike segments of one anchor that a task merges at most.
MOST = 30_000


def mixed(x: np.ndarray, k: int = 0) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33)) ^ np.uint64(k)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    state = worker_state()
    if len(getattr(state, "suffix_powers", ((),))[0]) < n:
        both = []
        for base in (ODD, INVERSE):
            a = np.full(max(n, CHUNK + 4096), base, np.uint64)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        state.suffix_powers = tuple(both)
    return state.suffix_powers


def segments(data: bytes, offsets: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """(row, start, size, place of the anchor in it, anchor's hash, segment's hash) of
    all segments of texts laid end to end; at most 2^24 bytes."""
    n, wide = len(data), length - anchor + 1
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    if n < length or not (np.diff(offsets) >= length).any():
        return none
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(CODES[np.frombuffer(data, np.uint8)] * up[:n], out=total[1:])
    h = mixed((total[anchor:] - total[:-anchor]) * down[: n - anchor + 1])
    m = len(h)
    rows = -(-m // wide)
    key = np.full(rows * wide, (1 << 64) - 1, np.uint64)
    key[:m] = (h >> PLACE << PLACE) | np.arange(m, dtype=np.uint64)
    key = key.reshape(rows, wide)
    ahead = np.minimum.accumulate(key, 1).ravel()[wide - 1 : m]
    behind = np.minimum.accumulate(key[:, ::-1], 1)[:, ::-1].ravel()[: m - wide + 1]
    best = (np.minimum(ahead, behind) & np.uint64((1 << 24) - 1)).astype(np.int64)
    inside = np.zeros(len(best) + 1, np.int8)  # strings that do not leave their text
    long = np.diff(offsets) >= length
    np.add.at(inside, offsets[:-1][long], 1)
    np.add.at(inside, offsets[1:][long] - length + 1, -1)
    first = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    place = best[first]
    cut = np.ones(len(first), bool)
    cut[1:] = (place[1:] != place[:-1]) | (first[1:] != first[:-1] + 1)
    row = np.searchsorted(offsets, first, "right") - 1
    cut[1:] |= row[1:] != row[:-1]
    begin, at, row = first[cut], place[cut], row[cut]
    end = first[np.append(np.flatnonzero(cut)[1:] - 1, len(first) - 1)] + length
    whole = mixed((total[end] - total[begin]) * down[begin], 0x5DEECE66D) ^ mixed(((end - begin) * 4096 + (at - begin)).astype(np.uint64))
    return row, begin - offsets[row], end - begin, at - begin, h[at], whole


def repeats(strings: list[bytes], at: np.ndarray, group: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(first, last + 1) byte of each string that strings of `length` bytes cover which
    another string of its group has at the same distance from its anchor; (0, 0) if none.
    `at` are the anchors' places, `group` ascends."""
    m, lead = len(strings), length - anchor
    columns = lead + length
    sizes = np.fromiter(map(len, strings), np.int64, m)
    a = lead - at
    b = a + sizes
    grid = np.full((m, columns), 256, np.int16)
    grid[(np.arange(columns) >= a[:, None]) & (np.arange(columns) < b[:, None])] = np.frombuffer(b"".join(strings), np.uint8)
    grid = np.ascontiguousarray(grid.T)
    order, base = np.arange(m), group.astype(np.int64) * 257
    common = np.zeros(m + 1, np.int32)  # of each string in order with the one before it
    lo, hi = np.zeros(m, np.int64), np.zeros(m, np.int64)
    for c in range(columns - 1, -1, -1):
        symbol = grid[c].take(order)
        key = base.take(order) + symbol
        if (key[1:] >= key[:-1]).all():
            same = (key[1:] == key[:-1]) & (symbol[1:] < 256)
            common[1:-1] = np.where(same, common[1:-1] + 1, 0)
        else:
            turn = np.argsort(key, kind="stable")
            order, key, symbol = order[turn], key[turn], symbol[turn]
            same = (key[1:] == key[:-1]) & (symbol[1:] < 256)
            p, q = turn[:-1][same], turn[1:][same]
            least = common[q].copy()
            far = np.flatnonzero(q != p + 1)
            if len(far):
                ranges = np.empty(2 * len(far), np.int64)
                ranges[::2], ranges[1::2] = p[far] + 1, q[far] + 1
                least[far] = np.minimum.reduceat(common, ranges)[::2]
            common[:] = 0
            common[1:-1][same] = least + 1
        if c <= lead:
            hit = order[np.maximum(common[:-1], common[1:]) >= length]
            if len(hit):
                new = hit[hi[hit] == 0]
                hi[new] = c + length
                lo[hit] = c
    found = hi > 0
    return np.where(found, lo - a, 0), np.where(found, hi - a, 0)


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """doc_id, the text's bytes, and 128 bits that tell rows of unlike id or text apart."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select("doc_id", t.cast("binary").alias("bytes"), F.xxhash64(F.lit(1), t, "doc_id").alias("r1"), F.xxhash64(F.lit("second"), t, "doc_id").alias("r2"))


def packed(rows: DataFrame) -> DataFrame:
    """rows with `z`, the compressed bytes, in place of `bytes`."""
    fields = [f for f in rows.schema if f.name != "bytes"]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3)
        for batch in batches:
            z = [squeeze.compress(x.as_buffer()) for x in batch.column("bytes")]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(z, pa.binary())], names=[*names, "z"])

    return arrow_map(rows.select(*names, "bytes"), run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "z binary"]))


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Batches of packed() rows and their texts; some rows at a time."""
    back = zstandard.ZstdDecompressor()
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            part = batch.slice(k, 256)
            yield part, [back.decompress(x.as_buffer()) for x in part.column("z")]


def found_segments(rows: DataFrame, length: int, anchor: int) -> DataFrame:
    ddl = "anchor bigint, h bigint, r1 bigint, r2 bigint, start bigint, size smallint, place smallint"
    names = [x.split()[0] for x in ddl.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in pieces(batches, "bytes", CHUNK):
            r1, r2 = (batch.column(c).to_numpy() for c in ("r1", "r2"))
            # a text longer than a chunk is read in overlapping parts; a segment cut there
            # holds whole strings still
            spans = [(k, min(len(data), k + CHUNK + length - 1)) for k in range(0, max(len(data) - length + 1, 1), CHUNK)] if batch.num_rows == 1 else [(0, len(data))]
            for x, y in spans:
                row, start, size, place, anchors, h = segments(data[x:y], off if batch.num_rows > 1 else np.array([0, y - x]), length, anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v) for v in (anchors.view(np.int64), h.view(np.int64), r1[row], r2[row], start + x, size.astype(np.int16), place.astype(np.int16))],
                    names=names,
                )

    return arrow_map(rows.select("bytes", "r1", "r2"), run, ddl)


def cut_out(rows: DataFrame) -> DataFrame:
    """Bytes of the wanted segments of each packed text."""
    ddl = "anchor bigint, h bigint, n bigint, place smallint, many boolean, string binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in unpacked(batches):
            out: list[list] = [[], [], [], [], [], []]
            for text, want in zip(texts, batch.column("want").to_pylist(), strict=True):
                for w in want:
                    for column, v in zip(out, (w["anchor"], w["h"], w["n"], w["place"], w["many"], text[w["start"] : w["start"] + w["size"]]), strict=True):
                        column.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int16(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds, strict=True)], names=["anchor", "h", "n", "place", "many", "string"])

    return arrow_map(rows.select("z", "want"), run, ddl)


def merged(strings: DataFrame, length: int, anchor: int) -> DataFrame:
    """(anchor, h, lo, hi) for strings, sorted by anchor within partitions, that repeat in part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def done(t: pa.Table) -> pa.RecordBatch:
            anchors, h, n = (t.column(c).to_numpy() for c in ("anchor", "h", "n"))
            group = np.cumsum(np.concatenate([[0], anchors[1:] != anchors[:-1]]))
            lo, hi = repeats(t.column("string").to_pylist(), t.column("place").to_numpy().astype(np.int64), group, length, anchor)
            keep = (hi > 0) & (n < 2)
            return pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (anchors, h, lo, hi)], names=["anchor", "h", "lo", "hi"])

        for batch in batches:
            for k in range(0, batch.num_rows, MERGE):
                part = pa.Table.from_batches([batch.slice(k, MERGE)])
                t = part if rest is None else pa.concat_tables([rest, part])
                anchors = t.column("anchor").to_numpy()
                cut = int(np.argmax(anchors == anchors[-1]))  # the last anchor may go on
                if cut >= MERGE // 2:
                    yield done(t.slice(0, cut).combine_chunks())
                    t = t.slice(cut)
                rest = t
        if rest is not None and rest.num_rows:
            yield done(rest.combine_chunks())

    return arrow_map(strings, run, "anchor bigint, h bigint, lo bigint, hi bigint")


def counted(strings: DataFrame, length: int) -> DataFrame:
    """(anchor, h, lo, hi) like merged(), for anchors of any size: every string by itself."""
    rows = strings.select(F.col("string").alias("bytes"), F.col("anchor").alias("r1"), F.col("h").alias("r2"))
    single = found_segments(rows, length, length)
    twice = single.groupBy("anchor", "h").agg(F.count("*").alias("n")).where("n > 1").select("anchor", "h")
    return single.join(twice, ["anchor", "h"]).groupBy(F.col("r1").alias("anchor"), F.col("r2").alias("h")).agg(F.min("start").alias("lo"), F.max(F.col("start") + F.col("size")).alias("hi"))


def repeated_spans(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(packed rows with keys r1 and r2, spans to remove by r1 and r2 as a set of (lo, hi))."""
    rows = keyed(docs, text)
    found = written(found_segments(rows, length, anchor))
    unlike = found.groupBy("anchor", "h").agg(F.count("*").alias("n"), F.min(F.struct("r1", "r2", "start")).alias("at"), F.first("size").alias("size"), F.first("place").alias("place"))
    unlike = written(unlike.select("anchor", "h", "n", "at.r1", "at.r2", "at.start", "size", "place"))
    # counted by a pre-aggregated sum, not a window: a hot anchor does not meet in one task
    sizes = unlike.groupBy("anchor").agg(F.count("*").alias("others")).where("others > 1")
    shared = written(unlike.join(sizes, "anchor"))
    want = shared.groupBy("r1", "r2").agg(F.collect_list(F.struct("start", "size", "place", "anchor", "h", "n", (F.col("others") > most).alias("many"))).alias("want"))
    rows = packed(rows)
    strings = cut_out(rows.drop("doc_id").join(want.hint("shuffle_hash"), ["r1", "r2"]))
    many = shared.where(F.col("others") > most).limit(1).count() > 0
    strings = written(strings) if many else strings
    few = strings.where("not many").repartition("anchor").sortWithinPartitions("anchor", "h")
    part = merged(few, length, anchor)
    part = part.unionByName(counted(strings.where("many"), length)) if many else part
    part = part.groupBy("anchor", "h").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    whole = unlike.where("n > 1").select("anchor", "h", F.lit(0).cast("bigint").alias("lo"), F.col("size").cast("bigint").alias("hi"))
    verdicts = written(part.unionByName(whole))
    forget(unlike, shared, *([strings] if many else []))
    spans = found.join(verdicts, ["anchor", "h"]).select("r1", "r2", F.struct((F.col("start") + F.col("lo")).alias("lo"), (F.col("start") + F.col("hi")).alias("hi")).alias("span"))
    return rows, spans.groupBy("r1", "r2").agg(F.collect_set("span").alias("spans"))


def united(spans: list[dict] | None) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["lo"], s["hi"]) for s in spans or ()):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remaining(docs: DataFrame, text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, most: int = MOST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (binary: the remaining bytes), a row for each row."""
    rows, spans = repeated_spans(docs, text, length, anchor, most)
    kind = next(f.dataType.simpleString() for f in docs.schema if f.name == "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in unpacked(batches):
            kept, removed, runs = [], [], []
            for data, found in zip(texts, batch.column("spans").to_pylist(), strict=True):
                at, left = 0, []
                spans = united(found)
                for a, b in spans:
                    left.append(data[at:a])
                    at = b
                kept.append(b"".join([*left, data[at:]]))
                removed.append(sum(b - a for a, b in spans))
                runs.append(len(spans))
            columns = [batch.column("doc_id"), pa.array(list(map(len, texts)), pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    both = rows.join(spans.hint("shuffle_hash"), ["r1", "r2"], "left").select("doc_id", "z", "spans")
    return arrow_map(both, run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def digests(docs: DataFrame) -> DataFrame:
    """Numbers and SHA-256 of what remains, and the remaining text (a character that a cut
    broke shows as U+FFFD there; the digest is of the bytes)."""
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    return remaining(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"), left.alias("text"))
