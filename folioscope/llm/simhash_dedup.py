"""SimHash near-duplicates by pivot distance tables.

Texts become 64-bit fingerprints of their word shingles; fingerprints at `radius`
or fewer differing bits link, and linked ones form components. Copies share a
fingerprint, so only distinct fingerprints are compared.

Every fingerprint gets its Hamming distances to reference fingerprints (pivots).
By the triangle inequality two fingerprints within the radius differ by no more
than the radius in every coordinate, so a pair whose largest coordinate
difference exceeds it is discarded, and survivors are verified by their exact
distance. 64-bit fingerprints of unlike texts lie about 32 +- 4 bits from any
pivot, so one coordinate discards only about four pairs in ten, and the table must
not be entered by all pairs. It is entered by the coordinates of the one-bit
pivots: d(x, e_i) - d(x, 0) tells bit i. These are cut into `blocks` groups;
radius differing bits leave blocks - radius groups of coordinates equal, so two
linked fingerprints share a cell of one of the choose(blocks, radius) tables.
A cell with many members (a large group of near copies) is dealt to blocks, and a task returns
a spanning forest of its links, never all pairs. Each block is first met with itself and with one
of them, so rows grow in proportion. Links contract: where they make one component of a cell,
as near copies do, that is all. What is left of other cells meets the cell's largest
component and itself, block by block, so no link is lost; components are never met with themselves.

one_of_each() links texts by the same tables first, fingerprints being those of their sets of
shingles, and the sets of every linked pair decide. At the similarity that it asks for most
pairs differ in more bits than tables reach. For these, bands of least hashes (MinHash) of the same
shingles find further candidates, for sets that the tables leave apart.

Null and empty texts have fingerprint zero and link like any other; one_of_each() takes
them for copies of one another. Very long texts are hashed whole, shingle by shingle.
Bits that are set in exactly half of the shingles are zero. Repeated rows keep one output
row each in near_duplicates(), and one of them stays in one_of_each(). Null ids have no say
in a component's name, and a component of null ids alone has a null one. An empty table
gives an empty one. near_duplicates() looks at doc_id and the text alone; one_of_each()
leaves all columns as they are.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, forget, free, utf8, written
from folioscope.llm.graph import components

RADIUS = 4
#: Members of a cell that one task compares with one another at most, twice.
CELL = 512
PIVOTS = np.array([0, *(xxhash.xxh64_intdigest(f"pivot {i}".encode()) for i in range(23))], np.uint64)


def shingle_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of the ASCII-lower-cased word shingles, repeats included; the whole sequence if shorter."""
    parts = text.lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    joined = b" ".join(parts)
    if len(parts) < words:
        shingles = [joined]
    else:
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
        starts = [0, *(ends[: len(parts) - words] + 1).tolist()]
        shingles = map(joined.__getitem__, map(slice, starts, ends[words - 1 :].tolist()))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, 42) for s in shingles], np.uint64)


def simhash(h: np.ndarray) -> int:
    """Bits that are set in over half of the hashes; 0 of none."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: bytes, words: int = 4) -> int:
    return simhash(shingle_hashes(text, words))


def stirred(h: np.ndarray, k: int) -> np.ndarray:
    """Another hash of the same shingles; the same one for k = 0."""
    if not k:
        return h
    x = (h ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def fingerprints(docs: DataFrame, text: str = "text", words: int = 4, keep: tuple[str, ...] = ("doc_id",), number: int = 1) -> DataFrame:
    """`keep` columns and `fp`, the fingerprint as a signed long; with `number` over one,
    also fp1, fp2 and so on, of other hashes of the shingles."""
    fields = [f for f in docs.schema if f.name in keep]
    names = ["fp", *(f"fp{k}" for k in range(1, number))]
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), *(f"{n} bigint" for n in names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("__text"))
            cuts = off.tolist()
            hashes = (shingle_hashes(data[a:b], words) for a, b in zip(cuts, cuts[1:], strict=False))
            fps = np.array([[simhash(stirred(h, k)) for k in range(number)] for h in hashes], np.uint64).reshape(-1, number).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], *[pa.array(np.ascontiguousarray(fps[:, k])) for k in range(number)]], names=[*[f.name for f in fields], *names])

    return arrow_map(docs.select(*keep, F.col(text).cast("string").alias("__text")), run, ddl)


def blocks_for(n: int, radius: int = RADIUS) -> int:
    """Fewest blocks, from radius + 2 to radius + 6, whose cells hold 16 fingerprints by chance at most."""
    return next((b for b in range(radius + 2, radius + 6) if n <= 16 * 2 ** (64 * (b - radius) / b)), radius + 6)


#: Parts that the rows of a key are dealt to where they meet its count.
PARTS = 8


def met(rows: DataFrame, counts: DataFrame, *key: str, by: str = "node") -> DataFrame:
    """rows joined with one row for each key: a row of counts goes to `PARTS` parts of its key,
    and rows are dealt to them by the column `by`, so that a hot key does not meet in one task."""
    salted = rows.withColumn("__part", F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int"))
    spread = counts.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    return salted.join(spread, [*key, "__part"]).drop("__part")


def cells(distinct: DataFrame, blocks: int, radius: int = RADIUS) -> DataFrame:
    """(node, fp, i, key, n): one row for each table and fingerprint; cells with one member are left out."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    masks = [sum(((1 << (edges[i + 1] - edges[i])) - 1) << edges[i] for i in equal) for equal in itertools.combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    tables = F.array(*[F.struct(F.lit(i).cast("smallint").alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])
    rows = distinct.select("node", "fp", F.explode(tables).alias("cell")).select("node", "fp", "cell.i", "cell.key")
    # counted by a pre-aggregated sum and joined, not by a window; most cells are chance pairs, so
    # counts are not dealt to parts: a crowded cell's narrow rows are left to the skew join
    return rows.join(rows.groupBy("i", "key").agg(F.count("*").alias("n")).where("n > 1"), ["i", "key"])


def dealt(rows: DataFrame, others: Column) -> DataFrame:
    """(node, fp, i, key, p, q, side): each row at the meetings of its block `own` with the blocks `others`
    of its cell. In that of a block with itself all sides are -1, else they are the rows' own blocks."""
    meets = F.transform(others, lambda k: F.struct(F.least(k, F.col("own")).alias("p"), F.greatest(k, F.col("own")).alias("q")))
    rows = rows.select("node", "fp", "i", "key", "own", F.explode(meets).alias("m"))
    return rows.select("node", "fp", "i", "key", "m.p", "m.q", F.when(F.col("m.p") == F.col("m.q"), -1).otherwise(F.col("own")).alias("side"))


def blocked(parts: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), "fp"), parts).cast("int")


def first_meetings(rows: DataFrame, cell: int = CELL) -> DataFrame:
    """Blocks of about `cell` rows of a cell meet themselves and the first of them: at most three times the rows, about."""
    parts = F.ceil(F.col("n") / cell).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("own", blocked(F.col("parts")))
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    return dealt(rows, F.when(F.col("own") == 0, every).otherwise(F.array(F.lit(0), F.col("own"))))


def other_meetings(rows: DataFrame, roots: DataFrame, cell: int = CELL) -> DataFrame:
    """What first_meetings() may have missed in cells of several components, of roots (node, root):
    rows beside the cell's largest component are met with all of the cell."""
    rows = rows.where(F.col("n") > cell).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    sizes = rows.groupBy("i", "key", "root").agg(F.count("*").alias("size"))
    # the first blocks are the rest's, those behind them the largest component's
    largest = sizes.groupBy("i", "key").agg(F.max(F.struct("size", "root")).alias("top"), F.sum("size").alias("all")).where("top.size < all")
    largest = largest.select("i", "key", F.col("top.root").alias("top"), F.ceil((F.col("all") - F.col("top.size")) / cell).cast("int").alias("rest"), F.ceil(F.col("top.size") / cell).cast("int").alias("main"))
    rows = met(rows, largest, "i", "key")
    inside = F.col("root") == F.col("top")
    rows = rows.withColumn("own", F.when(inside, F.col("rest") + blocked(F.col("main"))).otherwise(blocked(F.col("rest"))))
    return dealt(rows, F.sequence(F.lit(0), F.when(inside, F.col("rest")).otherwise(F.col("rest") + F.col("main")) - 1))


def spanning(n: int, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of links between n items; earlier links are preferred."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    x_out, y_out = [], []
    for x, y in zip(left.tolist(), right.tolist(), strict=True):
        a, b = find(x), find(y)
        if a != b:
            root[max(a, b)] = min(a, b)
            x_out.append(x)
            y_out.append(y)
    return np.array(x_out, np.int64), np.array(y_out, np.int64)


def linked(group: np.ndarray, fps: np.ndarray, pivots: np.ndarray, radius: int, side: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """A spanning forest of the links within each group of a sorted array; also how
    many pairs the pivots left to verify. With `side`, rows of unlike sides only."""
    n = len(fps)
    coords = np.bitwise_count(fps[:, None] ^ pivots[None, :]).astype(np.int8)
    pairs, survivors = [], 0
    alive = np.arange(n - 1)
    shift = 1
    while len(alive):
        alive = alive[alive + shift < n]
        alive = alive[group[alive] == group[alive + shift]]
        i, j = alive, alive + shift
        if side is not None:
            apart = side[i] != side[j]
            i, j = i[apart], j[apart]
        for k in range(coords.shape[1]):  # the pivots discard
            near = np.abs(coords[i, k] - coords[j, k]) <= radius
            i, j = i[near], j[near]
        survivors += len(i)
        bits = np.bitwise_count(fps[i] ^ fps[j])
        close = bits <= radius
        pairs.append(np.stack([bits[close].astype(np.int64), i[close], j[close]]))
        shift += 1
    found = np.concatenate(pairs, 1) if pairs else np.zeros((3, 0), np.int64)
    # the closest pairs first, so that the forest holds the surest links
    order = np.argsort(found[0], kind="stable")
    return *spanning(n, found[1][order], found[2][order]), survivors


def forests(meetings: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): a spanning forest of the links of each meeting."""
    rows = meetings.repartition("i", "key", "p", "q").sortWithinPartitions("i", "key", "p", "q", "fp")
    pivots = PIVOTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def found(t: pa.Table) -> pa.RecordBatch:
            keys = [t.column(c).to_numpy() for c in ("i", "key", "p", "q")]
            new = np.concatenate([[True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys])])
            fps = t.column("fp").to_numpy().astype(np.int64).view(np.uint64)
            side, group = t.column("side").to_numpy(), np.cumsum(new)
            # a block by itself compares all of its rows, two blocks only across
            mixed = np.where(side < 0, np.arange(len(side)) + 2, np.where(side == t.column("p").to_numpy(), 0, 1))
            i, j, _ = linked(group, fps, pivots, radius, mixed)
            nodes = t.column("node").to_numpy()
            return pa.RecordBatch.from_arrays([pa.array(nodes[i]), pa.array(nodes[j])], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])]).combine_chunks()
            # the last group may go on in the next batch
            keys = [t.column(c).to_numpy() for c in ("i", "key", "p", "q")]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            cut = int(np.argmax(same))
            if cut:
                yield found(t.slice(0, cut))
            rest = t.slice(cut)
        if rest is not None and rest.num_rows:
            yield found(rest)

    return arrow_map(rows, run, "a bigint, b bigint")


def links(distinct: DataFrame, blocks: int | None = None, radius: int = RADIUS, cell: int = CELL) -> DataFrame:
    """(a, b): links between nodes whose fingerprints are within the radius, as forests that
    connect what all such pairs connect. `distinct` has unlike rows of (node, fp)."""
    distinct = written(distinct)
    rows = written(cells(distinct, blocks or blocks_for(distinct.count(), radius), radius))
    forget(distinct)
    found = written(forests(first_meetings(rows, cell), radius))
    if rows.where(F.col("n") > cell).isEmpty():
        forget(rows)
        return found
    more = written(forests(other_meetings(rows, components(found), cell), radius))
    forget(rows)
    return found.unionByName(more)


def classes(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root): the component of every fingerprint that has a link."""
    distinct = fps.select(F.col("fp").alias("node"), "fp").distinct()
    return components(links(distinct, radius=radius)).select(F.col("node").alias("fp"), "root")


def near_duplicates(docs: DataFrame, text: str = "text", words: int = 4, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per input row."""
    fps = written(fingerprints(docs, text, words))
    # one row per distinct fingerprint: the smallest doc_id that has it
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = classes(fps, radius)
    named = roots.join(least, "fp").groupBy("root").agg(F.min("least").alias("named"))
    of = least.join(met(roots, named, "root", by="fp").select("fp", "named", F.lit(True).alias("linked")), "fp", "left")
    of = of.select("fp", F.when(F.col("linked"), F.col("named")).otherwise(F.col("least")).alias("component_id"))
    return fps.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: For groups by similarity: words a shingle, least similarity, bands and minima a band. A pair
#: of similarity s shares no band by a chance of (1 - s ** MINIMA) ** BANDS: 3e-6 at 0.8.
WORDS, SIMILAR, BANDS, MINIMA = 5, 0.8, 24, 4
#: Shingles that a block of a cell holds, on average, at most.
BLOCK = 1 << 19


def odd(name: str, n: int) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(f"{name} {i}".encode()) | 1 for i in range(n)], np.uint64)


def band_keys(h: np.ndarray, bands: int, minima: int) -> np.ndarray:
    """A hash of each band's minima, by a factor each, over the shingle hashes; none of none."""
    if not len(h):
        return np.zeros(0, np.int64)
    factors = odd_factors(bands * minima)
    least = np.full(bands * minima, (1 << 64) - 1, np.uint64)
    for k in range(0, len(h), 4096):
        least = np.minimum(least, (h[k : k + 4096] * factors[:, None]).min(1))
    keys = (least ^ least >> np.uint64(29)) * odd_mixers(bands * minima)
    return (keys.reshape(bands, minima).sum(1, dtype=np.uint64)).view(np.int64)


@functools.cache
def odd_factors(n: int) -> np.ndarray:
    return odd("factor", n)


@functools.cache
def odd_mixers(n: int) -> np.ndarray:
    return odd("mixer", n)


def sketches(docs: DataFrame, text: str, words: int, keep: tuple[str, ...], bands: int, minima: int) -> DataFrame:
    """`keep` columns, `node`, 128 bits of hash of the set of shingles, `fp`, its fingerprint, in which
    each shingle counts once, and `bands`, its band keys."""
    fields = [f for f in docs.schema if f.name in keep]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "node binary, fp bigint, bands array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("__text"))
            cuts = off.tolist()
            nodes, fps, keys = [], [], []
            for a, b in zip(cuts, cuts[1:], strict=False):
                h = np.unique(shingle_hashes(data[a:b], words))
                nodes.append(xxhash.xxh3_128_digest(h.tobytes(), 7))
                fps.append(simhash(h))
                keys.append(band_keys(h, bands, minima))
            prints = pa.array(np.array(fps, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], pa.array(nodes, pa.binary()), prints, pa.array(keys, pa.list_(pa.int64()))], names=[*[f.name for f in fields], "node", "fp", "bands"])

    return arrow_map(docs.select(*keep, F.col(text).cast("string").alias("__text")), run, ddl)


def shingle_sets(docs: DataFrame, text: str, words: int, keep: tuple[str, ...]) -> DataFrame:
    """`keep` columns and the set of shingle hashes."""
    fields = [f for f in docs.schema if f.name in keep]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "shingles array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, off = utf8(batch.column("__text"))
            cuts = off.tolist()
            sets = [np.unique(shingle_hashes(data[a:b], words)).view(np.int64) for a, b in zip(cuts, cuts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], pa.array(sets, pa.list_(pa.int64()))], names=[*[f.name for f in fields], "shingles"])

    return arrow_map(docs.select(*keep, F.col(text).cast("string").alias("__text")), run, ddl)


def similar(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) whose shingle sets (node, shingles) are that similar by Jaccard; two empty sets are."""
    a, b = (sets.select(F.col("node").alias(n), F.col("shingles").alias(f"s{n}")) for n in ("a", "b"))
    both = edges.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("sa", "sb")))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return both.where((union == 0) | (F.col("common") >= similarity * union)).select("a", "b")


def printed(first: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) between nodes whose fingerprints are within the radius, by the pivot tables; nodes
    of one fingerprint link to the least of them."""
    least = first.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("n"))
    near = links(least.select(F.col("fp").alias("node"), "fp"), radius=radius)
    of = lambda n: least.select(F.col("fp").alias(n), F.col("least").alias(f"least_{n}"))
    near = near.join(of("a"), "a").join(of("b"), "b").select(F.col("least_a").alias("a"), F.col("least_b").alias("b"))
    same = met(first.select("node", "fp"), least.where("n > 1").select("fp", "least"), "fp").where("node <> least")
    return near.unionByName(same.select(F.col("least").alias("a"), F.col("node").alias("b"))).distinct()


def apart(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Edges (a, b) whose ends roots (node, root) do not connect."""
    of = lambda n: roots.select(F.col("node").alias(n), F.col("root").alias(f"root_{n}"))
    both = edges.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return both.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def alike(sets: list[np.ndarray], similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the sets that are that similar by Jaccard: counts of common shingles, by matrix products."""
    n, sizes = len(sets), np.array([len(s) for s in sets], np.int64)
    _, place, times = np.unique(np.concatenate([np.zeros(0, np.int64), *sets]), return_inverse=True, return_counts=True)
    many = times[place] > 1
    owner, column = np.repeat(np.arange(n), sizes)[many], (np.cumsum(times > 1) - 1)[place[many]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((n, n), np.float32)
    for c in range(0, int(column[-1]) + 1 if len(column) else 0, 1024):
        a, b = np.searchsorted(column, [c, c + 1024])
        dense = np.zeros((n, 1024), np.float32)
        dense[owner[a:b], column[a:b] - c] = 1
        common += dense @ dense.T
    exact = common.astype(np.float64)
    return np.nonzero(np.triu(exact >= similarity * (sizes[:, None] + sizes[None, :] - exact), 1))


def contested(rows: DataFrame, known: DataFrame, sets: DataFrame, similarity: float, cell: int = CELL) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between unlike roots, and a table to forget once they are read.

    Every pair of a cell that holds nodes of several known roots is verified. Large cells are
    cut into blocks that meet pairwise, with their sets.
    """
    rows = rows.where("n > 2").join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
    held = rows = written(rows.join(sets.select("node", "size"), "node").select("node", "key", "n", "root", "size"))
    several = rows.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.sum("size").alias("total")).where("low <> high")
    rows = met(rows, several.select("key", "total"), "key")
    parts = F.greatest(F.ceil(F.col("n") / cell), F.ceil(F.col("total") / BLOCK)).cast("int")
    rows = rows.withColumn("parts", parts).withColumn("own", F.pmod(F.xxhash64(F.lit("block"), "node"), F.col("parts")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: (k != F.col("own")) | (F.col("parts") == 1))
    meets = F.transform(others, lambda k: F.struct(F.least(k, F.col("own")).alias("p"), F.greatest(k, F.col("own")).alias("q")))
    rows = rows.select("node", "key", "root", F.explode(meets).alias("m")).select("node", "key", "root", "m.p", "m.q")
    rows = rows.join(sets.select("node", "shingles"), "node").repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def changes(t: pa.Table) -> np.ndarray:
            keys = [t.column(c).to_numpy() for c in ("key", "p", "q")]
            return np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1

        def found(t: pa.Table, cuts: list[int]) -> Iterator[pa.RecordBatch]:
            for a, b in zip(cuts, cuts[1:], strict=False):
                group = t.slice(a, b - a)
                nodes, roots = (np.array(group.column(c).to_pylist(), object) for c in ("node", "root"))
                i, j = alike([s.values.to_numpy() for s in group.column("shingles")], similarity)
                apart = roots[i] != roots[j]
                i, j = spanning(len(nodes), i[apart], j[apart])
                yield pa.RecordBatch.from_arrays([pa.array(nodes[i], pa.binary()), pa.array(nodes[j], pa.binary())], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            if not t.num_rows:
                continue
            # the last group may go on in the next batch
            cuts = [0, *changes(t).tolist()]
            yield from found(t, cuts)
            rest = t.slice(cuts[-1])
        if rest is not None and rest.num_rows:
            yield from found(rest, [0, rest.num_rows])

    return arrow_map(rows, run, "a binary, b binary"), held


def one_of_each(docs: DataFrame, text: str = "text", words: int = WORDS, similarity: float = SIMILAR, bands: int = BANDS, minima: int = MINIMA, cell: int = CELL) -> DataFrame:
    """Rows of docs, one for each group of near-duplicates: that of the smallest doc_id (null
    ids last), then the smallest hash of its text. Same columns.

    Texts link if their sets of `words`-word shingles are `similarity` similar. Equal sets
    (by 128 bits of hash) are copies. Sets whose SimHash fingerprints the pivot tables link are
    verified first. Sets that agree in one of `bands` bands of `minima` least hashes share a cell:
    every pair of a cell is verified, unless links that were verified connect it already, first each
    set with its cell's smallest, then all pairs of the cells that this leaves in several pieces.
    """
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    r1, r2 = free(docs, "__r1"), free(docs, "__r2")
    keyed = docs.withColumns({r1: F.xxhash64(F.lit(1), t, "doc_id"), r2: F.xxhash64(F.lit("second"), t, "doc_id")})
    ids = keyed.select("doc_id", F.col(r1).alias("r1"), F.col(r2).alias("r2"), F.col(text).alias("text"))
    found = written(sketches(ids, "text", words, ("doc_id", "r1", "r2"), bands, minima))
    # a text for each set of shingles, by a pre-aggregated minimum: copies go before any join
    who = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "r1", "r2")
    first = written(found.groupBy("node").agg(F.min(who).alias("who"), F.first("fp").alias("fp"), F.first("bands").alias("bands")))
    forget(found)
    near = written(printed(first))
    tables = first.select("node", F.posexplode("bands").alias("i", "key")).select("node", F.xxhash64("i", "key").alias("key"))
    shared = tables.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1")
    rows = written(met(tables, shared, "key"))
    needed = rows.select("node").unionByName(near.select(F.col("a").alias("node"))).unionByName(near.select(F.col("b").alias("node"))).distinct()
    shown = first.join(needed, "node", "left_semi").select("node", "who.r1", "who.r2")
    sets = shingle_sets(ids.select("r1", "r2", "text").join(shown.hint("shuffle_hash"), ["r1", "r2"]).select("node", "text"), "text", words, ("node",)).dropDuplicates(["node"])
    sets = written(sets.withColumn("size", F.size("shingles")))
    stars = rows.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    near_links = written(similar(near, sets.select("node", "shingles"), similarity))
    star_links = written(similar(apart(stars, components(near_links, contract=True)), sets.select("node", "shingles"), similarity))
    known = near_links.unionByName(star_links)
    more, held = contested(rows, components(known, contract=True), sets, similarity, cell)
    more = written(more)
    roots = components(known.unionByName(more), contract=True)
    forget(near, rows, sets, near_links, star_links, more, held)
    kept = first.join(roots, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("who").alias("who")).select(F.col("who.r1").alias(r1), F.col("who.r2").alias(r2))
    # repeated rows agree in id and text; one of them stays
    return keyed.join(kept.hint("shuffle_hash"), [r1, r2], "left_semi").dropDuplicates([r1, r2]).select(*docs.columns)
