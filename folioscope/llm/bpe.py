"""Byte-level BPE encoding and decoding without regular expressions.

Pre-tokenisation runs on arrays. Every code point becomes one of eight symbols
(letter, number, other, three kinds of white space, apostrophes that may start a
contraction). A finite automaton over these symbols knows where a pre-token
starts; as each symbol is a function from states to states and composing
functions is associative, the states are found by a blocked scan: blocks of
symbols are composed side by side, block functions are scanned by doubling, and
each block is replayed from its start state. The slices between boundaries go
through a pair-merging cache that lives in the Python worker.

Null texts encode to no tokens, as empty ones do. Very long texts go through alone, in
arrays of their size; a pre-token of any length is merged in O(n log n). Pairs that tie
in rank are merged leftmost first. One output row per input row; repeated rows give
repeated results, an empty table none. Input columns are dealt with under private
names, so a column named like a result may be there unless it is kept.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, pieces, worker_state

# symbols
LETTER, NUMBER, OTHER, SPACE_MID, BLANK_LAST, SPACE_LAST, APOSTROPHE_2, APOSTROPHE_3 = range(8)
# states
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_SPACE, PREFIXED, TAIL_1, TAIL_2 = range(8)
#: White_Space of Unicode, and the letters of the pattern's contractions.
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
CONTRACTIONS_1, CONTRACTIONS_2 = "stmd", ("re", "ve", "ll")
#: Entries the merge cache may hold before it starts anew.
CACHE = 200_000
NONE = 1 << 40
BLOCK = 128


def automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, does a pre-token start here), by symbol (plus 8: first of a text) and state."""
    to, cut = np.zeros((16, 8), np.uint8), np.zeros((16, 8), bool)
    for state in range(8):
        for symbol, run in ((LETTER, IN_LETTERS), (NUMBER, IN_NUMBERS), (OTHER, IN_OTHER)):
            to[symbol, state], cut[symbol, state] = run, state not in (run, PREFIXED)
        for symbol, tail in ((APOSTROPHE_2, TAIL_1), (APOSTROPHE_3, TAIL_2)):
            inside = state in (IN_OTHER, PREFIXED)
            to[symbol, state], cut[symbol, state] = IN_OTHER if inside else tail, not inside
        to[SPACE_MID, state], cut[SPACE_MID, state] = IN_SPACE, state != IN_SPACE
        to[BLANK_LAST, state], cut[BLANK_LAST, state] = PREFIXED, True
        to[SPACE_LAST, state], cut[SPACE_LAST, state] = FRESH, True
    to[LETTER, TAIL_1], cut[LETTER, TAIL_1] = FRESH, False
    to[LETTER, TAIL_2], cut[LETTER, TAIL_2] = TAIL_1, False
    to[8:], cut[8:] = to[:8, FRESH][:, None], cut[:8, FRESH][:, None]
    return to, cut


def classes() -> np.ndarray:
    """Letter, number, other or (as SPACE_MID) white space, by code point."""
    import unicodedata

    kinds = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[WHITE_SPACE] = SPACE_MID
    return out


def symbols(points: np.ndarray, first: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Symbol of each code point; `first` are the places at which texts start."""
    n = len(points)
    kind = table[points]
    last = np.zeros(n, bool)
    last[first[1:] - 1] = True
    last[n - 1] = True
    solid_next = np.zeros(n, bool)
    solid_next[:-1] = kind[1:] != SPACE_MID
    solid_next &= ~last
    ends = (kind == SPACE_MID) & solid_next
    out = kind.copy()
    out[ends] = np.where(points[ends] == 0x20, BLANK_LAST, SPACE_LAST)
    for i in np.flatnonzero(points == 0x27):
        if last[i]:
            continue
        a = chr(points[i + 1])
        if a in CONTRACTIONS_1:
            out[i] = APOSTROPHE_2
        elif not last[i + 1] and a + chr(points[i + 2]) in CONTRACTIONS_2:
            out[i] = APOSTROPHE_3
    out[first] += 8
    return out


def monoid(to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions that sequences of symbols can make, numbered, identity first.

    Returns (number of the function after one more symbol, number of the
    composition, state reached from FRESH); a function is then one small number.
    """
    known = {tuple(range(8)): 0}
    queue = [tuple(range(8))]
    steps = []
    for f in queue:
        row = []
        for line in to:
            g = tuple(int(line[x]) for x in f)
            if g not in known:
                known[g] = len(known)
                queue.append(g)
            row.append(known[g])
        steps.append(row)
    both = [[known[tuple(g[x] for x in f)] for g in queue] for f in queue]
    return np.array(steps, np.int32), np.array(both, np.int32), np.array([f[FRESH] for f in queue], np.uint8)


def scan(symbol: np.ndarray, to: np.ndarray, functions: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """State before each symbol, by composing transition functions in blocks."""
    steps, both, reached = functions
    n = len(symbol)
    rows = -(-n // BLOCK)
    grid = np.zeros(rows * BLOCK, np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T)
    after = np.ascontiguousarray(steps.T).ravel()
    whole = np.zeros(rows, np.int32)
    for line in grid:
        whole = after.take(line * np.int32(len(steps)) + whole)
    step = 1
    while step < rows:
        later = whole.copy()
        later[step:] = both[whole[:-step], whole[step:]]
        whole, step = later, step * 2
    state = np.zeros(rows, np.uint8)
    state[1:] = reached[whole[:-1]]
    out = np.empty((BLOCK, rows), np.uint8)
    flat = to.ravel()
    for line, into in zip(grid, out, strict=True):
        into[:] = state
        state = flat.take((line << 3) | state)
    return out.T.ravel()[:n]


def boundaries(data: bytes, offsets: np.ndarray, table: np.ndarray, machine: tuple) -> np.ndarray:
    """Byte positions at which pre-tokens start, for texts laid end to end."""
    if not data:
        return np.zeros(0, np.int64)
    raw = np.frombuffer(data, np.uint8)
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    points = raw if len(at) == len(raw) else np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    first = np.unique(offsets[:-1][offsets[:-1] < offsets[1:]])
    first = first if len(at) == len(raw) else np.searchsorted(at, first)
    to, cut, functions = machine
    symbol = symbols(points, first, table)
    state = scan(symbol, to, functions)
    return at[cut.ravel().take((symbol << 3) | state)]


class Merger:
    """Ids of pre-tokens, as little-endian unsigned 32-bit integers, with a cache.

    Pre-tokens the cache lacks are merged many at a time: a matrix holds their
    ids, each round joins every row's pair of lowest rank (leftmost first) until
    no row has one. Ranks of pairs come from an open-addressed table.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.cache: dict[bytes, bytes] = {}
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        found = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, r = (np.array(x, np.int64) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
        self.bits = max(10, int(len(r) * 4).bit_length())
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NONE, np.int64)
        key = (a << 32) | b
        slot = self.slots(key)
        while len(key):
            free = self.keys[slot] < 0
            _, one = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            put = np.zeros(len(slot), bool)
            put[one] = True
            put &= free
            self.keys[slot[put]], self.values[slot[put]] = key[put], r[put]
            key, r, slot = key[~put], r[~put], (slot[~put] + 1) & ((1 << self.bits) - 1)

    def slots(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, NONE where there is none; ids below zero join nothing."""
        out = np.full(a.size, NONE, np.int64)
        at = np.flatnonzero((a >= 0) & (b >= 0))
        key = (a.ravel()[at] << 32) | b.ravel()[at]
        slot = self.slots(key)
        while len(at):
            there = self.keys.take(slot)
            same = there == key
            out[at[same]] = self.values.take(slot[same])
            more = ~same & (there >= 0)
            at, key, slot = at[more], key[more], (slot[more] + 1) & ((1 << self.bits) - 1)
        return out.reshape(a.shape)

    def joined(self, some: list[bytes]) -> None:
        """Put pre-tokens of like length into the cache."""
        m, width = len(some), max(map(len, some))
        sizes = np.fromiter(map(len, some), np.int64, m)
        ids = np.full((m, width + 1), -1, np.int64)
        ids[np.arange(width + 1) < sizes[:, None]] = self.bytes[np.frombuffer(b"".join(some), np.uint8)]
        near = self.pair(ids[:, :-1], ids[:, 1:])
        row, column, final = np.arange(m), np.arange(width + 1), ids.copy()
        while len(row):
            i = near.argmin(1)
            low = near[np.arange(len(row)), i]
            over = low == NONE
            if over.any():
                final[row[over]] = ids[over]
                row, ids, near, i, low = row[~over], ids[~over], near[~over], i[~over], low[~over]
                if not len(row):
                    break
            at = np.arange(len(row))
            ids[at, i] = low
            shift = np.minimum(column + (column > i[:, None]), width)
            ids = np.take_along_axis(ids, shift, 1)
            ids[:, -1] = -1
            near = np.take_along_axis(near, np.minimum(shift[:, :-1], width - 1), 1)
            near[:, -1] = NONE
            near[at, i] = self.pair(ids[at, i], ids[at, i + 1])
            before = i > 0
            near[at[before], i[before] - 1] = self.pair(ids[at[before], i[before] - 1], ids[at[before], i[before]])
        full = final >= 0
        flat, cuts = final[full].astype("<u4").tobytes(), [0, *(4 * np.cumsum(full.sum(1))).tolist()]
        self.cache.update(zip(some, map(flat.__getitem__, map(slice, cuts, cuts[1:])), strict=True))

    def __call__(self, slices: list[bytes]) -> list[bytes]:
        if len(self.cache) >= CACHE:
            self.cache.clear()
        get = self.cache.get
        out = [get(p) for p in slices]
        missing = {p for p, ids in zip(slices, out, strict=True) if ids is None}
        if not missing:
            return out
        own = {}
        batch = []
        for p in missing:
            if (rank := self.ranks.get(p)) is not None:
                self.cache[p] = rank.to_bytes(4, "little")
            elif len(p) <= 40:
                batch.append(p)
            else:
                own[p] = np.array(self.merged(p), "<u4").tobytes()
        batch.sort(key=len)
        for k in range(0, len(batch), 2048):
            self.joined(batch[k : k + 2048])
        return [ids or get(p) or own[p] for p, ids in zip(slices, out, strict=True)]

    def merged(self, piece: bytes) -> list[int]:
        """Join the pair of lowest rank, leftmost first, until none is left. A heap keeps long pieces in O(n log n)."""
        import heapq

        n, ranks = len(piece), self.ranks
        end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        dead = bytearray(n)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i]
            if dead[i] or j >= n or end[j] != stop:
                continue
            end[i], dead[j], right[i] = stop, 1, right[j]
            if right[i] < n:
                left[right[i]] = i
                if (r := ranks.get(piece[i : end[right[i]]])) is not None:
                    heapq.heappush(heap, (r, i, end[right[i]]))
            if (k := left[i]) >= 0 and (r := ranks.get(piece[k:stop])) is not None:
                heapq.heappush(heap, (r, k, stop))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = right[i]
        return out


def read_ranks(lines: list[bytes]) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


def load(path: str):
    """The merger, token bytes by id, code-point classes and automaton, once per worker."""
    state = worker_state()
    if getattr(state, "bpe_path", None) != path:
        with open(path, "rb") as f:
            ranks = read_ranks(f.read().splitlines())
        to, cut = automaton()
        state.bpe, state.bpe_path = (Merger(ranks), by_id(ranks), classes(), (to, cut, monoid(to))), path
    state.clear = state.bpe[0].cache.clear  # at the end of each task
    return state.bpe


def by_id(ranks: dict[bytes, int]) -> list[bytes]:
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    return tokens


def token_bytes(path: str) -> list[bytes]:
    """Token bytes by id, without what only encoding needs."""
    state = worker_state()
    if getattr(state, "bpe_path", None) == path:
        return state.bpe[1]
    if getattr(state, "tokens_path", None) != path:
        with open(path, "rb") as f:
            state.tokens, state.tokens_path = by_id(read_ranks(f.read().splitlines())), path
    return state.tokens


def read_back(ids: list[bytes | None], tokens: list[bytes]) -> pa.Array:
    return pa.array([b"".join(map(tokens.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in ids], pa.binary())


def encode(docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), offsets: bool = False, decoded: bool = False) -> DataFrame:
    """`keep` columns, ids (binary, little-endian unsigned 32-bit) and n_tokens; with
    `offsets` also token_ends (binary, the byte position after each token); with `decoded`
    also the bytes that the ids decode to, as decode() would give them, in the same pass.

    `path` names a rank file that every node has, as installed tokenizers are.
    """
    fields = [f for f in docs.schema if f.name in keep]
    source = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "ids binary, n_tokens bigint" + ", token_ends binary" * offsets + ", decoded binary" * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, tokens, table, machine = load(path)
        sizes = np.array([len(t) for t in tokens], np.int64)
        for batch, data, off in pieces(batches, "__text"):
            starts = boundaries(data, off, table, machine)
            cuts = [*starts.tolist(), len(data)]
            of_row = np.searchsorted(starts, off).tolist()
            slices = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
            packed = merger(slices)
            ids = [b"".join(packed[a:b]) for a, b in zip(of_row, of_row[1:], strict=False)]
            names = [*[f.name for f in fields], "ids", "n_tokens"]
            columns = [*[batch.column(f.name) for f in fields], pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())]
            if offsets:
                names.append("token_ends")
                columns.append(pa.array([np.cumsum(sizes[np.frombuffer(x, "<u4")]).astype("<u8").tobytes() for x in ids], pa.binary()))
            if decoded:
                names.append("decoded")
                columns.append(read_back(ids, tokens))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return arrow_map(source, run, ddl)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """All columns of `encoded` plus decoded (binary): the bytes of its ids."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema) + ", decoded binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_bytes(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, read_back(batch.column(ids).to_pylist(), tokens)], names=[*batch.schema.names, "decoded"])

    return arrow_map(encoded, run, ddl)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded bytes."""
    back = encode(docs, path, decoded=True)
    return back.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
