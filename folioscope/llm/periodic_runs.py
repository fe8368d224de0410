"""Periodic runs of words within documents: found by block matching, extended exactly.

A run is a stretch of consecutive words with smallest period q, of at least LEAST words and
TIMES * q, which no neighbour extends. A run with a period in [s, 2s), s a power of two from
FIRST on (periods below FIRST belong to it as well), wholly holds a block of s words that
begins at a multiple of s, and its copy q words on: three periods leave room for both. So for
each s the aligned blocks become keys, sequences of word numbers, of an Aho-Corasick
automaton, which is searched across the document; an occurrence at a distance that belongs to
s seeds a stretch, which is extended word by word to both sides as far as words q apart agree.

Two tests spare the automaton blocks that cannot seed: each word of a block must occur again
less than 2s words on, and a block that lies with three times its size in a run of smaller
period finds only multiples of that. Neither loses a run. Of equal stretches the smallest
period stays, which by the theorem of Fine and Wilf divides the others.

Words are `[^\\x20\\x09-\\x0D]+`, compared as bytes. Each document is worked on by itself, in a
batch of about a megabyte of text; there is no exchange. Memory follows the longest document.
A null, empty or blank text has no words and no run; repeated rows and ids keep a row each; an
empty table gives no rows. Of equally strong runs the first is reported, then that of smaller
period. Columns that are kept stay as they are; one named like a result is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from fractions import Fraction

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from folioscope.llm.common import arrow_map, pieces

#: Words and periods that a run has at least, and words of the smallest block.
LEAST, TIMES, FIRST = 24, 3, 8
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
Run = tuple[int, int, int]


def numbered(words: Iterable[bytes]) -> np.ndarray:
    """A number for each word, the same for equal words."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def recurrence(w: np.ndarray) -> np.ndarray:
    """For each place the distance to the next one of the same word; len(w) where there is none."""
    order = np.argsort(w, kind="stable")
    out = np.full(len(w), len(w), np.int64)
    same = w[order[1:]] == w[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def agreeing(w: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and j on (step 1) or backwards (step -1, from i - 1 and j - 1) agree; i < j."""
    done, size = 0, 32
    most = len(w) - j if step > 0 else i
    while done < most:
        k = min(size, most - done)
        same = w[i + done : i + done + k] == w[j + done : j + done + k] if step > 0 else (w[i - done - k : i - done] == w[j - done - k : j - done])[::-1]
        if not same.all():
            return done + int(same.argmin())
        done, size = done + k, size * 2
    return done


def seeds(w: np.ndarray, blocks: np.ndarray, s: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """(distance, block start) of the blocks' occurrences low to 2s - 1 words behind them, in order."""
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    keys: dict[tuple, int] = {}
    key_of = np.full(len(w) // s + 1, -1, np.int64)
    for x in blocks.tolist():
        key = tuple(w[x : x + s].tolist())
        if key not in keys:
            keys[key] = len(keys)
            automaton.add_word(key, keys[key])
        key_of[x // s] = keys[key]
    automaton.make_automaton()
    # only what lies within reach of a block is searched: neighbouring reaches are one stretch
    ends = np.minimum(blocks + 3 * s, len(w))
    first = np.flatnonzero(np.concatenate([[True], blocks[1:] > ends[:-1]]))
    last = np.concatenate([first[1:] - 1, [len(blocks) - 1]])
    places, found = [], []
    for a, b in zip(blocks[first].tolist(), ends[last].tolist(), strict=True):
        for end, key in automaton.iter(tuple(w[a:b].tolist())):
            places.append(a + end - s + 1)
            found.append(key)
    y, key = np.array(places, np.int64), np.array(found, np.int64)
    pairs = []
    for back in range((2 * s - low - 1) // s + 1):  # the aligned places low to 2s - 1 words before y
        x = (y - low) // s * s - back * s
        good = (x >= 0) & (y - x < 2 * s)
        good[good] = key_of[x[good] // s] == key[good]
        pairs.append(np.stack([y[good] - x[good], x[good]]))
    d, x = np.concatenate(pairs, axis=1)
    order = np.lexsort((x, d))
    return d[order], x[order]


def runs_of(w: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs (start, length, period) of a sequence of numbers, by start, then period."""
    n, found = len(w), {}
    if times < 3 or least < 3 * FIRST:
        raise ValueError("blocks are sure to be met from three periods and three blocks on")
    again = recurrence(w) if n >= least else w
    s = FIRST
    while max(least, times * (s if s > FIRST else 1)) <= n:
        low = s if s > FIRST else 1
        far = np.concatenate([[0], np.cumsum(again >= 2 * s)])
        blocks = np.arange(0, n - s - low + 1, s)
        blocks = blocks[far[blocks + s] == far[blocks]]
        if found and len(blocks):
            # the furthest end of the runs that begin at or before each block
            begins, ends = (np.array(v) for v in zip(*sorted(found), strict=True))
            at = np.searchsorted(begins, blocks, "right")
            reach = np.concatenate([[0], np.maximum.accumulate(ends)])[at]
            blocks = blocks[reach < np.minimum(blocks + 3 * s, n)]
        if len(blocks):
            ds, xs = seeds(w, blocks, s, low)
            last, until = 0, 0
            for d, x in zip(ds.tolist(), xs.tolist(), strict=True):
                if d == last and x + s <= until:
                    continue  # within the stretch of a seed before
                a = x - agreeing(w, x, x + d, -1)
                until, last = x + s + agreeing(w, x + s, x + s + d, 1), d
                if until + d - a >= max(least, times * d):
                    found[a, until + d] = min(d, found.get((a, until + d), d))
        s *= 2
    return sorted((a, b - a, q) for (a, b), q in found.items())


def strongest(runs: list[Run]) -> Run | None:
    """The run of most periods; of several the first, then that of the smallest period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which of n words stay when each run is cut to its first period."""
    depth = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return np.cumsum(depth[:-1]) == 0


def collapsed(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text", prepare: Callable[..., list[bytes]] | None = None, texts: bool = True) -> DataFrame:
    """The kept columns, n_words, runs, the strongest run (start, length, period, exponent_milli),
    runs_sha256, collapsed_sha256 and, with `texts`, the `collapsed` text: the words that stay, joined by one space.

    prepare(words, *kept values) may give other words to be judged in place of the text's.
    """
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    ddl += f", n_words bigint, runs {RUNS}, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string" + ", collapsed string" * texts
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, off in pieces(batches, "__text"):
            columns: list[list] = [[] for _ in range(8 + texts)]
            given = [batch.column(i).to_pylist() for i in range(len(keep))] if prepare else []
            for i in range(batch.num_rows):
                words = data[off[i] : off[i + 1]].split()
                if prepare:
                    words = prepare(words, *(g[i] for g in given))
                runs = runs_of(numbered(words))
                if runs:
                    stay = kept_words(len(words), runs)
                    best = strongest(runs)
                    rest = b" ".join([words[j] for j in np.flatnonzero(stay).tolist()])
                else:
                    best, rest = None, b" ".join(words)
                listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs).encode()
                values = (len(words), [dict(zip(("start", "length", "period"), r, strict=True)) for r in runs], *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(listed).hexdigest(), hashlib.sha256(rest).hexdigest())
                for c, v in zip(columns, (*values, rest.decode()) if texts else values, strict=True):
                    c.append(v)
            kinds = (pa.int64(), kind, *[pa.int64()] * 4, *[pa.string()] * (2 + texts))
            names = [*keep, "n_words", "runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed"][: len(keep) + 8 + texts]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    if clash := {k.lower() for k in keep} & {"n_words", "runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed", "__text"}:
        raise ValueError(f"kept columns are named like results: {sorted(clash)}")
    return arrow_map(docs.select(*keep, docs[text].alias("__text")), run, ddl)
