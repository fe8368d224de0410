"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text's features are its byte 1- to 4-grams, taken over lower-cased letters with
every run of other characters as one blank, hashed to rows of an embedding table.
Their embeddings are averaged and a linear softmax scores the languages. Both are
trained here by stochastic gradient descent in numpy, on a bounded sample of
labelled rows chosen by a hash of doc_id, evenly by language. A part of the
sample is set aside and calibrates: it fits the softmax temperature, and the threshold of
rejection, which `false_rejection` of texts like them fall below at most, by the rank that
exchangeable texts have (none where the sample is too small to vouch for it); one for each
range of lengths. It is a threshold of the evidence before the softmax: texts unlike all that was learned, as of
other languages, have little for any language, but the softmax of it may be near one.

Scores of whole texts need no embeddings: as averaging is linear, each hashed
gram carries its product with the softmax matrix, and a text adds these up.

Null and empty texts and texts without a letter are `und` with score 0 and rejected.
Very long texts are scored whole, a text at a time. With nothing to learn from, every
text is `und`. Ties go to the first language in alphabetical order. Repeated rows get the
same answer; an empty table gives an empty one. predict() replaces columns that are
named like its results; accepted() leaves all columns as they are.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioscope.llm.common import arrow_map, free, pieces

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
UND = "und"
#: Bytes of text, blanks and other signs as one, at which a further threshold of rejection begins:
#: short texts have less steady evidence, and are held against others of their kind.
LENGTHS = (200,)


def letter_bytes() -> np.ndarray:
    """Lower-cased byte by byte; all but letters and bytes above 127 become blanks."""
    out = np.full(256, 32, np.uint8)
    for c in range(ord("a"), ord("z") + 1):
        out[c] = out[c - 32] = c
    out[128:] = np.arange(128, 256)
    return out


def grams(data: bytes, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Buckets of the grams at every place, by length of gram, and each text's first and
    last + 1 place. Texts stand apart by blanks, so no gram reaches into the next one."""
    raw = letter_bytes()[np.frombuffer(data, np.uint8)]
    n = len(offsets) - 1
    keep = np.ones(len(raw), bool)
    keep[1:] = (raw[1:] != 32) | (raw[:-1] != 32)
    keep[offsets[:-1][offsets[:-1] < len(raw)]] = True
    ends = np.concatenate([[0], np.cumsum(keep)])[offsets]
    apart = max(GRAMS) + 1
    text = np.full(int(ends[-1]) + apart * (n + 1), 32, np.uint8)
    text[np.arange(int(ends[-1])) + np.repeat(np.arange(1, n + 1) * apart, np.diff(ends))] = raw[keep]
    # a text's grams begin at the blank before it
    first = ends[:-1] + np.arange(1, n + 1) * apart - 1
    last = first + np.diff(ends) + 1
    code, wide, buckets = np.zeros(len(text), np.uint32), text.astype(np.uint32), []
    for k in range(1, max(GRAMS) + 1):
        code = code[: len(text) - k + 1] * np.uint32(0x01000193) + wide[k - 1 :] + np.uint32(k)
        if k in GRAMS:
            buckets.append(((code * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)).astype(np.int32))
    return buckets, first, last


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray = field(repr=False)  # buckets x languages
    bias: np.ndarray = field(repr=False)
    temperature: float = 1.0
    thresholds: tuple[float, ...] = (-np.inf,) * (len(LENGTHS) + 1)

    def evidence(self, data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of each language before the softmax, which says how much a text is like what
        was learned, and the texts' sizes."""
        n, k = len(offsets) - 1, len(self.languages)
        total, count = np.zeros((n, k)), np.zeros(n)
        if data:
            buckets, first, last = grams(data, offsets)
            ranges = np.stack([first, last], 1).ravel()
            for b in buckets:
                for j in range(k):
                    total[:, j] += np.add.reduceat(self.table[:, j].take(b), ranges, dtype=np.float64)[::2]
            count += (last - first) * len(buckets)
        return total / np.maximum(count, 1)[:, None] + self.bias, count // len(GRAMS)

    def unlike(self, evidence: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which texts have less evidence than those of their length that calibrated."""
        return evidence.max(1) < np.array(self.thresholds)[np.searchsorted(LENGTHS, sizes, "right")]

    def softmax(self, evidence: np.ndarray) -> np.ndarray:
        e = np.exp((evidence - evidence.max(1, keepdims=True)) / self.temperature)
        return e / e.sum(1, keepdims=True)

    def probabilities(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        return self.softmax(self.evidence(data, offsets)[0])


def bag(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct buckets and their shares, for each text."""
    out = []
    for t in texts:
        data = t.encode()
        buckets, first, last = grams(data, np.array([0, len(data)]))
        ids, n = np.unique(np.concatenate([b[first[0] : last[0]] for b in buckets]), return_counts=True)
        out.append((ids, (n / n.sum()).astype(np.float32)))
    return out


#: Characters of a piece that stands for a longer text in training. Scores are of whole texts.
PIECE = 3000
#: Texts and pieces that training goes through at least, in more epochs if they are few.
LEAST = 20_000


def fitted(texts: list[str], labels: list[str], dim: int = 16, epochs: int = 4, rate: float = 0.5, seed: int = 7, false_rejection: float = 0.005, parts: int = 2) -> Model:
    """Train on texts (a random piece of long ones) and on `parts` short random pieces of
    each; one text in three, whole, calibrates."""
    languages = sorted(set(labels))
    k = len(languages)
    if not k:
        return Model([UND], np.zeros((BUCKETS, 1), np.float32), np.zeros(1))
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(x) for x in labels])
    held = np.zeros(len(y), bool)
    for j in range(k):  # every third text of each language
        own = np.flatnonzero(y == j)
        held[own[2::3]] = True
    xs, ys, hx, hy = [], [], [], []
    for t, j, h in zip(texts, y, held, strict=True):
        at = int(rng.integers(0, max(1, len(t) - PIECE)))
        pick = [t[at : at + PIECE]]
        for _ in range(parts):
            a = int(rng.integers(0, max(1, len(t) - 60)))
            pick.append(t[a : a + int(rng.integers(20, 400))])
        if h:
            hx.append(t), hy.append(j)
        else:
            xs.extend(pick), ys.extend([j] * len(pick))
    x, yy = bag(xs), np.array(ys)
    weight = (len(yy) / (k * np.maximum(np.bincount(yy, minlength=k), 1)))[yy]
    table = rng.normal(0, 0.1, (BUCKETS, dim)).astype(np.float32)
    soft, bias = np.zeros((dim, k), np.float32), np.zeros(k, np.float32)
    scale = 40.0  # averages are small; this stands for a larger rate of the embeddings
    epochs = max(epochs, -(-LEAST // max(len(x), 1)))
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        step = rate * (1 - epoch / epochs)
        for b in range(0, len(order), 32):
            rows = order[b : b + 32]
            ids = np.concatenate([x[i][0] for i in rows])
            share = np.concatenate([x[i][1] for i in rows])
            cuts = np.concatenate([[0], np.cumsum([len(x[i][0]) for i in rows])])[:-1]
            hidden = np.add.reduceat(table[ids] * share[:, None], cuts, 0)
            logits = hidden @ soft + bias
            e = np.exp(logits - logits.max(1, keepdims=True))
            error = e / e.sum(1, keepdims=True)
            error[np.arange(len(rows)), yy[rows]] -= 1
            error *= (weight[rows] / len(rows))[:, None]
            back = error @ soft.T
            soft -= step * hidden.T @ error
            bias -= step * 0.1 * error.sum(0)
            turn = np.argsort(ids, kind="stable")
            new = np.concatenate([[0], np.flatnonzero(np.diff(ids[turn])) + 1])
            moved = (share[:, None] * np.repeat(back, np.diff(np.append(cuts, len(ids))), 0))[turn]
            table[ids[turn[new]]] -= step * scale * np.add.reduceat(moved, new, 0)
    model = Model(languages, (table @ soft).astype(np.float32), bias.astype(np.float64))
    if hx:
        data = [t.encode() for t in hx]
        off = np.concatenate([[0], np.cumsum([len(d) for d in data])])
        (z, sizes), truth = model.evidence(b"".join(data), off), np.array(hy)
        # as if one more text had been wrong: few texts cannot vouch for a sharp temperature
        doubt = 1 / (len(truth) + 2)

        def loss(t: float) -> float:
            model.temperature = t
            p = np.log(np.maximum(model.softmax(z), 1e-300))
            own = p[np.arange(len(truth)), truth]
            return -float(((1 - doubt) * own + doubt * (p.sum(1) - own) / max(1, k - 1)).mean())

        model.temperature = min(map(float, np.geomspace(0.05, 8, 40)), key=loss)
        kind, thresholds = np.searchsorted(LENGTHS, sizes, "right"), []
        for j in range(len(LENGTHS) + 1):
            top = np.sort(z.max(1)[kind == j])
            rank = int(false_rejection * (len(top) + 1))
            thresholds.append(float(top[rank - 1]) if rank else -np.inf)
        model.thresholds = tuple(thresholds)
    return model


#: Of the fitting sample: texts of a language, characters of a text, characters in all, and languages.
PER_LANGUAGE, LONGEST, IN_ALL, LANGUAGES = 1000, 20_000, 64_000_000, 1000


def training_sample(docs: DataFrame, per_language: int = PER_LANGUAGE, longest: int = LONGEST, in_all: int = IN_ALL, languages: int = LANGUAGES) -> tuple[list[str], list[str]]:
    """About `per_language` texts of each language, the ones of lowest hash, none over `longest`
    characters (of a language that has longer ones only, one of them, cut). Where that comes to more than
    about `in_all` characters each language gives fewer, in proportion; of more than `languages` the
    commonest are learned. So whatever `lang` holds, in_all characters reach the driver, and half as much again at most."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 != 2))
    usable = usable.select("doc_id", "lang", "text", (F.length("text") <= longest).alias("fits"))
    fits = F.col("fits").cast("long")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"), F.sum(fits).alias("fit"), F.sum(fits * F.length("text")).alias("chars")).orderBy(F.desc("n"), "lang").limit(languages).collect()
    if not counts:
        return [], []
    # the share of each language that gives about per_language rows, and all together in_all characters
    share = {r["lang"]: min(1.0, 1.15 * per_language / r["fit"]) for r in counts if r["fit"]}
    scale = min(1.0, in_all / max(1.0, sum(share[r["lang"]] * r["chars"] for r in counts if r["fit"])))
    share = {k: v * scale for k, v in share.items()}
    alone = [r["lang"] for r in counts if not r["fit"]]
    shares = F.from_json(F.lit(json.dumps(share)), "map<string,double>")
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = usable.where("fits").select("lang", "text", draw.alias("draw")).where(F.col("draw") < shares[F.col("lang")]).distinct()
    # the draw is by chance: what it gives over the bound is left out, by a running sum over the texts in order of the draw
    order = Window.orderBy("draw", "lang", "text")
    rows = rows.orderBy("draw", "lang", "text").limit(per_language * len(counts) * 2)
    rows = rows.withColumn("before", F.sum(F.length("text")).over(order)).where(F.col("before") <= in_all * 1.5).select("lang", "text").collect()
    if alone:
        cut = F.substring("text", 1, max(1, min(longest, in_all // (2 * len(alone)))))
        rows += usable.where(F.col("lang").isin(alone)).groupBy("lang").agg(F.min(cut).alias("text")).collect()
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def scored(docs: DataFrame, model: Model, text: str = "text", name: str = "__language") -> DataFrame:
    """All columns of docs and `name`: (language, score, rejected), from the text alone."""
    docs = docs.drop(name)
    ddl = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), f"`{name}` struct<language:string,score:double,rejected:boolean>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(model.languages)
        for batch, data, off in pieces(batches, text):
            z, sizes = model.evidence(data, off)
            best = [pa.array(names[z.argmax(1)].tolist(), pa.string()), pa.array(model.softmax(z).max(1), pa.float64()), pa.array(model.unlike(z, sizes))]
            both = pa.StructArray.from_arrays(best, names=["language", "score", "rejected"])
            yield pa.RecordBatch.from_arrays([*batch.columns, both], names=[*batch.schema.names, name])

    found = F.col(name)
    known = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)) & (found["language"] != UND)
    score = F.when(known, found["score"]).otherwise(0.0)
    verdict = F.struct(F.when(known, found["language"]).otherwise(UND).alias("language"), score.alias("score"), (~known | found["rejected"]).alias("rejected"))
    return arrow_map(docs, run, ddl).withColumn(name, verdict)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of docs plus lang_pred, score and rejected."""
    others = [c for c in docs.columns if c not in ("lang_pred", "score", "rejected")]
    name = free(docs, "__language")
    found = F.col(name)
    return scored(docs.select(*dict.fromkeys([*others, text])), model, text, name).select(*others, found["language"].alias("lang_pred"), found["score"].alias("score"), found["rejected"].alias("rejected"))


def accepted(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Rows of docs, as they are, whose language the classifier accepts."""
    name = free(docs, "__language")
    return scored(docs, model, text, name).where(~F.col(f"{name}.rejected")).select(*docs.columns)


def train(docs: DataFrame, **options) -> Model:
    return fitted(*training_sample(docs), **options)
