"""Personal data by weak supervision.

Candidates are base spans (fixed patterns, always kept) and looser ones: spelled
out addresses, national phone numbers, social security numbers, bank account
numbers, names, dates of birth and street addresses. Five labelers, each of which may
be wrong, vote yes, no or nothing on each: the pattern labeler by checksums and forms,
the gazetteer labeler by lists, the labelers of the words before and after, and the
placeholder labeler by made-up digits and names. The reliabilities of the labelers are
estimated without truth, by expectation-maximisation over the counts of vote patterns
in all documents. The posteriors of a bounded sample of candidates train the final
classifier, a logistic regression on votes, shape and context. Looser candidates that it
accepts join the base spans; base spans that it would refuse are told as doubted.

Only counts of vote patterns (at most 243 a kind) and the sample (`SAMPLE` rows at
most) come to the driver. Null and empty texts have no spans. Every scan starts at signs
that a match must hold and reads on from there, so very long texts, of one long word or of
many candidates, take time in proportion. Offsets are in code points. Looser candidates
that overlap are taken in the order of their kinds, then places; a score at the threshold
is accepted. Repeated rows get the same spans, an empty table none. find() keeps the
columns asked for; mask() all, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.llm.common import arrow_map, forget, utf8, written

BASE = ("email", "ip", "card", "phone")
MORE = ("ssn", "iban", "name", "birth", "street")
KINDS = BASE + MORE
#: Base patterns, each begun where a scan of its signs says.
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Gazetteers.
DOMAINS = {"com", "org", "net", "edu", "gov", "io", "de", "fr", "es", "uk", "ru", "info", "eu", "it", "nl", "ch", "at"}
FIRST_NAMES = {
    "James", "Mary", "John", "Anna", "Robert", "Linda", "Michael", "Maria", "David", "Sarah", "Peter", "Paul", "Laura", "Thomas", "Julia", "Hans", "Pierre", "Marie",
    "Carlos", "Carmen", "Ivan", "Olga", "William", "Elizabeth", "Richard", "Susan", "Joseph", "Jessica", "Charles", "Karen", "Daniel", "Nancy", "Matthew", "Lisa",
    "Anthony", "Betty", "Mark", "Sandra", "Steven", "Emily", "Andrew", "Emma", "George", "Alice", "Klaus", "Petra", "Juan", "Lucia", "Jean", "Claire", "Louis", "Sofia",
}
TITLES, STREETS = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sr|Sra", "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Court|Blvd|Boulevard|Way|Place"
IBAN_SIZES = {"DE": 22, "FR": 27, "ES": 24, "GB": 22, "IT": 27, "NL": 18, "CH": 21, "AT": 20, "BE": 16, "PL": 28, "PT": 25, "SE": 24}
NAMES = "|".join(sorted(FIRST_NAMES))
LOOSE = {
    "phone": re.compile(r"(?<![0-9.+-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9.-])"),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "name": re.compile(rf"\b(?:(?:{TITLES})\.? [A-Z][a-zà-ÿ]{{1,30}}(?: [A-Z][a-zà-ÿ]{{1,30}}){{0,2}}|(?:{NAMES})(?: [A-Z][a-zà-ÿ]{{1,30}}){{1,2}})\b"),
    "birth": re.compile(r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}[./][0-9]{1,2}[./][0-9]{4})(?![0-9/-])"),
    "street": re.compile(rf"(?<![0-9.])[0-9]{{1,5}} (?:[A-Z][a-z]{{1,30}} ){{1,3}}(?:{STREETS})\b"),
}
SPELLED = re.compile(r"(?: ?(?:\[at\]|\(at\)) ?| at )[A-Za-z0-9-]{1,63}(?: ?(?:\[dot\]|\(dot\)) ?| dot )([A-Za-z]{2,24})\b")
#: Words before a candidate that speak for it, by kind, and words around that speak against any.
BEFORE = {
    "email": r"mail|contact|write|reach|address",
    "ip": r"\bip\b|server|host|address|login|client|from",
    "card": r"card|credit|visa|pay|debit|amex|charge",
    "phone": r"phone|tel|call|mobile|fax|cell|dial|ring|text",
    "ssn": r"ssn|social|security",
    "iban": r"iban|bank|account|transfer|konto",
    "name": r"name|signed|contact|met|dear|by|sincerely|regards|patient|author|with",
    "birth": r"born|birth|dob|geboren|nacid",
    "street": r"lives?|address|home|resid|located|deliver|moved|at",
}
BEFORE = {k: re.compile(rf"(?:{v})[^.;\n]{{0,24}}$", re.I) for k, v in BEFORE.items()}
NOT_BEFORE = re.compile(r"(?:version|release|isbn|issn|order|serial|section|figure|table|ticket|part|build|model|item|invoice|published|updated|posted|dated|on|since|brand|novel|shop)[ #:.no]*$", re.I)
AFTER = re.compile(r"^[ ,;.)]*(?:is my|was born|or write|to reach|anytime|expires|after hours|lives|called|said|wrote|signed)", re.I)
NOT_AFTER = re.compile(r"^[ ,]*(?:units?|pieces|items|pages?|percent|%|copies|kg|mm|releases?|edition|museum|avenue|street|brand|stadium|airport|university)", re.I)
#: Bytes of a text without which it has no candidate. The second begins with letters, not a
#: boundary, so that only capitals are looked at.
DIGIT, NAMED, DOT = re.compile(rb"[0-9@]"), re.compile(rb"(?:%s|%s)\b" % (TITLES.encode(), NAMES.encode())), re.compile(rb"\bdot\b|[\[(]dot[\])]")
#: Candidates the final classifier is fitted on at most, and the score it accepts.
SAMPLE, ACCEPT = 20_000, 0.8
FEATURES = 1 << 12
#: Labelers that mean the same whatever the kind (of words before, words after, placeholders):
#: their votes on all kinds tell how reliable they are.
SHARED = (2, 3, 4)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return re.sub(r"[^0-9]", "", s)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Every domain after an @, and the run of local characters before it that no earlier match took."""
    taken = floor = 0
    for m in DOMAIN.finditer(text):
        floor = max(taken, floor)
        a = floor + len(text[floor : m.start()].rstrip(LOCAL))
        if a < m.start():
            yield a, m.end()
            taken = m.end()
        floor = m.start() + 1


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Runs of four numbers between dots, each at most 255."""
    for m in DOTTED.finditer(text):
        parts = m.group().split(".")
        at = m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) <= 3 and int(p or "0") <= 255 for x in four):
                yield at, at + size
            at += size + 1


def base_spans(text: str) -> list[tuple[str, int, int]]:
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if "." in text:
        out += [("ip", a, b) for a, b in addresses(text)]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16:
            d = digits_of(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits_of(m.group())) <= 15]
    return out


def loose_spans(text: str) -> Iterator[tuple[str, int, int]]:
    floor = 0
    for m in SPELLED.finditer(text):
        a = floor + len(text[floor : m.start()].rstrip(LOCAL))
        if a < m.start():
            yield "email", a, m.end()
        floor = m.end()
    for kind, pattern in LOOSE.items():
        yield from ((kind, m.start(), m.end()) for m in pattern.finditer(text))


def candidates(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and looser ones that overlap neither them nor one another."""
    base, more = base_spans(text), []
    taken = None
    for kind, a, b in loose_spans(text):
        if taken is None:
            taken = bytearray(len(text))
            for _, x, y in base:
                taken[x:y] = b"\1" * (y - x)
        if taken.find(1, a, b) < 0:
            more.append((kind, a, b))
            taken[a:b] = b"\1" * (b - a)
    return base, more


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def by_pattern(kind: str, s: str, d: str) -> int:
    """Do checksums and forms hold?"""
    match kind:
        case "email":
            return 1 if "@" in s and ".." not in s and s[0] not in ".-" else 0
        case "ip":
            return -1 if any(len(p) > 1 and p[0] == "0" for p in s.split(".")) else 1
        case "card":
            return 1 if luhn(d) else -1
        case "phone":
            return 1 if (10 <= len(d) <= 13 if s[0] == "+" else d[0] not in "01" and d[3] not in "01") else -1
        case "ssn":
            return -1 if d[:3] in ("000", "666") or d[0] == "9" or d[3:5] == "00" or d[5:] == "0000" else 1
        case "iban":
            return 1 if iban_ok(s) else -1
        case "birth":
            year = next(int(p) for p in re.split(r"[./-]", s) if len(p) == 4)
            return 1 if 1915 <= year <= 2020 else -1
    return 0


def by_gazetteer(kind: str, s: str, d: str) -> int:
    match kind:
        case "email":
            return 1 if re.split(r"[^A-Za-z]+", s)[-1].lower() in DOMAINS else -1
        case "ip":
            return -1 if s.startswith(("0.", "127.", "255.")) or s.count(".") == 3 and d[0] == "1" and len(s) == 7 else 1
        case "card":
            return 1 if d[0] in "3456" else -1
        case "phone":
            return 1 if s[0] == "+" else 0
        case "iban":
            return 1 if IBAN_SIZES.get(s[:2]) == len(s.replace(" ", "")) else -1
        case "name":
            words = [w.rstrip(".") for w in s.split()]
            return 1 if any(w in FIRST_NAMES for w in words) else -1
    return 0


def by_placeholder(kind: str, s: str, d: str) -> int:
    """No to what looks made up."""
    made = len(d) >= 8 and (len(set(d)) <= 2 or d in "01234567890123456789" or d in "98765432109876543210")
    return -1 if made or re.search(r"example|test|sample|doe\b|lorem|x{3}", s, re.I) else 0


def votes(kind: str, s: str, before: str, after: str = "") -> tuple[int, ...]:
    """Of the labelers, in order: 1 yes, -1 no, 0 nothing."""
    d = digits_of(s)
    ahead = -1 if NOT_BEFORE.search(before) else 1 if BEFORE[kind].search(before) else 0
    behind = -1 if NOT_AFTER.search(after) else 1 if AFTER.search(after) else 0
    return by_pattern(kind, s, d), by_gazetteer(kind, s, d), ahead, behind, by_placeholder(kind, s, d)


def features(kind: str, s: str, before: str, vote: tuple[int, ...]) -> list[int]:
    shape = re.sub(r"(.)\1+", r"\1", re.sub(r"[0-9]", "9", re.sub(r"[a-z]", "a", re.sub(r"[A-Z]", "A", s))))[:24]
    words = re.findall(r"[^\W\d_]+", before.lower())[-2:]
    names = [f"k{kind}", f"s{kind}{shape}", f"l{kind}{len(s) // 4}", *(f"v{kind}{i}{v}" for i, v in enumerate(vote)), *(f"w{kind}{w}" for w in words)]
    return sorted({zlib.crc32(n.encode()) % FEATURES for n in names})


def described(text: str, span: tuple[str, int, int]) -> tuple[tuple[int, ...], list[int]]:
    kind, a, b = span
    s, before, after = text[a : min(b, a + 200)], text[max(0, a - 40) : a], text[b : b + 24]
    vote = votes(kind, s, before, after)
    return vote, features(kind, s, before, vote)


@dataclass
class Model:
    reliabilities: dict[str, list[tuple[float, float]]]  # by kind and labeler: P(yes | personal), P(no | not)
    prior: dict[str, float]
    weights: np.ndarray

    def score(self, ids: list[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[ids].sum() + self.weights[FEATURES], -30, 30))))


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], kinds: list[str] | None = None, shared: tuple[int, ...] = (), rounds: int = 100) -> tuple[dict, dict, list[float]]:
    """Prior by kind, (P(yes|1), P(no|0)) of each labeler among its votes by kind, and the
    posterior of each row of (votes, count).

    Each kind has a prior of its own; labelers are reliable by kind, but for the `shared` ones,
    whose votes mean the same for all. Weak Beta priors hold labelers above chance and away
    from 0 and 1.
    """
    names, of = np.unique(kinds or [""] * len(patterns), return_inverse=True)
    v, n = np.array([p for p, _ in patterns], float), np.array([c for _, c in patterns], float)
    labelers, groups = v.shape[1], len(names)
    place = [np.zeros(len(of), np.int64) if k in shared else of for k in range(labelers)]
    prior, good = np.full(groups, 0.5), np.full((labelers, groups, 2), 0.8)
    summed = lambda x, at: np.bincount(at, x, groups)
    for _ in range(rounds):
        one, zero = np.log(prior)[of], np.log(1 - prior)[of]
        for k in range(labelers):
            yes, no, (p, q) = v[:, k] > 0, v[:, k] < 0, good[k, place[k]].T
            one = one + yes * np.log(p) + no * np.log(1 - p)
            zero = zero + yes * np.log(1 - q) + no * np.log(q)
        post = 1 / (1 + np.exp(np.clip(zero - one, -50, 50)))
        prior = (summed(post * n, of) + 2) / (summed(n, of) + 4)
        for k in range(labelers):
            yes, no, at = v[:, k] > 0, v[:, k] < 0, place[k]
            a, b = summed(post * n * yes, at), summed(post * n * no, at)
            c, d = summed((1 - post) * n * no, at), summed((1 - post) * n * yes, at)
            good[k, :, 0], good[k, :, 1] = np.maximum((a + 8) / (a + b + 10), 0.5), np.maximum((c + 8) / (c + d + 10), 0.5)
    reliable = {str(x): [tuple(good[k, 0 if k in shared else i].tolist()) for k in range(labelers)] for i, x in enumerate(names)}
    return dict(zip(map(str, names), prior.tolist(), strict=True)), reliable, post.tolist()


def trained(rows: list[tuple[list[int], float]], epochs: int = 40, rate: float = 0.5, seed: int = 3) -> np.ndarray:
    """Weights of a logistic regression with soft labels, by batches; the last one is the bias."""
    w = np.zeros(FEATURES + 1)
    if not rows:
        return w
    wide = max(len(ids) for ids, _ in rows)
    ids = np.full((len(rows), wide + 1), FEATURES + 1)  # padded with a weight that stays 0
    ids[:, wide] = FEATURES
    for i, (x, _) in enumerate(rows):
        ids[i, : len(x)] = x
    y, w = np.array([p for _, p in rows]), np.append(w, 0.0)
    rng = np.random.default_rng(seed)
    epochs = max(epochs, -(-100_000 // len(rows)))  # few rows take more of them
    for epoch in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), 64):
            some = ids[order[k : k + 64]]
            z = np.clip(w[some].sum(1), -30, 30)
            error = 1 / (1 + np.exp(-z)) - y[order[k : k + 64]]
            w -= rate / (1 + 10 * epoch / epochs) / 8 * np.bincount(some.ravel(), np.repeat(error, wide + 1), FEATURES + 2)
            w[-1] = 0
        w *= 1 - 0.04 / epochs
    return w[:-1]


def votes_table(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row for each candidate: kind, its votes and features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for t in texts_of(batch, "__text"):
                if t:
                    for span in (x for both in candidates(t) for x in both):
                        v, ids = described(t, span)
                        out.append({"kind": span[0], "votes": v, "ids": ids})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("kind", pa.string()), ("votes", pa.list_(pa.int8())), ("ids", pa.list_(pa.int32()))]))

    return arrow_map(docs.select(F.col(text).cast("string").alias("__text")), run, "kind string, votes array<tinyint>, ids array<int>")


def texts_of(batch: pa.RecordBatch, column: str) -> Iterator[str]:
    """Texts of a batch; those that can hold no candidate come as empty ones."""
    data, off = utf8(batch.column(column))
    cuts = off.tolist()
    for a, b in zip(cuts, cuts[1:], strict=False):
        sign = DIGIT.search(data, a, b) or NAMED.search(data, a, b) or (data.find(b"dot", a, b) >= 0 and DOT.search(data, a, b))
        yield data[a:b].decode() if sign else ""


def fit(docs: DataFrame, text: str = "text") -> Model:
    # a few files of votes, not one for each task
    table = written(votes_table(docs, text).hint("rebalance"))
    counts = table.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    prior, reliable, found = expectation_maximisation([(tuple(r["votes"]), r["count"]) for r in counts], [r["kind"] for r in counts], SHARED) if counts else ({}, {}, [])
    post = {(r["kind"], *r["votes"]): p for r, p in zip(counts, found, strict=True)}
    # unlike candidates only, thinned by a hash before the limit, so that the driver gets
    # about SAMPLE rows from all tasks together
    unlike = table.select("kind", "votes", "ids").distinct()
    draw = F.pmod(F.xxhash64("kind", "votes", "ids"), F.lit(1 << 30))
    most = int(min(1.0, 1.1 * SAMPLE / max(unlike.count(), 1)) * (1 << 30))
    sample = unlike.withColumn("draw", draw).where(F.col("draw") <= most).orderBy("draw", "kind", "ids").limit(SAMPLE).collect()
    forget(table)
    rows = [(list(r["ids"]), post[r["kind"], *r["votes"]]) for r in sample]
    return Model(reliable, prior, trained(rows))


def spans_of(text: str, model: Model, accept: float = ACCEPT) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    base, more = candidates(text) if text else ([], [])
    return base, [s for s in more if model.score(described(text, s)[1]) >= accept]


def joined(spans: list[tuple[str, int, int]]) -> str:
    order = {k: i for i, k in enumerate(KINDS)}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (order[s[0]], s[1])))


def find(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), accept: float = ACCEPT) -> DataFrame:
    """`keep` columns, counts of base spans by kind, base and all spans as strings, the number
    of all spans, and the base spans that the classifier would refuse (a score below 0.5)."""
    fields = [f for f in docs.schema if f.name in keep]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "".join(f"n_{k} bigint, " for k in BASE) + "base_spans string, spans string, n_spans bigint, doubted string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, doubted = [], []
            for t in texts_of(batch, "__text"):
                base, more = spans_of(t, model, accept)
                found.append((base, more))
                doubted.append(joined([s for s in base if model.score(described(t, s)[1]) < 0.5]))
            counts = [pa.array([sum(s[0] == k for s in base) for base, _ in found], pa.int64()) for k in BASE]
            both = [pa.array([joined(b) for b, _ in found]), pa.array([joined(b + m) for b, m in found]), pa.array([len(b) + len(m) for b, m in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in fields], *counts, *both, pa.array(doubted)], names=[*[f.name for f in fields], *(f"n_{k}" for k in BASE), "base_spans", "spans", "n_spans", "doubted"])

    return arrow_map(docs.select(*keep, F.col(text).cast("string").alias("__text")), run, ddl)


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """text with each span replaced by its kind in angle brackets; overlaps go to the first."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with personal data in its text masked, and n_chars, where there is one, renewed."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index(text)
            column = batch.column(place)
            new = None
            for i, t in enumerate(texts_of(batch, text)):
                base, more = spans_of(t, model)
                if base or more:
                    new = new or column.to_pylist()
                    new[i] = masked(t, base + more)
            yield batch if new is None else pa.RecordBatch.from_arrays([*batch.columns[:place], pa.array(new, column.type), *batch.columns[place + 1 :]], names=batch.schema.names)

    out = arrow_map(docs, run, ddl)
    if "n_chars" in docs.columns:
        kind = next(f.dataType for f in docs.schema if f.name == "n_chars")
        out = out.withColumn("n_chars", F.length(text).cast(kind))
    return out
