"""Secret scans by sliding-window entropy. DataFrame functions only.

Base spans are fixed patterns. The method adds long strings of credential
characters: for each the class is found (hexadecimal, letters and digits, or base-64
with its signs), and a window of `WINDOW` characters slides over it. The window's
counts of characters are kept as 5-bit fields of seven long integers: with each step
one field goes up, one goes down, and the sum of c * log2(c) changes by their
differences. A string whose highest window entropy reaches its class's threshold is
added, unless an allow-list knows it: UUIDs, placeholders, runs of an alphabet, paths and names
of words, rulers, or a digest named as one before it. Base spans stay whatever the
allow-list says.

Null and empty texts have no spans. Very long texts and strings take time in
proportion to their length. Offsets are in code points; spans that start together
come in the order of their kinds. Repeated rows agree; an empty table gives an empty
one. Columns of the input beyond `keep` are not looked at; kept ones must not be
named like the results.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import bound, matches

KINDS = ("assign", "access", "hex", "entropy")
#: Base patterns. Shorter matches of the last two fail and hide no longer one.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
STRING = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
#: Bits that a window of the class must reach, of log2(20) = 4.32 at most.
CLASSES = (("hex", "^[0-9a-fA-F]+$", 3.0), ("alnum", "^[0-9A-Za-z]+$", 3.6), ("base64", "", 3.6))
WORD = r"(?:[A-Z]?[a-z]++|[_-])*+[0-9]{0,4}"
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    r"|(?i)example|placeholder|changeme|your[_-]|xxxx|abcdefghij|0123456789|1234567890"
    rf"|^(?-i:/?(?:{WORD}/)*{WORD})$|^[-=_/+]+$|__"
)
ALLOWED_BEFORE = r"(?i)(?:sha-?(?:1|256|384|512)|md5|checksum|digest|integrity|commit|etag|uuid)[\x20\"'=:-]*$"
#: Counts are fields of so many bits, twelve to a long integer; codes from "+" to "~".
FIELD, FIELDS, LOWEST, HIGHEST = 5, 12, 43, 126


def highest_entropy(string: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy, in bits, of a window over a string of characters from "+" to
    "~" (others count as the nearest of them); of the whole one if shorter. At most 31 wide."""
    if not 0 < window < 1 << FIELD:
        raise ValueError(f"a window of {window} does not fit the counts")
    size = F.least(F.length(string), F.lit(window)).cast("double")
    longs = (HIGHEST - LOWEST) // FIELDS + 1
    codes = F.transform(F.split(string, ""), lambda c: F.least(F.greatest(F.ascii(c), F.lit(LOWEST)), F.lit(HIGHEST)) - LOWEST)

    # of c * log2(c) when the count c goes up by one
    gains = F.array(*[F.lit((c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0.0)) for c in range(window + 1)])
    words = [f"n{j}" for j in range(longs)]

    def one(code: Column) -> tuple[Column, Column]:
        """Which long holds the code's field, and one unit of the field."""
        return F.floor(code / FIELDS).cast("int"), F.call_function("shiftleft", F.lit(1).cast("long"), (code % FIELDS) * FIELD)

    def count(s: Column, code: Column) -> Column:
        held = F.get(F.array(*[s[w] for w in words]), F.floor(code / FIELDS).cast("int"))
        return F.call_function("shiftright", held, (code % FIELDS) * FIELD).bitwiseAND(F.lit((1 << FIELD) - 1)).cast("int")

    def changed(s: Column, code: Column, by: int) -> list[Column]:
        which, unit = one(code)
        return [(s[w] + F.when(which == j, unit * by).otherwise(F.lit(0).cast("long"))).alias(w) for j, w in enumerate(words)]

    def slid(code: Column) -> Column:
        zero = F.struct(*[F.lit(0).cast("long").alias(w) for w in words], F.lit(0.0).alias("sum"), F.lit(1e9).alias("least"))

        def left(s: Column, i: Column) -> Column:
            old = F.get(code, i - window)
            return F.when(i < window, s).otherwise(F.struct(*changed(s, old, -1), (s["sum"] - F.get(gains, count(s, old) - 1)).alias("sum"), s["least"].alias("least")))

        def entered(s: Column, i: Column) -> Column:
            new = F.get(code, i)
            total = s["sum"] + F.get(gains, count(s, new))
            least = F.when((i + 1 >= window) | (i + 1 == F.size(code)), F.least(s["least"], total)).otherwise(s["least"])
            return F.struct(*changed(s, new, 1), total.alias("sum"), least.alias("least"))

        return F.aggregate(F.sequence(F.lit(0), F.size(code) - 1), zero, lambda s, i: bound(left(s, i), lambda t: entered(t, i)), lambda s: F.log2(size) - s["least"] / size)

    return bound(codes, slid)


def suspicious(text: Column, m: Column) -> Column:
    """Is a matched string (start, end, value) a secret by its entropy?"""
    v = m["value"]
    mixed = v.rlike("[0-9]") & v.rlike("[A-Za-z]")
    known = v.rlike(ALLOWED) | F.substring(text, F.greatest(m["start"] - 23, F.lit(1)), F.least(m["start"], F.lit(24))).rlike(ALLOWED_BEFORE)
    threshold = F.coalesce(*[F.when(v.rlike(pattern), bits) for _, pattern, bits in CLASSES])
    return F.when(~mixed | known, False).otherwise(highest_entropy(v) >= threshold)


def tagged(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"), m["value"].alias("value")))


def scanned(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """`keep` columns, `base` and `spans`: arrays of (start, kind, end, value) in order."""
    none = F.array().cast("array<struct<start:int,end:int,found:string,value:string>>")
    t = F.col("t")
    rows = docs.select(*keep, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    # cheap tests first: most texts hold no trigger and no long string
    low = F.lower(t)
    trigger = low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api")
    rows = rows.withColumn("trigger", trigger).withColumn("long", t.rlike(r"[A-Za-z0-9+/_=-]{20}"))
    rows = rows.select(
        *keep,
        "t",
        F.when(F.col("trigger"), F.filter(matches(t, ASSIGN, 1), lambda m: F.length(m["value"]) >= 6)).otherwise(none).alias("assign"),
        F.when(F.col("long") & t.contains("AKIA"), matches(t, ACCESS)).otherwise(none).alias("access"),
        F.when(F.col("long"), matches(t, HEX)).otherwise(none).alias("hex"),
        F.when(F.col("long"), matches(t, STRING)).otherwise(none).alias("strings"),
    )
    rows = rows.select(*keep, "t", F.array_sort(F.concat(*[tagged(F.col(k), k) for k in KINDS[:3]])).alias("base"), "strings")
    clear = lambda m: F.forall("base", lambda b: (b["end"] <= m["start"]) | (b["start"] >= m["end"]))
    added = F.filter("strings", lambda m: clear(m) & suspicious(t, m))
    return rows.select(*keep, "base", F.when(F.size("strings") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", tagged(added, "entropy")))).alias("spans"))


def listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, counts of base spans, SHA-256 of the base spans' list, all spans' list, and their number."""
    found = scanned(docs, text)

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"))
