"""Quality rules with risk-controlled thresholds. DataFrame functions only.

Four rates of a text (symbols, repeated lines, repeated words, letters a word) are
each held against a cutoff. Cutoffs come from labelled holdouts of the document's
stratum, its language. A path is a row of settings from lenient to strict: one path
tightens all four cutoffs together, four more tighten one each. For every setting the
good documents that it would reject, by any of its rules, are counted over all labelled
documents. It passes if the exact binomial lower tail P(Bin(n, false_rejection) <=
rejected) is at most error / (strata * paths), strata being those that hold a good
labelled document; on a path, nothing beyond the first setting that fails is tested.
By fixed-sequence testing within paths and Bonferroni's correction over strata and
paths, with probability 1 - error every setting that passed, in whatever stratum,
rejects at most `false_rejection` of the good documents. As that holds for all of them
at once, the one that rejects most of the bad labelled documents may be taken; ties go
to the setting that rejects fewer good ones, then to the path named first. With nothing
that passed, no rule is in force in that stratum: with 4 strata it takes 297 good
holdouts without a rejection for any to pass. risk_report() shows every stratum.

Null and empty texts have no words and fail the base rules; null strata are a stratum by
themselves. Very long texts take n log n time. Several labels of one document count as
good if all are. Repeated rows agree; empty tables of documents give none, empty labels
no cutoffs. Input columns beyond doc_id, the text and the stratum are not looked at.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions.arrays import bound
from folioscope.llm.common import written

BLANK = r"[\x20\x09-\x0D]+"
#: Score above the cutoff: rejected. From lenient to strict, as many settings for each rule.
RULES = {
    "symbol_rate": (0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02),
    "dup_line_rate": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2),
    "repeat_word_rate": (0.48, 0.45, 0.42, 0.4, 0.35, 0.3, 0.25, 0.2, 0.18, 0.15),
    "mean_word": (40.0, 35.0, 30.0, 25.0, 22.0, 20.0, 18.0, 16.0, 14.0, 12.0),
}
STEPS = 10
#: Rules that each path tightens; the others are off on it.
PATHS = {"all": tuple(RULES)} | {r: (r,) for r in RULES}
FALSE_REJECTION, ERROR, SUMMED = 0.02, 0.05, 4000


def counted_words(words: Column) -> Column:
    """Words that lie in a 3-word window which occurs at least twice."""

    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(hashes) - 3), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1), F.get(hashes, i + 2)))

    def covered(s: Column) -> Column:
        # in order of place, each window adds the words that the one before it does not cover
        same = lambda p, k: F.coalesce(F.get(s, k)["h"] == p["h"], F.lit(False))
        places = F.sort_array(F.transform(F.filter(s, lambda p, k: same(p, k - 1) | same(p, k + 1)), lambda p: p["i"]))
        return bound(places, lambda x: F.aggregate(F.transform(x, lambda i, k: F.least(i - F.coalesce(F.get(x, k - 1), F.lit(-3)), F.lit(3))), F.lit(0), lambda n, v: n + v))

    def repeats(w: Column) -> Column:
        pairs = F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(F.size(F.array_distinct(w)) == F.size(w), 0).otherwise(bound(F.sort_array(pairs), covered))

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < 3, 0).otherwise(bound(bound(hashed, windows), repeats)).cast("long")


def measured(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), stratum: str = "lang") -> DataFrame:
    """`keep` columns, the stratum, base counts, base_failed and the rates, from whole texts."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(*keep, F.coalesce(F.col(stratum).cast("string"), F.lit("und")).alias("stratum"), t.alias("t"))
    bare = F.expr(r"trim(BOTH ' \t\n\u000b\f\r' FROM t)")
    lines = F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        *keep,
        "stratum",
        F.length("t").alias("n_chars"),
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK, -1)).alias("words"),
        F.length(F.regexp_replace("t", BLANK, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", "[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        bound(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
    )
    rows = rows.select(*keep, "stratum", "n_chars", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols", F.col("lines.dup").alias("n_dup_lines"), F.col("lines.n").alias("n_lines"), counted_words(F.col("words")).alias("n_repeat_words"))
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return rows.select(
        "*",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "n_chars").alias("symbol_rate"),
        share("n_dup_lines", "n_lines").alias("dup_line_rate"),
        share("n_repeat_words", "n_words").alias("repeat_word_rate"),
        share("word_chars", "n_words").alias("mean_word"),
    )


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x >= 1: Stirling's series at x + 8, stepped down."""
    y = x + 8.0
    series = (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    down = F.log(x)
    for i in range(1, 8):
        down = down + F.log(x + float(i))
    return series - down


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(Bin(n, share) <= k), summed downwards from its largest term; what lies beyond
    SUMMED terms is bounded by a geometric series and added, so it is never too small.
    1 where k is not below the mean."""
    k, n = k.cast("double"), n.cast("double")
    odds = (1 - share) / share
    top = F.exp(log_gamma(n + 1) - log_gamma(k + 1) - log_gamma(n - k + 1) + k * F.log(F.lit(share)) + (n - k) * F.log(F.lit(1 - share)))
    steps = F.when(k < 1, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), F.least(k.cast("int"), F.lit(SUMMED))))
    zero = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(s: Column, j: Column) -> Column:
        term = s["term"] * (k - j + 1) / (n - k + j) * odds
        return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

    def end(s: Column) -> Column:
        ratio = F.least((k - SUMMED) / (n - k + SUMMED) * odds, F.lit(0.999999))
        return s["total"] + F.when(k > SUMMED, s["term"] * ratio / (1 - ratio)).otherwise(0.0)

    return F.when(k >= n * share, 1.0).otherwise(F.least(top * F.aggregate(steps, zero, step, end), F.lit(1.0)))


def rejects(path: str, step: int) -> Column:
    """Would the setting reject a row of rates?"""
    over = [F.col(rule) > RULES[rule][step] for rule in PATHS[path]]
    return functools.reduce(lambda a, b: a | b, over)


def risk_report(rates: DataFrame, labels: DataFrame, false_rejection: float = FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """One row for each stratum, path and step: n good holdouts, k of them and `bad` of the bad
    ones rejected, the tail probability, the level it is held against, and whether it passed."""
    known = labels.where("doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = rates.where(~F.col("base_failed")).join(known, "doc_id")
    good = F.col("quality") == 1
    settings = [(p, i) for p in PATHS for i in range(STEPS)]
    counts = [F.sum((who & rejects(p, i)).cast("long")).alias(f"{name}_{p}_{i}") for p, i in settings for name, who in (("k", good), ("bad", ~good))]
    table = written(held.groupBy("stratum").agg(F.sum(good.cast("long")).alias("n"), *counts).where("n > 0"))
    level = error / (max(table.count(), 1) * len(PATHS))
    tests = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(i).alias("step"), F.col(f"k_{p}_{i}").alias("k"), F.col(f"bad_{p}_{i}").alias("bad")) for p, i in settings])
    rows = table.select("stratum", "n", F.lit(level).alias("level"), F.explode(tests).alias("t")).select("stratum", "n", "level", "t.*")
    rows = rows.withColumn("tail", binomial_tail(F.col("k"), F.col("n"), false_rejection))
    firsts = rows.groupBy("stratum", "path").agg(F.coalesce(F.min(F.when(F.col("tail") > F.col("level"), F.col("step"))), F.lit(STEPS)).alias("first_failed"))
    return rows.join(firsts, ["stratum", "path"]).withColumn("passed", F.col("step") < F.col("first_failed")).drop("first_failed")


def risk_table(rates: DataFrame, labels: DataFrame, false_rejection: float = FALSE_REJECTION, error: float = ERROR) -> DataFrame:
    """(stratum, path, step, n and a cutoff for each rule, null where it is off): the setting in
    force in each stratum that has one."""
    passed = risk_report(rates, labels, false_rejection, error).where("passed")
    order = F.create_map(*[F.lit(x) for i, p in enumerate(PATHS) for x in (p, i)])[F.col("path")]
    best = passed.groupBy("stratum").agg(F.max(F.struct("bad", (-F.col("k")).alias("k"), (-order).alias("order"), (-F.col("step")).alias("step"), "path", "n")).alias("b")).select("stratum", "b.path", (-F.col("b.step")).alias("step"), "b.n")
    grid = lambda r: F.get(F.array(*[F.lit(c) for c in RULES[r]]), F.col("step"))
    return best.select("*", *[F.when(F.col("path").isin(*[p for p in PATHS if r in PATHS[p]]), grid(r)).alias(f"cutoff_{r}") for r in RULES])


def judged(rates: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """rates with `kept`, by a left join with the cutoffs, a row for each stratum at most."""
    names = [f"cutoff_{r}" for r in RULES]
    rows = rates.join(cutoffs.select("stratum", *names), "stratum", "left")
    over = [F.coalesce(F.col(r) > F.col(f"cutoff_{r}"), F.lit(False)) for r in RULES]
    return rows.withColumn("kept", ~F.col("base_failed") & ~functools.reduce(lambda a, b: a | b, over)).drop(*names)


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """doc_id, base counts, base_failed, kept, rates and stratum, one row per row of docs."""
    rates = written(measured(docs, text, stratum=stratum))
    return judged(rates, written(risk_table(rates, labels)))
