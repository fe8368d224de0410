"""Entity rules as Column expressions: validity, confidence, normalised values, comments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.arrays import bound
from folioscope.functions.text import squeezed, strip, words

#: Fixed values.
LONG_TYPES = ("handwritten_text", "handwritten_note", "handwritten_amount", "payment_details")
TECHNICAL = ("ttz", "ttkh", "tech_doc")
AMOUNT_TYPES = ("amount", "identifier", "other")
CONFUSABLE = "0OoДЗ8BВ5Sбь9гqяРрPpCсТтАаЕеКкМмНнУуХх"
MARK = "[HANDWRITTEN:"
LEAST_CONFIDENCE = 0.3
COMMENTS = (
    (0.3, "Рукопись плохо читается, требуется проверка оператором"),
    (0.5, "Рукопись частично нечёткая, рекомендуется проверить"),
    (0.7, "Рукопись допускает неточности, рекомендуется уточнить"),
)
COMMENT = "Низкая уверенность, требуется проверка оператором"


def _or(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def is_valid(kind: Column, value: Column) -> Column:
    """Some text on one line, not too long, and no sentence unless the type takes long values."""
    v, long = strip(_or(value, "")), _or(kind, "other").isin(*LONG_TYPES)
    sentence = v.endswith(".") & (F.size(words(v)) > 5)
    return (v != "") & ~v.contains("\n") & (F.length(v) <= F.when(long, 500).otherwise(150)) & ~(sentence & ~long)


def unmarked(text: Column) -> Column:
    return F.regexp_replace(text, r"(?iU)\[HANDWRITTEN:\s*([^\]]*)\]", "$1")


def ambiguity(snippet: Column) -> Column:
    """1 less 0.08 for each token that mixes letters and digits or looks confusable; 0.8 at least."""
    tokens = F.regexp_extract_all(unmarked(snippet), F.lit(r"(?U)\w+"), F.lit(0))

    def unclear(t: Column) -> Column:
        letter, digit = t.rlike(r"\p{L}"), t.rlike(r"\p{Nd}")
        kept = F.length(t) - F.length(F.regexp_replace(t, f"[{CONFUSABLE}]", ""))
        return F.when(letter & digit, True).when(letter & (F.length(t) >= 3), kept / F.length(t) >= 0.6).otherwise(False)

    return F.greatest(F.lit(0.8), 1 - 0.08 * F.size(F.filter(tokens, unclear)))


def handwriting_penalty(value: Column, evidence: Column, source: Column) -> Column:
    """Short, very long and ambiguous snippets, and pages full of handwriting, are less sure."""
    shown = F.coalesce(F.nullif(strip(_or(evidence, "")), F.lit("")), strip(_or(value, "")))

    def scaled(s: Column) -> Column:
        n = F.length(s)
        size = F.when(n <= 4, 0.75).when(n <= 10, 0.85).when(n > 60, 0.9).otherwise(1.0)
        return F.when(s == "", 1.0).otherwise(size * ambiguity(s))

    text = _or(source, "")
    marks = (F.length(text) - F.length(F.replace(text, F.lit(MARK), F.lit("")))) / len(MARK)
    crowd = F.when(marks >= 2, 1 - F.least(F.lit(0.15), 0.03 * (marks - 1))).otherwise(1.0)
    return bound(unmarked(shown), scaled) * crowd


def in_source(evidence: Column, source: Column) -> Column:
    """Is the evidence, but for case and spacing, in the source? True if either is too short to tell."""
    e, s = strip(_or(evidence, "")), _or(source, "")
    return (s == "") | (F.length(e) < 3) | squeezed(s).contains(squeezed(e))


def confidence(raw: Column, value: Column, evidence: Column, handwritten: Column, source: Column) -> Column:
    """Raw confidence, lowered for handwriting and for evidence the source lacks; four digits."""
    v, e = strip(_or(value, "")), strip(_or(evidence, ""))
    hand = _or(handwritten, False) | F.concat_ws(" ", v, e).contains(MARK)
    default = 0.70 - 0.35 * (1 - handwriting_penalty(v, e, source))
    base = F.when(hand & (raw.isNull() | (raw >= 1.0)), default).otherwise(_or(raw, 0.5))
    base = base * F.when(hand, 0.85).otherwise(1.0) * F.when(in_source(e, source), 1.0).otherwise(0.7)
    return F.when(v == "", 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.bround(base, 4))))


def comment(score: Column, handwritten: Column) -> Column:
    """What an operator is told of a score below 0.5; null from there on."""
    out = F.when(~_or(handwritten, False), COMMENT)
    for limit, text in COMMENTS:
        out = out.when(score < limit, text)
    return F.when(score < 0.5, out.otherwise(COMMENT))


def normalised(kind: Column, value: Column, given: Column, document_type: Column) -> Column:
    """(type, normalized_value): units, ranges, tolerances and dates in one form."""
    v, k = strip(_or(value, "")), F.lower(_or(kind, ""))
    technical = document_type.isin(*TECHNICAL)
    amount = technical & k.isin(*AMOUNT_TYPES) & v.rlike(r"(?iU)\b\d+(?:\.\d+)?\s*(?:мм|см|м|км|кг|г|с|мс|Гц|кГц|МГц|В|А|Вт|кВт)\b")
    span = technical & v.rlike(r"(?iU)от\s+\d+(?:\.\d+)?\s*до\s+\d+(?:\.\d+)?")
    tolerance = technical & v.rlike(r"(?U)[±\+]\s*\d+(?:\.\d+)?")
    d = r"(?U)(\d{2})\.(\d{2})\.(\d{4})"
    date = F.concat_ws("-", F.regexp_extract(v, d, 3), F.regexp_extract(v, d, 2), F.regexp_extract(v, d, 1))
    form = F.when(amount, "NUM UNIT").when(span, "RANGE_NUM").when(tolerance, "TOLERANCE_NUM").when((k == "date") & v.rlike(d), date)
    return F.struct(F.when(amount, "amount").otherwise(kind).alias("type"), F.coalesce(F.nullif(given, F.lit("")), form).alias("normalized_value"))


def processed(entity: Column, source: Column, page: Column) -> Column:
    """One raw entity (type, value, normalized_value, page, paragraph, evidence, confidence,
    handwritten) as a record; null if it is not valid."""
    value, evidence = _or(entity["value"], ""), _or(entity["evidence"], "")
    score = confidence(entity["confidence"], value, evidence, entity["handwritten"], source)
    hand = F.coalesce(entity["handwritten"], F.concat_ws(" ", evidence, value).contains(MARK))
    record = F.struct(
        _or(entity["type"], "other").alias("type"),
        value.alias("value"),
        entity["normalized_value"].alias("normalized_value"),
        F.coalesce(F.nullif(entity["page"], F.lit(0)), F.greatest(page, F.lit(1))).alias("page"),
        _or(entity["paragraph"], 0).alias("paragraph"),
        evidence.alias("evidence"),
        score.alias("confidence"),
        hand.alias("handwritten"),
        comment(score, hand).alias("comment"),
    )
    return F.when(is_valid(entity["type"], value), record)
