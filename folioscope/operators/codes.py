"""Classification codes with evidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.arrays import bound, matches, places
from folioscope.functions.text import strip

#: Code families in order of output, and their numbers.
FAMILIES = {
    "УДК": r"[0-9]+(?:\.[0-9]+)*",
    "ГРНТИ": r"[0-9]{1,2}(?:\.[0-9]{1,2}){1,2}",
    "ГНТИ": r"[0-9]{1,2}(?:\.[0-9]{1,2}){1,2}",
}
RADIUS = 60


def evidence(text: Column, start: Column, end: Column, radius: int = RADIUS) -> Column:
    """Up to `radius` characters around a match, on one line."""
    first = F.greatest(start - radius, F.lit(0))
    return strip(F.replace(F.substring(text, first + 1, end + radius - first), F.lit("\n"), F.lit(" ")))


def first_of_each(found: Column, key) -> Column:
    """Elements whose key no earlier element has."""
    return bound(found, lambda x: bound(F.transform(x, key), lambda k: F.transform(places(x, lambda e, i: F.array_position(k, key(e)) == i + 1), lambda i: F.get(x, i))))


def extracted(text: Column, page: Column, families: dict[str, str] | None = None, head: str = r"(?iU)\b{name}\s*({number})") -> Column:
    """array of (type, value, number, evidence, page): codes by family, then by position; the
    first of each type and number. Null texts have none."""
    def of(name: str, number: str) -> Column:
        pattern = head.format(name=name, number=number)
        found = first_of_each(matches(text, pattern, 1, within=True), lambda m: m["value"])
        records = F.transform(
            found,
            lambda m: F.struct(
                F.lit(name).alias("type"),
                m["found"].alias("value"),
                m["value"].alias("number"),
                evidence(text, m["start"], m["end"]).alias("evidence"),
                page.cast("int").alias("page"),
            ),
        )
        return F.when(text.rlike(pattern), records)  # most texts have none: one look, no arrays

    parts = [of(name, number) for name, number in (families or FAMILIES).items()]
    return F.concat(*[F.coalesce(p, F.array().cast("array<struct<type:string,value:string,number:string,evidence:string,page:int>>")) for p in parts])
