"""Text predicates and clean-ups as Column expressions.

Regular expressions are Java's. (?U) makes classes and \\b cover all of Unicode and
(?i) with it all cases; blanks also take in U+001C to U+001F, as the reference does.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioscope.functions.arrays import bound

#: What counts as blank.
WHITE = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = r"[\s\x{1c}-\x{1f}]"
LINE_END = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"

#: Key words of document types, in order of precedence.
TYPE_WORDS = {
    "article": r"abstract|introduction|methods|results|discussion|references|аннотация|введение|методы|результаты|обсуждение|список литературы",
    "report": r"slide|слайд|конференц|семинар|цель работы|методы|выводы|итоги",
    "thesis": r"диссертация|автореферат|кандидат|доктор|глава\s+\d+|введение|обзор литературы|методика|результаты|заключение|список литературы",
    "tech_doc": r"требования|функционал|нефункционал|спецификация|инструкция|руководство оператора|реvision|редакция|действует",
    "directive": r"приказываю|указываю|поручаю|обязываю|рекомендую|в соответствии с|на основании|срок исполнения|контроль оставляю",
    "certificate": r"справка|выдана|№\s*[A-Za-z0-9]+|от\s+\d{2}\.\d{2}\.\d{4}|имеет|не имеет|по состоянию на|за период",
    "summary": r"сводка|итого|всего|по состоянию на|дтп|пожар|происшествие|статистика|за\s+\d+\s+(?:час|сутки|день|месяц)",
    "review": r"плюсы|минусы|итог|вердикт|сравнение|в отличие|по сравнению|оценка|рейтинг",
    "textbook": r"определение|теорема|пример\s+\d+|задача\s+\d+|решение|глава\s+\d+|параграф\s+\d+|§\s*\d+|\n\n[0-9]+(?:\.[0-9]+)*\s+",
    "ttkh": r"тактико-технические характеристики|ттх|масса|габариты|экипаж|вооружение|дальность|скорость|запас хода|двигатель",
    "ttz": r"техническое задание|ттз|должно обеспечивать|не должно превышать|в диапазоне от|вероятность не менее|требования|пункт\s+\d+(?:\.\d+)*",
}
#: Words of collections, and of lines that open an article.
COLLECTION_WORDS = r"сборник|журнал|газета|альманах|вестник|выпуск|содержание|оглавление|номер|вып\.\s*\d|№\s*\d"
TITLE_LINE = r"^[А-ЯЁA-Z0-9][^\n]{4,78}$"
#: Lines that the Office converters drop.
DOCX_NOISE = (
    r"^(?:Стр\.|Стр\s*:|Page\s+\d+|Page\s*:.*)$",
    r"^(?:Содержание|Оглавление|Contents)$",
    r"^(?:Список\s+литературы|Литература|References|Bibliography)$",
    r"^(?:Благодарности|Acknowledgements?)$",
    r"^(?:Приложения|Appendix)$",
)
PPTX_NOISE = (r"^(?:Стр\.|Page\s+\d+|Page\s*:.*|Слайд\s+\d+|Slide\s+\d+)$",)


def strip(text: Column) -> Column:
    """Without blanks at both ends."""
    return F.btrim(text, F.lit(WHITE))


def split_lines(text: Column) -> Column:
    """Lines at any Unicode line end; a final line end opens no line."""
    return bound(F.split(text, LINE_END, -1), lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, 1, F.size(x) - 1)).otherwise(x))


def stripped_lines(text: Column) -> Column:
    return F.transform(split_lines(text), strip)


def words(text: Column) -> Column:
    """Words between blanks; none in a blank text."""
    return F.filter(F.split(text, rf"(?U){BLANK}+", -1), lambda w: w != "")


def squeezed(text: Column) -> Column:
    """Lower case, with single spaces between words."""
    return F.array_join(words(F.lower(text)), " ")


def is_blank(text: Column) -> Column:
    return F.coalesce(~text.rlike(rf"(?U)[^\s\x{{1c}}-\x{{1f}}]"), F.lit(True))


def alternatives(pattern: str) -> list[str]:
    """The parts of a pattern between its outermost bars."""
    out, depth = [""], 0
    for sign in re.findall(r"\\.|\[\^?\]?(?:\\.|[^\]])*\]|.", pattern, re.DOTALL):
        depth += (sign == "(") - (sign == ")")
        if sign == "|" and depth == 0:
            out.append("")
        else:
            out[-1] += sign
    return out


def beginning(pattern: str) -> str:
    """What every match begins with: the plain signs up to the first special one."""
    plain = re.match(r"[^\\\[\](){}.*+?|^$]*", pattern)[0]
    return plain[:-1] if pattern[len(plain) : len(plain) + 1] in ("?", "*", "{", "+") else plain


def mentions(low: Column, pattern: str) -> Column:
    """Does a lower-cased text have one of the pattern's alternatives, in any case? Plain words are
    sought byte by byte, which costs a fraction of a regular expression, and regular expressions
    only where the text has what they begin with."""
    found = F.lit(False)
    for part in alternatives(pattern):
        if part == re.escape(part).replace("\\ ", " ").replace("\\-", "-"):
            found = found | low.contains(part.lower())
            continue
        # an escape of upper case means another class: such a pattern keeps its case
        lowered = part if re.search(r"\\[A-Z]", part) else part.lower()
        test = low.rlike(f"(?U)(?:{lowered})" if lowered.lower() == lowered else f"(?iU)(?:{part})")
        found = found | ((low.contains(beginning(part).lower()) & test) if beginning(part) else test)
    return found


def document_type(text: Column, suffix: Column | None = None, rules: dict[str, str] | None = None, sample: int = 4000) -> Column:
    """The first rule found in the first `sample` characters; else by suffix, else other."""
    by_suffix = F.lit("other") if suffix is None else F.when(F.lower(suffix) == ".pptx", "report").otherwise("other")

    def named(low: Column) -> Column:
        out = None
        for name, pattern in (rules or TYPE_WORDS).items():
            test = mentions(low, pattern)
            out = F.when(test, name) if out is None else out.when(test, name)
        return out.otherwise(by_suffix)

    return bound(F.lower(F.substring(F.coalesce(text, F.lit("")), 1, sample)), named)


def meaningful(text: Column, least: int = 200, prose: int = 40) -> Column:
    """At least `least` characters, two lines with text, and one longer than `prose`."""

    def judged(t: Column) -> Column:
        lines = F.filter(stripped_lines(t), lambda x: x != "")
        return (F.length(t) >= least) & bound(lines, lambda x: (F.size(x) >= 2) & F.exists(x, lambda y: F.length(y) > prose))

    return F.coalesce(bound(strip(text), judged), F.lit(False))


def is_collection(text: Column, words_pattern: str = COLLECTION_WORDS) -> Column:
    """Key words in the first 3000 characters, or two title lines on the first five pages with text."""
    # fixed values: 3000 characters, five pages, two titles of twelve words at most
    first = lambda p: strip(F.element_at(split_lines(strip(p)), 1))

    def titled(pages: Column) -> Column:
        title = lambda t: t.rlike(TITLE_LINE) & (F.size(words(t)) <= 12)
        return F.when(F.size(pages) < 2, False).otherwise(F.size(F.filter(F.slice(pages, 1, 5), lambda p: bound(first(p), title))) >= 2)

    pages = F.filter(F.split(text, "\f", -1), lambda p: ~is_blank(p))
    return F.coalesce(bound(F.lower(F.substring(text, 1, 3000)), lambda low: mentions(low, words_pattern)) | bound(pages, titled), F.lit(False))


def file_name(name: Column) -> Column:
    """A name that file systems take; 'unnamed' if nothing is left."""
    safe = F.regexp_replace(name, r'[<>:"/\\|?*\x00-\x1f]+', "_")
    bare = F.regexp_replace(strip(safe), r"^\.+|\.+$", "")
    return F.coalesce(F.nullif(bare, F.lit("")), F.lit("unnamed"))


def without_regions(text: Column) -> Column:
    """Without the bbox and img suffixes of image links."""
    return F.regexp_replace(text, r"(?iU)\s*(?:\|\s*(?:bbox:\s*[\d.\s]+?|img:\s*\d+)\s*)+(?=\]|$)", "")


def ocr_cleaned(text: Column) -> Column:
    """8OO and O0 before millimetres become digits; a hyphen between digits a space."""
    # fixed values: the three patterns
    text = F.regexp_replace(text, r"(?U)\b8OO((?iu:\s*мм|\s*mm))\b", "800$1")
    text = F.regexp_replace(text, r"(?U)\bO0((?iu:\s*мм|\s*mm))\b", "00$1")
    return F.regexp_replace(text, r"(?U)(?<=\d)(\s*)-(\s*)(?=\d)", "$1 $2")


def without_fences(text: Column) -> Column:
    """Without a code fence that opens a text, and the one that ends it."""

    def opened(t: Column) -> Column:
        lines = split_lines(t)
        rest = bound(lines, lambda x: F.when(F.size(x) > 1, F.slice(x, 2, F.size(x))).otherwise(x))
        ended = bound(rest, lambda x: F.when((F.size(x) > 0) & (strip(F.element_at(x, -1)) == "```"), F.slice(x, 1, F.size(x) - 1)).otherwise(x))
        return F.when(t.startswith("```"), strip(F.array_join(ended, "\n"))).otherwise(t)

    return bound(strip(text), opened)


def without_thinking(text: Column) -> Column:
    """Without the blocks in which models think aloud."""
    # fixed values: the names of the blocks and their forms
    for tag in ("thinking", "thought", "reasoning"):
        if tag == "thought":
            text = F.regexp_replace(text, r"(?is)\[THINKING\][^\[]*\[/THINKING\]", "")
        text = F.regexp_replace(text, rf"(?isU)<{tag}>\s*.*?\s*</{tag}>\s*", "")
    text = F.regexp_replace(text, r"(?i)<arg_value>[^\n]*</arg_value>", "")
    text = strip(F.regexp_replace(text, r"(?iU)</thinking>\s*$", ""))
    return strip(F.regexp_replace(text, r"(?iU)\[/THINKING\]\s*$", ""))


def unescaped(text: Column) -> Column:
    """Markdown escapes resolved."""
    return F.regexp_replace(text, r"\\([.\-*+\\`()\[\]{}#!|>~])", "$1")


def without_noise(text: Column, patterns: tuple[str, ...] = DOCX_NOISE) -> Column:
    """Without noise lines; at most one blank line in a row."""
    noise = "|".join(f"(?:{p})" for p in patterns)
    kept = F.filter(split_lines(text), lambda x: ~strip(x).rlike(f"(?iU){noise}"))
    lines = F.transform(kept, lambda x: F.when(is_blank(x), "").otherwise(x))
    return strip(F.regexp_replace(F.array_join(lines, "\n"), r"\n{3,}", "\n\n"))


def draft(text: Column) -> Column:
    """Line ends, real and spelled out, as line feeds."""
    return F.regexp_replace(F.regexp_replace(text, r"\r\n?", "\n"), r"\\n", "\n")


def head_and_tail(text: Column, limit: int, mark: str = "\n...\n[текст обрезан для контекста]\n...\n") -> Column:
    """A text over `limit` as its first and last halves of the limit, with a mark between."""
    half = limit // 2
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, half), F.lit(mark), F.substring(text, -half, half))).otherwise(text)


def slide_heading(text: Column) -> Column:
    """A slide's heading as Markdown, null if the text is none."""
    # fixed values: the forms of headings, and twelve words at most
    t = strip(text)
    number = F.regexp_extract(t, r"(?U)^([0-9]+(?:\.[0-9]+)*)(?:\s|$)", 1)
    depth = F.least(F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1, F.lit(6))
    is_heading = t.rlike(r"(?U)^(?:Глава\s+\d+|[0-9]+(?:\.[0-9]+)*\s+.+)$") | ((F.size(words(t)) <= 12) & t.rlike("[:：]$"))
    shaped = F.when(t.rlike(r"(?iU)^Глава\s+\d+"), F.concat(F.lit("# "), t)).when(number != "", F.concat(F.repeat(F.lit("#"), depth), F.lit(" "), t)).otherwise(F.concat(F.lit("### "), t))
    return F.when(F.coalesce(is_heading, F.lit(False)) & (t != ""), shaped)


def markdown_table(rows: Column) -> Column:
    """Rows of cells as a Markdown table; short rows are padded, no rows give an empty text."""
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))

    def shaped(r: Column) -> Column:
        return bound(F.array_max(F.transform(r, F.size)), lambda n: bound(F.transform(r, lambda c: line(F.concat(c, F.array_repeat(F.lit(""), n - F.size(c))))), lambda x: F.array_join(F.flatten(F.array(F.slice(x, 1, 1), F.array(line(F.array_repeat(F.lit("---"), n))), F.slice(x, 2, F.size(x)))), "\n")))

    return F.when(F.size(rows) < 1, "").otherwise(bound(rows, shaped))


def page_size(value: Column) -> Column:
    """(width, height) of 'WxH' with positive numbers, else null."""
    p = r"^\s*([0-9]+(?:\.[0-9]+)?)\s*[xX×]\s*([0-9]+(?:\.[0-9]+)?)\s*$"
    width = F.regexp_extract(value, p, 1).try_cast("double")
    height = F.regexp_extract(value, p, 2).try_cast("double")
    return F.when((width > 0) & (height > 0), F.struct(width.alias("width"), height.alias("height")))
