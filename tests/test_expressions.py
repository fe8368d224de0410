"""Golden cases of single expressions."""

import itertools
import math
import random
import re

from pyspark.sql import functions as F

from folioscope.functions import arrays, entities, layout, text
from folioscope.operators import codes, relational, segment


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_paragraphs(spark):
    markdown = "<!-- page 1 -->\n# Title\nfirst line\n\nsecond\n\n<!-- page 2 -->\n## Part\ntext\n\nlast"
    got = one(spark, segment.paragraphs(F.lit(markdown)))
    assert [(r["page"], r["paragraph"], r["text"], r["section"], r["section_level"]) for r in got] == [
        (1, 1, "# Title\nfirst line", "Title", 1),
        (1, 2, "second", "Title", 1),
        (2, 1, "## Part\ntext", "Part", 2),
        (2, 2, "last", "Part", 2),
    ]
    assert one(spark, segment.paragraphs(F.lit("")))  == []
    assert one(spark, segment.paragraphs(F.lit(None).cast("string"))) == []


def test_blocks(spark):
    markdown = "# H\n\nwrapped\nline\n\n- a\n- b\n\n| x | y |\n|---|---|\n| 1 | 2 |\n\n<!-- page 2 -->\n## Next\ntail"
    got = one(spark, segment.blocks(F.lit(markdown)))
    assert [b["kind"] for b in got] == ["heading", "paragraph", "list", "table", "page_break", "heading", "paragraph"]
    assert got[1]["text"] == "wrapped line" and got[2]["items"] == ["a", "b"]
    assert got[3]["rows"] == [["x", "y"], ["1", "2"]] and got[4]["level"] == 2


def test_articles(spark):
    issue = "Журнал №1\nвступление\n\nСтатья первая\nтекст\fСтатья вторая\nещё\f \nхвост"
    got = one(spark, segment.articles(F.lit(issue)))
    assert [(a["text"], a["page"]) for a in got] == [("Журнал №1\nвступление", 1), ("Статья первая\nтекст", 2), ("Статья вторая\nещё\nхвост", 3)]
    assert [(a["text"], a["page"]) for a in one(spark, segment.articles(F.lit(" plain ")))] == [("plain", 1)]
    assert [a["text"] for a in one(spark, segment.articles(F.lit(None).cast("string")))] == [""]


def test_codes(spark):
    got = one(spark, codes.extracted(F.lit("x\nудк 51.78 и ГРНТИ 12.34.56; УДК 51.78"), F.lit(2)))
    assert [(c["type"], c["value"], c["number"], c["page"]) for c in got] == [("УДК", "удк 51.78", "51.78", 2), ("ГРНТИ", "ГРНТИ 12.34.56", "12.34.56", 2)]
    assert got[0]["evidence"] == "x удк 51.78 и ГРНТИ 12.34.56; УДК 51.78"


def test_bbox(spark):
    assert one(spark, text.without_regions(F.lit("[Image: photo: портрет | bbox: 100 200 300 400 | img: 2]"))) == "[Image: photo: портрет]"


def test_confidence(spark):
    score = lambda raw, hand, source: one(spark, entities.confidence(F.lit(raw), F.lit("value"), F.lit("evidence"), F.lit(hand), F.lit(source)))
    assert score(0.9, True, "elsewhere") == 0.5355
    assert score(0.9, False, "elsewhere") == 0.63
    assert score(0.8, False, "some  EVIDENCE here") == 0.8


def test_normalised(spark):
    got = one(spark, entities.normalised(F.lit("date"), F.lit("12.05.2026"), F.lit(None).cast("string"), F.lit("other")))
    assert tuple(got) == ("date", "2026-05-12")


def test_widths(spark):
    rows = [["x" * 5] * 3, ["y" * 90, "b", "c"]]
    weights = one(spark, layout.column_weights(F.array(*[F.array(*[F.lit(c) for c in r]) for r in rows])))
    assert weights == [48, 5, 5]
    widths = one(spark, layout.scaled_widths(F.array(*[F.lit(w) for w in weights]), 480.0))
    assert sum(widths) <= 480.0001 and widths[0] == max(widths)
    assert one(spark, layout.scaled_widths(F.array_repeat(F.lit(10), 200), 480.0)) == [9.0] * 200


def test_links(spark):
    wrapped = "[HANDWRITTEN: a\nb](img/\nx.png) and ![a](b.png)"
    got = spark.createDataFrame([(wrapped,)], "t string").select(segment.joined_links(F.col("t"))).first()[0]
    assert got == "[HANDWRITTEN: a b](img/x.png) and ![a](b.png)"


def test_middle_split(spark):
    assert tuple(one(spark, segment.middle_split(F.lit("aa bb  cc dd")))) == ("aa bb", "  ", "cc dd")
    assert tuple(one(spark, segment.middle_split(F.lit("abc")))) == ("", "", "abc")


def test_chunks(spark):
    body = "one two\n\n" + "word " * 30 + "\n\nend"
    got = spark.createDataFrame([(body,)], "t string").select(segment.chunks(F.col("t"), 40)).first()[0]
    assert [c["text"] for c in got][0] == "one two" and got[-1]["text"] == "end"
    assert all(len(c["text"]) <= 40 for c in got) and got[-1]["start"] == body.rindex("end")


def test_strip_like_python(spark):
    signs = [0x9, 0xA, 0xB, 0xC, 0xD, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    for s in signs:
        t = f"{chr(s)}a{chr(s)}b{chr(s)}"
        row = spark.createDataFrame([(t,)], "t string").select(text.strip(F.col("t")), text.split_lines(F.col("t")), text.words(F.col("t"))).first()
        assert (row[0], row[1], row[2]) == (t.strip(), t.splitlines(), t.split()), hex(s)


def test_ledger(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "file string")
    ledger = spark.createDataFrame([("a", "ok"), ("a", "error"), ("b", "error"), ("c", "skip")], "file string, status string")
    assert [r[0] for r in relational.pending(files, ledger).collect()] == ["b"]
    assert relational.pending(files, ledger, force=True).count() == 3


def test_names_are_unique(spark):
    rows = spark.createDataFrame([(i, s) for i, s in enumerate(["x", "x", "x_2", "x", "", "..", "a/b"])], "i int, stem string")
    names = [r["name"] for r in relational.export_names(rows, "stem", ["i"]).orderBy("i").collect()]
    assert names == ["x", "x_3", "x_2", "x_4", "unnamed", "unnamed_2", "a_b"]


def test_lines_needed(spark):
    t = "a" * 100 + "\n\n" + "b" * 10
    fit = max(4, int(200 / (12 * 0.52)))
    want = sum(max(1, math.ceil(len(x) / fit)) for x in t.split("\n"))
    assert one(spark, layout.lines_needed(F.lit(t), F.lit(200.0), F.lit(12.0))) == want
    assert re.match("a", t)


def packed(text: str, limit: int) -> list[tuple[str, int]]:
    """Pieces by definition: paragraphs by places, joined while they fit, long ones word by word."""
    if len(text) <= limit:
        return [(text, 0)]
    paragraphs, at = [], 0
    for p in text.split("\n\n"):
        at = text.index(p, at)
        paragraphs.append((p, at))
        at += len(p)
    out, group = [], []
    fits = lambda g: sum(len(p) + 2 for p, _ in g) <= limit
    for p, at in [*paragraphs, (None, 0)]:
        if group and (p is None or len(p) > limit or not fits([*group, (p, at)])):
            out.append(("\n\n".join(x for x, _ in group), group[0][1]))
            group = []
        if p is not None and len(p) <= limit:
            group.append((p, at))
        elif p is not None:
            line: list[str] = []
            for w in [*p.split(), None]:
                if line and (w is None or sum(len(x) + 1 for x in [*line, w]) > limit):
                    out.append((" ".join(line), at))
                    line = []
                if w is not None:
                    line.append(w)
    return out


def test_chunks_of_any_text(spark):
    rng = random.Random(8)
    parts = ["a", "word", "é" * 9, " ", "\n", "\n\n", "\n\n", "\n\n\n", "long " * 12, "x" * 50]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", segment.chunks(F.col("t"), 40).alias("c")).collect()
    for r in rows:
        assert [(c["text"], c["start"]) for c in r["c"]] == packed(r["t"], 40), repr(r["t"])
    assert spark.createDataFrame([(None,)], "t string").select(segment.chunks(F.col("t"), 40)).first()[0] == [("", 0)]


def test_running_and_carried(spark):
    rng = random.Random(9)
    lists = [[rng.randint(0, 9) for _ in range(n)] for n in (0, 1, 63, 64, 65, 128, 1000)]
    rows = spark.createDataFrame([(x,) for x in lists], "x array<int>")
    for r in rows.select("x", arrays.running(F.col("x")).alias("s"), arrays.carried(F.col("x"), lambda v: F.when(v > 7, v), -1).alias("c")).collect():
        assert r["s"] == list(itertools.accumulate(r["x"]))
        assert r["c"] == list(itertools.accumulate(r["x"], lambda a, v: v if v > 7 else a, initial=-1))[1:]


def test_matches_of_long_texts(spark):
    text = "no 7, " * 20_000
    rows = spark.createDataFrame([(text,)], "t string")
    for within in (False, True):
        got = rows.select(arrays.matches(F.col("t"), r"no ([0-9])", 1, within).alias("m")).select(F.size("m"), F.element_at("m", -1)).first()
        assert got[0] == 20_000 and (got[1]["start"], got[1]["end"], got[1]["value"]) == (len(text) - 6, len(text) - 2, "7")


def test_as_of_in_parts(spark):
    """Parts of the time line give what the whole line gives, hot key or not."""
    rng = random.Random(10)
    events = spark.createDataFrame([(i, rng.choice("aab"), rng.randint(0, 500)) for i in range(400)], "id int, k string, t int")
    states = spark.createDataFrame([(rng.choice("ab"), t, rng.choice([None, float(t)])) for t in rng.sample(range(500), 60)], "k string, since int, v double")
    whole = relational.as_of(events, states, ["k"], "t", "since", "v").orderBy("id").collect()
    for span in (1, 7, 100, 1000):
        assert relational.as_of(events, states, ["k"], "t", "since", "v", span=span).orderBy("id").collect() == whole
    known = [(r["k"], r["since"], r["v"]) for r in states.collect() if r["v"] is not None]
    assert all(r["v"] == max(((t, v) for k, t, v in known if k == r["k"] and t <= r["t"]), default=(0, None))[1] for r in whole)


def test_numbers_of_a_hot_key(spark):
    rng = random.Random(12)
    data = [(i, rng.choice("aaaab"), rng.choice([None, 0, 1, 5, 5, 1000, rng.randint(0, 10**6)])) for i in range(2000)]
    got = relational.numbered(spark.createDataFrame(data, "id int, k string, size long"), "k", ["size", "id"]).collect()
    for key in "ab":
        own = sorted((d for d in data if d[1] == key), key=lambda d: (d[2] is not None, d[2] or 0, d[0]))
        assert {r["id"]: r["n"] for r in got if r["k"] == key} == {d[0]: i for i, d in enumerate(own, 1)}


def test_reviewed_files_and_order(spark):
    files = spark.createDataFrame([("b/x.png", False), ("a/x.pdf", False), ("c/y.png", False), ("z", True)], "path string, is_dir boolean")
    marks = spark.createDataFrame([("done/x.json",)], "path string")
    assert [r["path"] for r in relational.in_order(relational.unreviewed(files, marks)).collect()] == ["z", "c/y.png"]
