"""The entity store on disk, measured texts, pictures in PDF files, lists of Word files, and page images."""

import io
import json
import os
import re
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.plans import bundles, extraction, model
from folioscope.sinks import drawings, fonts, ledger, pdf, store, word
from folioscope.sources import images, ooxml


# store


def rows_of(spark, *rows):
    return spark.createDataFrame(rows, "file string, value int, tags array<string>")


def test_store(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    assert store.manifest(path) is None
    with pytest.raises(FileNotFoundError):
        store.read(spark, path)
    assert len(store.update(rows_of(spark, *((f"f{i}", i, ["a"]) for i in range(200)), (None, 1, [])), path, buckets=16)) == 16
    held = lambda: {r["file"]: (r["value"], r["tags"]) for r in store.read(spark, path).collect()}
    assert len(held()) == 200
    before = {b: os.listdir(f"{path}/{f}/__bucket={b}") for b, f in store.manifest(path)["held"].items()}
    # an update rewrites the buckets it touches and no others; of two rows of a key the greater stays
    touched = store.update(rows_of(spark, ("f7", -7, ["new"]), ("f7", -8, []), ("g", 1, None)), path)
    after = {b: os.listdir(f"{path}/{f}/__bucket={b}") for b, f in store.manifest(path)["held"].items()}
    assert {int(b) for b in after if after[b] != before[b]} == set(touched) and len(touched) <= 2
    now = held()
    assert len(now) == 201 and now["f7"] == (-7, ["new"]) and now["f8"] == (8, ["a"]) and now["g"] == (1, None)
    assert {r["file"] for r in store.read(spark, path, ["f7", "g", "none"]).collect()} == {"f7", "g"}
    assert store.update(rows_of(spark), path) == [] and held() == now
    with pytest.raises(ValueError, match="holds"):
        store.update(rows_of(spark).drop("tags"), path)

    # a write that is killed leaves the store whole, and what it left is swept by the next one
    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(store, "_put", killed)
        with pytest.raises(KeyboardInterrupt):
            store.update(rows_of(spark, ("f8", 0, [])), path)
    assert held() == now
    for i in range(3):
        store.update(rows_of(spark, ("f8", i, [])), path)
    state = store.manifest(path)
    assert held()["f8"] == (2, []) and set(os.listdir(path)) == {store.MANIFEST, *state["held"].values(), *state["replaced"]}
    assert store.exported(spark, path, str(tmp_path / "out.json")) == 201
    assert json.load(open(tmp_path / "out.json"))["f8"] == {"value": 2, "tags": []}


def test_rows_of_the_entity_store(spark):
    record = lambda kind, value: (kind, value, None, 1, 1, value, 0.9, False, None)
    records = spark.createDataFrame([("a", 1, 0, record("date", "Two")), ("a", 0, 1, record("date", "one")), ("a", 2, 0, record("date", " two "))], ledger.T.StructType([*ledger.T._parse_datatype_string("file string, position int, number int").fields, ledger.T.StructField("record", ledger.ENTITY)]))
    documents = spark.createDataFrame([("a", "# Head\n\ntext"), ("b", "")], "file string, text string")
    got = {r["file"]: r for r in extraction.entity_rows(records, documents, spark.createDataFrame([("a", "short")], "file string, annotation string")).collect()}
    assert [e["value"] for e in got["a"]["entities"]] == ["one", "Two"] and got["a"]["annotation"] == "short" and len(got["a"]["paragraphs"]) == 2
    assert (got["b"]["entities"], got["b"]["annotation"]) == ([], "") and extraction.entity_rows(records, documents).count() == 2


# measured texts


def made_font(widths, unit=1000):
    """A TrueType file of letters from A on, with a table of runs; the last advance counts for the rest."""
    n = len(widths)
    runs = struct.pack(">HHHHHHH", 4, 16 + 8 * 2, 0, 4, 0, 0, 0) + struct.pack(">HH", 64 + n, 0xFFFF) + b"\0\0" + struct.pack(">HHHHHH", 65, 0xFFFF, (1 - 65) & 0xFFFF, 1, 0, 0)
    tables = {
        b"head": b"\0" * 18 + struct.pack(">H", unit) + b"\0" * 34,
        b"hhea": b"\0" * 34 + struct.pack(">H", n + 1),
        b"hmtx": b"".join(struct.pack(">HH", w, 0) for w in (300, *widths)),
        b"cmap": struct.pack(">HHHHI", 0, 1, 3, 1, 12) + runs,
    }
    at, head, body = 12 + 16 * len(tables), b"\0\1\0\0" + struct.pack(">HHHH", len(tables), 0, 0, 0), b""
    for tag, t in tables.items():
        head += struct.pack(">4sIII", tag, 0, at + len(body), len(t))
        body += t
    return head + body


def test_widths_of_a_font(tmp_path):
    font = fonts.parsed(made_font([500, 250, 1000], 2000))
    assert [font.width(c, 10) for c in "ABC?"] == [2.5, 1.25, 5.0, 1.5]
    assert fonts.font_at(str(tmp_path / "none.ttf")) is None
    (tmp_path / "bad.ttf").write_bytes(b"\0\1\0\0\0\1")
    assert fonts.font_at(str(tmp_path / "bad.ttf")) is None
    if real := fonts.font_at():
        assert real.width("i", 12) < real.width("m", 12) < 14 and real.width("Ж", 12) > real.width("г", 12)


def test_measured_lines_never_overrun():
    font = fonts.parsed(made_font([100, 900] + [500] * 24))
    text = "AAAA BBBB ABAB " * 30 + "B" * 90 + " A"
    for width in (0.5, 1.0, 3.0):
        lines = drawings.wrapped(text, width, 12, font)
        assert all(drawings.breadth(x, 12, font) <= width + 1e-9 for x in lines) and "".join("".join(lines).split()) == "".join(text.split())
    # narrow letters fill more of a line than the estimate says, wide ones less
    assert len(drawings.wrapped("AAA " * 99, 3, 12, font)) < len(drawings.wrapped("AAA " * 99, 3, 12)) < len(drawings.wrapped("BBB " * 99, 3, 12, font))


def block(kind, **given):
    return {"kind": kind, "level": 1, "text": "", "rows": [], "items": []} | given


def test_shrink_then_split():
    font = fonts.parsed(made_font([500] * 26))
    wide = [[f"K{i}" for i in range(100)], ["X"] * 100, [*["X"] * 5, "LONG CONTENT OF A CELL " * 40, *["X"] * 94]]
    tall = [["A", "B"], ["WORD " * 3000, "X"], ["Y", "Z"]]
    for cells in (wide, tall):
        pages = drawings.laid_out([block("table", rows=cells)], font=font)
        for s in (s for p in pages for s in p):
            assert s.bottom >= drawings.MARGIN - 1e-6 and s.left + s.width <= drawings.A4[0] - drawings.MARGIN + 1e-6
            assert s.size * 72 >= drawings.SMALLEST and s.text.count("\n") * s.size * drawings.LINE < s.height
        said = sorted("".join("".join(s.text for p in pages for s in p if not s.name.startswith("Header")).split()))
        assert said == sorted("".join("".join(c for r in cells[1:] for c in r).split()))
    assert drawings.shrunk(["W" * 20], [1.2], 12, font, 99) == 8.0 and drawings.shrunk(["W"], [1.2], 12, font, 99) == 12


# pictures in PDF files


def png_of(values, color, lines=None, palette=b"", laced=0):
    high, wide = values.shape[:2]
    raw = b"".join(b"\0" + row.tobytes() for row in values) if lines is None else lines
    parts = ((b"IHDR", struct.pack(">IIBBBBB", wide, high, 8, color, 0, 0, laced)), *([(b"PLTE", palette)] if palette else []), (b"IDAT", zlib.compress(raw)), (b"IEND", b""))
    return images.SIGNATURE + b"".join(struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d)) for k, d in parts)


JPEG = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08\x00\x28\x00\x50\x03" + b"\0" * 9 + b"\xff\xd9"


def stream_of(content, entries):
    """The data of the first object whose entries match."""
    m = re.search(rb"<<([^>]*?/Subtype /Image" + entries + rb".*?)/Length (\d+) >>\nstream\n", content, re.S)
    return m[1], content[m.end() : m.end() + int(m[2])]


def test_pictures_in_pdf():
    grey = np.arange(30 * 20, dtype=np.uint8).reshape(20, 30)
    rgba = np.dstack([grey, grey, grey, np.flipud(grey)])
    shown = {"images/a.png": png_of(grey, 0), "images/b.png": png_of(rgba, 6), "images/c.jpg": JPEG, "images/d.png": png_of(grey % 2, 3, palette=b"\0\0\0\xff\0\0"), "images/e.png": png_of(grey, 0, laced=1), "images/f.png": b"broken"}
    text = "Схема: " + " ".join(f"![pic {p[7]}]({p})" for p in shown) + " end ![lost](images/gone.png)"
    blocks = [block("heading", text="Отчёт"), block("heading", level=2, text="Раздел 1"), block("paragraph", text=text), block("table", rows=[["Параметр", "Значение"], ["Масса", "12.5"]])]
    content = pdf.package(blocks, pictures=shown, font=fonts.font_at())
    assert content.count(b" Do Q") == 0 and content.count(b"/Subtype /Image") == 4 + 1  # four pictures and a mask; streams are packed
    entries, data = stream_of(content, rb" /Width 80")
    assert b"/DCTDecode" in entries and b"/DeviceRGB" in entries and data == JPEG
    entries, data = stream_of(content, rb" /Width 30 /Height 20 /BitsPerComponent 8 /ColorSpace /DeviceGray /Filter /FlateDecode /DecodeParms")
    assert zlib.decompress(data) == b"".join(b"\0" + r.tobytes() for r in grey)
    assert b"/Indexed /DeviceRGB 1 <000000ff0000>" in content and b"/SMask" in content
    drawn = b"".join(zlib.decompress(m[1]) for m in re.finditer(rb"/FlateDecode >>\nstream\n(.*?)\nendstream", content, re.S) if m[1][:1] == b"\x78" and b"Td" in zlib.decompress(m[1]))
    assert drawn.count(b" Do Q") == 4 and all(f"[{n}]".encode() in drawn for n in ("pic e", "pic f", "lost"))
    # each object begins where the table says
    places = [int(x) for x in re.findall(rb"(\d{10}) 00000 n", content)]
    assert all(content[p:].startswith(f"{k} 0 obj".encode()) for k, p in enumerate(places, 1))
    assert pdf.package([]).startswith(b"%PDF")
    # letters beyond Western ones have the widths of the font
    assert b"/Widths [250 750]" in pdf.package([block("paragraph", text="ЖЯ")], font=fonts.Font({ord("Ж"): 250.0}, 750.0)) and b"/Widths [500 500]" in pdf.package([block("paragraph", text="ЖЯ")])


def test_regions_of_pictures(spark, tmp_path):
    """meta.json says how large a picture is shown, in each format."""
    picture = png_of(np.zeros((100, 200), np.uint8), 0)
    assert drawings.region_size(200, 100, [0, 0, 0.5, 0.5]) == pytest.approx((8.5 / 2.54, 4.25 / 2.54))
    assert drawings.region_size(200, 100, [0.1, 0, 0.1, 1]) is None is drawings.region_size(200, 100, None)
    for name, meta in (("one", {"regions": [{"name": "p.png", "bbox": [0, 0, 1, 1]}, {"name": "x/p.png", "bbox": [0.0, 0.0, 0.5, 0.5], "kind": "photo"}]}), ("two", None), ("three", "broken")):
        os.makedirs(tmp_path / name / "images")
        (tmp_path / name / "text.txt").write_text("words ![p](images/p.png)")
        (tmp_path / name / "images" / "p.png").write_bytes(picture)
        if meta:
            (tmp_path / name / "meta.json").write_text(meta if isinstance(meta, str) else json.dumps(meta))
    found = {r["bundle"]: r["pictures"][0]["bbox"] for r in bundles.bundles(spark, str(tmp_path)).collect()}
    assert found == {"one": [0.0, 0.0, 0.5, 0.5], "two": None, "three": None}
    made = {(r["bundle"], r["format"]): bytes(r["content"]) for r in bundles.rebuilt(bundles.bundles(spark, str(tmp_path)), content="document").collect()}
    size = lambda b: int(re.search(rb'cx="(\d+)"', zipfile.ZipFile(io.BytesIO(made[b, "docx"])).read("word/document.xml"))[1])
    assert size("one") == round(8.5 * 360_000) and size("two") == round(200 / 150 * 2.54 * 360_000) == size("three")
    width = lambda b: max(float(m[1]) for s in re.findall(rb"/FlateDecode >>\nstream\n(.*?)\nendstream", made[b, "pdf"], re.S) for m in re.finditer(rb"q ([\d.]+) 0 0 [\d.]+ [\d.]+ [\d.]+ cm", zlib.decompress(s)))
    assert width("one") == pytest.approx(8.5 / 2.54 * 72, abs=0.01) and width("two") == pytest.approx(96)


# lists of Word files

WORD = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships" xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:wp="http://schemas.openxmlformats.org/drawingml/2006/wordprocessingDrawing"'


def word_file(body, numbering="", styles="", relations=""):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("word/document.xml", f"<w:document {WORD}><w:body>{body}</w:body></w:document>")
        z.writestr("word/styles.xml", f"<w:styles {WORD}>{styles}</w:styles>")
        z.writestr("word/_rels/document.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{relations}</Relationships>')
        if numbering:
            z.writestr("word/numbering.xml", f"<w:numbering {WORD}>{numbering}</w:numbering>")
    return out.getvalue()


def item(text, number=None, level=0, style=""):
    listed = f'<w:numPr><w:ilvl w:val="{level}"/><w:numId w:val="{number}"/></w:numPr>' if number is not None else ""
    return f'<w:p><w:pPr>{f"""<w:pStyle w:val="{style}"/>""" if style else ""}{listed}</w:pPr><w:r><w:t>{text}</w:t></w:r></w:p>'


NUMBERING = (
    '<w:abstractNum w:abstractNumId="7"><w:lvl w:ilvl="0"><w:start w:val="3"/><w:numFmt w:val="decimal"/></w:lvl><w:lvl w:ilvl="1"><w:start w:val="1"/><w:numFmt w:val="lowerLetter"/></w:lvl><w:lvl w:ilvl="2"><w:numFmt w:val="bullet"/></w:lvl></w:abstractNum>'
    '<w:num w:numId="1"><w:abstractNumId w:val="7"/></w:num><w:num w:numId="2"><w:abstractNumId w:val="7"/><w:lvlOverride w:ilvl="0"><w:startOverride w:val="1"/></w:lvlOverride></w:num><w:num w:numId="4"><w:abstractNumId w:val="7"/></w:num>'
)


def test_lists_of_word_files():
    body = item("a", 1) + item("b", 1) + item("b1", 1, 1) + item("b2", 1, 1) + item("x", 1, 2) + item("c", 1) + item("c1", 1, 1) + item("text") + item("d", 4) + item("again", 2) + item("more", 2) + item("by style", style="Steps2") + item("out", 0, style="Steps") + item("unknown", 99) + item("plain", style="ListBullet")
    styles = '<w:style w:styleId="Steps"><w:pPr><w:numPr><w:numId w:val="2"/></w:numPr></w:pPr></w:style><w:style w:styleId="Steps2"><w:basedOn w:val="Steps"/></w:style>'
    assert ooxml.Word(word_file(body, NUMBERING, styles)).markdown() == "3. a\n4. b\n   1. b1\n   2. b2\n      - x\n5. c\n   1. c1\n\ntext\n\n6. d\n1. again\n2. more\n3. by style\n\nout\n\n- unknown\n- plain"
    assert ooxml.Word(word_file(item("a", 1))).markdown() == "- a"


def test_type_links_and_pictures_of_word_files():
    run = lambda t, look="": f'<w:r><w:rPr>{look}</w:rPr><w:t xml:space="preserve">{t}</w:t></w:r>'
    drawing = '<w:r><w:drawing><wp:inline><wp:docPr id="1" name="n" descr="a chart"/><a:blip r:embed="rId5"/></wp:inline></w:drawing></w:r>'
    body = f'<w:p>{run("plain ")}{run("bo", "<w:b/>")}{run("ld ", "<w:b/>")}{run("both", "<w:b/><w:i/>")}{run(" off", """<w:b w:val="0"/>""")}<w:hyperlink r:id="rId4">{run("site", "<w:i/>")}</w:hyperlink>{drawing}</w:p>'
    body += f'<w:p><w:pPr><w:pStyle w:val="Heading2"/></w:pPr>{run("Head", "<w:b/>")}</w:p>'
    relations = '<Relationship Id="rId4" Target="http://a.b/"/><Relationship Id="rId5" Target="media/image1.png"/>'
    assert ooxml.Word(word_file(body, relations=relations)).markdown() == "plain **bold** ***both*** off[*site*](http://a.b/)![a chart](media/image1.png)\n\n## Head"
    assert ooxml.Word(word.package([block("list", items=["a", "b"])])).markdown() == "- a\n- b"


# page images


def test_contrast_by_tiles():
    """Maps of tiles computed by hand: a clipped histogram, its rest dealt evenly, running sums."""
    grey = np.array([[10] * 8 + [200] * 8] * 16, np.uint8)
    maps, high, wide = images.tile_maps(grey, 2, 2.0)
    assert (high, wide) == (8, 8) and maps.shape == (2, 2, 256)
    # a tile of 64 equal values: one stays (2 * 64 / 256 is less than one), 63 go to values 0, 4, 8, ... 248
    counts = np.zeros(256)
    counts[np.arange(63) * 4] += 1
    counts[10] += 1
    assert (maps[0, 0] == np.rint(counts.cumsum() * 255 / 64)).all()
    out = images.equalized(grey, 2)
    left, right = maps[0, 0], maps[0, 1]
    assert out[0, 0] == left[10] and out[0, 15] == right[200] and out.shape == grey.shape
    assert out[5, 5] == np.rint(left[10] * (1 - 0.1875) + right[10] * 0.1875)  # 5.5 / 8 - 0.5 of the way
    assert images.equalized(np.full((13, 7), 9, np.uint8)).shape == (13, 7)
    spread = images.equalized(np.tile(np.arange(100, 140, dtype=np.uint8), (40, 1)))
    assert np.ptp(spread.astype(int)) > 60  # a narrow range of values is spread


def test_local_threshold():
    bell = images.gaussian_mean(np.eye(1, 71, 35, dtype=np.uint8).reshape(1, 71) * 255)
    sigma = 0.3 * (34 * 0.5 - 1) + 0.8
    weights = np.exp(-(np.arange(-17, 18) ** 2) / (2 * sigma * sigma))
    assert np.allclose(bell[0, 18:53], 255 * weights / weights.sum()) and bell[0, :18].max() == 0
    # ink on an uneven ground: a threshold for the whole page would lose one half
    page = (np.linspace(60, 250, 200)[None, :] * np.ones((100, 1))).astype(np.uint8)
    page[50:53, 10:190] = (page[50:53, 10:190] * 0.6).astype(np.uint8)
    black = images.binarized(page) == 0
    assert black[50:53, 12:188].all() and not black[:35].any()


def test_turned_pages():
    grey = np.arange(12, dtype=np.uint8).reshape(3, 4) * 10
    assert (images.turned(grey, 0) == grey).all() and (images.turned(grey, 90, grow=True) == np.rot90(grey)).all() and (images.turned(grey, 180, grow=True) == np.rot90(grey, 2)).all()
    assert images.turned(np.zeros((10, 10), np.uint8), 45)[0, 0] == 255
    rng = np.random.default_rng(0)
    page = np.full((400, 320), 255, np.uint8)
    for y in range(60, 340, 20):
        page[y : y + 7, 50:270] = np.where(rng.random((7, 220)) < 0.6, 0, 255)
    for angle in (-9.5, 3.0, 10.0):
        assert images.skew_of(images.turned(page, angle)) == -angle
    assert images.skew_of(page) == 0 and images.deskewed(page) is page
    straight = images.deskewed(images.turned(page, 7.0))
    assert straight.shape[0] > 400 and images.skew_of(straight) == 0


# broken replies


def test_salvaged_entities():
    got = lambda t: [(e["type"], e["value"]) for e in model.salvaged(t)]
    assert got('{"entities": [{"type": "date", "value": "1 \\"May\\""}, {"type": "sum", "value": "5"') == [("date", '1 \\"May\\"'), ("sum", "5")]
    assert got("\"type\": \"date\" \"page\": 3, \"value\": 'May', {\"type\": \"sum\", \"value\": 12 000 rub}\n\"type\": \"lost\", \"type\": \"code\"\n\"value\": A-7\nrest") == [("date", "May"), ("sum", "12 000 rub"), ("code", "A-7")]
    assert got("") == got("no JSON at all: type value") == got('{"value": "x", "type": "late"}') == []
    assert model.lenient('[{"type": "a", "value": "b"} {"type": "c"')["entities"] == [{"type": "a", "value": "b"}]


def test_clocked_requests(spark):
    """Times by a clock that a stub moves on: first part, end, parts a second and pages a second."""
    assert list(model.parts_of(["data: {\"choices\": [{\"delta\": {\"content\": \"a\"}}]}\n", ": note", "data: broken", "data: {\"choices\": []}", "data: {\"choices\": [{\"delta\": {}}]}", "data: [DONE]", "data: {\"choices\": [{\"delta\": {\"content\": \"late\"}}]}"])) == ["a"]
    now = [0.0]

    def stream(url, payload):
        if len(payload["messages"][1]["content"]) == 1:
            raise OSError("gone")
        for step in (2.0, 0.5, 1.5):
            now[0] += step
            yield "x"

    pages = spark.createDataFrame([("f", i, bytearray(b"png")) for i in (1, 2, 3, 4, 5)], "file string, page int, png binary").coalesce(1)
    got = model.clocked(model.batches(pages).coalesce(1), "u", stream, clock=lambda: now[0])
    assert sorted((r["chunk"], r["pages"], r["first_seconds"], r["seconds"], r["parts"], r["error"]) for r in got.collect()) == [(1, 2, 2.0, 4.0, 3, None), (2, 2, 2.0, 4.0, 3, None), (3, 1, 0.0, 0.0, 0, "gone")]
    assert tuple(model.rates(got).first()) == (2, 2.0, 2.0, 4.0, 4.0, 0.75, 0.5)
