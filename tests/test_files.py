"""Sources, sinks and the watch loop on real files."""

import io
import json
import os
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.plans import extraction, model
from folioscope.sinks import archive, drawings, ledger, pdf, texts, word
from folioscope.sources import archives, files, html, images, ooxml
from folioscope.streaming import watch

PAGE = "<html><head><title>T</title><script>no</script></head><body><nav>menu</nav><h1>Head</h1><p>A <b>bold</b> move</p><table><tr><th>a</th><th>b</th></tr><tr><td>1</td></tr></table><img src='p.png' alt='pic'><h2></h2>lost<h3>Next</h3></body></html>"
BLOCKS = [
    {"kind": "heading", "level": 2, "text": "Заголовок", "rows": [], "items": []},
    {"kind": "paragraph", "level": 0, "text": "слово " * 2000, "rows": [], "items": []},
    {"kind": "list", "level": 0, "text": "", "rows": [], "items": ["a", "b & c"]},
    {"kind": "table", "level": 0, "text": "", "rows": [["x", "y"], *[["1", "2"]] * 60], "items": []},
]


def test_html():
    assert html.page_text(PAGE).split("\n\n")[:3] == ["T", "# Head", "Abold" + "move"]
    assert "| a | b |" in html.page_text(PAGE) and "| 1 |  |" in html.page_text(PAGE)
    assert "![pic](p.png)" in html.page_text(PAGE) and "### Next" in html.page_text(PAGE)
    assert html.page_text(None) == ""


def test_word_round_trip():
    content = word.package(BLOCKS)
    found = ooxml.Word(content)
    assert found.text().startswith("Заголовок\nслово") and found.text().endswith("1 | 2")
    assert found.markdown().startswith("## Заголовок")


def png(wide: int, high: int) -> bytes:
    import struct
    import zlib

    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    rows = zlib.compress((b"\0" + b"\x80" * wide) * high)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", wide, high, 8, 0, 0, 0, 0)) + chunk(b"IDAT", rows) + chunk(b"IEND", b"")


def test_drawing():
    pages = drawings.laid_out(BLOCKS)
    assert len(pages) > 1
    assert list(drawings.problems(drawings.package(pages))) == []
    assert list(drawings.problems(b"no zip"))
    assert any("no shapes" in p for p in drawings.problems(drawings.package([[]])))
    # a table that goes over pages has its header on each; a single row is not one
    heads = [[s.text for s in p if s.name.startswith("Header")] for p in pages if any(s.name.startswith("Row") for s in p)]
    assert len(heads) > 1 and all(h == ["x", "y"] for h in heads)
    assert [s.name for s in drawings.laid_out([{"kind": "table", "rows": [["a", "b"]]}])[0]] == ["Row 1 1", "Row 1 2"]
    assert drawings.laid_out([{"kind": "page_break"}]) == [[]] and all(p for p in drawings.laid_out([BLOCKS[0], {"kind": "page_break"}, {"kind": "page_break"}, BLOCKS[2]]))
    low = [s.bottom for p in pages for s in p]
    assert min(low) >= drawings.MARGIN - 1e-6


def test_drawing_summary():
    pages = drawings.laid_out(BLOCKS)
    found = drawings.summary(drawings.package(pages))
    assert found["pages"] == len(pages) and found["shapes"] == sum(map(len, pages)) == found["texts"] == found["written"]
    assert found["images"] == 0 and found["sizes"] == [drawings.A4] * len(pages)


def test_pictures_in_drawings(spark):
    blocks = [{"kind": "paragraph", "level": 0, "text": "see ![a map](images/m.png) and [HANDWRITTEN: note](n.jpg) ![gone](x.png)", "rows": [], "items": []}]
    pages = drawings.laid_out(blocks, pictures={"images/m.png": png(3000, 600), "n.jpg": b"no picture"})
    assert [(s.name, s.text, bool(s.picture)) for s in pages[0]] == [("Paragraph", "see and note", False), ("a map", "", True), ("Caption", "[gone]", False)]
    shown = pages[0][1]
    assert round(shown.width, 6) == drawings.A4[0] - 2 * drawings.MARGIN and round(shown.width / shown.height, 6) == 5
    content = drawings.package(pages)
    assert list(drawings.problems(content)) == [] and drawings.summary(content)["images"] == 1
    rows = spark.createDataFrame([("f", blocks, [("images/m.png", bytearray(png(30, 20)))])], "file string, blocks array<struct<kind:string,level:int,text:string,rows:array<array<string>>,items:array<string>>>, pictures array<struct<path:string,content:binary>>")
    assert drawings.summary(bytes(drawings.drawn(rows).first()["content"]))["images"] == 1
    one, sizes = drawings.pictured([("a.png", png(200, 400)), ("b.png", png(100, 100)), ("c.gif", b"x")])
    assert sizes == [(1.0, 2.0), (0.5, 0.5)] and list(drawings.problems(drawings.package(one, size=sizes))) == []
    tiles, sizes = drawings.pictured([(f"{i}.png", png(100, 50)) for i in range(5)], dpi=100, sheet=True)
    assert sizes == [(3.0, 1.0)] and [(s.left, s.bottom) for s in tiles[0]] == [(0, 0.5), (1, 0.5), (2, 0.5), (0, 0), (1, 0)]
    with pytest.raises(ValueError):
        drawings.pictured([("c.gif", b"x")])


def test_faults_in_drawings():
    def changed(edit):
        out = io.BytesIO()
        with zipfile.ZipFile(io.BytesIO(whole)) as z, zipfile.ZipFile(out, "w") as to:
            files = {n: z.read(n) for n in z.namelist()}
            edit(files)
            for n, c in files.items():
                to.writestr(n, c)
        return "; ".join(drawings.problems(out.getvalue()))

    pages = [drawings.pictured([("a.png", png(20, 20))])[0][0] + drawings.laid_out(BLOCKS[:1])[0]]
    whole = drawings.package(pages)
    page, rels = "visio/pages/page1.xml", "visio/pages/_rels/page1.xml.rels"
    swap = lambda n, a, b: lambda f: f.update({n: f[n].replace(a, b)})
    assert changed(lambda f: None) == ""
    assert "missing part: visio/document.xml" in changed(lambda f: f.pop("visio/document.xml"))
    assert "malformed xml" in changed(lambda f: f.update({page: b"<x"}))
    assert "content type not declared for odd.bin" in changed(lambda f: f.update({"odd.bin": b""}))
    assert "missing visio/media/image1_1.png" in changed(lambda f: f.pop("visio/media/image1_1.png"))
    assert "unused media file: visio/media/z.png" in changed(lambda f: f.update({"visio/media/z.png": b""}))
    assert "1 pictures but 0 image relationships" in changed(lambda f: f.update({rels: drawings.relations([]).encode()}))
    assert "declares no pages" in changed(lambda f: f.update({"visio/pages/pages.xml": f'<Pages xmlns="{drawings.VISIO}"/>'.encode()}))
    assert "has no Text" in changed(lambda f: f.update({page: f[page].replace(b"<Text>", b"<Texts>").replace(b"</Text>", b"</Texts>")}))
    assert "Cell[@N='PinX']" in changed(swap(page, b'"PinX"', b'"Pin"'))
    assert "unsupported compression GIF" in changed(swap(page, b'CompressionType="PNG"', b'CompressionType="GIF"'))
    assert "out of order" in changed(swap("visio/document.xml", b"FaceNames", b"Odd"))


def test_diagrams(spark):
    reply = {
        "page": {"width": 1000, "height": 800},
        "shapes": [
            {"id": "start", "type": "ellipse", "x": 100, "y": 100, "width": 200, "height": 100, "text": "Start", "rotation": 90},
            {"id": "end", "type": "diamond", "x": 0, "y": 0, "width": 1000, "height": 1000, "text": "End", "fill": "#ff0000", "line_style": "dashed"},
            {"id": "flow", "type": "connector", "x": 300, "y": 150, "width": 200, "height": 0, "text": "Flow", "from": "start", "to": "end", "line_color": "#00ff00"},
            {"type": "image", "text": "no text"},
            {"type": "odd"},
        ],
    }
    rows = spark.createDataFrame([("d", json.dumps(reply)), ("bad", "nothing")], "file string, reply string").select("file", model.diagram(F.col("reply")).alias("diagram"))
    made = {r["file"]: bytes(r["content"]) for r in drawings.diagrams_drawn(rows, dpi=100).collect()}
    assert list(drawings.problems(made["d"])) == []
    found = drawings.summary(made["d"])
    assert (found["pages"], found["sizes"], found["shapes"], found["written"]) == (1, [(10.0, 8.0)], 5, 3)
    assert any("no shapes" in p for p in drawings.problems(made["bad"])) and drawings.summary(made["bad"])["texts"] == 0
    (shapes,), _ = drawings.diagrammed(reply, 100)
    start, end, flow, image, odd = shapes
    assert [round(x, 6) for x in (start.left, start.bottom, start.width, start.height)] == [1.0, 6.4, 2.0, 0.8] and start.angle == 90 and start.outline == "ellipse"
    assert [round(x, 6) for x in (end.left, end.bottom, end.width, end.height)] == [0, 0, 10.0, 8.0] and (end.fill, end.line, end.outline) == ("#ff0000", 2, "diamond")
    assert (flow.height, flow.fill, round(flow.bottom, 6)) == (0.01, "#00ff00", 6.8) and image.text == "" and odd.name == "shape_4" and odd.outline == "rectangle"


def test_pdf():
    content = pdf.package([{"kind": "paragraph", "level": 0, "text": "plain (text) " * 900, "rows": [], "items": []}, *BLOCKS[2:]])
    assert content.startswith(b"%PDF-1.4") and content.count(b"/Type /Page ") > 1
    table = int(content.rsplit(b"startxref\n", 1)[1].split()[0])
    assert content[table : table + 4] == b"xref"
    import re
    import zlib

    streams = [zlib.decompress(x) for x in re.findall(rb"stream\n(.*?)\nendstream", content, re.DOTALL)]
    assert rb"plain \050text\051 plain" in streams[0]


def letters_of(content: bytes) -> str:
    """What a reader copies from a PDF file: strings by the maps of their fonts."""
    import re
    import zlib

    bodies = {int(n): b for n, b in re.findall(rb"(\d+) 0 obj\n(.*?)\nendobj", content, re.DOTALL)}
    text = lambda b: zlib.decompress(b.split(b"stream\n", 1)[1].rsplit(b"\nendstream", 1)[0])
    page = next(b for b in bodies.values() if b"/Type /Page " in b)
    fonts = {k: bodies[int(n)] for k, n in re.findall(rb"/(\w+) (\d+) 0 R", page.split(b"/Font <<")[1])}
    maps = {k: {int(a, 16): chr(int(b, 16)) for a, b in re.findall(rb"<(..)> <(....)>", text(bodies[int(re.search(rb"/ToUnicode (\d+)", b)[1])]))} for k, b in fonts.items() if b"ToUnicode" in b}
    out = []
    for b in bodies.values():
        if b"FlateDecode" in b and b"begincmap" not in (t := text(b)):
            for line in t.split(b"\n"):
                for font, raw in re.findall(rb"/(\w+) [\d.]+ Tf \(((?:\\\d{3}|[^)])*)\) Tj", line):
                    codes = re.sub(rb"\\(\d{3})", lambda m: bytes([int(m[1], 8)]), raw)
                    out.append("".join(maps[font][c] for c in codes) if font in maps else codes.decode("cp1252"))
                out.append("\n")
    return "".join(out)


def scan_pdf(pictures: list[tuple[bytes, str]]) -> bytes:
    """A PDF file whose pages are pictures: (image dictionary and data, filter)."""
    n = len(pictures)
    kids = " ".join(f"{3 + 2 * i} 0 R" for i in range(n))
    out = f"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n2 0 obj << /Type /Pages /Kids [{kids}] /Count {n} >> endobj\n".encode()
    for i, (data, keys) in enumerate(pictures):
        out += f"{3 + 2 * i} 0 obj << /Type /Page /Parent 2 0 R /Resources << /XObject << /I {4 + 2 * i} 0 R >> >> >> endobj\n".encode()
        out += f"{4 + 2 * i} 0 obj << /Subtype /Image /Width 30 /Height 20 /BitsPerComponent 8 {keys} /Length {len(data)} >>\nstream\n".encode() + data + b"\nendstream endobj\n"
    return out + b"trailer << /Root 1 0 R >>"


def test_pdf_text_without_a_library():
    from folioscope.sources import pdf as reader
    from folioscope.sources import pdf_objects

    blocks = [{"kind": "heading", "level": 1, "text": "Заголовок (тест) \\ naïve", "rows": [], "items": []}, {"kind": "paragraph", "level": 0, "text": "plain (text) words " * 40, "rows": [], "items": []}, {"kind": "page_break", "level": 0, "text": "", "rows": [], "items": []}, {"kind": "paragraph", "level": 0, "text": "УДК 51.78", "rows": [], "items": []}]
    file = pdf_objects.File(pdf.package(blocks))
    texts_ = [pdf_objects.page_text(file, p) for p in file.pages()]
    assert texts_[0].startswith("Заголовок (тест) \\ naïve\nplain (text) words") and texts_[1] == "УДК 51.78" and texts_[0].count("\n") > 3
    if reader._open(pdf.package(blocks)) is None:
        assert reader.read(pdf.package(blocks)) == ("\f".join(texts_), 2)
    for bad in (b"", b"none", b"%PDF-1.4 trailer << /Encrypt 1 0 R >>"):
        with pytest.raises(ValueError):
            pdf_objects.File(bad)
    # an object stream, a font with a map of two-byte codes, gaps that are blanks, escapes
    import zlib

    inner = [b"<< /Type /Catalog /Pages 2 0 R >>", b"<< /Type /Pages /Kids [5 0 R] /Resources << /Font << /F 6 0 R >> >> >>", b"<< /Type /Page /Contents [7 0 R] >>", b"<< /Type /Font /Subtype /Type0 /ToUnicode 8 0 R >>"]
    places, body = [], b""
    for x in inner:
        places.append(len(body))
        body += x + b" "
    head = " ".join(f"{k} {p}" for k, p in zip((1, 2, 5, 6), places, strict=True)).encode() + b" "
    pack = lambda k, keys, data: f"{k} 0 obj << {keys} /Filter /FlateDecode /Length {len(zlib.compress(data))} >> stream\n".encode() + zlib.compress(data) + b"\nendstream endobj\n"
    show = b"BT /F 9 Tf 1 0 0 1 5 700 Tm [<0001> 20 <0002> -400 <0003>] TJ 0 -12 Td <00040005> Tj T* (\\000\\001) ' ET"
    maps = b"1 beginbfrange <0001> <0003> <0416> endbfrange 1 beginbfrange <0004> <0005> [<0041> <00420043>] endbfrange"
    made = b"%PDF-1.5\n" + pack(9, f"/Type /ObjStm /N 4 /First {len(head)}", head + body) + pack(7, "", show) + pack(8, "", maps)
    file = pdf_objects.File(made)
    assert [pdf_objects.page_text(file, p) for p in file.pages()] == ["ЖЗ И\nABCЖ"]


def test_scans_without_a_library(spark, tmp_path):
    """Pages that are pictures go to the model as such."""
    import zlib

    from folioscope.sources import pdf as reader

    grey = np.arange(600, dtype=np.uint8).reshape(20, 30)
    color = np.repeat(grey[:, :, None], 3, 2)
    content = scan_pdf([(zlib.compress(grey.tobytes()), "/ColorSpace /DeviceGray /Filter /FlateDecode"), (zlib.compress(color.tobytes()), "/ColorSpace /DeviceRGB /Filter [/FlateDecode]"), (b"\xff\xd8jpeg", "/ColorSpace /DeviceRGB /Filter /DCTDecode")])
    if reader._open(content) is not None:
        pytest.skip("pages are drawn by the library")
    pages = images.page_files(content, "pdf")
    assert set(np.unique(images.decoded(images.page_files(content, "pdf", "binarize")[0]))) == {0, 255}
    assert [(images.decoded(p) == grey).all() for p in pages[:2]] == [True, True] and pages[2] == b"\xff\xd8jpeg"
    root, out = tmp_path / "in", str(tmp_path / "out")
    root.mkdir()
    (root / "scan.pdf").write_bytes(content)
    (root / "drawn.pdf").write_bytes(pdf.package([]))
    (root / "broken.pdf").write_bytes(b"%PDF-1.4 none")
    (root / "text.pdf").write_bytes(pdf.package([{"kind": "paragraph", "level": 0, "text": "УДК 51.78 words", "rows": [], "items": []}]))
    assert watch.batch(spark, str(root), out, extract=watch.extract_from(["u"], lambda u, p: (200, "read by the model"))) == 4
    rows = {r["file"]: r for r in ledger.read(spark, f"{out}/results.jsonl").collect()}
    assert {k: (v["status"], v["pages"]) for k, v in rows.items()} == {"scan.pdf": ("ok", 3), "text.pdf": ("ok", 1), "drawn.pdf": ("error", 0), "broken.pdf": ("error", 0)}
    assert rows["text.pdf"]["documents"][0]["rubricators"][0]["number"] == "51.78" and "no library" in rows["drawn.pdf"]["error"]


def test_pdf_letters():
    text = "Заголовок (тест) • naïve — Ω ≤ π, \\ 日本"
    assert text in letters_of(pdf.package([{"kind": "heading", "level": 1, "text": text, "rows": [], "items": []}]))
    many = "".join(chr(c) for c in range(0x400, 0x600))
    assert many in letters_of(pdf.package([{"kind": "paragraph", "level": 0, "text": many, "rows": [], "items": []}]))


def test_pictures_in_word():
    text = "see ![a map](images/m.png) and [HANDWRITTEN: note](n.jpg) ![gone](x.png)"
    blocks = [{"kind": "paragraph", "level": 0, "text": t, "rows": [], "items": []} for t in (text, "![a map](images/m.png)")]
    content = word.package(blocks, {"images/m.png": png(300, 150)})
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = z.read("word/document.xml").decode()
        assert [n for n in z.namelist() if "media" in n] == ["word/media/image1.png", "word/media/image2.png"]
        assert z.read("word/_rels/document.xml.rels").decode().count("/image") == 4
    assert body.count("<w:drawing>") == 2 and 'cx="1828800"' in body and 'cy="914400"' in body
    assert "[gone]" in body and "<w:i/>" in body and body.count('<w:jc w:val="center"/>') == 1
    assert ooxml.Word(content).text().startswith("see ")


def test_bundles(spark, tmp_path):
    from folioscope.plans import bundles

    for name in ("one", "two", "three"):
        os.makedirs(tmp_path / name / "images")
        (tmp_path / name / "text.txt").write_text(f"# Title {name}\n\nbody ![p](images/a.png)\n")
    (tmp_path / "one" / "images" / "page_00001.png").write_bytes(png(400, 200))
    (tmp_path / "one" / "images" / "a.png").write_bytes(png(20, 10))
    (tmp_path / "two" / "layout.json").write_text('{"blocks": [{"type": "heading", "level": 1, "text": "From the layout"}]}')
    done = dict(bundles.write(spark, str(tmp_path)))
    assert {os.path.relpath(p, tmp_path) for p, e in done.items() if not e} == {f"{b}/reconstruct.{f}" for b in ("one", "two", "three") for f in ("docx", "pdf", "vsdx")} - {"three/reconstruct.vsdx"}
    assert [e for e in done.values() if e] == ["no images to convert"]
    read = lambda b: drawings.summary((tmp_path / b / "reconstruct.vsdx").read_bytes())
    assert read("one")["sizes"] == [(2.0, 1.0)] and read("one")["images"] == 1 and read("two")["texts"] == 1
    made = {(r["bundle"], r["format"]): r for r in bundles.rebuilt(bundles.bundles(spark, str(tmp_path)), ("vsdx",), "document").collect()}
    assert drawings.summary(bytes(made["one", "vsdx"]["content"]))["images"] == 1 and made["three", "vsdx"]["error"] is None
    with pytest.raises(ValueError):
        bundles.rebuilt(bundles.bundles(spark, str(tmp_path)), ("odt",))


def test_command_line(spark, tmp_path, capsys):
    from folioscope.__main__ import main

    (tmp_path / "a.png").write_bytes(png(200, 100))
    (tmp_path / "t.md").write_text("# Head\n\ntext ![p](a.png)\n")
    out = str(tmp_path / "o.vsdx")
    assert main(["visio", str(tmp_path), str(tmp_path / "a.png"), "--out", out]) == 0
    assert "pages: 1, images: 1" in capsys.readouterr().out
    assert main(["visio", str(tmp_path / "t.md"), "--mode", "document", "--out", out, "--page-size", "5x5"]) == 0
    assert "images: 1, texts: 2" in capsys.readouterr().out and drawings.summary(open(out, "rb").read())["sizes"] == [(5.0, 5.0)]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.docx").write_bytes(word.package(BLOCKS[:1]))
    assert main(["run", str(tmp_path / "in"), str(tmp_path / "out"), "--preprocess", "binarize"]) == 0 and "1 files" in capsys.readouterr().out
    assert os.listdir(tmp_path / "out" / "txts") == ["a.txt"]
    assert main(["rebuild", str(tmp_path / "t.md"), str(tmp_path / "t.docx")]) == 0 and (tmp_path / "t.docx").stat().st_size > 0


def test_requests_of_images(spark):
    """Layouts, entities and diagrams of page images: all requests of a file in order, bad replies give nothing."""
    pages = spark.createDataFrame([("f", i, bytearray(bytes([i]))) for i in (1, 2, 3)] + [("bad", 1, bytearray(b"\x09"))], "file string, page int, png binary")

    def post(url, payload):
        shown = [c["image_url"]["url"].rpartition(",")[2] for c in payload["messages"][1]["content"] if c["type"] == "image_url"]
        n = len(shown)
        if "CQ==" in shown:
            return 200, "no json"
        if "blocks" in payload["messages"][0]["content"]:
            return 200, json.dumps({"blocks": [{"type": "paragraph", "text": f"p{n}"}]})
        if "shapes" in payload["messages"][0]["content"]:
            return 200, json.dumps({"shapes": [{"id": f"s{n}"}], **({"page": {"width": 500, "height": 400}} if n == 2 else {})})
        return 200, json.dumps({"entities": [{"type": "date", "value": f"0{n}.05.2026", "confidence": 0.9}]})

    got = {r["file"]: [b["text"] for b in r["blocks"]] for r in extraction.layouts(pages, ["u"], post).collect()}
    assert got == {"f": ["p2", "p1"], "bad": []}
    found = {r["file"]: r["diagram"] for r in model.diagrams(pages, ["u"], extraction.DIAGRAM_TASK, post).collect()}
    assert [s["id"] for s in found["f"]["shapes"]] == ["s2", "s1"] and found["f"]["page"]["width"] == 500 and found["bad"]["shapes"] == [] and found["bad"]["page"]["width"] == 1000
    seen = extraction.extracted_from_images(pages, ["u"], "system", post).collect()
    assert sorted((r["file"], r["record"]["value"], r["record"]["page"]) for r in seen) == [("f", "01.05.2026", 3), ("f", "02.05.2026", 1)]
    texts_of = spark.createDataFrame([("f", None), ("t", "words")], "file string, text string")
    notes = extraction.annotated(texts_of, ["u"], lambda u, p: (200, str(len([c for c in p["messages"][1]["content"] if isinstance(c, dict)]))), images=pages).collect()
    assert {r["file"]: r["annotation"] for r in notes} == {"f": "2", "t": "0"}


def test_entities_from_a_model(spark, tmp_path):
    def post(url, payload):
        text = payload["messages"][1]["content"]
        if "fail" in text:
            return 400, "bad"
        found = [{"type": "date", "value": "12.05.2026", "evidence": "12.05.2026", "confidence": 0.9}, {"type": "date", "value": " 12.05.2026", "confidence": 0.9}, {"type": "x", "value": ""}, {"type": "y", "value": "z", "confidence": 0.1}]
        return 200, "<thinking>hm</thinking>```json\n" + json.dumps({"entities": found}) + "\n```"

    body = "<!-- page 3 -->\n\nSigned on 12.05.2026 in town.\n\n" + "word " * 20
    rows = spark.createDataFrame([("a", body, "other"), ("b", "fail", "other")], "file string, text string, document_type string")
    system = extraction.prompt([("date", "a day")], "ttz", "feedback")
    assert "- date: a day" in system and system.endswith("feedback")
    got = extraction.extracted(rows, ["u"], system, post, limit=60).collect()
    assert [(r["file"], r["record"]["type"], r["record"]["normalized_value"], r["record"]["page"], r["record"]["confidence"]) for r in got] == [("a", "date", "2026-05-12", 3, 0.9)]
    assert [r["record"]["comment"] for r in extraction.extracted(rows, ["u"], system, post, limit=60).collect()] == [None]
    trash = str(tmp_path / "trash")
    assert extraction.extracted(rows, ["u"], system, lambda u, p: (200, "no json"), limit=60, trash=trash).count() == 0
    assert {(r["context"], r["raw"]) for r in spark.read.json(trash).collect()} == {("entities", "no json")}
    notes = extraction.annotated(rows, ["u"], lambda u, p: (200, "```\nshort\n```")).collect()
    assert {r["file"]: r["annotation"] for r in notes} == {"a": "short", "b": "short"}


def test_layout_reply(spark):
    reply = '{"blocks": [{"type": "heading", "level": 9, "text": " A "}, {"type": "odd"}, {"type": "list", "items": ["x"]}, {"type": "image", "caption": "c"}]}'
    got = spark.createDataFrame([(reply,), ("bad",)], "r string").select(extraction.layout_blocks(F.col("r"))).collect()
    assert [(b["kind"], b["level"], b["text"]) for b in got[0][0]] == [("heading", 6, "A"), ("list", 1, ""), ("paragraph", 1, "[c]")]
    assert got[1][0] == []


def slides() -> bytes:
    p, a, r = ooxml.P[1:-1], ooxml.A[1:-1], ooxml.R[1:-1]
    slide = f'<p:sld xmlns:p="{p}" xmlns:a="{a}"><p:cSld><p:spTree><p:sp><p:txBody><a:p><a:r><a:t>1.2 Title</a:t></a:r></a:p></p:txBody></p:sp><p:sp><p:txBody><a:p><a:r><a:t>body</a:t></a:r></a:p></p:txBody></p:sp></p:spTree></p:cSld></p:sld>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("ppt/presentation.xml", f'<p:presentation xmlns:p="{p}" xmlns:r="{r}"><p:sldIdLst><p:sldId id="256" r:id="rId1"/></p:sldIdLst></p:presentation>')
        z.writestr("ppt/_rels/presentation.xml.rels", f'<Relationships xmlns="{ooxml.RELS[1:-1]}"><Relationship Id="rId1" Target="slides/slide1.xml"/></Relationships>')
        z.writestr("ppt/slides/slide1.xml", slide)
        z.writestr("docProps/core.xml", f'<cp:coreProperties xmlns:cp="{ooxml.CP[1:-1]}" xmlns:dc="{ooxml.DC[1:-1]}"><dc:title> Deck </dc:title></cp:coreProperties>')
    return out.getvalue()


def test_slides(spark):
    rows = spark.createDataFrame([(bytearray(slides()),), (bytearray(b"broken"),)], "content binary")
    got = rows.select(ooxml.pptx_text(F.col("content")), ooxml.pptx_markdown(ooxml.pptx_slides(F.col("content"))), ooxml.metadata(F.col("content"))).collect()
    assert got[0][0] == "Слайд 1\n1.2 Title\nbody" and got[0][1] == "<!-- slide 1 -->\n## 1.2 Title\nbody"
    assert {x["key"]: x["value"] for x in got[0][2]} == {"title": "Deck", "slide_count": "1"}
    assert tuple(got[1])[0] == ""


def test_zip(spark, tmp_path):
    rows = spark.createDataFrame([("txts/b.txt", bytearray(b"bb" * 1000)), ("a.txt", bytearray("ж".encode()))], "name string, content binary")
    path = str(tmp_path / "r.zip")
    assert texts.write_zip(rows, path) == 2
    with zipfile.ZipFile(path) as z:
        assert z.testzip() is None and z.namelist() == ["a.txt", "txts/b.txt"] and z.read("a.txt").decode() == "ж"
    blob = open(path, "rb").read()
    assert dict(archives.entries(blob[: len(blob) - 60]))["txts/b.txt"] == b"bb" * 1000


def test_images():
    grey = np.tile(np.linspace(0, 255, 64).astype(np.uint8), (64, 1))
    assert images.steps_of("binarize, denoise") == ("denoise", "binarize")
    assert set(np.unique(images.cleaned(grey, "binarize,denoise"))) == {255}  # an even slope has no ink
    inked = grey.copy()
    inked[30:33, 20:60] //= 2
    assert set(np.unique(images.cleaned(inked, "binarize,denoise"))) == {0, 255}
    assert images.cleaned(grey, "deskew,shadow,contrast,upscale").shape == (128, 128)
    with pytest.raises(ValueError):
        images.steps_of("sharpen")


def test_png_files(spark):
    rng = np.random.default_rng(3)
    grey = rng.integers(0, 256, (40, 30), dtype=np.uint8)
    assert (images.decoded(images.encoded(grey)) == grey).all() and drawings.picture_size(images.encoded(grey)) == (30, 40)
    # every kind of line filter, by its definition
    import struct
    import zlib

    lines = []
    for y in range(40):
        kind = y % 5
        row = bytearray([kind])
        for x in range(30):
            a, b, c = (int(grey[y, x - 1]) if x else 0), (int(grey[y - 1, x]) if y else 0), (int(grey[y - 1, x - 1]) if x and y else 0)
            paeth = min((a, b, c), key=lambda v: (abs(a + b - c - v), (a, b, c).index(v)))
            row.append((int(grey[y, x]) - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
        lines.append(bytes(row))
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    filtered = images.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", 30, 40, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")
    assert (images.decoded(filtered) == grey).all()
    rows = spark.createDataFrame([(bytearray(images.encoded(grey)),), (bytearray(b"none"),), (None,)], "png binary")
    got = [r[0] for r in rows.select(images.preprocessed(F.col("png"), "binarize, denoise")).collect()]
    assert set(np.unique(images.decoded(bytes(got[0])))) == {0, 255} and bytes(got[1]) == b"none" and got[2] is None


def test_replies(spark):
    replies = ['```json\n{"a": 1}\n```', '{"a": 1\n"b": 2}', '{"a": [1]} tail', '{"entities": [{"type": "x", "value": "y"}, {"type"', "nothing", None]
    rows = spark.createDataFrame([(r,) for r in replies], "reply string")
    got = [r[0] and json.loads(r[0]) for r in rows.select(model.read_json(F.col("reply"))).collect()]
    assert got == [{"a": 1}, {"a": 1, "b": 2}, {"a": [1]}, {"entities": [{"type": "x", "value": "y"}]}, None, None]
    assert model.quarantine(rows, "test").count() == 2
    shapes = spark.createDataFrame([('{"shapes": [{"x": 5}]}',)], "r string").select(model.diagram(F.col("r")).alias("d")).first()["d"]["shapes"]
    assert (shapes[0]["id"], shapes[0]["type"], shapes[0]["x"], shapes[0]["width"]) == ("shape_0", "rectangle", 5.0, 100.0)


def test_client_rotates_and_gives_up():
    calls = []

    def post(url, payload):
        calls.append(url)
        return (200, "fine") if url == "b" else (503, "busy")

    client = model.Client(["a", "b"], post, wait=lambda s: None)
    assert client.ask({"x": 1}) == "fine" and calls == ["a", "b"]
    with pytest.raises(RuntimeError):
        model.Client(["a"], post, wait=lambda s: None).ask({})
    with pytest.raises(RuntimeError):
        model.Client(["a"], lambda u, p: (400, "bad"), wait=lambda s: None).ask({})


def test_model_markers(spark):
    pages = spark.createDataFrame([("f", i, bytearray(b"png")) for i in (1, 2, 3)], "file string, page int, png binary")
    out = model.markdown(model.answered(model.batches(pages), ["stub"], model.stub)).first()["markdown"]
    assert out.count("<!-- page") == 2 and "<!-- page 2 -->" in out


def test_json_lines(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"file": "a"}\n\nbroken\n{"file": "b"}\n')
    assert [r["file"] for r in files.json_lines(spark, str(tmp_path / "l.jsonl"), "file string").collect()] == ["a", "b"]
    kept = files.json_lines_kept(spark, str(tmp_path / "l.jsonl"), ledger.T._parse_datatype_string("file string")).cache()
    assert kept.where("_parse_error").select("_raw").first()[0] == "broken"


def prose(word: str) -> str:
    return f"<html><body><h1>{word}</h1><p>{(word + ' ') * 60}</p><p>УДК 51.7</p></body></html>"


def test_batches(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    (root / "book").mkdir(parents=True)
    os.makedirs(root / "deep")
    (root / "deep" / "page.html").write_text("<p>short</p>")
    (root / "book" / "c1.html").write_text(prose("one"))
    (root / "book" / "c2.html").write_text(prose("two"))
    (root / "report.docx").write_bytes(word.package(BLOCKS))
    (root / "empty.docx").write_bytes(b"broken")
    assert watch.batch(spark, str(root), out) == 4
    rows = {r["file"]: r for r in ledger.read(spark, f"{out}/results.jsonl").collect()}
    assert {k: v["status"] for k, v in rows.items()} == {"book": "ok", "deep": "ok", "report.docx": "ok", "empty.docx": "error"}
    assert "BadZipFile" in rows["empty.docx"]["error"] and rows["empty.docx"]["documents"] == []
    assert rows["book"]["documents"][0]["rubricators"][0]["number"] == "51.7"
    assert sorted(os.listdir(f"{out}/txts")) == ["book.txt", "deep.txt", "report.txt"]
    # what failed is tried again, and each attempt is a row; a mended file is done
    assert watch.batch(spark, str(root), out) == 1
    (root / "empty.docx").write_bytes(word.package(BLOCKS[:1]))
    assert watch.batch(spark, str(root), out) == 1 and watch.batch(spark, str(root), out) == 0
    assert watch.batch(spark, str(root), out, force=True) == 4
    assert ledger.read(spark, f"{out}/stats.jsonl", ledger.STATS).count() == 10
    (root / "late.docx").write_bytes(word.package(BLOCKS[:1]))
    assert watch.batch(spark, str(root), out, settle=3600) == 0
    shown = json.loads(open(f"{out}/results_readable.json").read())
    assert len(shown) == 10 and {r["status"] for r in shown} == {"ok", "error"} and "error" in shown[0]


def test_texts_come_before_the_commit(spark, tmp_path, monkeypatch):
    """A batch that is cut off while it writes texts is found pending again and loses none."""
    root, out = tmp_path / "in", str(tmp_path / "out")
    root.mkdir()
    (root / "a.docx").write_bytes(word.package(BLOCKS[:1]))

    def cut_off(*_):
        raise OSError("cut off")

    with monkeypatch.context() as m:
        m.setattr(texts, "write_files", cut_off)
        with pytest.raises(OSError, match="cut off"):
            watch.batch(spark, str(root), out)
    assert ledger.read(spark, f"{out}/results.jsonl").count() == 0
    assert watch.batch(spark, str(root), out) == 1 and os.listdir(f"{out}/txts") == ["a.txt"]
    assert [r["status"] for r in ledger.read(spark, f"{out}/results.jsonl").collect()] == ["ok"]


def test_scans_go_to_the_model(spark, tmp_path):
    """PDF files without text and images are read by the model; what it cannot read stays pending."""
    root, out = tmp_path / "in", str(tmp_path / "out")
    root.mkdir()
    (root / "scan.pdf").write_bytes(b"%PDF-1.4 no text")
    (root / "photo.png").write_bytes(png(60, 40))
    (root / "bad.jpg").write_bytes(b"bad")

    def pages_of(content, suffix):
        return [png(3, 3), png(4, 4), png(5, 5)] if suffix == "pdf" else [content]

    def post(url, payload):
        shown = [c["image_url"]["url"] for c in payload["messages"][1]["content"]]
        if any("YmFk" in x for x in shown):
            return 400, "no image"
        return 200, f"```markdown\n# Page {len(shown)}\n\nwords of the page [Image: x | bbox: 1 2 3 4](a.png)\n```"

    extract = watch.extract_from(["stub"], post, pages_of=pages_of)
    assert watch.batch(spark, str(root), out, extract=extract) == 3
    rows = {r["file"]: r for r in ledger.read(spark, f"{out}/results.jsonl").collect()}
    assert {k: (v["status"], v["pages"]) for k, v in rows.items()} == {"scan.pdf": ("ok", 3), "photo.png": ("ok", 1), "bad.jpg": ("error", 1)}
    text = open(f"{out}/txts/scan.txt").read()
    assert text.count("<!-- page") == 2 and "# Page 2" in text and "# Page 1" in text and "bbox" not in text and "```" not in text
    assert "no image" in rows["bad.jpg"]["error"] and sorted(os.listdir(f"{out}/txts")) == ["photo.txt", "scan.txt"]
    # without a model a scan is an error, not skipped for good
    other = str(tmp_path / "other")
    assert watch.batch(spark, str(root), other, extract=watch.extract_from(pages_of=pages_of)) == 3
    assert {r["status"] for r in ledger.read(spark, f"{other}/results.jsonl").collect()} == {"error"}


def names_of(out):
    with zipfile.ZipFile(f"{out}/results.zip") as z:
        assert z.testzip() is None
        return {n: z.read(n) for n in z.namelist()}


def test_archive_of_a_run(spark, tmp_path):
    root, out = tmp_path / "in", str(tmp_path / "out")
    root.mkdir()
    (root / "a.docx").write_bytes(word.package(BLOCKS[:1]))
    watch.batch(spark, str(root), out)
    held = names_of(out)
    assert set(held) == {"results.jsonl", "results_readable.json", "stats.jsonl", "txts/a.txt"}
    assert json.loads(held["results.jsonl"])["file"] == "a.docx" and held["txts/a.txt"].decode() == open(f"{out}/txts/a.txt").read()
    # between reconciliations files are appended and journals stay as they were
    (root / "b.docx").write_bytes(word.package(BLOCKS[:1]))
    os.makedirs(f"{out}/rendered")
    open(f"{out}/rendered/page.png", "w").close()
    watch.batch(spark, str(root), out, full=False)
    more = names_of(out)
    assert set(more) - set(held) == {"txts/b.txt"} and more["results.jsonl"] == held["results.jsonl"]
    assert archive.refreshed(spark, out) == "built" and names_of(out)["results.jsonl"].count(b"\n") == 2
    assert archive.refreshed(spark, out) == "kept"
    # text files put there by hand, a broken archive and one that is gone
    with open(f"{out}/txts/hand.txt", "w") as f:
        f.write("by hand\n")
    assert archive.refreshed(spark, out) == "extended" and names_of(out)["txts/hand.txt"] == b"by hand\n" and archive.refreshed(spark, out) == "kept"
    blob = open(f"{out}/results.zip", "rb").read()
    open(f"{out}/results.zip", "wb").write(blob[:-200])
    assert archive.refreshed(spark, out, full=False) == "built" and len(names_of(out)) == 6
    os.remove(f"{out}/results.zip")
    assert archive.refreshed(spark, out) == "built" and len(names_of(out)) == 6
    assert archive.refreshed(spark, str(tmp_path / "nothing")) == "kept"


def counting(folder):
    """An opener that leaves a mark for each file it opens, whichever process does."""
    import uuid

    from folioscope.sources.reader import content_of

    def opened(path):
        name = path.rpartition("/")[2]
        open(f"{folder}/{name}.{uuid.uuid4().hex}", "w").close()
        return content_of(path)

    return opened


def marks(folder):
    found = sorted(n.rpartition(".")[0] for n in os.listdir(folder))
    for n in os.listdir(folder):
        os.remove(f"{folder}/{n}")
    return found


def test_only_pending_files_are_opened(spark, tmp_path, caplog):
    """Done files are listed, not opened; pending ones are opened once, scans once more for the model."""
    root, out, opened = tmp_path / "in", str(tmp_path / "out"), tmp_path / "opened"
    (root / "book").mkdir(parents=True)
    opened.mkdir()
    for i in range(30):
        (root / f"d{i}.docx").write_bytes(word.package(BLOCKS[:1]))
    (root / "book" / "c1.html").write_text(prose("one"))
    (root / "book" / "c2.html").write_text(prose("two"))
    (root / "book" / "c3.htm").write_text(prose("three"))
    (root / "book" / "notes.txt").write_text("never read")
    (root / "photo.png").write_bytes(png(3, 3))
    extract = watch.extract_from(["u"], lambda u, p: (200, "words"), pages_of=lambda c, s: [c], opened=counting(opened))
    plans = []

    def seen(documents, folder):
        plans.append(documents)
        return extract(documents, folder)

    with caplog.at_level("INFO", logger="folioscope.streaming.watch"):
        assert watch.batch(spark, str(root), out, extract=seen) == 32
    assert "found 32, pending 32, processed 32, without text 0, failed 0, pages 32" in caplog.text
    assert marks(opened) == sorted([*(f"d{i}.docx" for i in range(30)), "c1.html", "c2.html"])
    # one read of contents in the plan, and no scan of the folder that has them
    from folioscope.sources import reader

    plan = reader.read(plans[0])._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("MapInArrow") == 1 and "binaryFile" not in plan
    (root / "late.docx").write_bytes(word.package(BLOCKS[:1]))
    assert watch.batch(spark, str(root), out, extract=seen) == 1
    assert marks(opened) == ["late.docx"] and not os.listdir(f"{out}/_batches")


def test_listing_reads_no_contents(spark, tmp_path):
    (tmp_path / "a.docx").write_bytes(b"x")
    scans = [x for x in files.documents(files.listed(spark, str(tmp_path)))._jdf.queryExecution().executedPlan().toString().splitlines() if "binaryFile" in x]
    assert scans and not any("content" in x.split("ReadSchema")[1] for x in scans if "ReadSchema" in x)


def test_documents_and_their_files(spark):
    from folioscope.sources import reader

    listing = spark.createDataFrame([(f"file:/r/{n}", n, len(n)) for n in ("a.pdf", "b/x.html", "b/in/y.html", "b/z.htm", "c.html/only.htm", "c.html/pic.png")], "path string, relative string, size long")
    wanted = spark.createDataFrame([("a.pdf", False), ("b", True), ("c.html", True), ("none", True), ("gone.pdf", False)], "path string, is_dir boolean")
    got = {r["file"]: (r["is_dir"], r["bytes"], [p["relative"] for p in r["parts"]]) for r in reader.wanted_files(wanted, listing).collect()}
    assert got == {"a.pdf": (False, 5, ["a.pdf"]), "b": (True, 19, ["b/in/y.html", "b/x.html"]), "c.html": (True, 15, ["c.html/only.htm"]), "none": (True, 0, [])}
    assert [reader.tasks_for(*x) for x in ((0, 0, 8), (3, 10, 8), (10**6, 10**4, 8), (5, 128 << 23, 8))] == [1, 3, 8, 8]


def test_paths_that_are_opened(tmp_path):
    from folioscope.sources.reader import content_of

    (tmp_path / "a b%20.txt").write_bytes(b"x")
    assert content_of(f"{tmp_path}/a b%20.txt") == content_of(f"file:{tmp_path}/a b%20.txt") == content_of(f"file://{tmp_path}/a b%20.txt") == b"x"


def test_archive_by_names(spark, tmp_path):
    """Of a thousand texts that the archive holds none is opened for one that it lacks, and none is moved."""
    out, opened = str(tmp_path / "out"), tmp_path / "opened"
    os.makedirs(f"{out}/txts")
    opened.mkdir()
    for i in range(1000):
        with open(f"{out}/txts/t{i:04d}.txt", "w") as f:
            f.write(f"text {i}\n" * 5)
    assert archive.refreshed(spark, out) == "built" and len(names_of(out)) == 1000
    end = texts.directory_of(f"{out}/results.zip", archive.manifest(f"{out}/results.zip")[1])[1]
    before = open(f"{out}/results.zip", "rb").read()[:end]
    with open(f"{out}/txts/new.txt", "w") as f:
        f.write("new\n")
    assert archive.refreshed(spark, out, opened=counting(opened)) == "extended" and marks(opened) == ["new.txt"]
    held = names_of(out)
    assert len(held) == 1001 and held["txts/new.txt"] == b"new\n" and held["txts/t0999.txt"] == b"text 999\n" * 5
    assert open(f"{out}/results.zip", "rb").read()[:end] == before
    assert archive.refreshed(spark, out, opened=counting(opened)) == "kept" and marks(opened) == [] and sorted(os.listdir(out)) == ["results.zip", "txts"]


def test_snapshot_grows_by_batches(spark, tmp_path):
    """A batch adds its rows in place of the closing bracket; what was cut off is written over or anew."""
    path, shown = str(tmp_path / "results.jsonl"), str(tmp_path / "shown.json")
    rows = lambda *names: spark.createDataFrame([(n, "docx", 1, 1, 0.0, "ok", None, [], "other") for n in names], ledger.RESULT)
    read = lambda: [r["file"] for r in json.load(open(shown))]

    def add(*names):
        with ledger.snapshot_follows(path, shown, rows(*names)):
            ledger.append(rows(*names), path)

    add("a")
    first = os.path.getsize(shown)
    add("b", "c")
    add()
    assert read() == ["a", "b", "c"] and not ledger.snapshot_checked(spark, path, shown)
    with open(shown, "rb") as f:
        assert f.read()[: first - len(ledger.CLOSING)] == open(shown, "rb").read()[: first - len(ledger.CLOSING)]
    # cut off behind the mark: written over
    with open(shown, "ab") as f:
        f.write(b',\n {"file": "half')
    add("d")
    assert read() == ["a", "b", "c", "d"]
    # rows that reached the ledger only, a snapshot cut short, and a mark that is gone: written anew
    ledger.append(rows("e"), path)
    add("f")
    assert sorted(read()) == ["a", "b", "c", "d", "e", "f"]
    os.truncate(shown, 40)
    add("g")
    assert len(read()) == 7
    os.remove(f"{shown}.mark")
    assert ledger.snapshot_checked(spark, path, shown) and len(read()) == 7 and not ledger.snapshot_checked(spark, path, shown)


def test_calls_are_bounded_over_all_tasks(spark, tmp_path):
    """However many tasks there could be, no more requests than `calls` are under way."""
    under, most = tmp_path / "under", tmp_path / "most"
    under.mkdir()
    most.mkdir()

    def post(url, payload):
        import time
        import uuid

        mine = under / uuid.uuid4().hex
        mine.touch()
        (most / str(len(os.listdir(under)))).touch()
        time.sleep(0.05)
        mine.unlink()
        return 200, payload["messages"][0]["content"][:20]

    for i in range(24):
        (tmp_path / f"s{i}.png").write_bytes(b"x")
    scans = spark.createDataFrame([(f"s{i}.png", 1, "", 0, None, 0.0, f"{tmp_path}/s{i}.png") for i in range(24)] + [("t.pdf", 1, "text", 1, None, 0.0, None)], "file string, size_bytes long, text string, pages int, error string, seconds double, path string").repartition(12)
    got = {r["file"]: r for r in model.read_scans(scans, ["u"], post, extraction.SCAN_TASK, lambda c, s: [c] * 5, calls=4, at_once=2).collect()}
    assert len(got) == 25 and got["t.pdf"]["text"] == "text" and got["s3.png"]["text"].count(extraction.SCAN_TASK[:20]) == 3
    assert max(int(n) for n in os.listdir(most)) <= 4
    pages = spark.createDataFrame([(str(i), 1, bytearray(b"png")) for i in range(20)], "file string, page int, png binary").repartition(10)
    assert model.answered(model.batches(pages), ["u"], post, calls=3).where("error is null").count() == 20 and max(int(n) for n in os.listdir(most)) <= 4


def test_feedback_of_a_ledger(spark, tmp_path, monkeypatch):
    from folioscope.plans import feedback

    path = str(tmp_path / "corrections.jsonl")
    add = lambda *rows: ledger.append(spark.createDataFrame([(None, m, [], [], t) for m, t in rows], ledger.CORRECTION), path)
    assert feedback.current_block(spark, path, 2) == ""
    add(("one", 1.0), ("two", 2.0), ("three", 3.0))
    first = feedback.current_block(spark, path, 2)
    assert "two" in first and "three" in first and "one\n" not in first and first.count("<EXAMPLE") == 2
    with monkeypatch.context() as m:  # nothing has changed: the ledger is not read again
        m.setattr(ledger, "read", lambda *_: pytest.fail("read again"))
        assert feedback.current_block(spark, path, 2) == first and feedback.current_block(spark, path, 0) == ""
    add(("four", 0.5))
    assert "four" in feedback.current_block(spark, path, 2)  # the last added, whatever its time
    assert feedback.current_block(spark, path, 2).index("three") < feedback.current_block(spark, path, 2).index("four")


def test_feedback_of_parts_that_end_out_of_order(spark, tmp_path):
    from folioscope.plans import feedback

    path = tmp_path / "corrections.jsonl"
    for names in (("one", "two", "three"), ("four", "five")):
        ledger.append(spark.createDataFrame([(None, n, [], [], 0.0) for n in names], ledger.CORRECTION), str(path))
    assert len([*path.glob("part-*")]) >= 5
    for batch in {p.name.split("-", 2)[2] for p in path.glob("part-*")}:  # within each batch the last part is written first
        parts = sorted(path.glob(f"part-*-{batch}"))
        times = sorted(p.stat().st_mtime_ns for p in parts)
        for p, t in zip(parts, reversed(times), strict=True):
            os.utime(p, ns=(t, t))
    for n, want in ((2, ["four", "five"]), (4, ["two", "three", "four", "five"])):
        got = feedback.current_block(spark, str(path), n).splitlines()
        assert [x for x in got if x in ("one", "two", "three", "four", "five")] == want


def test_watch(spark, tmp_path):
    import time

    root, out = tmp_path / "in", str(tmp_path / "out")
    root.mkdir()
    (root / "a.docx").write_bytes(word.package(BLOCKS[:1]))
    query = watch.watch(spark, str(root), out, str(tmp_path / "state"), interval=0.5, settle=0)
    until = time.time() + 60
    while time.time() < until and not os.path.exists(f"{out}/txts/a.txt"):
        time.sleep(0.5)
    watch.stopped(query, spark, out)
    assert os.path.exists(f"{out}/txts/a.txt") and "txts/a.txt" in names_of(out) and "results.jsonl" in names_of(out)


def test_word_columns(spark):
    rows = spark.createDataFrame([(bytearray(word.package(BLOCKS[:1] + BLOCKS[2:3])),), (bytearray(b"broken"),), (None,)], "content binary")
    got = rows.select(ooxml.docx_text(F.col("content")), ooxml.docx_markdown(F.col("content")), ooxml.docx_read(F.col("content")).alias("r")).collect()
    assert got[0][0].startswith("Заголовок") and got[0][1].startswith("## Заголовок") and (got[0]["r"]["pages"], got[0]["r"]["error"]) == (1, None)
    assert tuple(got[1])[:2] == ("", "") == tuple(got[2])[:2] and "BadZipFile" in got[1]["r"]["error"] and got[2]["r"]["error"]


def test_images_to_work_on(spark, tmp_path):
    for name in ("b/x.png", "a/y.JPG", "a/z.pdf", "a/t.txt"):
        os.makedirs(tmp_path / os.path.dirname(name), exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    names = lambda rows: [r["relative"] for r in rows.collect()]
    assert names(files.usable_images(spark, str(tmp_path))) == ["a/y.JPG", "b/x.png"]
    for name in ("b/x.png", "a/y.JPG"):
        os.remove(tmp_path / name)
    assert names(files.usable_images(spark, str(tmp_path))) == ["a/z.pdf"]
    shown = spark.createDataFrame([("one", "page_2.png"), ("one", "page_1.png"), ("one", "a.png"), ("two", "b.JPEG"), ("two", "c.txt")], "bundle string, name string")
    assert [tuple(r) for r in files.bundle_images(shown).collect()] == [("one", "page_1.png"), ("one", "page_2.png"), ("two", "b.JPEG")]


def test_page_images(spark):
    import zlib

    from folioscope.sources import pdf as reader

    grey = np.zeros((20, 30), np.uint8)
    content = scan_pdf([(zlib.compress(grey.tobytes()), "/ColorSpace /DeviceGray /Filter /FlateDecode")] * 2)
    rows = spark.createDataFrame([(bytearray(content),), (bytearray(b"none"),)], "content binary")
    got = [r[0] for r in rows.select(reader.page_images(F.col("content"))).collect()]
    assert [x["page"] for x in got[0]] == [1, 2] and got[1] == []
