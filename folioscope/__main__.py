"""Command line: python -m folioscope run | samples | rebuild | bundle | visio"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def page_size(text: str) -> tuple[float, float]:
    """Inches, as in 8.27x11.69."""
    wide, _, high = text.lower().partition("x")
    size = float(wide), float(high)
    if min(size) <= 0:
        raise ValueError(text)
    return size


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="folioscope")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="extract, classify, split and export documents")
    run.add_argument("input")
    run.add_argument("output")
    run.add_argument("--watch", action="store_true")
    run.add_argument("--watch-interval", type=float, default=5.0)
    run.add_argument("--watch-settle", type=float, default=5.0)
    run.add_argument("--archive-sync", type=float, default=60.0, help="seconds between reconciliations of the archive")
    run.add_argument("--force", action="store_true")
    run.add_argument("--endpoints", default="", help="comma-separated URLs of the model that reads scans")
    run.add_argument("--calls", type=int, default=32, help="requests to the model under way at once, over all tasks")
    run.add_argument("--preprocess", default="", help="steps for the pages of scans: upscale, denoise, shadow, contrast, deskew, binarize")
    samples = commands.add_parser("samples", help="fine-tuning samples from corrections")
    samples.add_argument("corrections")
    samples.add_argument("out")
    samples.add_argument("--prompt", default="")
    rebuild = commands.add_parser("rebuild", help="Markdown to DOCX, PDF or VSDX")
    rebuild.add_argument("markdown")
    rebuild.add_argument("out")
    bundle = commands.add_parser("bundle", help="DOCX, PDF and VSDX files of all bundles below a folder")
    bundle.add_argument("root")
    bundle.add_argument("--format", default="docx,pdf,vsdx")
    bundle.add_argument("--content", choices=("pages", "sheet", "document"), default="pages")
    visio = commands.add_parser("visio", help="pictures, the diagram in one, or a Markdown text as a drawing")
    visio.add_argument("inputs", nargs="+", help="picture files or folders of them; with --mode document a Markdown file")
    visio.add_argument("--out", required=True)
    visio.add_argument("--mode", choices=("pages", "sheet", "document", "diagram"), default="pages")
    visio.add_argument("--dpi", type=float, default=200.0)
    visio.add_argument("--page-size", type=page_size)
    visio.add_argument("--columns", type=int, default=0)
    visio.add_argument("--title", default="")
    visio.add_argument("--endpoints", default="")
    return parser


def run(spark: SparkSession, a: argparse.Namespace) -> None:
    from folioscope.plans.model import endpoints_of
    from folioscope.streaming import watch

    from functools import partial

    from folioscope.sources.images import page_files, steps_of

    pages_of = partial(page_files, steps=",".join(steps_of(a.preprocess)))
    extract = watch.extract_from(endpoints_of(a.endpoints), pages_of=pages_of, calls=a.calls)
    if not a.watch:
        print(watch.batch(spark, a.input, a.output, force=a.force, extract=extract), "files")
        return
    query = watch.watch(spark, a.input, a.output, f"{a.output}/_checkpoint", a.watch_interval, a.watch_settle, extract, a.archive_sync)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        watch.stopped(query, spark, a.output)


def blocks_of(spark: SparkSession, path: str):
    from folioscope.operators.segment import blocks, joined_links

    return spark.read.text(path, wholetext=True).select(F.lit(path).alias("file"), blocks(joined_links(F.col("value"))).alias("blocks"))


def pictures_of(inputs: list[str]) -> list[tuple[str, bytes]]:
    """Files, and picture files right in folders, each once."""
    from folioscope.sinks.drawings import MEDIA, suffix_of

    found: dict[str, None] = {}
    for i in inputs:
        paths = sorted(os.path.join(i, n) for n in os.listdir(i) if suffix_of(n) in MEDIA) if os.path.isdir(i) else [i]
        found |= dict.fromkeys(map(os.path.realpath, paths))
    out = []
    for path in found:
        with open(path, "rb") as f:
            out.append((path, f.read()))
    return out


def drawing(spark: SparkSession, a: argparse.Namespace) -> bytes:
    from folioscope.plans import extraction, model
    from folioscope.sinks import drawings

    if a.mode == "document":
        blocks = [r.asDict(recursive=True) for r in blocks_of(spark, a.inputs[0]).first()["blocks"]]
        base = os.path.dirname(a.inputs[0])
        links = {m[2] or m[4] for b in blocks for m in drawings.LINK.finditer(b["text"])}
        shown = {p: pictures_of([os.path.join(base, p)])[0][1] for p in links if os.path.isfile(os.path.join(base, p))}
        size = a.page_size or drawings.A4
        return drawings.package(drawings.laid_out(blocks, size, pictures=shown), a.title, size)
    pictures = pictures_of(a.inputs)
    if a.mode == "diagram":
        images = spark.createDataFrame([(pictures[0][0], 1, bytearray(pictures[0][1]))], "file string, page int, png binary")
        found = model.diagrams(images, model.endpoints_of(a.endpoints), extraction.DIAGRAM_TASK).first()
        pages, sizes = drawings.diagrammed(found["diagram"].asDict(recursive=True), a.dpi)
    else:
        pages, sizes = drawings.pictured(pictures, a.dpi, a.page_size, sheet=a.mode == "sheet", columns=a.columns)
    return drawings.package(pages, a.title, sizes)


def visio(spark: SparkSession, a: argparse.Namespace) -> int:
    from folioscope.sinks import drawings

    content = drawing(spark, a)
    with open(a.out, "wb") as f:
        f.write(content)
    s, wrong = drawings.summary(content), list(drawings.problems(content))
    print(f"created {a.out}\npages: {s['pages']}, images: {s['images']}, texts: {s['texts']}, size: {s['size']} bytes")
    print("\n".join(f"invalid: {p}" for p in wrong) or "structure check: ok")
    return int(bool(wrong))


def main(given: list[str] | None = None) -> int:
    a = arguments().parse_args(given)
    spark = SparkSession.builder.appName("folioscope").getOrCreate()
    if a.command == "run":
        run(spark, a)
    elif a.command == "samples":
        from folioscope.plans.feedback import samples as build
        from folioscope.sinks import ledger

        build(ledger.read(spark, a.corrections, ledger.CORRECTION), a.prompt).write.mode("overwrite").json(a.out)
    elif a.command == "bundle":
        from folioscope.plans.bundles import write

        for path, error in write(spark, a.root, tuple(x.strip() for x in a.format.split(",") if x.strip()), a.content):
            print(f"skipped {path}: {error}" if error else f"created {path}")
    elif a.command == "visio":
        return visio(spark, a)
    else:
        from folioscope.sinks import drawings, pdf, word

        made = {"docx": word.written, "pdf": pdf.written}.get(a.out.rpartition(".")[2], drawings.drawn)(blocks_of(spark, a.markdown))
        with open(a.out, "wb") as f:
            f.write(made.first()["content"])
    return 0


if __name__ == "__main__":
    sys.exit(main())
