"""Entities, annotations and layouts from a model's replies, as one DataFrame plan each."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioscope.functions import entities
from folioscope.functions.text import head_and_tail, strip, without_fences, without_thinking
from folioscope.operators.relational import keep_first
from folioscope.operators.segment import chunks, page_at, page_marks, paragraphs
from folioscope.plans.model import Client, Post, answered, batches, over_http, quarantine, read_json

ENTITIES = "struct<entities:array<struct<type:string,value:string,normalized_value:string,page:int,paragraph:int,evidence:string,confidence:double,handwritten:boolean>>>"
BLOCKS = "struct<blocks:array<struct<type:string,level:int,text:string,items:array<string>,rows:array<array<string>>,caption:string>>>"
#: Sizes, kinds, and the forms of notes that later steps know.
LONGEST, BLOCK_KINDS = 500, ("heading", "paragraph", "list", "table", "image")
SCAN_TASK = """Write down the pages shown as clean Markdown, and nothing but Markdown: no remarks, no reasoning, no code fences.

Text: every word in reading order, as it is spelled. Join words that a line end has cut; leave out page numbers, running heads and feet, watermarks and stamps of copies.
Structure: # for the title, ## and ### for sections and their parts, - or 1. for lists, | tables | with all their columns, and formulas as they stand.
Pictures: where one is, [Image: kind: what it shows | bbox: left top right bottom | img: n], with coordinates from 0 to 1000 and n the number of the page shown.
Handwriting: [HANDWRITTEN: the words | bbox: left top right bottom]; what cannot be read is [?]."""
ENTITY_TASK = "Extract the entities of the text as JSON: {\"entities\": [{\"type\", \"value\", \"page\", \"paragraph\", \"evidence\", \"confidence\", \"handwritten\"}]}. Use only these types:"
IMAGE_TASK = "Extract the entities of these page images."
LAYOUT_TASK = "Read the pages and give their blocks in order as JSON: {\"blocks\": [{\"type\": heading, paragraph, list, table or image, \"level\", \"text\", \"items\", \"rows\", \"caption\"}]}. Leave nothing out and add nothing."
DIAGRAM_TASK = "Read the diagram and give its page and shapes as JSON: {\"page\": {\"width\", \"height\"}, \"shapes\": [{\"id\", \"type\", \"x\", \"y\", \"width\", \"height\", \"text\", \"fill\", \"from\", \"to\"}]}. Coordinates run from 0 to 1000, from the top left corner."
ANNOTATION_TASK = "Write an annotation of one or two sentences."
FOCUS = {
    "article": "Authors, organisations, dates, methods and references matter most.",
    "directive": "The kind and number of the directive, its date, whom it is addressed to and who signed it (with their posts), what it rests on, its items and tasks, deadlines and who controls them matter most.",
    "certificate": "The kind, number and date of the certificate, whom it is issued to and by, what it rests on, what it states, periods (as of a day, or for a time), amounts, rates and codes matter most.",
    "tech_doc": "Quantities with their units, ranges and tolerances matter most.",
    "ttz": "Requirements with their numbers, the norms they set (times, temperatures, ranges, probabilities), the standards they name, deadlines and those who carry them out matter most.",
    "ttkh": "Names and models, masses, dimensions, crews, armament, ranges, speeds, engines, protection, electronics and versions matter most. Keep units as they are written and put nothing general in place of a figure. A heading without a figure is no entity.",
    "summary": "The kind of summary and its period, dates and times, places, states and categories, quantities, identifiers and persons or units responsible matter most. Keep the wording of states as it is. The word for the summary alone is no entity.",
}


def prompt(vocabulary: list[tuple[str, str]], document_type: str = "other", feedback: str = "") -> str:
    """The system prompt: the task, the vocabulary's types, the document type's focus, recent corrections."""
    types = "\n".join(f"- {name}: {text}" for name, text in vocabulary)
    return "\n\n".join(x for x in (f"{ENTITY_TASK}\n{types}", FOCUS.get(document_type, ""), feedback) if x)


def asked(requests: DataFrame, endpoints: list[str], system: str, post: Post = over_http, keys: tuple[str, ...] = ("file",)) -> DataFrame:
    """`keys`, reply and error for each request (keys, content): a failure is a row."""
    fields = [f for f in requests.schema if f.name in keys]
    names = [f.name for f in fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = Client(endpoints, post)
        for f in frames:
            out = f[names].copy()
            replies, errors = [], []
            for content in f["content"]:
                try:
                    replies.append(client.ask({"messages": [{"role": "system", "content": system}, {"role": "user", "content": content}]}))
                    errors.append(None)
                except RuntimeError as e:
                    replies.append(None)
                    errors.append(str(e))
            yield out.assign(reply=replies, error=errors)

    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields) + "reply string, error string"
    return requests.select(*dict.fromkeys([*names, "content"])).mapInPandas(run, ddl)


def chunked(documents: DataFrame, limit: int = LONGEST) -> DataFrame:
    """(file, document_type, position, content, page): the chunks of (file, text, document_type) with the page each starts on."""
    rows = documents.select("file", "document_type", chunks(F.col("text"), limit).alias("chunks"), "text")
    rows = rows.select("file", "document_type", "text", F.posexplode("chunks").alias("position", "chunk"))
    rows = rows.withColumn("marks", page_marks(F.col("text")))
    return rows.select("file", "document_type", "position", F.col("chunk.text").alias("content"), page_at(F.col("marks"), F.col("chunk.start")).alias("page"))


def extracted(documents: DataFrame, endpoints: list[str], system: str, post: Post = over_http, limit: int = LONGEST, least: float = entities.LEAST_CONFIDENCE, trash: str = "") -> DataFrame:
    """(file, record): chunks are put to the model, replies read leniently, entities checked and
    scored against their chunk, the first of each type and value kept, values normalised. Replies
    that cannot be read are added to the JSON lines in `trash`, if given; for that they are kept
    until the result is, and not asked for again."""
    requests = chunked(documents, limit)
    keys = ("file", "document_type", "position", "content", "page")
    replies = asked(requests, endpoints, system, post, keys).where("error is null")
    if trash:
        replies = replies.persist()
        quarantine(replies, "entities").write.mode("append").json(trash)
    return checked(replies, least)


def extracted_from_images(images: DataFrame, endpoints: list[str], system: str, post: Post = over_http, size: int = 2, document_type: str = "other", least: float = entities.LEAST_CONFIDENCE) -> DataFrame:
    """(file, record) as extracted() gives them, of page images (file, page, png): `size` pages go
    into a request, evidence is sought in the reply, entities without a page get the request's first."""
    replies = answered(batches(images, size), endpoints, post, system, text=IMAGE_TASK).where("error is null")
    first = ((F.col("chunk") - 1) * size + 1).cast("int")
    return checked(replies.select("file", F.lit(document_type).alias("document_type"), (F.col("chunk") - 1).alias("position"), without_thinking(F.col("reply")).alias("content"), first.alias("page"), "reply"), least)


def checked(replies: DataFrame, least: float = entities.LEAST_CONFIDENCE) -> DataFrame:
    """(file, position, number, record) of replies (file, document_type, position, content, page, reply)."""
    found = F.from_json(read_json(without_thinking(F.col("reply"))), ENTITIES)["entities"]
    rows = replies.select("file", "document_type", "position", "page", "content", F.posexplode(found).alias("number", "entity"))
    rows = rows.select("file", "document_type", "position", "number", entities.processed(F.col("entity"), F.col("content"), F.col("page")).alias("record"))
    rows = rows.where(F.col("record").isNotNull() & (F.col("record.confidence") >= least))
    rows = rows.withColumn("kind", F.col("record.type")).withColumn("same", F.lower(strip(F.col("record.value"))))
    first = keep_first(rows, ["file", "kind", "same"], ["position", "number"])
    form = entities.normalised(F.col("record.type"), F.col("record.value"), F.col("record.normalized_value"), F.col("document_type"))
    named = F.col("record").withField("type", form["type"]).withField("normalized_value", form["normalized_value"])
    return first.select("file", "position", "number", named.alias("record"))


def annotated(documents: DataFrame, endpoints: list[str], post: Post = over_http, limit: int = LONGEST, images: DataFrame | None = None) -> DataFrame:
    """(file, annotation) of (file, text); long texts are shown by head and tail. Files without a
    text are shown by the first two of their `images` (file, page, png), and get none without those."""
    blank = F.coalesce(strip(F.col("text")), F.lit("")) == ""
    shown = documents.where(~blank).select("file", F.concat(F.lit("Document text:\n"), head_and_tail(F.col("text"), limit)).alias("content"))
    replies = asked(shown, endpoints, ANNOTATION_TASK, post).select("file", "reply", "error")
    if images is not None:
        seen = batches(images.join(documents.where(blank).select("file"), "file", "left_semi"), 2).where("chunk = 1")
        replies = replies.unionByName(answered(seen, endpoints, post, ANNOTATION_TASK).select("file", "reply", "error"))
    return replies.where("error is null").select("file", strip(without_fences(without_thinking(F.col("reply")))).alias("annotation"))


def layouts(images: DataFrame, endpoints: list[str], post: Post = over_http, size: int = 2, prompt: str = "") -> DataFrame:
    """(file, blocks): the blocks of a file's page images (file, page, png), of all its requests in order;
    none for replies that cannot be read or did not come."""
    replies = answered(batches(images, size), endpoints, post, prompt or LAYOUT_TASK, text="Give the layout of these pages as JSON.")
    parts = F.array_sort(F.collect_list(F.struct("chunk", layout_blocks(F.col("reply")).alias("blocks"))))
    return replies.groupBy("file").agg(parts.alias("parts")).select("file", F.flatten(F.transform("parts", lambda p: p["blocks"])).alias("blocks"))


def layout_blocks(reply: Column) -> Column:
    """array of (kind, level, text, rows, items) of a layout reply: known kinds only, levels 1 to 6."""
    blocks = F.from_json(read_json(reply), BLOCKS)["blocks"]
    none, rows = F.array().cast("array<string>"), F.array().cast("array<array<string>>")
    known = F.filter(blocks, lambda b: b["type"].isin(*BLOCK_KINDS))
    text = lambda b: strip(F.coalesce(F.when(b["type"] == "image", F.concat(F.lit("["), b["caption"], F.lit("]"))).otherwise(b["text"]), F.lit("")))
    shaped = F.transform(
        known,
        lambda b: F.struct(
            F.when(b["type"] == "image", "paragraph").otherwise(b["type"]).alias("kind"),
            F.greatest(F.lit(1), F.least(F.lit(6), F.coalesce(b["level"], F.lit(1)))).alias("level"),
            text(b).alias("text"),
            F.coalesce(b["rows"], rows).alias("rows"),
            F.coalesce(b["items"], none).alias("items"),
        ),
    )
    return F.coalesce(shaped, F.array().cast("array<struct<kind:string,level:int,text:string,rows:array<array<string>>,items:array<string>>>"))


def with_regions(links: DataFrame, regions: DataFrame, path: str = "path") -> DataFrame:
    """links with the bbox of the region of their file name (the last of equal names, by `position`); null without one."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    last = regions.groupBy("name").agg(F.max_by("bbox", "position").alias("bbox"))
    return links.withColumn("__name", name).join(last.withColumnRenamed("name", "__name"), "__name", "left").drop("__name")


def entity_rows(records: DataFrame, documents: DataFrame, annotations: DataFrame | None = None) -> DataFrame:
    """(file, paragraphs, entities, annotation), as the entity store holds them: of each document (file, text) its
    paragraphs, its records (file, position, number, record) in order, the first of each type and value, and its annotation."""
    first = keep_first(records.withColumn("kind", F.col("record.type")).withColumn("same", F.lower(strip(F.col("record.value")))), ["file", "kind", "same"], ["position", "number"])
    found = first.groupBy("file").agg(F.array_sort(F.collect_list(F.struct("position", "number", "record"))).alias("found"))
    rows = documents.select("file", paragraphs(F.col("text")).alias("paragraphs")).join(found, "file", "left")
    none = F.array().cast(records.select(F.array("record").alias("a")).schema["a"].dataType)
    rows = rows.withColumn("entities", F.coalesce(F.transform("found", lambda x: x["record"]), none))
    said = annotations.select("file", "annotation") if annotations is not None else documents.select("file").limit(0).withColumn("annotation", F.lit(""))
    return rows.join(said, "file", "left").select("file", "paragraphs", "entities", F.coalesce("annotation", F.lit("")).alias("annotation"))
