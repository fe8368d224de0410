"""Joins, deduplication, naming and ordering that the document pipeline rests on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from folioscope.functions.text import file_name

DONE = ("ok", "skip")
#: What is read, and what archives hold.
SUPPORTED = ("pdf", "docx", "pptx", "html", "htm", "png", "jpg", "jpeg")
IGNORED = ("css", "js", "mjs", "ts", "tsx", "jsx")
JOURNALS = ("results.jsonl", "results_readable.json", "stats.jsonl")


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order. A pre-aggregated minimum, so a hot key does
    not gather its rows in one task; `order` must tell the rows of a key apart."""
    rest = [c for c in df.columns if c not in keys]
    ranked = [F.col(o) if isinstance(o, str) else o for o in order]
    row = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(ranked)], F.struct(*rest).alias("row"))
    return df.groupBy(*keys).agg(F.min(row).alias("first")).select(*[F.col(c) if c in keys else F.col(f"first.row.{c}") for c in df.columns])


def pending(files: DataFrame, ledger: DataFrame, force: bool = False, key: str = "file") -> DataFrame:
    """Files with no finished ledger row; errors stay pending, and a later error undoes no ok."""
    if force:
        return files
    done = ledger.where(F.col("status").isin(*DONE)).select(key).distinct()
    return files.join(done, key, "left_anti")


def settled(files: DataFrame, now: Column, seconds: float) -> DataFrame:
    """Files untouched for `seconds`; folders are always settled."""
    calm = F.unix_micros(F.col("modified")) <= F.unix_micros(now) - F.lit(int(seconds * 1_000_000))
    return files.where(F.coalesce(F.col("is_dir"), F.lit(False)) | calm)


def by_size(files: DataFrame) -> DataFrame:
    """Smallest first, folders as size 0; ties by folders first, then path."""
    return files.orderBy(F.when(F.col("is_dir"), F.lit(0)).otherwise(F.col("size")), F.desc("is_dir"), "path")


def in_order(files: DataFrame) -> DataFrame:
    """Folders first, then files, each by path: the order in which discovery tells them."""
    return files.orderBy(F.desc("is_dir"), "path")


def unreviewed(files: DataFrame, marks: DataFrame, path: str = "path") -> DataFrame:
    """Files without a mark of their stem; files of one stem share a mark."""
    stem = lambda c: F.regexp_replace(F.regexp_extract(c, r"([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")
    done = marks.select(stem(path).alias("__stem")).distinct()
    return files.withColumn("__stem", stem(path)).join(done, "__stem", "left_anti").drop("__stem")


def collection_roots(paths: DataFrame, path: str = "path") -> DataFrame:
    """(root): folders that are one document each: named like an HTML file, or with an HTML
    file right in them; only the outermost. Top folders of `paths` are none."""
    parts = F.split(path, "/", -1)
    n = F.size(parts)
    folders = paths.select(
        F.col(path),
        F.explode(F.when(n < 2, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), n - 1))).alias("depth"),
    )
    html = r"(?i)\.html?$"
    folder = F.array_join(F.slice(parts, 1, F.col("depth")), "/")
    marked = folders.withColumn("folder", folder).where((F.element_at(parts, F.col("depth")).rlike(html)) | ((F.col("depth") == n - 1) & F.element_at(parts, -1).rlike(html)))
    marked = marked.where("folder <> ''").select("folder").distinct()
    # outermost: no proper ancestor is marked
    names = F.split("folder", "/", -1)
    depth = F.size(names)
    above = marked.select("folder", F.explode(F.when(depth < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), depth - 1), lambda i: F.array_join(F.slice(names, 1, i), "/")))).alias("above"))
    inner = above.join(marked.select(F.col("folder").alias("above")), "above", "left_semi").select("folder").distinct()
    return marked.join(inner, "folder", "left_anti").select(F.col("folder").alias("root"))


def discovered(paths: DataFrame, path: str = "path") -> DataFrame:
    """(path, is_dir): collections, then supported files outside them. Every file in a
    collection belongs to it, whatever its kind."""
    roots = collection_roots(paths, path)
    parts = F.split(path, "/", -1)
    ancestors = F.when(F.size(parts) < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/")))
    inside = paths.select(F.col(path), F.explode(ancestors).alias("root")).join(roots, "root", "left_semi").select(path).distinct()
    suffix = F.lower(F.regexp_extract(F.element_at(parts, -1), r"\.([^.]+)$", 1))
    files = paths.join(inside, path, "left_anti").where(suffix.isin(*SUPPORTED)).select(F.col(path).alias("path"), F.lit(False).alias("is_dir"))
    return roots.select(F.col("root").alias("path"), F.lit(True).alias("is_dir")).unionByName(files)


def numbered(rows: DataFrame, key: str, order: list[str], number: str = "n") -> DataFrame:
    """rows with `number`: their places, from 1, in order among those of their key.

    The first of `order` is a number of 0 or more, or null. Rows of a key are dealt to buckets of
    like magnitude, 16 to each doubling, which follow one another in order: places are
    counted within buckets, and the buckets' sizes are added up before them. So a hot key fills
    a task only with the rows of one magnitude.
    """
    bucket = F.coalesce(F.floor(F.log2(F.col(order[0]) + 1) * 16), F.lit(-1)).alias("__bucket")
    dealt = rows.select("*", bucket)
    before = F.sum("__size").over(Window.partitionBy(key).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    sizes = dealt.groupBy(key, "__bucket").agg(F.count("*").alias("__size")).select(key, "__bucket", F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.row_number().over(Window.partitionBy(key, "__bucket").orderBy(*order))
    return dealt.withColumn(number, local).join(sizes, [key, "__bucket"]).withColumn(number, (F.col(number) + F.col("__before")).cast("int")).select(*rows.columns, number)


def numbered_name(base: Column, number: Column) -> Column:
    """base, then base_2, base_3."""
    return F.when(number == 1, base).otherwise(F.concat(base, F.lit("_"), number.cast("string")))


def numbered_names(documents: DataFrame, stem: str = "stem", order: list[str] | None = None) -> DataFrame:
    """documents with `name`: the safe stem, then stem_2, stem_3 for later ones in order, also
    where that is another one's stem. `order` begins with a number, such as the size."""
    named = documents.withColumn("base", file_name(F.col(stem)))
    return numbered(named, "base", order or ["size", "path"]).withColumn("name", numbered_name(F.col("base"), F.col("n"))).drop("base", "n")


def export_names(documents: DataFrame, stem: str = "stem", order: list[str] | None = None) -> DataFrame:
    """numbered_names(), but a suffixed name that is itself a stem goes on to the next free
    number, so names are unique."""
    named = documents.withColumn("base", file_name(F.col(stem)))
    ranked = numbered(named, "base", order or ["size", "path"])
    # names that stems themselves take: base_k of another base
    tail = F.regexp_extract("base", r"^(.*)_([0-9]{1,9})$", 2).try_cast("int")
    taken = named.select(F.regexp_extract("base", r"^(.*)_([0-9]{1,9})$", 1).alias("base"), tail.alias("k"), "base").toDF("base", "k", "own").where("k >= 2").where(F.col("own") == F.concat("base", F.lit("_"), F.col("k").cast("string"))).groupBy("base").agg(F.array_sort(F.collect_set("k")).alias("taken"))
    ranked = ranked.join(taken, "base", "left")
    # the n-th number free of those taken: step over each taken one up to it
    free = F.aggregate(F.coalesce("taken", F.array().cast("array<int>")), F.col("n"), lambda k, t: F.when(t <= k, k + 1).otherwise(k))
    number = F.when(F.col("n") == 1, 1).otherwise(free)
    return ranked.withColumn("name", numbered_name(F.col("base"), number)).drop("base", "n", "taken")


def archivable(name: Column) -> Column:
    """Do archives hold a file of this relative name? Top-level journals and text exports only."""
    return F.when(name.contains("/"), name.rlike(r"^txts/.*\.txt$")).otherwise(name.isin(*JOURNALS))


def missing(files: DataFrame, manifest: DataFrame, key: str = "name") -> DataFrame:
    """Archivable files that the manifest lacks, by name."""
    return files.where(archivable(F.col(key))).join(manifest.select(key).distinct(), key, "left_anti").orderBy(key)


def stale(files: DataFrame, manifest: DataFrame, digest: str = "crc", journals: tuple[str, ...] | None = JOURNALS) -> DataFrame:
    """Journals (all files, if None) whose digest is not what the manifest holds: they call for a rebuild."""
    live = (files if journals is None else files.where(F.col("name").isin(*journals))).select("name", digest)
    return live.join(manifest.select("name", F.col(digest).alias("held")), "name").where(F.col(digest) != F.col("held")).select("name", digest, "held")


def as_of(events: DataFrame, states: DataFrame, key: list[str], at: str, since: str, value: str, default=None, span: int | None = None) -> DataFrame:
    """events with the value of the last state of their key at or before them.

    Both sides are laid on one time line and the value is carried forward by a window, so no
    pair of rows is ever formed. With `span` (in seconds for timestamps, else in units of the
    time) the line of a key is cut into parts of that length, so that a hot key does not fill a
    task: the last value of each part is carried over to the next by a window over the parts.
    """
    columns = events.columns
    none = F.lit(None).cast(states.schema[value].dataType)
    left = events.select(F.struct(*columns).alias("event"), *[F.col(k) for k in key], F.col(at).alias("__t"), F.lit(1).alias("__side"), none.alias("__v"))
    right = states.select(F.lit(None).cast(left.schema["event"].dataType).alias("event"), *[F.col(k) for k in key], F.col(since).alias("__t"), F.lit(0).alias("__side"), F.col(value).alias("__v"))
    both = left.unionByName(right)
    part = []
    if span:
        clock = {"timestamp": lambda: F.unix_seconds("__t"), "timestamp_ntz": lambda: F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("__t"))}
        number = clock.get(states.schema[since].dataType.simpleString(), lambda: F.col("__t"))()
        both, part = both.withColumn("__part", F.floor(number / span)), ["__part"]
    line = Window.partitionBy(*key, *part).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, 0)
    found = F.last("__v", ignorenulls=True).over(line)
    if span:
        # a row for each part: its last value, from a pre-aggregated maximum, and the one before it
        last = both.where("__side = 0 and __v is not null").groupBy(*key, "__part").agg(F.max(F.struct("__t", "__v")).alias("__l"))
        parts = both.select(*key, "__part").distinct().join(last, [*key, "__part"], "left")
        before = F.last("__l.__v", ignorenulls=True).over(Window.partitionBy(*key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
        both = both.withColumn("__v", found).where("__side = 1").join(parts.select(*key, "__part", before.alias("__b")), [*key, "__part"])
        out = both.withColumn("__v", F.coalesce("__v", "__b"))
    else:
        out = both.withColumn("__v", found).where("__side = 1")
    result = F.col("__v") if default is None else F.coalesce("__v", F.lit(default))
    return out.select(*[F.col(f"event.{c}") for c in columns], result.alias(value))


def last_rows(df: DataFrame, position: str, n: int) -> DataFrame:
    """The n rows of the highest positions, in order; none for n <= 0."""
    return df.orderBy(F.desc(position)).limit(max(n, 0)).orderBy(position)


def violations(references: DataFrame, parts: DataFrame, reference: str, part: str) -> DataFrame:
    """References to parts that do not exist."""
    return references.join(parts.select(F.col(part).alias(reference)).distinct(), reference, "left_anti")


