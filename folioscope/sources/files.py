"""Files as rows: discovery, contents of a folder, and lenient JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.operators.relational import discovered
from folioscope.sources import images


def listed(spark: SparkSession, root: str) -> DataFrame:
    """(path, relative, size, modified) of all files below root; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", "length", "modificationTime")
    base = root.rstrip("/")
    return found.select("path", F.regexp_replace("path", rf"^(?:file:)?(?://)?\Q{base}\E/*", "").alias("relative"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def documents(files: DataFrame) -> DataFrame:
    """(path, is_dir, size, modified) of a listing, relative to its root: single files and HTML collections."""
    found = discovered(files.select(F.col("relative").alias("path")))
    return found.join(files.select(F.col("relative").alias("path"), "size", "modified"), "path", "left")


def contents(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(path, relative, content) of files with one of the suffixes (all if none are given)."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    if suffixes:
        found = found.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes))
    base = root.rstrip("/")
    return found.select("path", F.regexp_replace("path", rf"^(?:file:)?(?://)?\Q{base}\E/*", "").alias("relative"), "content")


def json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """JSON lines; blank and malformed lines are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def json_lines_kept(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines; a malformed one comes with its text in `_raw`, whose being set is the error."""
    held = T.StructType([*schema.fields, T.StructField("_raw", T.StringType())])
    return spark.read.schema(held).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_raw").json(path).withColumn("_parse_error", F.col("_raw").isNotNull())


def usable_images(spark: SparkSession, root: str) -> DataFrame:
    """Images below root, or PDFs where there are no images; each path once."""
    files = listed(spark, root).withColumn("suffix", F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)))
    pictures = files.where(F.col("suffix").isin(*images.SUFFIXES))
    # one row says that there are images; PDF files have none to meet where there are none
    some = pictures.limit(1).select(F.lit("pdf").alias("suffix"))
    found = pictures.unionByName(files.where("suffix = 'pdf'").join(some, "suffix", "left_anti"), allowMissingColumns=True)
    return found.dropDuplicates(["path"]).select(*files.columns).orderBy("path")


def bundle_images(files: DataFrame, bundle: str = "bundle", name: str = "name") -> DataFrame:
    """A bundle's page_*.png files, or any of its images where it has none."""
    pages = files.where(F.col(name).rlike(r"^page_.*\.png$"))
    others = files.where(F.lower(name).rlike(r"\.(?:png|jpe?g)$")).join(pages.select(bundle).distinct(), bundle, "left_anti")
    return pages.unionByName(others.select(*pages.columns)).orderBy(bundle, name)
