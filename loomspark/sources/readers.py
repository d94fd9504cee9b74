"""Readers: archives, and the engine's own JSON files by their suffix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions.text import relative_path
from ..shared import stored
from . import json_ranges

SUMMARY, SENTIMENT = ".summary.json", ".sentiment.summary.json"
THREAD_SUMMARY, THREAD_SENTIMENT = ".thread.summary.json", ".thread.sentiment.summary.json"
SKIPPED_DIRS = ("summaries", "summary", "index")
#: First and last line of a glossary that is written an entry a line.
GLOSSARY_HEAD, GLOSSARY_END = '{"version": 1, "entries": [', "]}"
#: Bytes of a glossary in other forms up to which it is parsed as one document.
PARSED_BYTES = 64 << 20


def archive(spark: SparkSession, path: str, field: str | None = None, range_bytes: int | None = None) -> DataFrame:
    """Raw conversations of an archive, a top-level array or an object that holds one, with _file and _place in it.

    In an object the field is the one named, else the first in document order that is an array; an error if
    there is none. Files of any size are cut into byte ranges, which many tasks read.
    """
    rows = json_ranges.elements(spark, path, field, range_bytes)
    return rows.select(F.from_json("value", schemas.RAW_CONVERSATION).alias("c"), F.col("file").alias("_file"), F.col("place").alias("_place")).select("c.*", "_file", "_place")


def archive_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw conversations, one a line: splittable."""
    return spark.read.schema(schemas.RAW_CONVERSATION).json(path)


def bundle(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of the documents of a bundle."""
    return spark.read.schema("name string, content string").parquet(path)


def _pattern(suffix: str) -> str:
    """A suffix of a glob, whose only signs are sets of characters, as a regular expression."""
    return suffix.replace(".", "[.]") + r"\z"


def json_files(spark: SparkSession, path: str, schema: str, suffix: str = ".json", without: str | None = None, recursive: bool = True, bundled: bool = False) -> DataFrame:
    """One row a document with its path and rel_path; columns are pruned in the reader, paths by name.

    Each is a file of its own, or a row of a bundle (see writers.bundle), which is read without a list of names.
    """
    if bundled:
        rows = bundle(spark, path).filter(F.col("name").rlike(_pattern(suffix)))
        rows = rows if recursive else rows.filter(~F.contains("name", F.lit("/")))
        rows = rows.select(F.from_json("content", schemas.struct(schema)).alias("c"), F.concat(F.lit(path.rstrip("/") + "/"), "name").alias("path"), F.col("name").alias("rel_path")).select("c.*", "path", "rel_path")
    else:
        reader = spark.read.schema(schema).option("multiLine", True).option("recursiveFileLookup", recursive).option("pathGlobFilter", f"*{suffix}")
        rows = reader.json(path).withColumn("path", F.col("_metadata.file_path")).withColumn("rel_path", relative_path("path", path))
    return rows.filter(~F.endswith("path", F.lit(without))) if without else rows


def threads(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """Thread files of a folder, not of those below it, with any case of the extension."""
    return json_files(spark, path, schemas.THREAD, ".[jJ][sS][oO][nN]", recursive=False, bundled=bundled)


def chunks(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    """Valid chunk files below a folder; folders of summaries and indexes are left out, so are invalid files."""
    rows = json_files(spark, path, schemas.CHUNK, ".json", SUMMARY, bundled=bundled)
    if path.rstrip("/").rpartition("/")[2].lower() in SKIPPED_DIRS:
        rows = rows.limit(0)
    inside = rows.filter(~F.lower("rel_path").rlike("(^|/)(" + "|".join(SKIPPED_DIRS) + ")/"))
    return inside.filter("conversation_id != '' AND chunk_number != 0")


def summaries(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    return json_files(spark, path, schemas.CHUNK_SUMMARY, SUMMARY, SENTIMENT, bundled=bundled)


def sentiments(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    return json_files(spark, path, schemas.CHUNK_SENTIMENT, SENTIMENT, bundled=bundled)


def thread_summaries(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    return json_files(spark, path, schemas.THREAD_SUMMARY, THREAD_SUMMARY, bundled=bundled)


def thread_sentiments(spark: SparkSession, path: str, bundled: bool = False) -> DataFrame:
    return json_files(spark, path, schemas.THREAD_SENTIMENT, THREAD_SENTIMENT, bundled=bundled)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever store it names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def glossary(spark: SparkSession, path: str, place: str | None = None) -> DataFrame:
    """Entries of a glossary file, none if it is missing; place: a column for their place, from 1.

    What writers.glossary has written is read by its lines, so no task holds more of it than an entry at a
    time. Other documents are parsed as they are, and large ones by ranges of their bytes.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schemas.GLOSSARY_ENTRY + (f", {place} bigint" if place else ""))
    by_line, largest = _form(spark, path)
    if by_line:
        return _entry_lines(spark, path, place)
    if largest > PARSED_BYTES:
        each = json_ranges.elements(spark, path, "entries")
        return each.select(F.from_json("value", schemas.struct(schemas.GLOSSARY_ENTRY)).alias("e"), "place").select("e.*", *([F.col("place").cast("bigint").alias(place)] if place else []))
    entries = f"version int, entries array<struct<{schemas.GLOSSARY_ENTRY.replace(' string', ':string').replace(' int', ':int').replace(' double', ':double')}>>"
    rows = spark.read.schema(entries).option("multiLine", True).json(path).select(F.posexplode(F.coalesce("entries", F.array().cast(schemas.struct(entries)["entries"].dataType))).alias("_at", "e"))
    return rows.select("e.*", *([(F.col("_at") + 1).cast("bigint").alias(place)] if place else []))


def _form(spark: SparkSession, path: str) -> tuple[bool, int]:
    """Whether a glossary is written an entry a line, by its first line, and the bytes of its largest file."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath().getName(), f) for f in store.listStatus(where) if f.isFile() and f.getPath().getName()[0] not in "_.")
    if not files:
        return False, 0
    stream = store.open(files[0][1].getPath())
    try:
        by_line = all(stream.read() == b for b in f"{GLOSSARY_HEAD}\n".encode())
    finally:
        stream.close()
    return by_line, max(f.getLen() for _, f in files)


def _entry_lines(spark: SparkSession, path: str, place: str | None) -> DataFrame:
    """Entries of a glossary that is written an entry a line, whatever the number and size of its files."""
    own = schemas.struct(schemas.GLOSSARY_ENTRY)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.filter(~F.col("value").isin(GLOSSARY_HEAD, GLOSSARY_END))
    entry = F.from_json(F.regexp_replace("value", "^,", ""), own, {"mode": "FAILFAST"})
    if not place:
        return lines.select(entry.alias("e")).select("e.*")
    held = stored(lines.select(entry.alias("e"), "file", "block", F.monotonically_increasing_id().alias("at")).select("e.*", "file", "block", "at"), "glossary-lines")
    # a row for each range of bytes; of the names of parts the longer are the later ones
    earlier = W.orderBy(F.length("file"), "file", "block").rowsBetween(W.unboundedPreceding, -1)
    ranges = held.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = ranges.select("file", "block", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1).alias("adds"))
    return held.join(F.broadcast(before), ["file", "block"]).select(*own.names, (F.col("at") + F.col("adds")).cast("bigint").alias(place))


def prompt_header(spark: SparkSession, path: str) -> str:
    """The text of a header file; an error if it is blank."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None or not text.value.strip():
        raise ValueError(f"{path} is empty")
    return text.value.strip()
