"""File trees as document tables: scan, media type, text extraction."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexharbor.functions.text import title_of
from lexharbor.operators import language
from lexharbor.session import materialize

# Media types by file extension.
BY_EXTENSION = {
    "txt": "text/plain", "text": "text/plain", "log": "text/plain",
    "htm": "text/html", "html": "text/html", "xml": "application/xml",
    "csv": "text/csv", "json": "application/json", "md": "text/x-web-markdown",
    "pdf": "application/pdf", "rtf": "application/rtf", "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "odt": "application/vnd.oasis.opendocument.text",
    "ott": "application/vnd.oasis.opendocument.text-template",
    "ods": "application/vnd.oasis.opendocument.spreadsheet",
    "odp": "application/vnd.oasis.opendocument.presentation",
    "zip": "application/zip", "png": "image/png", "jpg": "image/jpeg", "gif": "image/gif",
}
# Media types by the first characters of the content.
BY_START = {
    "%PDF-": "application/pdf", "{\\rtf": "application/rtf",
    "<!doctype html": "text/html", "<html": "text/html", "<?xml": "application/xml",
}
ZIP_START = "PK\u0003\u0004"
# A document is indexed if its media type contains one of these.
INDEXED = ("opendocument.text", "rtf", "openxmlformats", "pdf", "text/plain")
UNKNOWN = "application/octet-stream"
# What opening a file of a tree costs, in bytes read meanwhile.
OPEN_BYTES = 64 << 10


def _files(spark: SparkSession, root: str, **options) -> DataFrame:
    try:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
                 .options(**options).load(root))
    except AnalysisException as missing:
        raise ValueError(f"nothing can be read at {root}") from missing
    return files.select(F.regexp_replace("path", "^file:/+", "/").alias("path"),
                        F.col("modificationTime").alias("modified"), "length", "content")


def scan(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modified, length, content)`` of one file, or of all files under a folder.

    Files that vanish or cannot be read while the job runs are passed over; compare with the
    :func:`listing` by :func:`unread` to learn which.
    """
    return _files(spark, root, ignoreMissingFiles=True, ignoreCorruptFiles=True)


def listing(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modified, length)`` of the files under ``root``; no content is opened."""
    return _files(spark, root).select("path", "modified", "length")


def unread(listed: DataFrame, read: DataFrame) -> DataFrame:
    """``(path, error)`` of the files listed that were not read.

    Take ``read`` from a stored table of what came of the scan (see :func:`read_files`): a second
    scan may read what the first could not.
    """
    missing = listed.select("path").join(read.select("path"), "path", "left_anti")
    return missing.select("path", F.lit("the file could not be read").alias("error"))


@contextmanager
def _small_files(spark: SparkSession) -> Iterator[None]:
    """Deal files to tasks by their bytes: counted as ``OPEN_BYTES`` more each, not as Spark's 4 MB.

    Else 32 files make a task, and each of the tables written from them has a file for each task.
    """
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, OPEN_BYTES)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def read_files(spark: SparkSession, root: str,
               extractors: dict[str, Callable[[str, bytes], str]] | None = None) -> DataFrame:
    """``(path, body, error)`` of the files under ``root`` that are indexed or could not be read.

    The tree is listed first; what is listed and not read afterwards becomes a row with an error.
    The result is stored, so one pass over the contents serves all readers.
    """
    with _small_files(spark):
        listed = materialize(listing(spark, root), "listing")
        seen = materialize(scan(spark, root), "contents")
    done = extract(seen, extractors)
    lost = unread(listed, seen).select("path", F.lit(None).cast("string").alias("body"), "error")
    return materialize(done.unionByName(lost), "extracted")


def media_type(path: Column, head: Column, whole: Column | None = None) -> Column:
    """Media type from the file name and the content.

    ``head`` is the start of the content as a string, read for signatures; it decides where
    it is telling, except that packed office files are told apart by name. Whether a file
    of unknown name is plain text is judged on ``whole`` (``head`` if that is all there is).
    """
    whole = head if whole is None else whole
    name = F.element_at(F.split(path, "/"), -1)
    extension = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    table = F.create_map(*[F.lit(x) for pair in BY_EXTENSION.items() for x in pair])
    named = F.try_element_at(table, extension)
    start = F.lower(F.ltrim(head))
    known = reduce(lambda chain, pair: chain.when(start.startswith(pair[0].lower()), pair[1]),
                   BY_START.items(), F.when(F.lit(False), F.lit("")))
    packed = F.when(head.startswith(ZIP_START), F.when(
        named.contains("openxmlformats") | named.contains("opendocument"), named)
        .otherwise("application/zip"))
    plain = F.when(~whole.rlike("[\\x00-\\x08\\x0E-\\x1A\\x1C-\\x1F]"), "text/plain")
    return F.coalesce(known, packed, named, plain, F.lit(UNKNOWN))


def head_of(content: Column, n: int = 512) -> Column:
    """Start of binary content as a string, for the signatures of :func:`media_type`."""
    return F.make_valid_utf8(F.substring(content, 1, n).cast("string"))


def is_indexed(mime: Column) -> Column:
    """Whether documents of this media type are indexed."""
    return reduce(lambda a, b: a | b, [mime.contains(part) for part in INDEXED])


def plain_text(content: Column) -> Column:
    """Whole content as text; bytes that are not UTF-8 become replacement characters."""
    return F.regexp_replace(F.make_valid_utf8(content.cast("string")), "^﻿", "")


def extract_with(files: DataFrame, extractor: Callable[[str, bytes], str]) -> DataFrame:
    """``(path, body, error)`` by a Python extractor of (path, bytes), in Arrow batches.

    A file the extractor fails on keeps a row with its error and no body.
    """
    rows = files.select("path", F.lit("").alias("mime"), "content", F.lit(None).cast("string").alias("body"))
    return rows.mapInArrow(_dispatch({"": extractor}), EXTRACTED)


EXTRACTED = "path string, body string, error string"


def _dispatch(extractors: dict[str, Callable[[str, bytes], str]]):
    """Task: rows with a body pass; of the rest each goes to the extractor of its media type."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies, errors = batch.column("body").to_pylist(), [None] * len(batch)
            columns = zip(batch.column("path"), batch.column("mime").to_pylist(),
                          batch.column("content"), strict=True)
            for i, (path, mime, content) in enumerate(columns):
                if bodies[i] is not None:
                    continue
                own = next((f for part, f in extractors.items() if part in mime), None)
                if own is None:
                    errors[i] = f"no extractor for {mime}"
                    continue
                try:
                    bodies[i] = own(path.as_py(), content.as_py())
                except Exception as failed:  # one bad file must not end the job
                    errors[i] = f"{type(failed).__name__}: {failed}"
            yield pa.RecordBatch.from_pydict({
                "path": batch.column("path"), "body": pa.array(bodies, pa.string()),
                "error": pa.array(errors, pa.string())})
    return run


def extract(files: DataFrame,
            extractors: dict[str, Callable[[str, bytes], str]] | None = None) -> DataFrame:
    """``(path, body, error)`` of the indexed files, in one pass over their contents.

    Plain text is decoded in place; other types go to the first extractor whose key their
    media type contains. A type without one is reported in ``error``. Without extractors no
    content leaves the JVM.
    """
    content = F.col("content")
    typed = files.select("path", "content", media_type(
        F.col("path"), head_of(content), F.make_valid_utf8(content.cast("string"))).alias("mime"))
    plain = F.col("mime").contains("text/plain")
    rows = typed.filter(is_indexed(F.col("mime"))).select(
        "path", "mime", F.when(~plain, content).alias("content"),
        F.when(plain, plain_text(content)).alias("body"))
    if extractors:
        return rows.mapInArrow(_dispatch(extractors), EXTRACTED)
    missing = F.concat(F.lit("no extractor for "), "mime")
    return rows.select("path", "body", F.when(F.col("body").isNull(), missing).alias("error"))


def documents(extracted: DataFrame, profile: DataFrame | None = None, alt: str = "pl",
              default: str = "en") -> tuple[DataFrame, DataFrame]:
    """``docs(path, lang, title, body)`` and ``errors(path, error)`` from extracted text.

    With a language profile, documents certainly in ``alt`` are routed there.
    """
    good = extracted.filter("error is null").select("path", "body")
    if profile is None:
        lang = good.withColumn("lang", F.lit(default))
    else:
        found = language.detect(good, profile).select("path", language.route(
            F.col("certain"), F.col("detected"), alt, default).alias("lang"))
        lang = good.join(found, "path")
    return (lang.select("path", "lang", title_of(F.col("path")).alias("title"), "body"),
            extracted.filter("error is not null").select("path", "error"))
