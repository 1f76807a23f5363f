"""Where documents come from: text folders, page tables, streams of either; and which of them are new."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.html import html_text
from ..session import new_path

# So many files and folders are listed in one call.
LISTED = 10_000


def decoded(column: str) -> Column:
    """A file name or path as it is; Spark encodes it like a URL."""
    return F.url_decode(F.replace(F.col(column), F.lit("+"), F.lit("%2B")))


def _file_columns(files: DataFrame, doc_id: str) -> DataFrame:
    if doc_id not in ("basename", "path"):
        raise ValueError("doc_id must be 'basename' or 'path'")
    name = decoded("_metadata.file_name" if doc_id == "basename" else "_metadata.file_path")
    return files.select(
        name.alias("doc_id"), decoded("_metadata.file_path").alias("path"), F.validate_utf8("value").alias("text")
    )


def _passed_over(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Path and length of the files below a folder that Spark's sources leave out: hidden ones and empty ones.

    Folders are listed by the driver, as for the index of files that Spark makes itself, but ``LISTED`` of them in one
    call: a folder of very many small folders takes no calls of its own for each, and no more than that is held at a time.
    """
    jvm, found = spark.sparkContext._jvm, []
    top = jvm.org.apache.hadoop.fs.Path(folder)
    system = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = system.makeQualified(top)
    root = top if system.getFileStatus(top).isDirectory() else top.getParent()
    above = len(root.toString().rstrip("/")) + 1
    todo = [system.listStatus(top)]
    while todo:
        listed = todo.pop()
        for start in range(0, len(listed), LISTED):
            some = listed[start : start + LISTED]
            # Only an array of plain objects can be written out whole.
            plain = spark.sparkContext._gateway.new_array(jvm.Object, len(some))
            jvm.System.arraycopy(some, 0, plain, 0, len(some))
            written = jvm.java.util.Arrays.toString(plain)
            entries = re.findall(r"\w+\{path=(.*?); isDirectory=(true|false);(?: length=(\d+);)?", written, re.DOTALL)
            if any(is_folder == "true" for _, is_folder, _ in entries):
                # Folders give way to what is in them, files are listed as themselves.
                todo.append(system.listStatus(jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(some)))
                continue
            for where, _, length in entries:
                out_of_sight = any(name.startswith(("_", ".")) for name in where[above:].split("/"))
                if out_of_sight or length == "0":
                    found.append((where, int(length)))
    return found


def _hidden_files(spark: SparkSession, folder: str, doc_id: str) -> DataFrame | None:
    """The rows of the files that Spark passes over; those with content are copied to names it reads."""
    files = _passed_over(spark, folder)
    if not files:
        return None
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    copies = new_path(spark, "hidden-files")
    for number, (path, length) in enumerate(files):
        if length:
            source, target = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, f"{copies}/{number}"))
            systems = source.getFileSystem(conf), target.getFileSystem(conf)
            jvm.org.apache.hadoop.fs.FileUtil.copy(systems[0], source, systems[1], target, False, conf)
    named = [(number, path, path.rsplit("/", 1)[1] if doc_id == "basename" else path, n > 0) for number, (path, n) in enumerate(files)]
    rows = spark.createDataFrame(named, "number bigint, path string, doc_id string, filled boolean")
    empty = rows.filter("not filled").select("doc_id", "path", F.lit("").alias("text"))
    if not any(n for _, n in files):
        return empty
    read = spark.read.option("wholetext", True).text(copies)
    read = read.select(
        F.col("_metadata.file_name").cast("bigint").alias("number"), F.validate_utf8("value").alias("text")
    )
    return empty.unionByName(rows.join(read, "number").select("doc_id", "path", "text"))


def read_text_folder(spark: SparkSession, folder: str, doc_id: str = "basename") -> DataFrame:
    """Every file below a folder as one document: ``doc_id, path, text``. Text that is not UTF-8 is an error.

    Empty files are empty documents, and names that start with ``_`` or ``.`` count like any other.
    """
    files = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(folder)
    found = _file_columns(files, doc_id)
    hidden = _hidden_files(spark, folder, doc_id)
    return found if hidden is None else found.unionByName(hidden)


def write_text_folder(rows: DataFrame, key: str, folder: str) -> None:
    """Write ``text`` as files ``<key>=<value>/part-...``, one per value and task, a line per row; null is an empty line.

    Tasks write through Arrow's file systems, into place: no folder is moved by the driver when all is done. A task that
    is run again writes the same file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = pa.fs.FileSystem.from_uri(folder)
        part, n = f"part-{TaskContext.get().partitionId():05d}.txt", 0
        lines = (line for batch in batches for line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        for value, same in groupby(lines, itemgetter(0)):
            place = f"{top}/{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            system.create_dir(place)
            with system.open_output_stream(f"{place}/{part}") as file:
                for _, text in same:
                    file.write((text or b"") + b"\n")
            n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    system, top = pa.fs.FileSystem.from_uri(folder)
    system.create_dir(top)
    lines = rows.select(key, F.col("text").cast("binary")).sortWithinPartitions(key)
    lines.mapInArrow(write, "n bigint").agg(F.sum("n")).collect()


def stream_text_folder(
    spark: SparkSession, folder: str, doc_id: str = "basename", files_per_batch: int = 10_000
) -> DataFrame:
    """Files as they arrive, as a stream; it picks up what Spark sees, so no hidden and no empty files."""
    files = (
        spark.readStream.format("text")
        .option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return _file_columns(files, doc_id)


def html_pages(pages: DataFrame) -> DataFrame:
    """Only the HTML pages of a page table; a table without ``content_type`` holds nothing else."""
    if "content_type" not in pages.columns:
        return pages
    media_type = F.lower(F.trim(F.regexp_replace("content_type", ";.*$", "")))
    return pages.filter(media_type == "text/html")


def page_url(pages: DataFrame) -> Column:
    """The URL a page is known by: where redirects ended, if recorded."""
    url = F.col("url")
    return F.coalesce(F.col("final_url"), url) if "final_url" in pages.columns else url


def page_documents(pages: DataFrame, doc_id: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """HTML pages as documents ``doc_id, text``; the id is the page's URL unless given. ``keep`` adds columns."""
    pages = html_pages(pages)
    key = page_url(pages) if doc_id is None else doc_id
    return pages.select(key.alias("doc_id"), html_text(F.col("html")).alias("text"), *keep)


def first_per_document(docs: DataFrame, order_by: str) -> DataFrame:
    """One row per ``doc_id``, the first by ``order_by``.

    Spark prunes to one row per id and task before the shuffle, so an id with very many rows does no harm.
    """
    rank = F.row_number().over(W.partitionBy("doc_id").orderBy(order_by))
    return docs.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def new_documents(docs: DataFrame, known: DataFrame, order_by: str | None = None) -> DataFrame:
    """Documents whose id is not in ``known``; with ``order_by`` repeated ids are reduced to their first row too."""
    docs = docs if order_by is None else first_per_document(docs, order_by)
    return docs.join(known.select("doc_id"), "doc_id", "left_anti")
