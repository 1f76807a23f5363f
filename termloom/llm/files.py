"""Files that tasks write and read themselves, below the folder that all executors share."""

from __future__ import annotations

import os
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from ..session import new_path


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
TEXT_ROWS = 1000


def open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a folder: a plain path, file:, hdfs:, s3: or gs:."""
    return pa.fs.FileSystem.from_uri(folder)


def new_file(folder: str, suffix: str) -> tuple[str, pa.NativeFile]:
    """Name of a new file of this task attempt, and the file opened for writing.

    Attempts never share a name; a file counts only once the manifest row of a finished task names it.
    """
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}{suffix}"
    return name, fs.open_output_stream(f"{path}/{name}", compression=None)


def read_file(folder: str, name: str) -> pa.NativeFile:
    fs, path = open_folder(folder)
    return fs.open_input_file(f"{path}/{name}")


def write_with_manifest(
    rows: DataFrame, folder: str, write: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str
) -> DataFrame:
    """Let each task write its files by ``write``, which yields their manifest rows; returns the stored manifest.

    Spark commits the rows of one attempt of each task, so lost and repeated attempts leave no trace in the manifest.
    """
    spark = rows.sparkSession
    rows.mapInArrow(write, schema).write.parquet(f"{folder}/manifest")
    return spark.read.schema(schema).parquet(f"{folder}/manifest")


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send at most so many rows to Python at a time while an action inside runs, for wide rows of long texts."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


_shipped: set[str] = set()


def prepare_session(spark: SparkSession) -> None:
    """Fit a session to long texts: rows per Arrow batch down to ``TEXT_ROWS``, the package on all executors.

    Workers and executors hold whole batches on both sides of a Python stage, so their size is what memory follows.
    """
    rows = int(spark.conf.get(ARROW_ROWS))
    if rows <= 0 or rows > TEXT_ROWS:
        spark.conf.set(ARROW_ROWS, str(TEXT_ROWS))
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, wherever the driver found it."""
    app = spark.sparkContext.applicationId
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if app in _shipped or not os.path.isdir(package):
        return
    folder = new_path(spark, "package")
    fs, path = open_folder(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/termloom.zip", compression=None) as out, zipfile.ZipFile(out, "w") as archive:
        for place, _, names in os.walk(package):
            for name in (n for n in sorted(names) if n.endswith(".py")):
                file = os.path.join(place, name)
                archive.write(file, os.path.relpath(file, os.path.dirname(package)))
    spark.sparkContext.addPyFile(f"{folder}/termloom.zip")
    _shipped.add(app)
