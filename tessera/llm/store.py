"""Scratch tables and files in the folder that all executors share."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path, ship_package


#: Rows that go to a Python worker at once, at most: texts are long.
BATCH_ROWS = 1_000
#: Rows that a Parquet scan holds in memory at once, at most: so are lists.
SCAN_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers, and keep the batches
    that they and the scans get small."""
    ship_package(spark)
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.parquet.columnarReaderBatchSize", SCAN_ROWS)):
        if not 0 < int(spark.conf.get(name)) <= most:
            spark.conf.set(name, most)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and
    a lost executor costs no recomputation of what lies before."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str):
    """(pyarrow file system, path) of a Hadoop-style URI or a plain path."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" in uri:
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), os.path.abspath(uri)


def unique_file(folder: str, suffix: str) -> str:
    """A file name that no other task attempt uses."""
    return f"{folder.rstrip('/')}/{uuid.uuid4().hex}{suffix}"
