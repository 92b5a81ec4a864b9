"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_SPLIT = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the cluster names in spark.checkpoint.dir; a local folder is set only where
    that is unset and driver and executors are one process, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="voxlath-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/voxlath/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: str | Column = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5; null for a null doc_id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 if isinstance(doc_id, str) else F.crc32(doc_id.cast("string").cast("binary")) % 5


def local_path(uri: str) -> str | None:
    """The path in the mounted file system that a URI names, or None for another store."""
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if "://" not in uri and os.path.isabs(uri) else None


#: Rows of an Arrow batch; texts can be long, so batches must be short.
BATCH_ROWS = 1000


def short_batches(spark: SparkSession) -> None:
    """Arrow batches of at most BATCH_ROWS rows from now on in this session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def tidy(f: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """f over a task's batches; what it held goes back to the system at the end, as workers outlive tasks."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
