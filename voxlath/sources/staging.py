"""Tables written to the folder that driver and executors share, to cut lineage between rounds."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table below spark.checkpoint.dir; a temporary folder only where that is unset in local mode."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="voxlath-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/voxlath/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
