"""Ingest as a stream of snapshots, and interval sessions."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.ingest import invalidation


def follow(spark: SparkSession, path: str, schema: str, checkpoint: str, handle: Callable[[DataFrame, int], None], once: bool = True) -> StreamingQuery:
    """Hand every new file's rows to handle exactly once per batch number; what is done is in the checkpoint, so a rerun resumes.

    handle must be idempotent by batch number, as a batch whose commit was lost comes again.
    """
    rows = spark.readStream.schema(schema).parquet(path)
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")).start()


class Catalog:
    """Current recordings: a whole table for some batches, and for those after it what each changed; only complete ones count.

    A batch writes its own rows; every `every` batches, they are merged into a new whole table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, every: int = 16):
        self._spark, self._path, self._schema, self._every = spark, path.rstrip("/"), schema, every

    def _numbers(self, kind: str, before: int | None) -> list[int]:
        jvm = self._spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self._path)
        store = root.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in store.listStatus(root)] if store.exists(root) else []
        found = [int(n.partition("=")[2]) for n in names if n.startswith(f"{kind}=") and store.exists(jvm.org.apache.hadoop.fs.Path(f"{self._path}/{n}/_SUCCESS"))]
        return sorted(n for n in found if before is None or n < before)

    def read(self, before: int | None = None) -> DataFrame:
        """The recordings after all batches, or after those before one; an id's newest row counts."""
        whole = self._numbers("whole", before)[-1:]
        after = [n for n in self._numbers("delta", before) if not whole or n > whole[0]]
        table = lambda kind, n: self._spark.read.schema(self._schema).parquet(f"{self._path}/{kind}={n}")
        parts = [table("whole", n).withColumn("__n", F.lit(n)) for n in whole] + [table("delta", n).withColumn("__n", F.lit(n)) for n in after]
        if not parts:
            return self._spark.createDataFrame([], self._schema)
        if not after:
            return parts[0].drop("__n")
        rows = functools.reduce(DataFrame.unionByName, parts)
        columns = [c for c in rows.columns if c not in ("id", "__n")]
        return rows.groupBy("id").agg(F.max_by(F.struct(*columns), "__n").alias("r")).select("id", "r.*").select(*[c for c in rows.columns if c != "__n"])

    def merge(self, batch: DataFrame, number: int) -> DataFrame:
        """Write what a batch changes, newer rows replacing older ones by id; returns (id, stage) to run again."""
        old = self.read(number)
        newest = batch.groupBy("id").agg(F.max_by(F.struct(*[c for c in batch.columns if c != "id"]), "modified").alias("r")).select("id", "r.*").select(*old.columns)
        newest.write.mode("overwrite").parquet(f"{self._path}/delta={number}")
        if number % self._every == self._every - 1:
            self.read(number + 1).write.mode("overwrite").parquet(f"{self._path}/whole={number}")
        return invalidation(old, newest)


def sessions(events: DataFrame, key: str, ts: str, gap: str, aggs: list[Column], watermark: str | None = None) -> DataFrame:
    """Events of a key closer than gap as one session; for streams with a watermark, late ones within it join."""
    rows = events.withColumn(ts, F.col(ts).cast("timestamp"))
    rows = rows.withWatermark(ts, watermark) if watermark else rows
    return rows.groupBy(key, F.session_window(ts, gap)).agg(*aggs)
