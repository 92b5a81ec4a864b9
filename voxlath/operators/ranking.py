"""Places of rows in a whole order, without bringing them into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import staged


def placed(rows: DataFrame, order: list[Column], out: str = "place") -> DataFrame:
    """Adds each row's place from 0 on.  order must be total, or equal rows get places in any order.

    The rows are dealt by ranges of the order and written with the number of their range, so that
    every later read sees the same ranges; then one small row for each range tells how many rows are
    in the ranges before.
    """
    ranges = staged(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = ranges.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    own = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return ranges.withColumn("__own", own).join(F.broadcast(sizes.select("__range", before.alias("__before"))), "__range").withColumn(out, F.col("__before") + F.col("__own") - 1).drop("__range", "__own", "__before")


def batches(rows: DataFrame, size: Column, n: int, tie: str, out: str = "batch") -> DataFrame:
    """Adds the number of a batch of n rows of similar size, the smallest first."""
    return placed(rows, [size, F.col(tie)], "__place").withColumn(out, F.floor(F.col("__place") / n)).drop("__place")
