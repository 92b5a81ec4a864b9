"""Joins of intervals and points by time bins.

Spark would plan a range condition as a nested loop; here both sides get bin numbers, the join
is an equi-join on (key, bin), and each pair meets in one bin.  A bin should be about as long as
the intervals are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bins(start: Column, end: Column, width: float) -> Column:
    return F.explode(F.sequence(F.floor(start / width), F.floor(F.greatest(start, end) / width)))


def points_in_intervals(points: DataFrame, intervals: DataFrame, keys: Sequence[str], width: float, at: str = "start", start: str = "seg_start", end: str = "seg_end", how: str = "inner") -> DataFrame:
    """Pairs with start <= point < end."""
    left = points.withColumn("__bin", F.floor(F.col(at) / width))
    right = intervals.withColumn("__bin", _bins(F.col(start), F.col(end), width))
    joined = left.join(right.withColumnsRenamed({k: f"__{k}" for k in keys}), [left[k] == F.col(f"__{k}") for k in keys] + [left["__bin"] == right["__bin"], left[at] >= right[start], left[at] < right[end]], how)
    return joined.drop(left["__bin"]).drop(right["__bin"]).drop(*[f"__{k}" for k in keys])


def overlapping(left: DataFrame, right: DataFrame, keys: Sequence[str], width: float, a: tuple[str, str] = ("start", "end"), b: tuple[str, str] = ("seg_start", "seg_end")) -> DataFrame:
    """left's rows that overlap any of right's (strictly on both sides), each once."""
    one = left.withColumn("__id", F.monotonically_increasing_id())
    x = one.withColumn("__bin", _bins(F.col(a[0]), F.col(a[1]), width))
    y = right.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(b[0]).alias("__s"), F.col(b[1]).alias("__e")).withColumn("__b", _bins(F.col("__s"), F.col("__e"), width))
    hit = x.join(y, [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("__bin") == F.col("__b"), F.col(a[0]) < F.col("__e"), F.col("__s") < F.col(a[1])], "left_semi")
    return hit.dropDuplicates(["__id"]).drop("__id", "__bin")


def words_in_segments(words: DataFrame, segments: DataFrame, keys: Sequence[str], width: float, tolerance: float = 0.2) -> DataFrame:
    """Per segment: its text, words, and words that its bounds cut: ones that cross its start, or end later than its end by more than tolerance.

    words: (keys, start, end, text); segments: (keys, seg_start, seg_end).  Equal rows of words count
    each; words and segments may be longer than a bin.
    """
    keys = list(keys)
    w = words.select(*keys, "start", "end", "text").withColumn("__w", F.monotonically_increasing_id()).withColumn("__bin", _bins(F.col("start"), F.col("end"), width))
    s = segments.select(*[F.col(k).alias(f"__{k}") for k in keys], "seg_start", "seg_end").withColumn("__b", _bins(F.col("seg_start"), F.col("seg_end"), width))
    near = w.join(s, [F.col(k) == F.col(f"__{k}") for k in keys] + [F.col("__bin") == F.col("__b")])
    inside = (F.col("start") >= F.col("seg_start")) & (F.col("start") < F.col("seg_end"))
    crosses = (F.col("start") < F.col("seg_start")) & (F.col("seg_start") < F.col("end"))
    # A pair meets in every bin that both touch, and counts in the first of these.
    first = F.floor(F.greatest(F.col("start"), F.col("seg_start")) / width)
    counted = near.where((inside | crosses) & (F.col("__bin") == first))
    cut = crosses | (inside & (F.col("end") > F.col("seg_end") + tolerance))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(inside, F.struct("start", "end", "text", "__w")))), lambda x: x["text"]), " ")
    out = counted.groupBy(*keys, "seg_start", "seg_end").agg(text.alias("text"), F.count_if(inside).alias("num_words"), F.count_if(cut).alias("cut_words"))
    return segments.select(*keys, "seg_start", "seg_end").join(out, [*keys, "seg_start", "seg_end"], "left").select(
        *keys, "seg_start", "seg_end", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("num_words", F.lit(0)).alias("num_words"), F.coalesce("cut_words", F.lit(0)).alias("cut_words")
    )


def frame_slice(start: Column, end: Column, hop: float) -> tuple[Column, Column]:
    """Half-open frame numbers that cover a span of seconds."""
    return F.floor(start / hop), F.ceil(end / hop)
