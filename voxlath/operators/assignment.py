"""Matching the speakers of overlapping windows to a recording's speakers."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Shared activity, in frames, that a match needs.
LEAST_SHARED = 0.5


def co_activity(local: DataFrame, speakers: DataFrame) -> DataFrame:
    """(rec, w, l, k, score): sums of the product of activities over a window's frames.

    local: (rec, w, t, l, p); speakers: (rec, t, k, p), on one grid of frames.  Products are summed
    as decimals, so that a score doesn't depend on the order in which tasks deliver them.
    """
    other = speakers.withColumnRenamed("p", "q")
    return local.join(other, ["rec", "t"]).groupBy("rec", "w", "l", "k").agg(F.sum((F.col("p") * F.col("q")).cast("decimal(20,12)")).cast("double").alias("score"))


def _ways(n: int, m: int) -> list[list[tuple[int, int]]]:
    """All matchings of n with m places that use all of the smaller side."""
    if n > m:
        return [[(a, b) for b, a in way] for way in _ways(m, n)]
    return [list(enumerate(other)) for other in permutations(range(m), n)]


def assign(scores: DataFrame, least: float = LEAST_SHARED, most: int = 6) -> DataFrame:
    """(rec, w, l, k): each window's best matching; then pairs with no more than least shared activity go.

    A window has a handful of speakers: its scores are one row, and the matchings of n with m
    speakers, n and m up to `most`, are tried in the order of their right sides, the first of equals
    standing.  More speakers of a window than that are an error.
    """
    side = lambda c: F.array_sort(F.collect_set(c))
    windows = scores.groupBy("rec", "w").agg(side("l").alias("ls"), side("k").alias("ks"), F.map_from_entries(F.collect_list(F.struct(F.struct("l", "k"), "score"))).alias("s"))
    none = F.expr("cast(array() as array<array<struct<a:int,b:int>>>)")
    value = lambda p: F.coalesce(F.try_element_at("s", F.struct(F.get("ls", p["a"]).alias("l"), F.get("ks", p["b"]).alias("k"))), F.lit(0.0))
    sizes = {(r["n"], r["m"]) for r in windows.select(F.size("ls").alias("n"), F.size("ks").alias("m")).distinct().limit(most * most + 1).collect()}  # few pairs of numbers
    if any(max(size) > most for size in sizes):
        raise ValueError(f"a window has more than {most} speakers")
    ways = none
    for n, m in sorted(sizes):
        table = "array(" + ",".join("array(" + ",".join(f"named_struct('a',{a},'b',{b})" for a, b in sorted(way)) + ")" for way in _ways(n, m)) + ")"
        ways = F.when((F.size("ls") == n) & (F.size("ks") == m), F.expr(table)).otherwise(ways)
    total = lambda way: F.aggregate(way, F.lit(0.0), lambda t, p: t + value(p))
    best = F.array_max(F.transform(ways, lambda way, i: F.struct(total(way).alias("t"), (-i).alias("i"), way.alias("way"))))["way"]
    pairs = windows.select("rec", "w", "ls", "ks", "s", F.explode(best).alias("p")).withColumn("score", value(F.col("p")))
    return pairs.where(F.col("score") > least).select("rec", "w", F.get("ls", F.col("p.a")).alias("l"), F.get("ks", F.col("p.b")).alias("k"))


def others_of(local: DataFrame, matched: DataFrame, speakers: DataFrame) -> DataFrame:
    """(rec, w, t, k, other): per speaker the strongest local speaker that isn't matched to it; 0 where there is none.

    speakers: (rec, k), each recording's few speakers.
    """
    names = matched.select("rec", "w", "l", F.col("k").alias("own"))
    cells = local.join(names, ["rec", "w", "l"], "left").join(speakers, "rec")
    return cells.groupBy("rec", "w", "t", "k").agg(F.coalesce(F.max(F.when(~F.col("own").eqNullSafe(F.col("k")), F.col("p"))), F.lit(0.0)).alias("other"))
