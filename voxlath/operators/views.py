"""Tables that the viewer, the listening studio and the reports show."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def payload(rows: DataFrame, columns: Sequence[str], optional: Sequence[str] = (), out: str = "payload") -> DataFrame:
    """Rows as JSON objects of the columns, and of optional ones where the table has them and they aren't null."""
    there = [*columns, *[c for c in optional if c in rows.columns]]
    return rows.select(F.to_json(F.struct(*there), {"ignoreNullFields": "true"}).alias(out))


def seen(rows: DataFrame, trained: DataFrame, by: str = "speaker") -> DataFrame:
    """Adds seen: whether the speaker has training clips."""
    known = trained.select(F.col(by)).distinct().withColumn("__seen", F.lit(True))
    return rows.join(known, by, "left").withColumn("seen", F.coalesce("__seen", F.lit(False))).drop("__seen")


def voices(rows: DataFrame, registry: DataFrame, by: str = "speaker") -> DataFrame:
    """Adds the speaker's voice, unknown where the registry has none."""
    known = registry.select(by, F.col("voice").alias("__voice"))
    return rows.join(known, by, "left").withColumn("voice", F.coalesce("__voice", F.lit("unknown"))).drop("__voice")


def beside_real(scores: DataFrame, metrics: Sequence[str], real: str = "real speech", on: str = "text_id") -> DataFrame:
    """Models' scores with those of real speech for the same text, null where there is none; of several the last by item counts."""
    own = scores.where(F.col("model") == real).groupBy(on).agg(F.max_by(F.struct(*metrics), "item").alias("real"))
    return scores.where(F.col("model") != real).join(own, on, "left")


def largest(rows: DataFrame, by: str, n: int, tie: str) -> DataFrame:
    """The n largest rows, ties by name."""
    return rows.orderBy(F.col(by).desc(), tie).limit(n)


def speaker_report(registry: DataFrame, n: int = 15) -> DataFrame:
    """(speaker, hours, share, recordings, voice) of the largest speakers; the share is of all speakers' speech."""
    total = registry.agg(F.sum("seconds").alias("__all"))
    rows = registry.join(F.broadcast(total))  # one row
    share = F.col("seconds") / F.when(F.col("__all") > 0, F.col("__all")).otherwise(1.0)
    return largest(rows, "seconds", n, "speaker").select("speaker", (F.col("seconds") / 3600).alias("hours"), share.alias("share"), F.size("recordings").cast("long").alias("recordings"), "voice")


def voice_hours(registry: DataFrame) -> DataFrame:
    return registry.groupBy(F.coalesce("voice", F.lit("unknown")).alias("voice")).agg((F.sum("seconds") / 3600).alias("hours"))


def latest(rounds: DataFrame, n: int = 30, by: str = "round_id") -> DataFrame:
    return rounds.orderBy(F.col(by).desc()).limit(n)


def first_seen(rows: DataFrame, value: str, order: str) -> DataFrame:
    """(value, place): distinct values in the order in which they first come."""
    first = rows.groupBy(value).agg(F.min(order).alias("__at"))
    place = F.row_number().over(Window.orderBy("__at", value)) - 1  # as many rows as models
    return first.select(value, place.alias("place"))


def unique_names(rows: DataFrame, name: str, order: str) -> DataFrame:
    """Adds unique: the name, and from the second row with it on with -2, -3, ...; an empty one is work."""
    base = F.when(F.col(name) == "", "work").otherwise(F.col(name))
    n = F.row_number().over(Window.partitionBy(base).orderBy(order))
    return rows.withColumn("unique", F.when(n == 1, base).otherwise(F.concat(base, F.lit("-"), n.cast("string"))))


def facet(items: DataFrame, name: str, n: int = 80, order: str = "item") -> DataFrame:
    """The first items of a facet: all, seen, unseen, a voice or a kind of text."""
    match = {"all": F.lit(True), "seen": F.col("seen"), "unseen": ~F.col("seen")}.get(name, (F.col("voice") == name) | (F.col("kind") == name))
    return items.where(match).orderBy(order).limit(n)


def speaker_tabs(segments: DataFrame) -> DataFrame:
    """(rec, speaker, segments, seconds) per speaker, and one row with a null speaker for all."""
    return segments.rollup("rec", "speaker").agg(F.count("*").alias("segments"), F.sum("duration").alias("seconds"), F.grouping("rec").alias("__whole")).where("__whole = 0").drop("__whole")


def overlap_seconds(intervals: DataFrame, by: Sequence[str]) -> DataFrame:
    return intervals.groupBy(*by).agg(F.sum(F.col("end") - F.col("start")).alias("seconds"))


def first_after(points: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str = "at") -> DataFrame:
    """Points with the first interval of sorted disjoint ones that ends after them, null past the last.

    Points and ends are sorted together, so that nothing is compared with more than its neighbour.
    """
    p = points.select(*keys, F.col(at).alias("__x"), F.lit(1).alias("__point"), F.lit(None).cast("struct<start:double,end:double>").alias("__i"))
    i = intervals.select(*keys, F.col("end").cast("double").alias("__x"), F.lit(0).alias("__point"), F.struct(F.col("start").cast("double").alias("start"), F.col("end").cast("double").alias("end")).alias("__i"))
    both = p.withColumn("__x", F.col("__x").cast("double")).unionByName(i)
    # An interval that ends at the point is not after it, so it sorts before.
    w = Window.partitionBy(*keys).orderBy("__x", "__point").rowsBetween(0, Window.unboundedFollowing)
    found = both.withColumn("__first", F.first("__i", ignorenulls=True).over(w)).where("__point = 1")
    return found.select(*keys, F.col("__x").alias(at), F.col("__first.start").alias("start"), F.col("__first.end").alias("end"))


def running_mean(rows: DataFrame, by: str, order: str, value: str) -> DataFrame:
    """(by, value): the first value, then half-way to each next one in order."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(value).cast("double").alias("v")))), lambda x: x["v"])
    own = rows.groupBy(by).agg(ordered.alias("__v"))
    return own.select(by, F.aggregate(F.slice("__v", 2, F.greatest(F.lit(0), F.size("__v") - 1)), F.get("__v", F.lit(0)), lambda s, x: (s + x) / 2).alias(value))


def report_line(model: Column, metrics: Sequence[tuple[Column, Column, Column, float, int]], n: Column) -> Column:
    """One line of a fixed-width table: the model, each metric's mean and half interval (scale, digits), the number of items."""
    cells = [F.lpad(F.concat(F.format_string(f"%.{d}f", m * s), F.lit(" ±"), F.format_string(f"%.{d}f", (high - low) / 2 * s)), 13, " ") for m, low, high, s, d in metrics]
    return F.concat(F.lit("  "), F.rpad(model, 14, " "), F.lit(" "), F.concat_ws(" ", *cells), F.lit("   "), n.cast("string"))
