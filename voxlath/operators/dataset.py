"""From clips to training splits: eligibility, caps, hold-out, routing, statistics."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ranking import placed


def hash_order(seed: int, *columns: str) -> Column:
    """A permutation key that depends on a seed, the same in any engine with md5."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def eligibility(rows: DataFrame, shortest: float, longest: float, has_file: Column | None = None) -> DataFrame:
    """Adds reason: the first that applies of no_clip_file, no_text, duration (outside the inclusive range), or keep."""
    has_file = F.lit(True) if has_file is None else has_file
    text = F.trim(F.coalesce("text", F.lit("")))
    reason = F.when(~has_file, "no_clip_file").when(text == "", "no_text").when(~F.col("duration").between(shortest, longest), "duration").otherwise("keep")
    return rows.withColumn("reason", reason)


def allow_list(rows: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows of recordings that the list doesn't name, and of named ones those of the listed speakers."""
    pairs = allowed.select("recording", "speaker").distinct().withColumn("__ok", F.lit(True))
    named = allowed.select("recording").distinct().withColumn("__named", F.lit(True))
    out = rows.join(named, "recording", "left").join(pairs, ["recording", "speaker"], "left")
    return out.where(F.col("__named").isNull() | F.col("__ok")).drop("__named", "__ok")


def map_speakers(rows: DataFrame, ids: DataFrame, similarity: DataFrame | None = None) -> DataFrame:
    """Local speakers by their global ids, their own where there is none; keeps the local one.

    similarity: (id, similarity) of clips to their voiceprints; adds speaker_similarity, null for
    clips without one.
    """
    if similarity is not None:
        rows = rows.join(similarity.select("id", F.col("similarity").alias("speaker_similarity")), "id", "left")
    named = ids.select(F.col("local").alias("speaker"), F.col("global").alias("__g"))
    return rows.join(named, "speaker", "left").withColumn("local_speaker", F.col("speaker")).withColumn("speaker", F.coalesce("__g", "speaker")).drop("__g")


def round_robin(rows: DataFrame, seed: int = 0) -> DataFrame:
    """Adds turn: a speaker's rows in rounds that take one of each recording, recordings and rows in seeded order."""
    own = Window.partitionBy("speaker", "recording").orderBy(hash_order(seed, "id"), "id")
    turns = rows.withColumn("round", F.row_number().over(own))
    return turns.withColumn("turn", F.row_number().over(Window.partitionBy("speaker").orderBy("round", hash_order(seed, "recording"), "recording")))


def cap_speakers(rows: DataFrame, budget: float, seed: int = 0) -> DataFrame:
    """Rows of speakers within the budget of seconds; of others the rows, in round-robin order, that still fit when their turn comes.

    A row that doesn't fit is skipped and the next tried, so this is an ordered fold, which no window
    expresses; only speakers over the budget are folded, in one pass over their turns and durations.
    """
    totals = rows.groupBy("speaker").agg(F.sum("duration").alias("__total"))
    marked = rows.join(totals, "speaker")
    over = round_robin(marked.where(F.col("__total") > budget), seed)

    def take(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table, used, kept = table.sort_by("turn"), 0.0, []
        for d in table.column("d").to_pylist():
            fits = used + d <= budget
            used += d if fits else 0.0
            kept.append(fits)
        return table.filter(pa.array(kept, pa.bool_())).select(["speaker", "id"])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    folded = over.select("speaker", "turn", "id", F.col("duration").cast("double").alias("d")).groupBy("speaker").applyInArrow(take, f"speaker {kinds['speaker']}, id {kinds['id']}")
    return marked.where(F.col("__total") <= budget).drop("__total").unionByName(marked.where(F.col("__total") > budget).drop("__total").join(folded, ["speaker", "id"], "left_semi"))


def hold_out(rows: DataFrame, share: float, seed: int = 0) -> DataFrame:
    """Adds split: whole recordings for dev, half to even of their number times the share, one at least where the share is positive and there are two."""
    recordings = placed(rows.select("recording").distinct(), [hash_order(seed, "recording"), F.col("recording")], "__r")
    n = recordings.agg(F.count("*").alias("__n"))
    least = F.when((F.lit(share) > 0) & (F.col("__n") > 1), 1).otherwise(0)
    dev = recordings.join(F.broadcast(n)).where(F.col("__r") < F.greatest(F.rint(F.col("__n") * share), least)).select("recording", F.lit("dev").alias("split"))  # one row
    return rows.join(dev, "recording", "left").withColumn("split", F.coalesce("split", F.lit("train")))


def route(rows: DataFrame, voices: DataFrame) -> DataFrame:
    """Adds dataset: dev, train_female for speakers with a female voice, train_main for all others."""
    out = rows.join(voices.select("speaker", "voice"), "speaker", "left")
    name = F.when(F.col("split") == "dev", "dev").when(F.col("voice") == "female", "train_female").otherwise("train_main")
    return out.withColumn("dataset", name)


def split_stats(rows: DataFrame, by: str = "dataset") -> DataFrame:
    return rows.groupBy(by).agg(F.count("*").alias("clips"), F.round(F.sum("duration") / 3600, 2).alias("hours"), F.countDistinct("speaker").alias("speakers"))


def cap_report(before: DataFrame, after: DataFrame, budget: float) -> DataFrame:
    a = before.groupBy("speaker").agg((F.sum("duration") / 3600).alias("available")).where(F.col("available") * 3600 > budget)
    return a.join(after.groupBy("speaker").agg((F.sum("duration") / 3600).alias("kept")), "speaker", "left")


def repeat_rows(rows: DataFrame, times: Column) -> DataFrame:
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), times)))


def systematic_sample(rows: DataFrame, n: int, order: list[str], by: list[str] | None = None) -> DataFrame:
    """Every step-th row in order, n at most; the step is the number of rows over n, one at least."""
    part = Window.partitionBy(*(by or []))
    step = F.greatest(F.lit(1), F.floor(F.count("*").over(part) / n))
    out = rows.withColumn("__step", step).withColumn("__i", F.row_number().over(part.orderBy(*order)) - 1)
    return out.where((F.col("__i") % F.col("__step") == 0) & (F.col("__i") < n * F.col("__step"))).drop("__step", "__i")


def require_files(rows: DataFrame, listing: DataFrame, path: str = "audio_path") -> DataFrame:
    """The rows, with an error at run time for one whose file isn't listed."""
    there = listing.select(F.col(path)).distinct().withColumn("__there", F.lit(True))
    out = rows.join(there, path, "left")
    checked = F.when(F.col("__there"), F.col(path)).otherwise(F.raise_error(F.concat(F.lit("listed but missing: "), F.coalesce(path, F.lit("null")))).cast("string"))
    return out.withColumn(path, checked).drop("__there")


def missing_files(rows: DataFrame, listing: DataFrame, path: str = "audio_path") -> DataFrame:
    return rows.join(listing.select(path), path, "left_anti")
