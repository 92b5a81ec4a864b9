"""From frame masks to clips: ordered folds over the islands of a run, and the rules for whole files.

The folds look at one run's islands at a time, an array bounded by the run's length; they are
higher-order functions, so they stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SPANS = "array<struct<start: bigint, end: bigint>>"


def _sorted_spans(start: str = "start", end: str = "end") -> Column:
    return F.array_sort(F.collect_list(F.struct(F.col(start).cast("bigint").alias("start"), F.col(end).cast("bigint").alias("end"))))


def merge_gaps(spans: Column, max_pause: int, max_len: int, split_pause: int) -> Column:
    """Ordered fold: a span joins the group before it unless the gap is over max_pause, or the group
    would exceed max_len and the gap is at least split_pause."""

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        gap = x["start"] - last["end"]
        new = (gap > max_pause) | ((x["end"] - last["start"] > max_len) & (gap >= split_pause))
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"))))
        return F.when(F.size(acc) == 0, F.array(x)).when(new, F.array_append(acc, x)).otherwise(joined)

    return F.aggregate(spans, F.expr(f"cast(array() as {_SPANS})"), step)


def speaker_gap_merge(runs: DataFrame, own: DataFrame, margin: int, max_pause: int, max_len: int, split_pause: int, keys: Sequence[str] = ("rec", "k")) -> DataFrame:
    """Utterances (keys, run_start, start, end) of clean runs, cut at gaps in the speaker's own activity.

    runs: (keys, start, end); own: the activity's islands inside runs (keys, run_start, run_end, start, end).
    Islands within margin of their run's edge go, as they may begin or end outside.
    """
    inside = own.where((F.col("start") - F.col("run_start") >= margin) & (F.col("run_end") - F.col("end") >= margin))
    groups = inside.groupBy(*keys, "run_start").agg(merge_gaps(_sorted_spans(), max_pause, max_len, split_pause).alias("g"))
    return groups.select(*keys, "run_start", F.explode("g").alias("g")).select(*keys, "run_start", "g.start", "g.end")


def split_long(start: Column, end: Column, gaps: Column, max_len: int, min_pause: int) -> Column:
    """Parts of a span, halved at its longest inner gap (the latest of equals) until they fit; a part that has no gap goes.

    Gaps are taken from the longest down: one cuts the part around it if that is still too long.
    """
    inner = F.filter(gaps, lambda g: (g["start"] > start) & (g["end"] < end) & (g["end"] - g["start"] >= min_pause))
    ranked = F.reverse(F.array_sort(F.transform(inner, lambda g: F.struct((g["end"] - g["start"]).alias("n"), g["start"].alias("start"), g["end"].alias("end")))))

    def cut(parts: Column, g: Column) -> Column:
        halves = lambda p: F.array(F.struct(p["start"].alias("start"), g["start"].alias("end")), F.struct(g["end"].alias("start"), p["end"].alias("end")))
        around = lambda p: (p["start"] < g["start"]) & (g["end"] < p["end"]) & (p["end"] - p["start"] > max_len)
        return F.flatten(F.transform(parts, lambda p: F.when(around(p), halves(p)).otherwise(F.array(F.struct(p["start"].alias("start"), p["end"].alias("end"))))))

    whole = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end")))
    return F.filter(F.aggregate(ranked, whole, cut), lambda p: p["end"] - p["start"] <= max_len)


def split_long_spans(rows: DataFrame, keys: Sequence[str], max_len: int, min_pause: int) -> DataFrame:
    """split_long for rows (keys, start, end, gaps array<struct<start, end>>)."""
    parts = split_long(F.col("start"), F.col("end"), F.col("gaps"), max_len, min_pause)
    return rows.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.start", "p.end")


def acoustic_chunks(frames: DataFrame, margin: int, min_pause: int, split_pause: int, max_len: int, keys: Sequence[str] = ("rec", "k")) -> DataFrame:
    """Chunks (keys, run_start, run_end, start, end) between acoustic cuts of clean runs.

    frames: dense frames of clean runs with run_start, run_end, own, quiet, and left_pause and
    right_pause, which say whether the run borders a pause.  A cut is a quiet stretch of
    min_pause, one without own activity of split_pause, or one of either kind of margin at the
    run's edge.  A chunk must end at cuts or at bordering pauses, fit max_len and be the
    speaker's own for at least half.
    """
    from .frames import run_ids

    run = [*keys, "run_start"]

    def stretch(df: DataFrame, name: str, mask: Column, least: int, edge: bool = False) -> DataFrame:
        df = run_ids(df.withColumn("__m", mask), run, "__m", "__r")
        w = Window.partitionBy(*run, "__r")
        long = F.count("*").over(w) >= least
        if edge:
            long = long & ((F.min("t").over(w) == F.col("run_start")) | (F.max("t").over(w) + 1 == F.col("run_end")))
        return df.withColumn(name, F.col("__m") & long).drop("__m", "__r")

    cut = stretch(frames, "__c1", F.col("quiet"), min_pause)
    cut = stretch(cut, "__c2", ~F.col("own"), split_pause)
    cut = stretch(cut, "__c3", F.col("quiet") | ~F.col("own"), margin, edge=True)
    from .frames import islands

    chunks = islands(
        cut, [*run, "run_end"], ~(F.col("__c1") | F.col("__c2") | F.col("__c3")),
        aggs=[F.avg(F.col("own").cast("double")).alias("share"), F.max("left_pause").alias("lp"), F.max("right_pause").alias("rp")],
    )
    ok = ((F.col("start") > F.col("run_start")) | F.col("lp")) & ((F.col("end") < F.col("run_end")) | F.col("rp")) & (F.col("end") - F.col("start") <= max_len) & (F.col("share") >= 0.5)
    return chunks.where(ok).select(*keys, "run_start", "run_end", "start", "end")


def acoustic_merge(chunks: DataFrame, margin: int, max_pause: int, max_len: int, keys: Sequence[str] = ("rec", "k")) -> DataFrame:
    """Clips of chunks: merged while the pause is at most max_pause and the span at most max_len; widened
    into the pauses around them by up to margin, at most half of a pause that two clips share."""
    keys = list(keys)

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        fits = (x["start"] - last["end"] <= max_pause) & (x["end"] - last["start"] <= max_len)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["start"].alias("start"), x["end"].alias("end"))))
        return F.when(F.size(acc) == 0, F.array(x)).when(fits, joined).otherwise(F.array_append(acc, x))

    merged = chunks.groupBy(*keys, "run_start", "run_end").agg(F.aggregate(_sorted_spans(), F.expr(f"cast(array() as {_SPANS})"), step).alias("g"))
    spans = merged.select(*keys, "run_start", "run_end", F.explode("g").alias("g")).select(*keys, "run_start", "run_end", F.col("g.start").alias("speech_start"), F.col("g.end").alias("speech_end"))
    w = Window.partitionBy(*keys, "run_start").orderBy("speech_start")
    before, after = F.lag("speech_end").over(w), F.lead("speech_start").over(w)
    lead = F.least(F.lit(margin), F.when(before.isNotNull(), F.floor((F.col("speech_start") - before) / 2)).otherwise(F.col("speech_start") - F.col("run_start")))
    trail = F.least(F.lit(margin), F.when(after.isNotNull(), F.floor((after - F.col("speech_end")) / 2)).otherwise(F.col("run_end") - F.col("speech_end")))
    return spans.select(*keys, "run_start", "speech_start", "speech_end", (F.col("speech_start") - lead).alias("start"), (F.col("speech_end") + trail).alias("end"))


def segment_scores(clips: DataFrame, frames: DataFrame, signals: Sequence[str], keys: Sequence[str] = ("rec", "k")) -> DataFrame:
    """Adds the largest of each signal over a clip and the mean of p over its speech.

    A clip's frames are exploded to an equi-join, so no range join is needed.  The mean adds a clip's
    frames in their order, so that its last digits don't depend on how rows were dealt.
    """
    keys = list(keys)
    cells = clips.select(*keys, "start", "end", "speech_start", "speech_end", F.explode(F.sequence("start", F.col("end") - 1)).alias("t"))
    spoken = (F.col("t") >= F.col("speech_start")) & (F.col("t") < F.col("speech_end"))
    heard = F.array_sort(F.collect_list(F.when(spoken & F.col("p").isNotNull(), F.struct("t", "p"))))  # the frames of one clip
    total = F.aggregate("__heard", F.lit(0.0), lambda acc, x: acc + x["p"])
    out = cells.join(frames, [*keys, "t"]).groupBy(*keys, "start", "end", "speech_start", "speech_end").agg(*[F.max(s).alias(f"max_{s}") for s in signals], heard.alias("__heard"))
    return out.withColumn("mean_p", F.when(F.size("__heard") > 0, total / F.size("__heard"))).drop("__heard")


def whole_file(frames: DataFrame, foreign: Column, threshold: float, margin: int, pad: int, min_len: int, max_len: int) -> DataFrame:
    """One row per recording: the span of its main speaker's speech, and why it is kept or not.

    frames: dense (rec, t, k, p) with the signals that foreign uses.
    """
    active = F.col("p") > threshold
    spoken = frames.groupBy("rec", "k").agg(F.sum(active.cast("long")).alias("n"), F.min(F.when(active, F.col("t"))).alias("a"), F.max(F.when(active, F.col("t"))).alias("b"))
    main = spoken.groupBy("rec").agg(F.max_by(F.struct("k", "n", "a", "b"), F.struct(F.col("n"), -F.col("k"))).alias("m")).select("rec", "m.*")
    size = frames.groupBy("rec").agg((F.max("t") + 1).alias("size"))
    span = main.join(size, "rec").withColumn("start", F.greatest(F.lit(0), F.col("a") - margin)).withColumn("end", F.least(F.col("size"), F.col("b") + 1 + margin))
    near = frames.withColumn("__f", foreign).join(span.select("rec", "k", "start", "end"), ["rec", "k"])
    heard = near.where("__f").where((F.col("t") >= F.col("start") - pad) & (F.col("t") < F.col("end") + pad)).select("rec").distinct().withColumn("heard", F.lit(True))
    length = F.col("end") - F.col("start")
    reason = F.when(F.col("n") == 0, "no speech").when(length < min_len, "too short").when(length > max_len, "too long").when(F.col("heard"), "second voice").otherwise("kept")
    return span.join(heard, "rec", "left").select("rec", "k", "start", "end", reason.alias("reason"))


def summary(segments: DataFrame, totals: DataFrame, rec: str = "rec", k: str = "k") -> DataFrame:
    """Per recording: total and kept frames, the kept share (0 without frames), segments, and kept frames by speaker, sorted."""
    by_speaker = segments.groupBy(rec, k).agg(F.sum(F.col("end") - F.col("start")).alias("n"), F.count("*").alias("c"))
    per = by_speaker.groupBy(rec).agg(F.sum("n").alias("kept"), F.sum("c").alias("segments"), F.map_from_entries(F.array_sort(F.collect_list(F.struct(k, "n")))).alias("by_speaker"))
    out = totals.join(per, rec, "left")
    kept = F.coalesce("kept", F.lit(0))
    return out.select(rec, "total", kept.alias("kept"), F.when(F.col("total") > 0, kept / F.col("total")).otherwise(0.0).alias("share"), F.coalesce("segments", F.lit(0)).alias("segments"), "by_speaker")
