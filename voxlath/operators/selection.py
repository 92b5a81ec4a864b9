"""From frames and words to clips: the whole selection of a recording's segments.

Every step is a window or an ordered fold within (recording, speaker), so frames that are dealt by
recording are never dealt again; only the join with the words is by time bins.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import frames as fr
from . import intervals as iv
from . import segments as sg

KEYS = ["rec", "k"]


@dataclass(frozen=True)
class Rules:
    """Thresholds, and lengths in frames; hop is a frame's seconds."""

    signals: Mapping[str, float | None] = field(default_factory=dict)
    mode: str = "acoustic"
    speech: float = 0.5
    pad: int = 30
    blur_frames: int = 8
    blur_strength: float = 2.0
    pause_db: float = -12.0
    min_pause: int = 10
    margin: int = 10
    max_pause: int = 60
    max_len: int = 1500
    split_pause: int = 20
    min_len: int = 100
    min_speech: int = 100
    min_words: int = 0
    word_bin: float = 8.0
    hop: float = 0.01


def spoken_enough(frames: DataFrame, own: Column | str, least: int, keys: list[str] = KEYS) -> DataFrame:
    """Frames of speakers with at least `least` frames of speech."""
    own = F.expr(own) if isinstance(own, str) else own
    n = F.sum(own.cast("long")).over(Window.partitionBy(*keys))
    return frames.withColumn("__n", n).where(F.col("__n") >= least).drop("__n")


def beside(frames: DataFrame, flag: str, before: str, after: str, keys: list[str] = KEYS) -> DataFrame:
    """Adds whether the frame before, and the one after, has the flag; none at the recording's ends."""
    w = Window.partitionBy(*keys).orderBy("t")
    at = lambda f, step: F.coalesce(f(flag).over(w) & (f("t").over(w) == F.col("t") + step), F.lit(False))
    return frames.withColumn(before, at(F.lag, -1)).withColumn(after, at(F.lead, 1))


def clean_frames(frames: DataFrame, rules: Rules, keys: list[str] = KEYS) -> DataFrame:
    """Frames of runs without another voice, with run_start, run_end, own, quiet, left_pause and right_pause.

    frames: dense (rec, t, k, p, db) and the signals.  In speaker_gap mode there are no pauses: the
    foreign mask is widened everywhere, and db isn't read.
    """
    if rules.mode not in ("acoustic", "speaker_gap"):
        raise ValueError(f"unknown mode {rules.mode!r}")
    own = F.col("p") > rules.speech
    rows = frames.withColumn("own", own).withColumn("foreign", fr.union_mask(rules.signals)).withColumn("strength", fr.strength(rules.signals))
    if rules.mode == "acoustic":
        rows = fr.mark_pauses(rows, rules.pause_db, rules.min_pause, rules.speech)
        rows = fr.padded_foreign(spoken_enough(rows, "own", rules.min_speech, keys), rules.pad, rules.blur_frames, rules.blur_strength, keys)
    else:
        rows = rows.withColumn("quiet", F.lit(False)).withColumn("barrier", F.lit(False))
        rows = fr.dilate(spoken_enough(rows, "own", rules.min_speech, keys), keys, "foreign", rules.pad, "unsafe")
    rows = fr.in_runs(beside(rows, "barrier", "__before", "__after", keys), keys, ~F.col("unsafe"))
    run = Window.partitionBy(*keys, "run_start")
    left = F.max(F.col("__before") & (F.col("t") == F.col("run_start"))).over(run)
    right = F.max(F.col("__after") & (F.col("t") == F.col("run_end") - 1)).over(run)
    return rows.withColumn("left_pause", left).withColumn("right_pause", right).drop("__before", "__after")


def gap_cuts(clean: DataFrame, rules: Rules, keys: list[str] = KEYS) -> DataFrame:
    """(keys, run_start, speech_start, speech_end, start, end): clips cut at gaps in the speaker's own activity.

    Groups that are too long are halved at their longest gap until they fit, and go where they have none.
    """
    run = [*keys, "run_start"]
    own = fr.islands(clean, [*run, "run_end"], "own")
    groups = sg.speaker_gap_merge(own, own, rules.margin, rules.max_pause, rules.max_len, rules.split_pause, keys)
    gaps = fr.islands(clean, run, ~F.col("own")).groupBy(*run).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gaps"))  # the gaps of one run
    none = F.expr("cast(array() as array<struct<start: bigint, end: bigint>>)")
    parts = sg.split_long_spans(groups.join(gaps, run, "left").withColumn("gaps", F.coalesce("gaps", none)), run, rules.max_len, rules.split_pause)
    return parts.select(*run, F.col("start").alias("speech_start"), F.col("end").alias("speech_end"), (F.col("start") - rules.margin).alias("start"), (F.col("end") + rules.margin).alias("end"))


def acoustic_cuts(clean: DataFrame, rules: Rules, keys: list[str] = KEYS) -> DataFrame:
    """The same for clips cut at acoustic pauses or gaps."""
    chunks = sg.acoustic_chunks(clean, rules.margin, rules.min_pause, rules.split_pause, rules.max_len, keys)
    return sg.acoustic_merge(chunks, rules.margin, rules.max_pause, rules.max_len, keys)


def rounded(rows: DataFrame, digits: int = 3) -> DataFrame:
    """Every floating column rounded; others as they are."""
    return rows.select(*[F.round(f.name, digits).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name) for f in rows.schema.fields])


def select_segments(frames: DataFrame, rules: Rules, words: DataFrame | None = None, keys: list[str] = KEYS) -> DataFrame:
    """(keys, start, end, duration in seconds, largest signals, mean_p and, with words, text, num_words, cut_words).

    frames as for clean_frames; words: (rec, start, end, text) in seconds.  Clips shorter than
    min_len, or with fewer words than min_words, are left out.
    """
    clean = clean_frames(frames, rules, keys)
    cuts = (acoustic_cuts if rules.mode == "acoustic" else gap_cuts)(clean, rules, keys).where(F.col("end") - F.col("start") >= rules.min_len)
    scored = sg.segment_scores(cuts, frames, list(rules.signals), keys)
    names = [f"max_{s}" for s in rules.signals]
    out = scored.select(*keys, (F.col("start") * rules.hop).alias("start"), (F.col("end") * rules.hop).alias("end"), ((F.col("end") - F.col("start")) * rules.hop).alias("duration"), *names, "mean_p")
    if words is None:
        return out
    bounds = out.select("rec", F.col("start").alias("seg_start"), F.col("end").alias("seg_end")).distinct()
    said = iv.words_in_segments(words, bounds, ["rec"], rules.word_bin).withColumnsRenamed({"seg_start": "start", "seg_end": "end"})
    return out.join(said, ["rec", "start", "end"]).where(F.col("num_words") >= rules.min_words).select(*keys, "start", "end", "duration", *names, "mean_p", "text", "num_words", "cut_words")


def in_order(segments: DataFrame) -> DataFrame:
    """By recording and start; segments that start together by speaker."""
    return segments.orderBy("rec", "start", "k")
