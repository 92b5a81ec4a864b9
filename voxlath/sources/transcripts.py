"""Transcripts as word tables: timed-text JSON, SRT and WebVTT cues, plain text.

Files come as one row each (rec, text); every parser gives (rec, seq, start, limit, text) rows,
and word_times the words' ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip_tags, timestamp_seconds

TIMED_TEXT = "struct<events: array<struct<tStartMs: bigint, dDurationMs: bigint, segs: array<struct<utf8: string, tOffsetMs: bigint>>>>>"
MAX_WORD, MIN_WORD = 1.0, 0.05
_TIME = r"(?:\d+:)?\d{1,2}:\d{2}[.,]\d{3}"
_CUE = rf"({_TIME})\s*-->\s*({_TIME})"


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, text): whole files, without a byte order mark."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return files.select("path", F.regexp_replace("value", "^﻿", "").alias("text"))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def timed_text_words(files: DataFrame) -> DataFrame:
    """Words of timed-text JSON; events without segments give none, missing offsets and durations are 0."""
    doc = files.select("rec", F.from_json("text", TIMED_TEXT).alias("j")).select("rec", F.posexplode("j.events").alias("e", "event"))
    segs = doc.select("rec", "e", F.col("event.tStartMs").alias("t0"), F.coalesce("event.dDurationMs", F.lit(0)).alias("d"), F.posexplode("event.segs").alias("s", "seg"))
    words = segs.select(
        "rec", "e", "s", ((F.col("t0") + F.coalesce("seg.tOffsetMs", F.lit(0))) / 1000).alias("start"), ((F.col("t0") + F.col("d")) / 1000).alias("limit"),
        F.posexplode(_words(F.replace(F.coalesce("seg.utf8", F.lit("")), F.lit(">>"), F.lit("")))).alias("w", "text"),
    )
    return words.select("rec", F.struct("e", "s", "w").alias("seq"), "start", "limit", "text")


def cues(files: DataFrame) -> DataFrame:
    """(rec, i, start, end, text): cues of SRT or WebVTT text.

    Markup goes; a line that the cue before holds too is dropped, so that rolling captions count
    once; cues that lose all lines or don't last are left out but still count as the cue before.
    """
    blocks = files.select("rec", F.posexplode(F.split("text", r"\r?\n\s*\r?\n")).alias("i", "block"))
    lines = blocks.select("rec", "i", F.split(F.trim(F.regexp_replace("block", r"\r", "")), "\n").alias("lines"))
    at = F.array_position(F.transform("lines", lambda x: x.rlike(_CUE)), F.lit(True))
    head = lines.withColumn("at", at).where("at > 0").withColumn("head", F.element_at("lines", F.col("at").cast("int")))
    body = F.filter(F.transform(F.slice("lines", F.col("at").cast("int") + 1, F.size("lines")), lambda x: F.trim(strip_tags(x))), lambda x: x != "")
    own = head.select("rec", "i", timestamp_seconds(F.regexp_extract("head", _CUE, 1)).alias("start"), timestamp_seconds(F.regexp_extract("head", _CUE, 2)).alias("end"), body.alias("body"))
    return rolling_dedupe(own).where((F.size("new") > 0) & (F.col("end") > F.col("start"))).select("rec", "i", "start", "end", F.array_join("new", " ").alias("text"))


def rolling_dedupe(rows: DataFrame, rec: str = "rec", order: str = "i", body: str = "body") -> DataFrame:
    """Adds new: the lines that the last row before with any line doesn't hold."""
    w = Window.partitionBy(rec).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.last_value(F.when(F.size(body) > 0, F.col(body)), F.lit(True)).over(w), F.array().cast("array<string>"))
    return rows.withColumn("__before", before).withColumn("new", F.filter(body, lambda x: ~F.array_contains("__before", x))).drop("__before")


def cue_words(rows: DataFrame) -> DataFrame:
    """Words of cues, which share a cue's time by their lengths plus one."""
    words = rows.select("rec", "i", "start", F.col("end").alias("limit"), F.posexplode(_words(F.col("text"))).alias("w", "text"))
    size = F.length("text") + 1
    whole = Window.partitionBy("rec", "i")
    before = F.coalesce(F.sum(size).over(whole.orderBy("w").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    start = F.col("start") + (F.col("limit") - F.col("start")) * before / F.sum(size).over(whole)
    return words.withColumn("__s", start).select("rec", F.struct("i", "w").alias("seq"), F.col("__s").alias("start"), "limit", "text")


def plain_text(files: DataFrame) -> DataFrame:
    """(rec, text): whole text with single spaces; it has no times."""
    return files.select("rec", F.array_join(_words(F.col("text")), " ").alias("text"))


def word_times(words: DataFrame) -> DataFrame:
    """Adds end: the next word's start, the limit or a second after the start, whichever is first, at least 0.05 s on."""
    following = F.lead("start").over(Window.partitionBy("rec").orderBy("start", "seq"))
    end = F.least(F.coalesce(following, F.col("limit")), F.col("limit"), F.col("start") + MAX_WORD)
    return words.withColumn("end", F.greatest(end, F.col("start") + MIN_WORD))
