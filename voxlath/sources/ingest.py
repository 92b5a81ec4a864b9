"""Input folders as a snapshot table, and what a new snapshot changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import safe_id

#: File kinds, the transcript kinds in order of preference.
AUDIO = ("wav", "flac", "mp3", "m4a", "ogg", "opus", "webm", "aac", "mp4", "mkv")
TRANSCRIPTS = ("json3", "srt", "vtt", "txt")


def listing(spark: SparkSession, path: str, recursive: bool = True) -> DataFrame:
    """(dir, stem, ext, path, size, modified): files without their content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    return files.select(
        F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("dir"), F.regexp_extract(name, r"^(.*)\.[^.]+$", 1).alias("stem"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("ext"), "path", "size", "modified"
    )


def recordings(files: DataFrame) -> DataFrame:
    """(id, dir, stem, audio, size, modified, transcript, kind, sidecar): audio with its preferred transcript and metadata file."""
    audio = files.where(F.col("ext").isin(*AUDIO)).select("dir", "stem", F.col("path").alias("audio"), "size", "modified")
    rank = F.array_position(F.array(*[F.lit(t) for t in TRANSCRIPTS]), F.col("ext"))
    best = files.where(F.col("ext").isin(*TRANSCRIPTS)).groupBy("dir", "stem").agg(F.min_by(F.struct("path", "ext"), rank).alias("t"))
    side = files.where("ext = 'json'").select("dir", "stem", F.col("path").alias("sidecar"))
    out = audio.join(best, ["dir", "stem"], "left").join(side, ["dir", "stem"], "left")
    return out.select(safe_id(F.col("stem")).alias("id"), "dir", "stem", "audio", "size", "modified", F.col("t.path").alias("transcript"), F.col("t.ext").alias("kind"), "sidecar")


def orphans(rows: DataFrame) -> DataFrame:
    return rows.where("transcript is null")


def duplicates(rows: DataFrame) -> DataFrame:
    return rows.groupBy("id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("audio")).alias("audio")).where("n > 1")  # the files of one id


def require_unique(rows: DataFrame) -> DataFrame:
    """The rows, with an error at run time where an id comes twice."""
    n = F.count("*").over(Window.partitionBy("id"))
    return rows.withColumn("id", F.when(n == 1, F.col("id")).otherwise(F.raise_error(F.concat(F.lit("duplicate id: "), "id")).cast("string")))


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, fingerprint: Column | list[str]) -> DataFrame:
    """(key, change): added, updated, unchanged or not_in_input, by null-safe comparison of the fingerprint's columns."""
    columns = fingerprint
    a = old.select(F.col(key).alias("__o"), F.struct(*columns).alias("__a"))
    b = new.select(F.col(key).alias("__n"), F.struct(*columns).alias("__b"))
    both = a.join(b, F.col("__o") == F.col("__n"), "full_outer")
    change = F.when(F.col("__o").isNull(), "added").when(F.col("__n").isNull(), "not_in_input").when(F.col("__a").eqNullSafe(F.col("__b")), "unchanged").otherwise("updated")
    return both.select(F.coalesce("__o", "__n").alias(key), change.alias("change"))


def invalidation(old: DataFrame, new: DataFrame) -> DataFrame:
    """(id, stage): the first stage that must run again: audio changes reset everything, transcript changes what uses words.

    old, new: (id, size, modified, transcript_sha1).  A file that only moved keeps its results.
    """
    a = old.select("id", F.struct("size", "modified").alias("__f"), F.col("transcript_sha1").alias("__t"))
    b = new.select("id", F.struct("size", "modified").alias("__g"), F.col("transcript_sha1").alias("__u"))
    stage = F.when(F.col("__f").isNull() | ~F.col("__f").eqNullSafe(F.col("__g")), "detect").when(~F.col("__t").eqNullSafe(F.col("__u")), "select").otherwise("none")
    return b.join(a, "id", "left").select("id", stage.alias("stage"))


def sidecar_metadata(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Adds meta: the object of the metadata file, as a map of strings, empty where there is none; an error at run time for one that holds no object.

    files: (path, text), the metadata files' whole texts.
    """
    texts = files.select(F.col("path").alias("sidecar"), F.col("text").alias("__json"))
    parsed = F.from_json("__json", "map<string,string>")
    bad = F.raise_error(F.concat("sidecar", F.lit(" must hold a JSON object"))).cast("map<string,string>")
    is_object = F.col("__json").rlike(r"^\s*\{") & F.try_parse_json("__json").isNotNull()
    meta = F.when(F.col("__json").isNull(), F.expr("cast(map() as map<string,string>)")).when(is_object, parsed).otherwise(bad)
    return rows.join(texts, "sidecar", "left").withColumn("meta", meta).drop("__json")
