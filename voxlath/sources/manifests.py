"""Manifests, shard lists, caches and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "id string, audio_path string, text string, language_id string, duration double, speaker string, recording_id string, local_speaker string, speaker_similarity double"
FAILURE = "recording_id string, stage string, time timestamp, error string"


def read_lines(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """JSON lines; blank lines are skipped, a path that matches nothing gives an empty table."""
    try:
        return spark.read.schema(schema).json(path)
    except Exception as e:  # the analyser's error for a missing path
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def write_lines(rows: DataFrame, path: str, files: int | None = None) -> None:
    (rows.coalesce(files) if files else rows).write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def log_failures(rows: DataFrame, path: str) -> None:
    rows.select("recording_id", "stage", "time", "error").write.mode("append").json(path)


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """Per stage how many recordings went well, were skipped, and failed."""
    kinds = ("ok", "skipped", "failed")
    return outcomes.groupBy("stage").agg(*[F.count_if(F.col("kind") == k).alias(k) for k in kinds])


def cache_state(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Adds state: cached where the last run had the same fingerprint, stale where another, missing, or no_input.

    wanted: (keys, fingerprint, has_input); done: (keys, fingerprint).
    """
    d = done.select(*keys, F.col("fingerprint").alias("__f"), F.lit(True).alias("__d"))
    state = F.when(~F.col("has_input"), "no_input").when(F.col("__d").isNull(), "missing").when(F.col("fingerprint").eqNullSafe(F.col("__f")), "cached").otherwise("stale")
    return wanted.join(d, keys, "left").withColumn("state", state).drop("__f", "__d")


def shard_list(lines: DataFrame, base: str, line: str = "value") -> DataFrame:
    """(tar, label, n, seconds): a shard list with absolute paths; applying it again changes nothing."""
    f = F.split(line, r"\s+")
    return lines.where(F.trim(line) != "").select(absolute(f[0], base).alias("tar"), absolute(f[1], base).alias("label"), f[2].cast("long").alias("n"), f[3].cast("double").alias("seconds"))


def absolute(path: Column, base: str) -> Column:
    """Drive paths become file: addresses, relative ones stand below base, others stay."""
    slashed = F.replace(path, F.lit("\\"), F.lit("/"))
    return F.when(path.rlike(r"^[A-Za-z]:[\\/]"), F.concat(F.lit("file:///"), slashed)).when(path.rlike(r"^(/|[a-z]+:)"), path).otherwise(F.concat(F.lit(base.rstrip("/") + "/"), path))


def data_config(splits: DataFrame) -> DataFrame:
    """(part, entries): the data configuration's train and dev lists; splits without clips are left out.

    splits: (part, language_id, path, repeat, clips); a configuration has a few rows.
    """
    entry = F.struct("language_id", F.array("path").alias("manifest_path"), "repeat")
    return splits.where("clips > 0").groupBy("part").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("entries"))


def checkpoints(paths: DataFrame, path: str = "path") -> DataFrame:
    """checkpoint-<digits> folders with their step, in numeric order."""
    return paths.where(F.col(path).rlike(r"(^|/)checkpoint-\d+$")).withColumn("step", F.regexp_extract(path, r"checkpoint-(\d+)$", 1).cast("long")).orderBy("step")


def hub_snapshot(path: Column) -> Column:
    """struct<id, revision> of a model cache's snapshot path; null for other paths."""
    pattern = r"models--([^/]+)/snapshots/([0-9a-f]+)"
    return F.when(path.rlike(pattern), F.struct(F.replace(F.regexp_extract(path, pattern, 1), F.lit("--"), F.lit("/")).alias("id"), F.regexp_extract(path, pattern, 2).alias("revision")))


def documents(rows: DataFrame, key: str, columns: list[str], out: str = "document") -> DataFrame:
    """(key, document): each row's columns as one JSON object, nulls included, as summaries and reports are kept."""
    return rows.select(key, F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias(out))


def write_documents(rows: DataFrame, path: str, key: str, columns: list[str]) -> None:
    """One JSON document a line, in folders by key."""
    documents(rows, key, columns).write.mode("overwrite").partitionBy(key).text(path)


def speakers_document(registry: DataFrame, local: DataFrame) -> DataFrame:
    """One row: the registry's document, speakers by id and local speakers by the id they have; both are small tables."""
    one = registry.select("speaker", F.struct("seconds", "clips", "recordings", "voice").alias("s")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("speaker", "s")))).alias("speakers"))
    names = local.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("local_speaker", "speaker")))).alias("local_to_global"))
    return one.join(F.broadcast(names)).select(F.to_json(F.struct("speakers", "local_to_global")).alias("document"))  # one row each


class DetectorCache:
    """Detector tables by recording: each has its own folder, which a later run of a recording replaces."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self._spark, self._path = spark, f"{path.rstrip('/')}/{name}"

    def put(self, rows: DataFrame, fingerprint: Column, rec: str = "rec") -> None:
        """Replace the recordings that rows have; others stay."""
        stored = rows.withColumn("fingerprint", fingerprint).withColumn("recording", F.col(rec).cast("string"))
        stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("recording").parquet(self._path)

    def get(self, wanted: DataFrame | None = None, rec: str = "rec") -> DataFrame:
        """Rows of the wanted recordings (rec, fingerprint) whose fingerprint is the stored one; of all without wanted."""
        rows = self._spark.read.parquet(self._path)
        if wanted is not None:
            keys = wanted.select(F.col(rec).cast("string").alias("recording"), "fingerprint").distinct()
            rows = rows.join(keys, ["recording", "fingerprint"], "left_semi")
        return rows.drop("recording", "fingerprint")
