"""Views of the star-schema tables that play the roles of the engine's inputs, for Spark and for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDINGS, HOURS, KINDS = 8, 720, ("click", "error", "purchase", "signup", "view")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("event_type")) - 1
    hour = F.expr("timestampdiff(HOUR, TIMESTAMP_NTZ'2024-01-01 00:00:00', cast(ts as timestamp_ntz))")
    return table(spark, sf_dir, "events").select((F.col("user_id") % RECORDINGS).alias("rec"), hour.cast("long").alias("t"), kind.cast("long").alias("k"), "value")


def _spine(spark: SparkSession, speakers: bool = True) -> DataFrame:
    out = spark.range(RECORDINGS * HOURS * (len(KINDS) if speakers else 1))
    if not speakers:
        return out.select(F.floor(F.col("id") / HOURS).alias("rec"), (F.col("id") % HOURS).alias("t"))
    n = len(KINDS)
    return out.select(F.floor(F.col("id") / (HOURS * n)).alias("rec"), F.floor(F.col("id") / n % HOURS).alias("t"), (F.col("id") % n).alias("k"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec, t, k, p), dense: detector frames."""
    p = _events(spark, sf_dir).groupBy("rec", "t", "k").agg(F.least(F.lit(1.0), F.max("value") / 100).alias("p"))
    return _spine(spark).join(p, ["rec", "t", "k"], "left").select("rec", "t", "k", F.coalesce("p", F.lit(0.0)).alias("p"))


def energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec, t, db), dense."""
    db = _events(spark, sf_dir).groupBy("rec", "t").agg((10 * F.log10(F.sum(F.col("value") * F.col("value")) / F.count("*") + F.lit(1e-10))).alias("db"))
    return _spine(spark, False).join(db, ["rec", "t"], "left").select("rec", "t", F.coalesce("db", F.lit(-100.0)).alias("db"))


def frames_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(rec, t, k, p, db): both in one table, dealt by recording, from one pass over the events."""
    best = F.array(*[F.max(F.when(F.col("k") == k, F.col("value"))) for k in range(len(KINDS))]).alias("best")
    db = (10 * F.log10(F.sum(F.col("value") * F.col("value")) / F.count("*") + F.lit(1e-10))).alias("db")
    heard = _events(spark, sf_dir).groupBy("rec", "t").agg(best, db)
    ks = F.posexplode(F.coalesce("best", F.array_repeat(F.lit(None).cast("double"), len(KINDS)))).alias("k", "value")
    out = _spine(spark, False).join(heard, ["rec", "t"], "left").select("rec", "t", F.coalesce("db", F.lit(-100.0)).alias("db"), ks)
    return out.select("rec", "t", F.col("k").cast("long").alias("k"), F.when(F.col("value").isNull(), 0.0).otherwise(F.least(F.lit(1.0), F.col("value") / 100)).alias("p"), "db").repartition("rec")


FRAMES = """
ev AS (SELECT user_id % 8 AS rec, date_diff('hour', TIMESTAMP '2024-01-01', ts) AS t, list_position(['click','error','purchase','signup','view'], event_type) - 1 AS k, value FROM events),
spine AS (SELECT r.range AS rec, h.range AS t, s.range AS k FROM range(8) r, range(720) h, range(5) s),
cells AS (SELECT rec, t, k, least(1.0::DOUBLE, max(value) / 100) AS p FROM ev GROUP BY rec, t, k),
frames AS (SELECT spine.rec, spine.t, spine.k::BIGINT AS k, coalesce(p, 0.0)::DOUBLE AS p FROM spine LEFT JOIN cells ON spine.rec = cells.rec AND spine.t = cells.t AND spine.k = cells.k)
"""

ENERGY = """
en AS (SELECT rec, t, 10 * log10(sum(value * value) / count(*) + 1e-10) AS db FROM ev GROUP BY rec, t),
energy AS (SELECT s.rec, s.t, coalesce(db, -100.0)::DOUBLE AS db FROM (SELECT DISTINCT rec, t FROM spine) s LEFT JOIN en ON s.rec = en.rec AND s.t = en.t)
"""


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, speaker, recording, duration, text): manifest rows."""
    parts = [F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")] + [F.col("l_quantity").cast("int").cast("string")]
    li, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    text = F.when((F.col("l_returnflag") == "N") & (F.col("l_linenumber") == 1), "").otherwise(F.col("p_name"))
    return li.join(part, F.col("l_partkey") == F.col("p_partkey"), "left").select(
        F.md5(F.concat_ws("-", *parts)).alias("id"), F.col("l_suppkey").alias("speaker"), (F.col("l_orderkey") % 40).alias("recording"), F.col("l_quantity").alias("duration"), text.alias("text")
    )


CLIPS = """
clips AS (SELECT md5(concat_ws('-', l_orderkey::VARCHAR, l_partkey::VARCHAR, l_suppkey::VARCHAR, l_linenumber::VARCHAR, l_quantity::INT::VARCHAR)) AS id,
  l_suppkey AS speaker, l_orderkey % 40 AS recording, l_quantity AS duration, CASE WHEN l_returnflag = 'N' AND l_linenumber = 1 THEN '' ELSE p_name END AS text
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)
"""


def clip_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, recording, local_speaker, duration, f0, embedding)."""
    rec = (F.col("vec_id") % 25).alias("recording")
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), rec, F.concat_ws("_", (F.col("vec_id") % 25).cast("string"), F.col("label").cast("string")).alias("local_speaker"),
        (1 + F.col("vec_id") % 10).cast("double").alias("duration"), F.when(F.col("vec_id") % 7 == 0, F.lit(float("nan"))).otherwise(80.0 + F.col("vec_id") % 150).alias("f0"),
        F.transform("embedding", lambda x: x.cast("double")).alias("embedding"),
    )


EMBEDDINGS = """
emb AS (SELECT vec_id AS id, vec_id % 25 AS recording, concat_ws('_', (vec_id % 25)::VARCHAR, label::VARCHAR) AS local_speaker, (1 + vec_id % 10)::DOUBLE AS duration,
  CASE WHEN vec_id % 7 = 0 THEN NULL ELSE (80.0 + vec_id % 150)::DOUBLE END AS f0, embedding::DOUBLE[] AS embedding FROM embeddings)
"""


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(model, item, cer, sim, seen, voice): one row per model and item, the newest."""
    e = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("model"), F.col("user_id").alias("item")).agg(F.max_by("value", "event_id").alias("value"))
    voice = F.when(F.col("item") % 3 == 0, "female").when(F.col("item") % 3 == 1, "male").otherwise("unknown")
    return e.select("model", "item", (F.col("value") / 500).alias("cer"), (1 - F.col("value") / 500).alias("sim"), (F.col("item") % 2 == 0).alias("seen"), voice.alias("voice"))


RESULTS = """
results AS (SELECT model, item, value / 500 AS cer, 1 - value / 500 AS sim, item % 2 = 0 AS seen, CASE item % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'unknown' END AS voice
  FROM (SELECT event_type AS model, user_id AS item, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2))
"""


def rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(round_id, blind, slots array<struct<slot, model>>, vote): blind rounds; vote is a slot, 'tie' or null."""
    e = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 3).alias("round_id"), F.array(F.lit("A"), F.lit("B"), F.lit("C"))[(F.col("event_id") % 3).cast("int")].alias("slot"), F.col("event_type").alias("model"), "value")
    g = e.groupBy("round_id").agg(F.array_sort(F.collect_list(F.struct("slot", "model"))).alias("slots"), F.max_by("slot", F.struct("value", "slot")).alias("best"), F.sort_array(F.collect_list("value"), False).alias("v"))
    tie = F.coalesce(F.get("v", F.lit(0)) - F.get("v", F.lit(1)) < 1.0, F.lit(False))
    return g.select("round_id", (F.col("round_id") % 4 != 3).alias("blind"), "slots", F.when(F.col("round_id") % 5 == 4, None).when(tie, "tie").otherwise(F.col("best")).alias("vote"))


ROUNDS = """
re AS (SELECT event_id // 3 AS round_id, ['A','B','C'][event_id % 3 + 1] AS slot, event_type AS model, value FROM events),
rg AS (SELECT round_id, arg_max(slot, {'v': value, 's': slot}) AS best, list_sort(list(value), 'DESC') AS v FROM re GROUP BY 1),
rounds AS (SELECT round_id, round_id % 4 <> 3 AS blind, CASE WHEN round_id % 5 = 4 THEN NULL WHEN coalesce(v[1] - v[2] < 1.0, false) THEN 'tie' ELSE best END AS vote FROM rg)
"""
