"""Queries over frame tables: detector masks, pauses, clean runs and clips."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import frames as fr
from ..operators import segments as sg
from ..streaming.incremental import sessions
from .fixtures import ENERGY, FRAMES, energy, frames, frames_energy

#: Thresholds of the detectors, and frame counts of the rules, that suit the fixture's density.
SIGNALS = {"other": 0.3, "overlap": 0.5, "local_other": None}
PAD, BLUR_FRAMES, BLUR_STRENGTH = 1, 1, 2.0
PAUSE_DB, MIN_PAUSE = -12.0, 2
MARGIN, MAX_PAUSE, MAX_LEN, SPLIT_PAUSE, MIN_LEN = 0, 4, 20, 2, 2
SPEECH = 0.1

SIG = FRAMES + """,
top2 AS (SELECT rec, t, list_sort(list(p), 'DESC')[2] AS overlap FROM frames GROUP BY rec, t),
sig AS (SELECT f.rec, f.t, f.k, f.p, coalesce(max(p) OVER (PARTITION BY f.rec, f.t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW), 0.0) AS other, overlap
  FROM frames f JOIN top2 ON f.rec = top2.rec AND f.t = top2.t),
masked AS (SELECT *, other > 0.3 OR overlap > 0.5 AS foreign_, greatest(0.0, other / 0.3, overlap / 0.5) AS strength, p > 0.1 AS own FROM sig)
"""

PAUSES = ENERGY + """,
lvl AS (SELECT e.rec, quantile_cont(db, 0.9) AS level FROM energy e JOIN (SELECT DISTINCT rec, t FROM frames WHERE p > 0.1) a ON e.rec = a.rec AND e.t = a.t GROUP BY e.rec),
quiet AS (SELECT e.rec, e.t, coalesce(db < level - 12.0, false) AS quiet FROM energy e LEFT JOIN lvl ON e.rec = lvl.rec),
qrun AS (SELECT *, t - row_number() OVER (PARTITION BY rec, quiet ORDER BY t) AS g FROM quiet),
pauses AS (SELECT rec, t, quiet, quiet AND count(*) OVER (PARTITION BY rec, quiet, g) >= 2 AS barrier FROM qrun)
"""

CLEAN = SIG + "," + PAUSES + """,
base AS (SELECT m.*, barrier, quiet FROM masked m JOIN pauses p ON m.rec = p.rec AND m.t = p.t),
og AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k ORDER BY t) AS g FROM base WHERE foreign_ AND NOT barrier),
outr AS (SELECT rec, k, min(t) AS a, max(t) + 1 AS b, max(t) + 1 - min(t) <= 1 AND max(strength) <= 2.0 AS weak FROM og GROUP BY rec, k, g),
pg AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k ORDER BY t) AS g FROM base WHERE barrier),
pr AS (SELECT rec, k, min(t) AS a, max(t) + 1 AS b FROM pg GROUP BY rec, k, g),
sm AS (SELECT pr.* FROM pr WHERE EXISTS (SELECT 1 FROM outr o WHERE o.rec = pr.rec AND o.k = pr.k AND NOT o.weak AND (o.b = pr.a OR o.a = pr.b))),
cl AS (SELECT o.* FROM outr o WHERE o.weak AND EXISTS (SELECT 1 FROM sm WHERE sm.rec = o.rec AND sm.k = o.k AND (sm.b = o.a OR sm.a = o.b))),
smf AS (SELECT DISTINCT rec, k, unnest(range(a, b)) AS t FROM sm),
clf AS (SELECT DISTINCT rec, k, unnest(range(a, b)) AS t FROM cl),
tr AS (SELECT base.*, smf.t IS NOT NULL AS smear, foreign_ AND clf.t IS NULL AND (smf.t IS NULL OR strength > 2.0) AS trimmed
  FROM base LEFT JOIN smf USING (rec, k, t) LEFT JOIN clf USING (rec, k, t)),
bx AS (SELECT *, sum(CASE WHEN barrier <> pb THEN 1 ELSE 0 END) OVER (PARTITION BY rec, k ORDER BY t) AS bid FROM (SELECT *, lag(barrier) OVER (PARTITION BY rec, k ORDER BY t) AS pb FROM tr)),
un AS (SELECT *, trimmed
    OR bool_or(trimmed AND NOT barrier) OVER (PARTITION BY rec, k, bid ORDER BY t RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)
    OR bool_or(trimmed AND barrier AND NOT smear) OVER (PARTITION BY rec, k ORDER BY t RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS unsafe FROM bx),
cg AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k ORDER BY t) AS g FROM un WHERE NOT unsafe),
runs AS (SELECT rec, k, g, min(t) AS start, max(t) + 1 AS "end" FROM cg GROUP BY rec, k, g),
inrun AS (SELECT cg.rec, cg.k, cg.t, cg.own, cg.quiet, cg.p, r.start AS rs, r."end" AS re FROM cg JOIN runs r ON cg.rec = r.rec AND cg.k = r.k AND cg.g = r.g)
"""


def signals(spark, d) -> DataFrame:
    """Frames with the detectors' signals and masks."""
    second = F.get(F.sort_array(F.collect_list("p").over(Window.partitionBy("rec", "t")), False), F.lit(1))  # as many values as speakers
    out = fr.others_max(frames_energy(spark, d), out="other").withColumn("overlap", second).withColumn("local_other", F.lit(None).cast("double"))
    return out.withColumn("foreign", fr.union_mask(SIGNALS)).withColumn("strength", fr.strength(SIGNALS)).withColumn("own", F.col("p") > SPEECH)


def speech_mask_summary(spark, d):
    f = frames(spark, d).withColumn("own", F.col("p") > 0.5)
    by = f.groupBy("rec", "k").agg(F.count("*").alias("frames"), F.sum(F.col("own").cast("long")).alias("speech"))
    return by.where(F.col("speech") >= 50)


def foreign_others(spark, d):
    return signals(spark, d).where("foreign").select("rec", "t", "k", F.round("other", 6).alias("other"), F.round("overlap", 6).alias("overlap"), F.round("strength", 6).alias("strength"))


def speech_islands(spark, d):
    return fr.islands(frames(spark, d), ["rec", "k"], F.col("p") > 0.3, aggs=[F.round(F.max("p"), 6).alias("peak")])


def dilated_mask(spark, d):
    return fr.dilate(signals(spark, d), ["rec", "k"], "foreign", 3, "wide").groupBy("rec", "k").agg(F.sum(F.col("foreign").cast("long")).alias("n"), F.sum(F.col("wide").cast("long")).alias("n_wide"))


def _paused(spark, d) -> DataFrame:
    return fr.mark_pauses(signals(spark, d), PAUSE_DB, MIN_PAUSE, SPEECH)


def dilated_within_barrier(spark, d):
    return fr.dilate_within(_paused(spark, d), ["rec", "k"], "foreign", "barrier", 2, "wide").where("wide").select("rec", "k", "t")


def speech_level(spark, d):
    return fr.speech_level(frames(spark, d), energy(spark, d), 0.5).select("rec", F.round("level", 6).alias("level"))


def pause_barriers(spark, d):
    return fr.islands(fr.pauses(frames(spark, d), energy(spark, d), PAUSE_DB, MIN_PAUSE, SPEECH), ["rec"], "barrier")


def smear_trim(spark, d):
    out = fr.smear_trim(_paused(spark, d), BLUR_FRAMES, BLUR_STRENGTH)
    return out.groupBy("rec", "k").agg(*[F.sum(F.col(c).cast("long")).alias(f"n_{c}") for c in ("foreign", "trimmed", "smear")])


def _unsafe(spark, d) -> DataFrame:
    return fr.padded_foreign(_paused(spark, d), PAD, BLUR_FRAMES, BLUR_STRENGTH)


def clean_runs(spark, d):
    """Runs without another voice, of at least two frames, with the speaker's share and mean score."""
    runs = fr.islands(_unsafe(spark, d), ["rec", "k"], ~F.col("unsafe"), aggs=[F.sum(F.col("own").cast("long")).alias("own"), F.round(F.avg("p"), 6).alias("mean_p")])
    return runs.where(F.col("end") - F.col("start") >= MIN_LEN)


def clean_run_summary(spark, d):
    runs = fr.islands(_unsafe(spark, d), ["rec", "k"], ~F.col("unsafe"))
    totals = frames(spark, d).groupBy("rec").agg(F.countDistinct("t").alias("total"))
    out = sg.summary(runs.where(F.col("end") - F.col("start") >= MIN_LEN), totals)
    return out.select("rec", "total", "kept", F.round("share", 6).alias("share"), "segments", F.size(F.map_keys(F.coalesce("by_speaker", F.create_map().cast("map<bigint,bigint>")))).cast("long").alias("speakers"))


def _in_runs(spark, d) -> DataFrame:
    """Frames of clean runs with their run's bounds."""
    return fr.in_runs(_unsafe(spark, d), ["rec", "k"], ~F.col("unsafe"))


def speaker_gap_merge(spark, d):
    own = fr.islands(_in_runs(spark, d), ["rec", "k", "run_start", "run_end"], "own")
    return sg.speaker_gap_merge(own, own, MARGIN, MAX_PAUSE, MAX_LEN, SPLIT_PAUSE)


def _chunks(spark, d) -> DataFrame:
    return sg.acoustic_chunks(_in_runs(spark, d).withColumn("left_pause", F.lit(True)).withColumn("right_pause", F.lit(True)), 1, MIN_PAUSE, SPLIT_PAUSE, MAX_LEN)


def acoustic_chunks(spark, d):
    return _chunks(spark, d)


def acoustic_merge(spark, d):
    return sg.acoustic_merge(_chunks(spark, d), 2, MAX_PAUSE, MAX_LEN)


def segment_scores(spark, d):
    out = sg.segment_scores(sg.acoustic_merge(_chunks(spark, d), 2, MAX_PAUSE, MAX_LEN), signals(spark, d), ["other", "overlap"])
    return out.select("rec", "k", "start", "end", *[F.round(c, 6).alias(c) for c in ("max_other", "max_overlap", "mean_p")])


def whole_file_select(spark, d):
    return sg.whole_file(signals(spark, d), F.col("other") > 0.95, 0.5, 10, 30, 100, 719)


def upsample_align(spark, d):
    f = frames(spark, d)
    coarse = fr.max_pool(f.where("t < 700"), ["rec", "k"], "p")
    up = fr.upsample(coarse.withColumnRenamed("p", "q"), f.select("rec", "k", "t"), ["rec", "k"], ["q"])
    return up.where("q > 0").select("rec", "k", "t", F.round("q", 6).alias("q"))


def maxpool_align(spark, d):
    return fr.max_pool(frames(spark, d), ["rec", "k"], "p", 7).where("p > 0").select("rec", "k", "t", F.round("p", 6).alias("p"))


def _windows(spark, d) -> DataFrame:
    """Frames as overlapping windows of 48 frames every 13, the last one right-aligned."""
    f = frames(spark, d)
    starts = f.groupBy("rec").agg(F.explode(fr.window_starts((F.max("t") + 1).cast("int"), 48, 13)).alias("w"))
    cells = starts.select("rec", "w", F.explode(F.sequence(F.lit(0), F.lit(47))).alias("i")).withColumn("t", (F.col("w") + F.col("i")).cast("long"))
    return cells.join(f, ["rec", "t"]).withColumn("weight", fr.hamming(F.col("i"), 48)).withColumn("p", F.col("p") * (1 + F.col("w") % 5) / 5)


def overlap_add(spark, d):
    return fr.overlap_add(_windows(spark, d), ["rec", "k", "t"], ["p"], "weight").where("p > 0").select("rec", "k", "t", F.round("p", 6).alias("p"))


def combine_windows(spark, d):
    w = _windows(spark, d)
    both = fr.combine_windows(w, ["rec", "k", "t"], "p", "max").join(fr.combine_windows(w, ["rec", "k", "t"], "p", "mean").withColumnRenamed("p", "mean"), ["rec", "k", "t"])
    return both.where("p > 0").select("rec", "k", "t", F.round("p", 6).alias("largest"), F.round("mean", 6).alias("mean"))


def ctc_collapse(spark, d):
    out = fr.collapse(frames(spark, d), ["rec"], blank=0)
    return out.select("rec", F.size("labels").cast("long").alias("n"), F.array_join(F.transform("labels", lambda x: x.cast("string")), "").alias("path"))


def peak_envelope(spark, d):
    return fr.peak_envelope(energy(spark, d), ["rec"], "db", 24).select("rec", "t", F.round("envelope", 6).alias("envelope"))


def session_merge(spark, d):
    from .fixtures import table

    e = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    s = sessions(e, "user_id", "ts", "12 hours", [F.count("*").alias("n"), F.min("ts").alias("first"), F.max("ts").alias("last")])
    return s.select("user_id", "n", F.unix_timestamp("first").alias("first_s"), F.unix_timestamp("last").alias("last_s"))


QUERIES = {f.__name__: f for f in (speech_mask_summary, foreign_others, speech_islands, dilated_mask, dilated_within_barrier, speech_level, pause_barriers, smear_trim, clean_runs, clean_run_summary, speaker_gap_merge, acoustic_chunks, acoustic_merge, segment_scores, whole_file_select, upsample_align, maxpool_align, overlap_add, combine_windows, ctc_collapse, peak_envelope, session_merge)}

_CHUNKS = CLEAN + """,
x1 AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k, rs, quiet ORDER BY t) AS g1, t - row_number() OVER (PARTITION BY rec, k, rs, own ORDER BY t) AS g2,
  t - row_number() OVER (PARTITION BY rec, k, rs, (quiet OR NOT own) ORDER BY t) AS g3 FROM inrun),
x2 AS (SELECT *, (quiet AND count(*) OVER (PARTITION BY rec, k, rs, quiet, g1) >= 2) OR (NOT own AND count(*) OVER (PARTITION BY rec, k, rs, own, g2) >= 2)
  OR ((quiet OR NOT own) AND (min(t) OVER (PARTITION BY rec, k, rs, (quiet OR NOT own), g3) = rs OR max(t) OVER (PARTITION BY rec, k, rs, (quiet OR NOT own), g3) + 1 = re)) AS cut FROM x1),
x3 AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k, rs ORDER BY t) AS g FROM x2 WHERE NOT cut),
chunks AS (SELECT rec, k, rs AS run_start, re AS run_end, min(t) AS start, max(t) + 1 AS "end" FROM x3 GROUP BY rec, k, rs, re, g HAVING max(t) + 1 - min(t) <= 20 AND avg(own::INT) >= 0.5),
cn AS (SELECT *, row_number() OVER (PARTITION BY rec, k, run_start ORDER BY start) AS i FROM chunks),
fold AS (SELECT rec, k, run_start, run_end, i, start AS s, "end" AS e, 1 AS grp FROM cn WHERE i = 1
  UNION ALL SELECT c.rec, c.k, c.run_start, c.run_end, c.i, CASE WHEN c.start - f.e <= 4 AND c."end" - f.s <= 20 THEN f.s ELSE c.start END, c."end",
    CASE WHEN c.start - f.e <= 4 AND c."end" - f.s <= 20 THEN f.grp ELSE f.grp + 1 END FROM fold f JOIN cn c ON c.rec = f.rec AND c.k = f.k AND c.run_start = f.run_start AND c.i = f.i + 1),
mg AS (SELECT rec, k, run_start, run_end, grp, min(s) AS s, max(e) AS e FROM fold GROUP BY ALL),
mw AS (SELECT *, lag(e) OVER w AS pe, lead(s) OVER w AS ns FROM mg WINDOW w AS (PARTITION BY rec, k, run_start ORDER BY s)),
merged AS (SELECT rec, k, run_start, s AS speech_start, e AS speech_end, s - least(2, CASE WHEN pe IS NOT NULL THEN (s - pe) // 2 ELSE s - run_start END) AS start,
  e + least(2, CASE WHEN ns IS NOT NULL THEN (ns - e) // 2 ELSE run_end - e END) AS "end" FROM mw)
"""

_WINDOWS = FRAMES + """,
ws AS (SELECT r.range AS rec, w.range * 13 AS w FROM range(8) r, range(52) w WHERE w.range * 13 <= 672 UNION SELECT range, 672 FROM range(8)),
wc AS (SELECT ws.rec, f.k, ws.w, i.range AS i, f.t, f.p * (1 + ws.w % 5) / 5 AS p, 0.54 - 0.46 * cos(2 * pi() * i.range / 47) + 1e-3 AS wt FROM ws, range(48) i, frames f WHERE f.rec = ws.rec AND f.t = ws.w + i.range)
"""

ORACLES = {
    "speech_mask_summary": f"WITH {FRAMES} SELECT rec, k, count(*) AS frames, sum((p > 0.5)::INT)::BIGINT AS speech FROM frames GROUP BY rec, k HAVING sum((p > 0.5)::INT) >= 50",
    "foreign_others": f"WITH {SIG} SELECT rec, t, k, round(other, 6) AS other, round(overlap, 6) AS overlap, round(strength, 6) AS strength FROM masked WHERE foreign_",
    "speech_islands": f'WITH {FRAMES}, g AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k ORDER BY t) AS g FROM frames WHERE p > 0.3) SELECT rec, k, min(t) AS start, max(t) + 1 AS "end", round(max(p), 6) AS peak FROM g GROUP BY rec, k, g',
    "dilated_mask": f"WITH {SIG}, w AS (SELECT *, bool_or(foreign_) OVER (PARTITION BY rec, k ORDER BY t ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS wide FROM masked) SELECT rec, k, sum(foreign_::INT)::BIGINT AS n, sum(wide::INT)::BIGINT AS n_wide FROM w GROUP BY rec, k",
    "dilated_within_barrier": f"""WITH {SIG}, {PAUSES}, b AS (SELECT m.*, barrier, lag(barrier) OVER (PARTITION BY m.rec, k ORDER BY m.t) AS pb FROM masked m JOIN pauses p ON m.rec = p.rec AND m.t = p.t),
      c AS (SELECT *, sum(CASE WHEN barrier <> pb THEN 1 ELSE 0 END) OVER (PARTITION BY rec, k ORDER BY t) AS bid FROM b)
      SELECT rec, k, t FROM (SELECT *, bool_or(foreign_ AND NOT barrier) OVER (PARTITION BY rec, k, bid ORDER BY t ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS wide FROM c) WHERE wide""",
    "speech_level": f"WITH {FRAMES}, {ENERGY} SELECT e.rec, round(quantile_cont(db, 0.9), 6) AS level FROM energy e JOIN (SELECT DISTINCT rec, t FROM frames WHERE p > 0.5) a ON e.rec = a.rec AND e.t = a.t GROUP BY e.rec",
    "pause_barriers": f'WITH {FRAMES}, {PAUSES}, g AS (SELECT *, t - row_number() OVER (PARTITION BY rec ORDER BY t) AS r FROM pauses WHERE barrier) SELECT rec, min(t) AS start, max(t) + 1 AS "end" FROM g GROUP BY rec, r',
    "smear_trim": f"WITH {CLEAN} SELECT rec, k, sum(foreign_::INT)::BIGINT AS n_foreign, sum(trimmed::INT)::BIGINT AS n_trimmed, sum(smear::INT)::BIGINT AS n_smear FROM tr GROUP BY rec, k",
    "clean_runs": f'WITH {CLEAN} SELECT rec, k, min(t) AS start, max(t) + 1 AS "end", sum(own::INT)::BIGINT AS own, round(avg(p), 6) AS mean_p FROM cg GROUP BY rec, k, g HAVING max(t) + 1 - min(t) >= 2',
    "clean_run_summary": f"""WITH {CLEAN}, r AS (SELECT rec, k, "end" - start AS n FROM runs WHERE "end" - start >= 2)
      SELECT a.rec, 720::BIGINT AS total, coalesce(kept, 0)::BIGINT AS kept, round(coalesce(kept, 0) / 720, 6) AS share, coalesce(c, 0)::BIGINT AS segments, coalesce(s, 0)::BIGINT AS speakers
      FROM (SELECT DISTINCT rec FROM frames) a LEFT JOIN (SELECT rec, sum(n) AS kept, count(*) AS c, count(DISTINCT k) AS s FROM r GROUP BY rec) b ON a.rec = b.rec""",
    "speaker_gap_merge": f"""WITH RECURSIVE {CLEAN}, og2 AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k, rs ORDER BY t) AS g FROM inrun WHERE own),
      own_i AS (SELECT rec, k, rs, min(t) AS start, max(t) + 1 AS e FROM og2 GROUP BY rec, k, rs, g), n AS (SELECT *, row_number() OVER (PARTITION BY rec, k, rs ORDER BY start) AS i FROM own_i),
      f AS (SELECT rec, k, rs, i, start AS s, e, 1 AS grp FROM n WHERE i = 1 UNION ALL
        SELECT n.rec, n.k, n.rs, n.i, CASE WHEN n.start - f.e > 4 OR (n.e - f.s > 20 AND n.start - f.e >= 2) THEN n.start ELSE f.s END, n.e,
          CASE WHEN n.start - f.e > 4 OR (n.e - f.s > 20 AND n.start - f.e >= 2) THEN f.grp + 1 ELSE f.grp END FROM f JOIN n ON n.rec = f.rec AND n.k = f.k AND n.rs = f.rs AND n.i = f.i + 1)
      SELECT rec, k, rs AS run_start, min(s) AS start, max(e) AS "end" FROM f GROUP BY rec, k, rs, grp""",
    "acoustic_chunks": f'WITH RECURSIVE {_CHUNKS} SELECT rec, k, run_start, run_end, start, "end" FROM chunks',
    "acoustic_merge": f'WITH RECURSIVE {_CHUNKS} SELECT rec, k, run_start, speech_start, speech_end, start, "end" FROM merged',
    "segment_scores": f'WITH RECURSIVE {_CHUNKS} SELECT m.rec, m.k, start, "end", round(max(other), 6) AS max_other, round(max(overlap), 6) AS max_overlap, round(avg(p) FILTER (t >= speech_start AND t < speech_end), 6) AS mean_p FROM merged m JOIN sig ON sig.rec = m.rec AND sig.k = m.k AND t >= start AND t < "end" GROUP BY m.rec, m.k, start, "end", speech_start, speech_end',
    "whole_file_select": f"""WITH {SIG}, sp AS (SELECT rec, k, sum((p > 0.5)::INT) AS n, min(t) FILTER (p > 0.5) AS a, max(t) FILTER (p > 0.5) AS b FROM sig GROUP BY rec, k),
      m AS (SELECT rec, k, n, greatest(0, a - 10) AS start, least(720, b + 1 + 10) AS e FROM (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY n DESC, k) AS r FROM sp) WHERE r = 1)
      SELECT rec, k, start, e AS "end", CASE WHEN n = 0 THEN 'no speech' WHEN e - start < 100 THEN 'too short' WHEN e - start > 719 THEN 'too long'
        WHEN EXISTS (SELECT 1 FROM sig WHERE sig.rec = m.rec AND sig.k = m.k AND other > 0.95 AND t >= start - 30 AND t < e + 30) THEN 'second voice' ELSE 'kept' END AS reason FROM m""",
    "upsample_align": f"WITH {FRAMES}, c AS (SELECT rec, k, t // 2 AS t, max(p) AS q FROM frames WHERE t < 700 GROUP BY 1, 2, 3) SELECT f.rec, f.k, f.t, round(q, 6) AS q FROM frames f JOIN c ON c.rec = f.rec AND c.k = f.k AND c.t = least(f.t // 2, 349) WHERE q > 0",
    "maxpool_align": f"WITH {FRAMES} SELECT rec, k, t // 7 AS t, round(max(p), 6) AS p FROM frames GROUP BY rec, k, t // 7 HAVING max(p) > 0",
    "overlap_add": f"WITH {_WINDOWS} SELECT rec, k, t, round(sum(p * wt) / greatest(sum(wt), 1e-8), 6) AS p FROM wc GROUP BY rec, k, t HAVING sum(p) > 0",
    "combine_windows": f"WITH {_WINDOWS} SELECT rec, k, t, round(max(p), 6) AS largest, round(avg(p), 6) AS mean FROM wc GROUP BY rec, k, t HAVING max(p) > 0",
    "ctc_collapse": f"""WITH {FRAMES}, b AS (SELECT rec, t, k FROM (SELECT *, row_number() OVER (PARTITION BY rec, t ORDER BY p DESC, k) AS r FROM frames) WHERE r = 1), l AS (SELECT *, lag(k) OVER (PARTITION BY rec ORDER BY t) AS pk FROM b)
      SELECT rec, count(*) AS n, string_agg(k::VARCHAR, '' ORDER BY t) AS path FROM l WHERE k <> 0 AND (pk IS NULL OR k <> pk) GROUP BY rec""",
    "peak_envelope": f"""WITH {FRAMES}, {ENERGY}, pk AS (SELECT rec, t // 24 AS t, max(abs(db)) AS peak FROM energy GROUP BY 1, 2), tp AS (SELECT rec, quantile_cont(peak, 0.999) AS top FROM pk GROUP BY rec)
      SELECT pk.rec, t, round(sqrt(least(1.0, greatest(0.0, peak / greatest(top, 1e-9)))), 6) AS envelope FROM pk JOIN tp ON pk.rec = tp.rec""",
    "session_merge": """WITH o AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
      s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM o) SELECT user_id, count(*) AS n, floor(epoch(min(ts)))::BIGINT AS first_s, floor(epoch(max(ts)))::BIGINT AS last_s FROM s GROUP BY user_id, g""",
}
