"""Queries of the segment selection, the overlap benchmark, and what viewer, studio and reports show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..operators import evaluation as ev
from ..operators import overlap as ov
from ..operators import selection as sel
from ..operators import views as vw
from .fixtures import CLIPS, ENERGY, FRAMES, KINDS, RESULTS, ROUNDS, clips, energy, frames, results, rounds, table
from .frame_queries import CLEAN, SIG, signals

RULES = sel.Rules(signals={"other": 0.3, "overlap": 0.5}, speech=0.1, pad=1, blur_frames=1, min_pause=2, margin=2, max_pause=4, max_len=20, split_pause=2, min_len=2, min_speech=150, min_words=1, hop=1.0)
GAPS = sel.Rules(signals={"other": 0.8, "overlap": 0.9}, mode="speaker_gap", speech=0.1, pad=1, margin=1, max_pause=4, max_len=12, split_pause=2, min_len=2, min_speech=0, hop=1.0)


def _words(spark, d) -> DataFrame:
    """A word for every event kind of a frame, a fifth of a frame after the one before."""
    f = frames(spark, d).where("p > 0")
    start = F.col("t") + F.col("k") * 0.2
    return f.select("rec", start.alias("start"), (start + 0.45).alias("end"), F.get(F.array(*[F.lit(k) for k in KINDS]), F.col("k").cast("int")).alias("text"))


def selected_segments(spark, d):
    out = sel.rounded(sel.select_segments(signals(spark, d), RULES, _words(spark, d)), 6)
    return out.withColumn("text", F.md5("text"))


def selected_by_gaps(spark, d):
    return sel.rounded(sel.select_segments(signals(spark, d), GAPS), 6)


def _lanes(spark, d) -> DataFrame:
    f = frames(spark, d)
    return ov.lanes(f.withColumn("p_multi", (F.col("t") % 5) / 5.0), 0.3, 0.7, 0.02)


def overlap_lanes(spark, d):
    return _lanes(spark, d)


def overlap_seconds(spark, d):
    return vw.overlap_seconds(_lanes(spark, d), ["rec", "lane"]).withColumn("seconds", F.round("seconds", 4))


def _truth(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frames with signals, turns of 12 of 24 hours a day, and insertions in them."""
    f = signals(spark, d).select("rec", "t", "k", "p", "other", "overlap")
    days = f.select("rec", F.floor(F.col("t") / 24).alias("day")).distinct()
    turns = days.select("rec", (F.col("day") * 24.0 + 2).alias("start"), (F.col("day") * 24.0 + 14).alias("end"))
    length = 1.0 + F.col("day") % 3
    ins = days.select("rec", F.col("day").alias("id"), (F.col("day") * 24.0 + 5).alias("start"), (F.col("day") * 24.0 + 5 + length).alias("end"), length.alias("length"), (F.col("day") % 5 * -6.0).alias("gain_db"))
    return f, turns, ins


def primary_channels(spark, d):
    f, turns, _ = _truth(spark, d)
    return ov.primary_channel(f, turns, 1.0, 0.3)


def kept_clean(spark, d):
    f, turns, ins = _truth(spark, d)
    kept = turns.select("rec", (F.col("start") + 6).alias("start"), "end")
    return ov.kept_clean(ov.untouched(f, turns, ins, 1.0, 0.3), kept, 1.0)


def signal_recall(spark, d):
    out = ov.signal_recall(*_truth(spark, d), ["other", "overlap"], 1.0, speech=0.3)
    return out.withColumn("misses", F.array_join(F.transform(F.map_entries("misses"), lambda e: F.concat_ws("=", e["key"], e["value"])), " "))


def bench_configs(spark, d):
    """Frames that each configuration flags."""
    configs = ov.config_table(spark, {"other": 0.3, "overlap": 0.5, "local_other": 0.4})
    rows = signals(spark, d).withColumn("local_other", F.greatest(F.lit(0.0), F.col("other") - 0.1))
    on = [F.coalesce(F.col(n) > F.col(f"c.{n}"), F.lit(False)) for n in ("other", "overlap", "local_other")]
    named = configs.agg(F.collect_list(F.struct(*configs.columns)).alias("all"))  # as many as configurations
    both = rows.join(F.broadcast(named)).withColumn("c", F.explode("all"))
    return both.where(on[0] | on[1] | on[2]).groupBy(F.col("c.config").alias("config"), F.col("c.mode").alias("mode")).agg(F.count("*").alias("flagged"))


def session_turns(spark, d):
    c = clips(spark, d).select("id", "speaker", "duration")
    return sel.rounded(ov.session_plan(c, 3, 40.0)[0], 4)


def session_insertions(spark, d):
    c = clips(spark, d).select("id", "speaker", "duration")
    return sel.rounded(ov.session_plan(c, 3, 40.0)[1], 4)


def loudest_crops(spark, d):
    e = energy(spark, d).select("rec", "t", (F.col("db") + 100).alias("e"))
    return ov.loudest_crop(e, ["rec"], 24, 5).withColumn("level", F.round("level", 6))


def seen_voices(spark, d):
    s = table(spark, d, "supplier")
    rows = clips(spark, d).select("id", "speaker")
    trained = s.where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("speaker"))
    registry = s.where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("speaker"), F.when(F.col("s_suppkey") % 2 == 0, "female").otherwise("male").alias("voice"))
    return vw.voices(vw.seen(rows, trained), registry).groupBy("seen", "voice").agg(F.count("*").alias("n"))


def real_speech(spark, d):
    r = results(spark, d).withColumn("model", F.when(F.col("model") == "view", "real speech").otherwise(F.col("model"))).withColumn("text_id", F.col("item") % 50)
    out = vw.beside_real(r, ["cer", "sim"])
    return out.groupBy("model", "text_id").agg(F.count("*").alias("n"), F.round(F.max("real.cer"), 6).alias("real_cer"))


def _registry(spark, d) -> DataFrame:
    c = clips(spark, d)
    own = c.groupBy("speaker").agg(F.sum("duration").cast("double").alias("seconds"), F.array_sort(F.collect_set("recording")).alias("recordings"))
    return own.withColumn("voice", F.when(F.col("speaker") % 3 == 0, "female").when(F.col("speaker") % 3 == 1, "male"))


def speaker_report(spark, d):
    return sel.rounded(vw.speaker_report(_registry(spark, d)), 6)


def voice_hours(spark, d):
    return sel.rounded(vw.voice_hours(_registry(spark, d)), 6)


def latest_rounds(spark, d):
    return vw.latest(rounds(spark, d)).select("round_id", "vote")


def model_order(spark, d):
    return vw.first_seen(table(spark, d, "events"), "event_type", "event_id").select(F.col("event_type").alias("model"), F.col("place").cast("long").alias("place"))


def unique_names(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.regexp_extract("p_name", r"^(\S*)", 1).alias("name"))
    return vw.unique_names(p, "name", "p_partkey").select("p_partkey", "unique")


def item_facets(spark, d):
    r = results(spark, d).groupBy("item").agg(F.first("seen").alias("seen"), F.first("voice").alias("voice")).withColumn("kind", F.when(F.col("item") % 4 == 0, "dev").otherwise("written"))
    parts = [vw.facet(r, f).select(F.lit(f).alias("facet"), "item") for f in ("all", "seen", "unseen", "female", "male", "written", "dev")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def speaker_tabs(spark, d):
    c = clips(spark, d).select(F.col("recording").alias("rec"), "speaker", "duration")
    return vw.speaker_tabs(c).withColumn("seconds", F.col("seconds").cast("double"))


def first_after(spark, d):
    lanes = _lanes(spark, d).where("lane = 'active'")
    points = frames(spark, d).where("k = 0 and t % 7 = 0").select("rec", ((F.col("t") + 0.5) * 0.02).alias("at"))
    return vw.first_after(points, lanes, ["rec"]).withColumn("at", F.round("at", 4))


def running_speed(spark, d):
    return vw.running_mean(table(spark, d, "orders"), "o_custkey", "o_orderkey", "o_totalprice")


def report_lines(spark, d):
    m = ev.group_means(ev.grouped(results(spark, d)), "cer", ["model", "group"])
    line = vw.report_line(F.col("model"), [(F.col("mean"), F.col("mean") * 0.5, F.col("mean") * 1.5, 100.0, 1), (F.col("mean"), F.col("mean"), F.col("mean"), 1.0, 3)], F.col("n"))
    return m.select("group", line.alias("line"))


def payloads(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_custkey") % 2 == 0, F.col("o_custkey")).alias("o_custkey"))
    return vw.payload(o, ["o_orderkey", "o_orderstatus"], ["o_custkey", "absent"])


def seeded_draws(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round(uniform(9, "c_custkey", "c_nationkey"), 9).alias("u"))


QUERIES = {
    f.__name__: f
    for f in (
        selected_segments, selected_by_gaps, overlap_lanes, overlap_seconds, primary_channels, kept_clean, signal_recall, bench_configs, session_turns, session_insertions, loudest_crops, seen_voices, real_speech,
        speaker_report, voice_hours, latest_rounds, model_order, unique_names, item_facets, speaker_tabs, first_after, running_speed, report_lines, payloads, seeded_draws,
    )
}

_CUTS = CLEAN + """,
spoken AS (SELECT rec, k FROM frames GROUP BY rec, k HAVING sum((p > 0.1)::INT) >= 150),
edge AS (SELECT r.*, coalesce(a.barrier, false) AS lp, coalesce(b.barrier, false) AS rp FROM runs r JOIN spoken USING (rec, k) LEFT JOIN pauses a ON a.rec = r.rec AND a.t = r.start - 1 LEFT JOIN pauses b ON b.rec = r.rec AND b.t = r."end"),
ir AS (SELECT i.*, lp, rp FROM inrun i JOIN edge e ON e.rec = i.rec AND e.k = i.k AND e.start = i.rs),
x1 AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k, rs, quiet ORDER BY t) AS g1, t - row_number() OVER (PARTITION BY rec, k, rs, own ORDER BY t) AS g2,
  t - row_number() OVER (PARTITION BY rec, k, rs, (quiet OR NOT own) ORDER BY t) AS g3 FROM ir),
x2 AS (SELECT *, (quiet AND count(*) OVER (PARTITION BY rec, k, rs, quiet, g1) >= 2) OR (NOT own AND count(*) OVER (PARTITION BY rec, k, rs, own, g2) >= 2)
  OR ((quiet OR NOT own) AND count(*) OVER e >= 2 AND (min(t) OVER e = rs OR max(t) OVER e + 1 = re)) AS cut FROM x1 WINDOW e AS (PARTITION BY rec, k, rs, (quiet OR NOT own), g3)),
x3 AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k, rs ORDER BY t) AS g FROM x2 WHERE NOT cut),
chunks AS (SELECT rec, k, rs, re, min(t) AS start, max(t) + 1 AS e FROM x3 GROUP BY rec, k, rs, re, lp, rp, g HAVING max(t) + 1 - min(t) <= 20 AND avg(own::INT) >= 0.5 AND (min(t) > rs OR lp) AND (max(t) + 1 < re OR rp)),
cn AS (SELECT *, row_number() OVER (PARTITION BY rec, k, rs ORDER BY start) AS i FROM chunks),
fold AS (SELECT rec, k, rs, re, i, start AS s, e, 1 AS grp FROM cn WHERE i = 1
  UNION ALL SELECT c.rec, c.k, c.rs, c.re, c.i, CASE WHEN c.start - f.e <= 4 AND c.e - f.s <= 20 THEN f.s ELSE c.start END, c.e,
    CASE WHEN c.start - f.e <= 4 AND c.e - f.s <= 20 THEN f.grp ELSE f.grp + 1 END FROM fold f JOIN cn c ON c.rec = f.rec AND c.k = f.k AND c.rs = f.rs AND c.i = f.i + 1),
mg AS (SELECT rec, k, rs, re, grp, min(s) AS s, max(e) AS e FROM fold GROUP BY ALL),
mw AS (SELECT *, lag(e) OVER w AS pe, lead(s) OVER w AS ns FROM mg WINDOW w AS (PARTITION BY rec, k, rs ORDER BY s)),
clip AS (SELECT rec, k, s, e, s - least(2, CASE WHEN pe IS NOT NULL THEN (s - pe) // 2 ELSE s - rs END) AS c0, e + least(2, CASE WHEN ns IS NOT NULL THEN (ns - e) // 2 ELSE re - e END) AS c1 FROM mw),
seg AS (SELECT c.rec, c.k, c0, c1, max(other) AS mo, max(overlap) AS mv, avg(p) FILTER (t >= s AND t < e) AS mp FROM clip c JOIN sig ON sig.rec = c.rec AND sig.k = c.k AND t >= c0 AND t < c1 WHERE c1 - c0 >= 2 GROUP BY ALL),
words AS (SELECT rec, t + k * 0.2::DOUBLE AS a, t + k * 0.2::DOUBLE + 0.45::DOUBLE AS b, ['click','error','purchase','signup','view'][k + 1] AS w FROM frames WHERE p > 0),
said AS (SELECT seg.rec, seg.k, c0, c1, count(*) FILTER (a >= c0 AND a < c1) AS n, count(*) FILTER ((a < c0 AND c0 < b) OR (a >= c0 AND a < c1 AND b > c1 + 0.2::DOUBLE)) AS cw,
  md5(coalesce(string_agg(w, ' ' ORDER BY a, b, w) FILTER (a >= c0 AND a < c1), '')) AS text FROM seg JOIN words ON words.rec = seg.rec GROUP BY ALL)
"""

_GAPS = SIG + """,
fg AS (SELECT f.rec, f.t, f.k, f.p, sig.other, sig.overlap, f.p > 0.1 AS own, sig.other > 0.8 OR sig.overlap > 0.9 AS bad FROM frames f JOIN sig USING (rec, t, k)),
un AS (SELECT *, bool_or(bad) OVER (PARTITION BY rec, k ORDER BY t RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS unsafe FROM fg),
cg AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k ORDER BY t) AS g FROM un WHERE NOT unsafe),
ir AS (SELECT *, min(t) OVER r AS rs, max(t) OVER r + 1 AS re FROM cg WINDOW r AS (PARTITION BY rec, k, g)),
og AS (SELECT *, t - row_number() OVER (PARTITION BY rec, k, rs, own ORDER BY t) AS h FROM ir),
isl AS (SELECT rec, k, rs, re, own, min(t) AS a, max(t) + 1 AS b FROM og GROUP BY rec, k, rs, re, own, h),
n AS (SELECT *, row_number() OVER (PARTITION BY rec, k, rs ORDER BY a) AS i FROM isl WHERE own AND a - rs >= 1 AND re - b >= 1),
f AS (SELECT rec, k, rs, i, a AS s, b AS e, 1 AS grp FROM n WHERE i = 1 UNION ALL
  SELECT n.rec, n.k, n.rs, n.i, CASE WHEN n.a - f.e > 4 OR (n.b - f.s > 12 AND n.a - f.e >= 2) THEN n.a ELSE f.s END, n.b,
    CASE WHEN n.a - f.e > 4 OR (n.b - f.s > 12 AND n.a - f.e >= 2) THEN f.grp + 1 ELSE f.grp END FROM f JOIN n ON n.rec = f.rec AND n.k = f.k AND n.rs = f.rs AND n.i = f.i + 1),
gp AS (SELECT rec, k, rs, list({'n': b - a, 'a': a, 'b': b}) AS gaps FROM isl WHERE NOT own AND b - a >= 2 GROUP BY 1, 2, 3),
grps AS (SELECT f.rec, f.k, f.rs, min(s) AS s, max(e) AS e FROM f GROUP BY f.rec, f.k, f.rs, grp),
sp AS (SELECT g.rec, g.k, g.rs, s, e, coalesce(gaps, []) AS gaps FROM grps g LEFT JOIN gp ON gp.rec = g.rec AND gp.k = g.k AND gp.rs = g.rs
  UNION ALL SELECT rec, k, rs, CASE side WHEN 0 THEN s ELSE cut.b END, CASE side WHEN 0 THEN cut.a ELSE e END, gaps
    FROM (SELECT *, list_max(list_filter(gaps, lambda x: x.a > s AND x.b < e)) AS cut FROM sp WHERE e - s > 12), (SELECT unnest([0, 1]) AS side) WHERE cut IS NOT NULL),
clip AS (SELECT rec, k, s, e, s - 1 AS c0, e + 1 AS c1 FROM sp WHERE e - s <= 12)
"""

_LANES = FRAMES + """,
lb AS (SELECT rec, t, count(*) FILTER (p > 0.3) >= 2 AS a, t % 5 / 5.0::DOUBLE > 0.7::DOUBLE AS m FROM frames GROUP BY rec, t),
ll AS (SELECT rec, t, 'active' AS lane FROM lb WHERE a UNION ALL SELECT rec, t, 'detected' FROM lb WHERE m UNION ALL SELECT rec, t, 'any' FROM lb WHERE a OR m),
lg AS (SELECT *, t - row_number() OVER (PARTITION BY rec, lane ORDER BY t) AS g FROM ll),
lanes AS (SELECT rec, lane, round(min(t) * 0.02::DOUBLE, 2) AS start, round((max(t) + 1) * 0.02::DOUBLE, 2) AS "end" FROM lg GROUP BY rec, lane, g)
"""

_TRUTH = SIG + """,
prim AS (SELECT rec, k FROM (SELECT rec, k, row_number() OVER (PARTITION BY rec ORDER BY count(*) FILTER (p > 0.3) DESC, k) AS r FROM sig WHERE t % 24 >= 2 AND t % 24 < 14 GROUP BY rec, k) WHERE r = 1),
main AS (SELECT sig.* FROM sig JOIN prim USING (rec, k)),
unt AS (SELECT * FROM main WHERE p > 0.3 AND t % 24 >= 2 AND t % 24 < 14 AND NOT (t % 24 >= 4 AND t % 24 < 7 + (t // 24) % 3))
"""

_SESSION = CLIPS + """,
tot AS (SELECT speaker, row_number() OVER (ORDER BY sum(duration) DESC, speaker) AS r FROM clips GROUP BY speaker),
dr AS (SELECT *, (('0x' || substr(md5('3:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE AS u FROM clips JOIN tot USING (speaker) WHERE r <= 2),
a AS (SELECT duration::DOUBLE AS d, row_number() OVER (ORDER BY u, id) AS i FROM dr WHERE r = 1 AND duration >= 4),
b AS (SELECT duration::DOUBLE AS d, row_number() OVER (ORDER BY u, id) - 1 AS i, count(*) OVER () AS n FROM dr WHERE r = 2),
af AS (SELECT i, d AS have, 0 AS turn FROM a WHERE i = 1 UNION ALL
  SELECT a.i, CASE WHEN af.have >= 20 THEN a.d ELSE af.have + a.d END, CASE WHEN af.have >= 20 THEN af.turn + 1 ELSE af.turn END FROM af JOIN a ON a.i = af.i + 1),
tl AS (SELECT turn, max(have) AS length FROM af GROUP BY turn),
tb AS (SELECT turn, length, b.d + 0.4::DOUBLE AS lead FROM tl JOIN b ON b.i = tl.turn % b.n),
ts AS (SELECT turn, length, lead, sum(lead + length + 0.4::DOUBLE) OVER (ORDER BY turn ROWS UNBOUNDED PRECEDING) - length - 0.4::DOUBLE AS start FROM tb),
turns AS (SELECT * FROM ts WHERE start - lead < 2400)
"""


def _u(seed: int, *of: str) -> str:
    return f"((('0x' || substr(md5({' || '.join([repr(str(seed)), *[f' {chr(39)}:{chr(39)} || {c}::VARCHAR' for c in of]])}), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


ORACLES = {
    "selected_segments": f"""WITH RECURSIVE {_CUTS} SELECT rec, k, c0::DOUBLE AS start, c1::DOUBLE AS "end", (c1 - c0)::DOUBLE AS duration, round(mo, 6) AS max_other, round(mv, 6) AS max_overlap, round(mp, 6) AS mean_p, text, n AS num_words, cw AS cut_words
      FROM seg JOIN said USING (rec, k, c0, c1) WHERE n >= 1""",
    "selected_by_gaps": f"""WITH RECURSIVE {_GAPS} SELECT c.rec, c.k, c0::DOUBLE AS start, c1::DOUBLE AS "end", (c1 - c0)::DOUBLE AS duration, round(max(other), 6) AS max_other, round(max(overlap), 6) AS max_overlap, round(avg(p) FILTER (t >= s AND t < e), 6) AS mean_p
      FROM clip c JOIN sig ON sig.rec = c.rec AND sig.k = c.k AND t >= c0 AND t < c1 WHERE c1 - c0 >= 2 GROUP BY c.rec, c.k, c0, c1, s, e""",
    "overlap_lanes": f"WITH {_LANES} SELECT * FROM lanes",
    "overlap_seconds": f'WITH {_LANES} SELECT rec, lane, round(sum("end" - start), 4) AS seconds FROM lanes GROUP BY 1, 2',
    "primary_channels": f"WITH {_TRUTH} SELECT rec, k FROM prim",
    "kept_clean": f"WITH {_TRUTH} SELECT rec, count(*) AS frames, count(*) FILTER (t % 24 >= 8) AS kept, round(count(*) FILTER (t % 24 >= 8) / count(*), 3) AS share FROM unt GROUP BY rec",
    "signal_recall": f"""WITH {_TRUTH}, days AS (SELECT DISTINCT rec, t // 24 AS day FROM sig), g AS (SELECT unnest([0.05, 0.1, 0.2, 0.3, 0.5])::DOUBLE AS threshold),
      pk AS (SELECT d.rec, d.day, max(other) AS other, max(overlap) AS overlap FROM days d JOIN main m ON m.rec = d.rec AND m.t >= d.day * 24 + 5 AND m.t < d.day * 24 + 6 + d.day % 3 GROUP BY 1, 2),
      h AS (SELECT 'other' AS signal, threshold, day, other > threshold AS hit FROM pk, g UNION ALL SELECT 'overlap', threshold, day, overlap > threshold FROM pk, g),
      kd AS (SELECT signal, threshold, printf('%.2fs@%+.0fdB', (1 + day % 3)::DOUBLE, (day % 5 * -6)::DOUBLE) AS kind, count(*) AS n, count(*) FILTER (NOT hit) AS missed FROM h GROUP BY 1, 2, 3),
      cl AS (SELECT 'other' AS signal, threshold, round(avg((other > threshold)::INT), 3) AS f FROM unt, g GROUP BY threshold UNION ALL SELECT 'overlap', threshold, round(avg((overlap > threshold)::INT), 3) FROM unt, g GROUP BY threshold)
      SELECT k.signal, k.threshold, round(1 - sum(missed) / sum(n), 3) AS recall, any_value(f) AS flagged_clean, coalesce(string_agg(kind || '=' || missed || '/' || n, ' ' ORDER BY kind) FILTER (missed > 0), '') AS misses FROM kd k LEFT JOIN cl ON cl.signal = k.signal AND cl.threshold = k.threshold GROUP BY 1, 2""",
    "bench_configs": f"""WITH {SIG}, x AS (SELECT other, overlap, greatest(0.0, other - 0.1::DOUBLE) AS lo FROM sig), c AS (SELECT * FROM (VALUES ('other_only@0.15', 'acoustic', 0.15, NULL, NULL), ('overlap_only@0.2', 'acoustic', NULL, 0.2, NULL), ('local_other_only@0.2', 'acoustic', NULL, NULL, 0.2),
      ('union@0.2', 'acoustic', 0.15, 0.2, 0.2), ('speaker_gap', 'speaker_gap', 0.3, 0.5, 0.4), ('default', 'acoustic', 0.3, 0.5, 0.4)) v(config, mode, a, b, l))
      SELECT config, mode, count(*) AS flagged FROM x, c WHERE coalesce(other > a::DOUBLE, false) OR coalesce(overlap > b::DOUBLE, false) OR coalesce(lo > l::DOUBLE, false) GROUP BY 1, 2""",
    "session_turns": f'WITH RECURSIVE {_SESSION} SELECT turn, round(start, 4) AS start, round(start + length, 4) AS "end" FROM turns',
    "session_insertions": f"""WITH RECURSIVE {_SESSION}, tr AS (SELECT turn, start, length, unnest(range(0, floor(length / 3)::BIGINT + 1)) AS i FROM turns),
      dw AS (SELECT *, [0.15, 0.3, 0.5, 1.0, 2.0][floor({_u(4, 'turn', 'i')} * 5)::INT + 1]::DOUBLE AS size, [0.0, -6.0, -12.0, -18.0, -24.0][floor({_u(5, 'turn', 'i')} * 5)::INT + 1]::DOUBLE AS gain_db, {_u(6, 'turn', 'i')} AS u FROM tr),
      st AS (SELECT *, CASE WHEN i = 0 THEN 1.5 + u * 1.5 ELSE lag(size) OVER (PARTITION BY turn ORDER BY i) + 3.0 + u * 3.0 END AS step FROM dw), pl AS (SELECT *, sum(step) OVER (PARTITION BY turn ORDER BY i ROWS UNBOUNDED PRECEDING) AS x FROM st)
      SELECT turn, round(start + x, 4) AS "at", size AS length, gain_db FROM pl WHERE x < length - 2.5""",
    "loudest_crops": f"""WITH {FRAMES}, {ENERGY}, p AS (SELECT r.range AS rec, i.range AS i, floor({_u(5, 'r.range', 'i.range')} * (720 - 24))::BIGINT AS x FROM range(8) r, range(8) i),
      l AS (SELECT p.rec, i, x, avg(db + 100) AS level FROM p JOIN energy e ON e.rec = p.rec AND e.t >= x AND e.t < x + 24 GROUP BY 1, 2, 3)
      SELECT rec, x AS "at", round(level, 6) AS level FROM (SELECT *, row_number() OVER (PARTITION BY rec ORDER BY level DESC, i) AS r FROM l) WHERE r = 1""",
    "seen_voices": f"WITH {CLIPS} SELECT coalesce(s_suppkey % 3 <> 0, false) AS seen, CASE WHEN s_suppkey IS NULL OR s_suppkey % 5 = 0 THEN 'unknown' WHEN s_suppkey % 2 = 0 THEN 'female' ELSE 'male' END AS voice, count(*) AS n FROM clips LEFT JOIN supplier ON s_suppkey = speaker GROUP BY 1, 2",
    "real_speech": f"""WITH {RESULTS}, real AS (SELECT item % 50 AS text_id, arg_max(cer, item) AS rc FROM results WHERE model = 'view' GROUP BY 1)
      SELECT model, item % 50 AS text_id, count(*) AS n, round(any_value(rc), 6) AS real_cer FROM results LEFT JOIN real ON real.text_id = item % 50 WHERE model <> 'view' GROUP BY 1, 2""",
    "speaker_report": f"""WITH {CLIPS}, r AS (SELECT speaker, sum(duration)::DOUBLE AS s, count(DISTINCT recording) AS n FROM clips GROUP BY 1)
      SELECT speaker, round(s / 3600, 6) AS hours, round(s / (SELECT sum(s) FROM r), 6) AS share, n AS recordings, CASE speaker % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' END AS voice FROM r ORDER BY s DESC, speaker LIMIT 15""",
    "voice_hours": f"WITH {CLIPS} SELECT CASE speaker % 3 WHEN 0 THEN 'female' WHEN 1 THEN 'male' ELSE 'unknown' END AS voice, round(sum(duration)::DOUBLE / 3600, 6) AS hours FROM clips GROUP BY 1",
    "latest_rounds": f"WITH {ROUNDS} SELECT round_id, vote FROM rounds ORDER BY round_id DESC LIMIT 30",
    "model_order": "SELECT event_type AS model, row_number() OVER (ORDER BY min(event_id)) - 1 AS place FROM events GROUP BY 1",
    "unique_names": r"""WITH p AS (SELECT p_partkey, CASE WHEN regexp_extract(p_name, '^(\S*)', 1) = '' THEN 'work' ELSE regexp_extract(p_name, '^(\S*)', 1) END AS b FROM part), n AS (SELECT *, row_number() OVER (PARTITION BY b ORDER BY p_partkey) AS n FROM p)
      SELECT p_partkey, CASE WHEN n = 1 THEN b ELSE b || '-' || n END AS "unique" FROM n""",
    "item_facets": f"""WITH {RESULTS}, i AS (SELECT DISTINCT item, seen, voice, CASE WHEN item % 4 = 0 THEN 'dev' ELSE 'written' END AS kind FROM results), f AS (SELECT unnest(['all','seen','unseen','female','male','written','dev']) AS facet),
      m AS (SELECT facet, item, row_number() OVER (PARTITION BY facet ORDER BY item) AS r FROM i, f WHERE facet = 'all' OR (facet = 'seen' AND seen) OR (facet = 'unseen' AND NOT seen) OR facet = voice OR facet = kind) SELECT facet, item FROM m WHERE r <= 80""",
    "speaker_tabs": f"WITH {CLIPS} SELECT recording AS rec, speaker, count(*) AS segments, sum(duration)::DOUBLE AS seconds FROM clips GROUP BY GROUPING SETS ((recording, speaker), (recording))",
    "first_after": f"""WITH {_LANES}, pt AS (SELECT rec, (t + 0.5::DOUBLE) * 0.02::DOUBLE AS x FROM frames WHERE k = 0 AND t % 7 = 0)
      SELECT pt.rec, round(x, 4) AS "at", min(l.start) AS start, min(l."end") AS "end" FROM pt LEFT JOIN lanes l ON l.rec = pt.rec AND lane = 'active' AND l."end" > x GROUP BY pt.rec, x""",
    "running_speed": "SELECT o_custkey, list_reduce(list(o_totalprice::DOUBLE ORDER BY o_orderkey), lambda a, b: (a + b) / 2) AS o_totalprice FROM orders GROUP BY 1",
    "report_lines": f"""WITH {RESULTS}, g AS (SELECT *, 'all' AS g FROM results UNION ALL SELECT *, CASE WHEN seen THEN 'seen' ELSE 'unseen' END FROM results UNION ALL SELECT *, voice FROM results WHERE voice <> 'unknown'), m AS (SELECT model, g, count(*) AS n, avg(cer) AS m FROM g GROUP BY 1, 2)
      SELECT g AS "group", '  ' || rpad(model, 14, ' ') || ' ' || lpad(printf('%.1f', m * 100) || ' ±' || printf('%.1f', (m * 1.5 - m * 0.5) / 2 * 100), 13, ' ') || ' ' || lpad(printf('%.3f', m) || ' ±0.000', 13, ' ') || '   ' || n AS line FROM m""",
    "payloads": """SELECT '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"' || CASE WHEN o_custkey % 2 = 0 THEN ',"o_custkey":' || o_custkey ELSE '' END || '}' AS payload FROM orders""",
    "seeded_draws": f"SELECT c_custkey, round({_u(9, 'c_custkey', 'c_nationkey')}, 9) AS u FROM customer",
}
