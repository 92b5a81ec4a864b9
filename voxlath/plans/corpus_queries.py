"""Queries over words, speakers, clips, results and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import vectors as vx
from ..operators import dataset as ds
from ..operators import evaluation as ev
from ..operators import frames as fr
from ..operators import intervals as iv
from ..operators import lexicon as lx
from ..operators import speakers as sp
from ..sources import ingest, transcripts
from ..sources.staging import staged
from .fixtures import CLIPS, EMBEDDINGS, FRAMES, RESULTS, ROUNDS, clip_embeddings, clips, frames, results, rounds, table


def _cues(spark, d) -> DataFrame:
    """Conversation turns as cues."""
    c = table(spark, d, "conversations")
    n = F.size(F.filter(F.split("text", r"\s+"), lambda w: w != ""))
    return c.select(F.col("conv_id").alias("rec"), F.col("turn").alias("i"), (F.col("turn") * 8.0).alias("start"), (F.col("turn") * 8.0 + 0.4 * n).alias("end"), "text")


_CUES = r"""
cues AS (SELECT conv_id AS rec, turn AS i, turn * 8.0::DOUBLE AS start, turn * 8.0::DOUBLE + 0.4::DOUBLE * len(list_filter(string_split_regex(text, '\s+'), lambda w: w <> '')) AS e,
  list_filter(string_split_regex(text, '\s+'), lambda w: w <> '') AS ws FROM conversations),
cw AS (SELECT rec, i, start AS c0, e AS c1, unnest(range(1, len(ws) + 1)) AS j, ws FROM cues),
cx AS (SELECT rec, i, j, c0, c1, ws[j] AS text, length(ws[j]) + 1 AS n FROM cw),
words AS (SELECT rec, i, j, text, c1 AS lim, c0 + (c1 - c0) * (sum(n) OVER (PARTITION BY rec, i ORDER BY j) - n)::BIGINT / (sum(n) OVER (PARTITION BY rec, i))::BIGINT AS start FROM cx),
timed AS (SELECT *, greatest(least(coalesce(lead(start) OVER (PARTITION BY rec ORDER BY start, i, j), lim), lim, start + 1.0), start + 0.05) AS e FROM words)
"""


def cue_words(spark, d):
    return transcripts.cue_words(_cues(spark, d)).select("rec", "text", F.round("start", 6).alias("start"), F.round("limit", 6).alias("limit"))


def word_end_times(spark, d):
    return transcripts.word_times(transcripts.cue_words(_cues(spark, d))).select("rec", "text", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"))


def _segments(spark, d) -> DataFrame:
    return table(spark, d, "conversations").select(F.col("conv_id").alias("rec"), (F.col("turn") * 8.0 + 1.03).alias("seg_start"), (F.col("turn") * 8.0 + 9.51).alias("seg_end"))


def words_in_segments(spark, d):
    words = transcripts.word_times(transcripts.cue_words(_cues(spark, d))).select("rec", "start", "end", "text")
    out = iv.words_in_segments(words, _segments(spark, d), ["rec"], 8.0)
    return out.select("rec", F.round("seg_start", 6).alias("seg_start"), "num_words", "cut_words", F.length("text").cast("long").alias("n_text"))


def points_in_segments(spark, d):
    words = transcripts.cue_words(_cues(spark, d)).select("rec", "start", "text")
    out = iv.points_in_intervals(words, _segments(spark, d), ["rec"], 8.0)
    return out.groupBy("rec").agg(F.count("*").alias("n"), F.round(F.sum(F.col("start") - F.col("seg_start")), 4).alias("offset"))


def leak_semijoin(spark, d):
    """Cues that overlap a short probe interval of their recording."""
    probes = table(spark, d, "conversations").where("turn % 3 = 1").select(F.col("conv_id").alias("rec"), (F.col("turn") * 8.0 - 2.0).alias("seg_start"), (F.col("turn") * 8.0 + 0.5).alias("seg_end"))
    return iv.overlapping(_cues(spark, d), probes, ["rec"], 10.0).select("rec", "i")


def rolling_dedupe(spark, d):
    c = table(spark, d, "conversations").select(F.col("conv_id").alias("rec"), F.col("turn").alias("i"), F.filter(F.split(F.lower("text"), r"[.!?\n ]+"), lambda x: x != "").alias("body"))
    out = transcripts.rolling_dedupe(c)
    return out.select("rec", "i", F.size("body").cast("long").alias("n_before"), F.array_join("new", " ").alias("text"))


def json_props(spark, d):
    e = table(spark, d, "events").select("event_id", F.explode(F.from_json("props", "map<string,string>")).alias("key", "value"))
    return e.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("value").alias("n_values"))


def tag_strip(spark, d):
    t = tx.squeeze(tx.strip_tags(F.col("html")))
    return table(spark, d, "pages").select("page_id", F.length(t).cast("long").alias("n"), F.md5(t).alias("digest"))


def id_sanitise(spark, d):
    return table(spark, d, "pages").select("page_id", tx.safe_id(F.regexp_replace("url", r"^https?://", "")).alias("id"))


def voiceprint_centroids(spark, d):
    c = sp.centroids(clip_embeddings(spark, d))
    return c.select("local_speaker", F.posexplode("centroid").alias("i", "v")).select("local_speaker", F.col("i").cast("long").alias("i"), F.round("v", 6).alias("v"))


def clip_similarity(spark, d):
    e = clip_embeddings(spark, d)
    return sp.similarity(e, sp.centroids(e)).select("id", "local_speaker", F.round("similarity", 6).alias("similarity"))


def outlier_rejection(spark, d):
    prints, _ = sp.voiceprints(clip_embeddings(spark, d), 0.05)
    return prints.select("local_speaker", "recording", "seconds", "clips", F.round("f0", 6).alias("f0"), F.round(F.get("centroid", F.lit(0)), 6).alias("c0"))


def _prints(spark, d) -> DataFrame:
    return staged(sp.voiceprints(clip_embeddings(spark, d), 0.05)[0].where("seconds > 0"), "prints")


def voiceprint_clusters(spark, d):
    prints = _prints(spark, d)
    found = sp.clusters(prints, 0.3, 5.0)
    members = prints.join(found, "local_speaker").withColumn("first", F.col("local_speaker"))
    return found.join(sp.rank_clusters(members).select("cluster", "rank"), "cluster").select("local_speaker", "cluster", "rank")


def _members(spark, d) -> DataFrame:
    """Speakers of clips in twenty groups, ranked by seconds."""
    c = clips(spark, d).groupBy(F.col("speaker").cast("string").alias("local_speaker")).agg(F.sum("duration").alias("seconds"), F.min("speaker").alias("s"))
    c = c.withColumn("cluster", F.col("s") % 20)
    ranks = sp.rank_clusters(c.withColumn("first", F.col("s")))
    return c.join(ranks.select("cluster", "rank"), "cluster")


def stable_ids(spark, d):
    members = _members(spark, d)
    previous = members.where("s % 3 <> 0").select("local_speaker", F.concat(F.lit("S"), F.lpad((F.col("s") % 7 + 1).cast("string"), 4, "0")).alias("speaker"))
    return sp.stable_ids(members, previous)


def cluster_rank(spark, d):
    return _members(spark, d).select("cluster", "rank").distinct().select("cluster", F.col("rank").cast("long").alias("rank"))


def voice_class_hours(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    p = F.when(F.col("quality").isNull(), None).otherwise(F.col("quality") * 0.6 + F.col("toxic") * 0.3)
    named = rows.select("source", sp.voice_class(p).alias("voice"), (F.col("n_chars") / 15).alias("seconds"))
    by = named.groupBy("voice").agg(F.countDistinct("source").alias("sources"), F.sum("seconds").alias("s"))
    return by.select("voice", "sources", F.round(F.col("s") / 3600, 4).alias("hours"), F.round(F.col("s") / F.sum("s").over(Window.partitionBy()), 6).alias("share"))


def speaker_registry(spark, d):
    e = clip_embeddings(spark, d).groupBy("local_speaker", "recording").agg(F.sum("duration").alias("seconds"), F.count("*").alias("clips"), F.max(F.when(~F.isnan("f0"), F.col("f0"))).alias("f0"))
    e = e.withColumn("p_female", F.when(F.col("recording") % 4 == 0, None).otherwise((F.col("recording") % 11) / 10))
    ids = e.select("local_speaker", (F.col("recording") % 6).alias("speaker")).distinct()
    out = sp.registry(e, ids)
    return out.select("speaker", "seconds", "clips", F.size("recordings").cast("long").alias("recordings"), F.size("members").cast("long").alias("members"), F.round("f0", 6).alias("f0"), F.round("p_female", 6).alias("p_female"), "voice")


def manifest_reasons(spark, d):
    return ds.eligibility(clips(spark, d), 5, 40).groupBy("reason").agg(F.count("*").alias("n"), F.sum("duration").alias("seconds"))


def _allowed(spark, d) -> DataFrame:
    return table(spark, d, "supplier").where("s_suppkey % 3 = 0").select((F.col("s_suppkey") % 20).alias("recording"), F.col("s_suppkey").alias("speaker"))


def allow_list(spark, d):
    return ds.allow_list(clips(spark, d), _allowed(spark, d)).groupBy("recording").agg(F.count("*").alias("n"), F.countDistinct("speaker").alias("speakers"))


def map_global_ids(spark, d):
    ids = table(spark, d, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("local"), (F.col("s_suppkey") % 10 + 1000).alias("global"))
    return ds.map_speakers(clips(spark, d), ids).groupBy("speaker").agg(F.count("*").alias("n"), F.countDistinct("local_speaker").alias("locals"))


def round_robin_order(spark, d):
    return ds.round_robin(clips(spark, d), 7).select("id", "speaker", F.col("turn").cast("long").alias("turn"))


def _cap(spark, d) -> float:
    """Half of the mean seconds of a speaker."""
    row = clips(spark, d).agg(F.sum("duration") / F.countDistinct("speaker") / 2).first()
    return float(int(row[0]))


def cap_per_speaker(spark, d):
    return ds.cap_speakers(clips(spark, d), _cap(spark, d), 7).select("id", "speaker", "duration")


def cap_report(spark, d):
    c, budget = clips(spark, d), _cap(spark, d)
    out = ds.cap_report(c, ds.cap_speakers(c, budget, 7), budget)
    return out.select("speaker", F.round("available", 6).alias("available"), F.round("kept", 6).alias("kept"))


def holdout_split(spark, d):
    return ds.hold_out(clips(spark, d), 0.1, 3).groupBy("recording", "split").agg(F.count("*").alias("n"))


def split_routing_stats(spark, d):
    voices = table(spark, d, "supplier").where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("speaker"), F.when(F.col("s_suppkey") % 2 == 0, "female").otherwise("male").alias("voice"))
    return ds.split_stats(ds.route(ds.hold_out(clips(spark, d), 0.1, 3), voices))


def systematic_sample(spark, d):
    return ds.systematic_sample(table(spark, d, "documents").select("doc_id", "lang"), 20, ["doc_id"], ["lang"]).select("doc_id", "lang")


def topk_per_group(spark, d):
    return sp.top_clips(clips(spark, d), "speaker", 8).select("id", "speaker", "duration")


def text_normalise(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(tx.normalise(F.col("text"))).alias("digest"), F.length(tx.normalise(F.col("text"))).cast("long").alias("n"))


def _pairs(spark, d) -> DataFrame:
    c = table(spark, d, "conversations")
    line = F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), "[^a-z ]", ""), " +", " "))
    w = Window.partitionBy("conv_id").orderBy("turn")
    return c.select("conv_id", "turn", line.alias("hypothesis"), F.lag(line).over(w).alias("reference")).where("reference is not null")


def cer_pairs(spark, d):
    return _pairs(spark, d).select("conv_id", "turn", F.round(tx.character_error_rate(F.col("reference"), F.col("hypothesis")), 6).alias("cer"))


def wer_pairs(spark, d):
    return _pairs(spark, d).select("conv_id", "turn", F.round(tx.word_error_rate(F.col("reference"), F.col("hypothesis")), 6).alias("wer"))


def result_group_means(spark, d):
    out = ev.group_means(ev.grouped(results(spark, d)), "cer", ["model", "group"])
    return out.select("model", "group", "n", F.round("mean", 6).alias("mean"))


def paired_diffs(spark, d):
    p = ev.paired(ev.grouped(results(spark, d)).where("group = 'all'"), "click", "cer", "item")
    return p.groupBy("model").agg(F.count("*").alias("n"), F.round(F.avg("diff"), 6).alias("diff"), F.round(ev.win_rate("cer"), 6).alias("wins"))


def bootstrap_ci(spark, d):
    out = ev.bootstrap(results(spark, d), "cer", ["model"], "item")
    return out.select("model", "n", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high")], ev.significance(F.col("low") - 0.1, F.col("high") - 0.1, True).alias("against_tenth"))


def best_model_per_group(spark, d):
    return ev.best_model(ev.group_means(ev.grouped(results(spark, d)), "sim", ["model", "group"]), ["group"], False)


def resume_antijoin(spark, d):
    r = results(spark, d)
    return ev.resume(r.select("model", "item"), r.where("cer < 0.1"), ["model", "item"])


def first_match(spark, d):
    texts = table(spark, d, "documents").select("doc_id", F.col("source").alias("speaker"))
    refs = table(spark, d, "documents").where("n_chars % 3 = 0").select(F.col("source").alias("speaker"), F.col("doc_id").alias("ref"))
    return ev.first_match(texts, refs, "speaker", "ref").select("doc_id", "speaker", "ref")


def worklist_cross(spark, d):
    models = table(spark, d, "nation").select(F.col("n_name").alias("model"))
    work = ev.work_list(models, table(spark, d, "supplier").select(F.col("s_suppkey").alias("item")))
    return work.groupBy("model").agg(F.count("*").alias("n"), F.sum("item").alias("items"))


def preference_tally(spark, d):
    return ev.preference_tally(rounds(spark, d))


def pairwise_wins(spark, d):
    return ev.pairwise_wins(rounds(spark, d))


def blind_slots(spark, d):
    r = rounds(spark, d)
    shown = r.select("round_id", F.explode(ev.mask_slots(F.col("slots"), F.col("blind"), F.col("vote"))).alias("s"))
    return shown.groupBy(F.coalesce("s.model", F.lit("?")).alias("model")).agg(F.count("*").alias("n"))


def recall_grid(spark, d):
    f = fr.others_max(frames(spark, d))
    cells = f.where("t % 9 < 4").withColumn("event", F.floor(F.col("t") / 9))
    out = ev.recall_grid(cells.select("rec", "k", "event").distinct(), cells, ["p", "other"], [0.03, 0.3, 0.9], ["rec", "k"])
    return out.select("signal", "threshold", F.round("recall", 6).alias("recall"), "missed")


def snapshot_diff(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    h = F.md5(F.col("o_orderkey").cast("string"))
    old = o.where(F.substring(h, 1, 1) != "0")
    new = o.where(F.substring(h, 2, 1) != "0").withColumn("price", F.when(F.substring(h, 3, 1) == "0", F.col("price") + 1).otherwise(F.col("price")))
    return ingest.snapshot_diff(old, new, "o_orderkey", ["price"]).groupBy("change").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


def lexicon_counts(spark, d):
    return lx.index(lx.counts(lx.words(table(spark, d, "documents")), 5))


def bigram_pmi(spark, d):
    docs = table(spark, d, "documents")
    pairs = staged(lx.bigrams(docs).where("n >= 3"), "pairs")
    out = lx.context_scores(pairs, staged(lx.counts(lx.words(docs), 5), "lexicon"), pairs)
    return out.select("first", "second", "n", F.round("score", 6).alias("score"))


def phonetic_buckets(spark, d):
    words = lx.counts(lx.words(table(spark, d, "documents"))).where(F.col("word").rlike("^[a-z]+$"))
    k = lx.keyed(words)
    return k.groupBy("key").agg(F.count("*").alias("n"), F.countDistinct("loose").alias("n_loose"), F.min("word").alias("first"))


def duration_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(tx.speaking_weight(F.col("text")), 3).alias("weight"), tx.estimated_frames(F.col("text")).alias("frames"))


def int8_quantise(spark, d):
    q = table(spark, d, "embeddings").select("vec_id", vx.quantise_rows(F.col("embedding")).alias("q"))
    flat = q.select("vec_id", F.round("q.scale", 9).alias("scale"), F.posexplode("q.q").alias("i", "v"))
    return flat.groupBy("vec_id", "scale").agg(F.sum("v").alias("total"), F.sum(F.col("v") * (F.col("i") + 1)).alias("weighted"))


QUERIES = {
    f.__name__: f
    for f in (
        cue_words, word_end_times, words_in_segments, points_in_segments, leak_semijoin, rolling_dedupe, json_props, tag_strip, id_sanitise, voiceprint_centroids, clip_similarity, outlier_rejection, voiceprint_clusters,
        cluster_rank, stable_ids, voice_class_hours, speaker_registry, manifest_reasons, allow_list, map_global_ids, round_robin_order, cap_per_speaker, cap_report, holdout_split, split_routing_stats, systematic_sample,
        topk_per_group, text_normalise, cer_pairs, wer_pairs, result_group_means, paired_diffs, bootstrap_ci, best_model_per_group, resume_antijoin, first_match, worklist_cross, preference_tally, pairwise_wins,
        blind_slots, recall_grid, snapshot_diff, lexicon_counts, bigram_pmi, phonetic_buckets, duration_estimate, int8_quantise,
    )
}

_SEG = "seg AS (SELECT conv_id AS rec, turn * 8.0::DOUBLE + 1.03::DOUBLE AS s0, turn * 8.0::DOUBLE + 9.51::DOUBLE AS s1 FROM conversations)"
_CENTRE = """
flat AS (SELECT id, local_speaker, recording, duration, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM emb),
ln AS (SELECT id, sqrt(sum(v * v)) + 1e-9 AS n FROM flat GROUP BY id),
sums AS (SELECT local_speaker, i, sum(duration * v) AS s FROM flat GROUP BY 1, 2),
cn AS (SELECT local_speaker, sqrt(sum(s * s)) + 1e-9 AS n FROM sums GROUP BY 1),
cent AS (SELECT sums.local_speaker, i, s / n AS c FROM sums JOIN cn USING (local_speaker)),
sim AS (SELECT id, flat.local_speaker, any_value(recording) AS recording, any_value(duration) AS duration, sum(v / ln.n * c) AS similarity FROM flat JOIN ln USING (id) JOIN cent ON cent.local_speaker = flat.local_speaker AND cent.i = flat.i GROUP BY id, flat.local_speaker)
"""
_TURNS = CLIPS + """,
q AS (SELECT *, row_number() OVER (PARTITION BY speaker, recording ORDER BY md5('7:' || id), id) AS rnd FROM clips),
turns AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY rnd, md5('7:' || recording::VARCHAR), recording) AS turn FROM q)
"""
_CAPPED = _TURNS + """,
bud AS (SELECT floor(sum(duration) / count(DISTINCT speaker) / 2) AS b FROM clips),
fold AS (SELECT speaker, turn, id, duration, CASE WHEN duration <= b THEN duration ELSE 0 END AS used, duration <= b AS kept FROM turns, bud WHERE turn = 1
  UNION ALL SELECT t.speaker, t.turn, t.id, t.duration, CASE WHEN f.used + t.duration <= b THEN f.used + t.duration ELSE f.used END, f.used + t.duration <= b FROM fold f JOIN turns t ON t.speaker = f.speaker AND t.turn = f.turn + 1, bud)
"""
_HOLD = CLIPS + """,
rk AS (SELECT recording, row_number() OVER (ORDER BY md5('3:' || recording::VARCHAR), recording) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT recording FROM clips)),
held AS (SELECT c.*, CASE WHEN r <= greatest(round_even(n * 0.1, 0), CASE WHEN n > 1 THEN 1 ELSE 0 END) THEN 'dev' ELSE 'train' END AS split FROM clips c JOIN rk USING (recording))
"""
_PAIRS = """
lines AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(lower(text), '[^a-z ]', '', 'g'), ' +', ' ', 'g')) AS h FROM conversations),
pairs AS (SELECT conv_id, turn, h AS hypothesis, lag(h) OVER (PARTITION BY conv_id ORDER BY turn) AS reference FROM lines)
"""
_GROUPED = RESULTS + """,
grouped AS (SELECT *, 'all' AS g FROM results UNION ALL SELECT *, CASE WHEN seen THEN 'seen' ELSE 'unseen' END FROM results UNION ALL SELECT *, voice FROM results WHERE voice <> 'unknown')
"""
_WORDS = r"""
toks AS (SELECT list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
lex AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM toks) GROUP BY word)
"""

_PAIRED = _WORDS + """, l AS (SELECT * FROM lex WHERE n >= 5), t AS (SELECT sum(n) + count(*) + 1 AS norm FROM l), bg AS (SELECT w[i] AS a, w[i + 1] AS b FROM (SELECT w, unnest(range(1, len(w))) AS i FROM toks)), bc AS (SELECT a, b, count(*) AS n FROM bg GROUP BY 1, 2 HAVING count(*) >= 3)"""
_P = "((coalesce(lb.n, 0) + 1)::DOUBLE / norm::DOUBLE)"
_SCORE = f"round(ln({_P}) + ln((bc.n + 1)::DOUBLE / (coalesce(la.n, 0) * {_P} + 1)), 6)"
#: A reproducible draw, and the drawn weight of a resample: how many steps of a Poisson(1) distribution lie below it.
DRAW = "(('0x' || substr(md5({}), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE"


def poisson(u: str) -> str:
    steps, p, total = [], 0.36787944117144233, 0.0
    for k in range(1, 9):
        total += p
        steps.append(f"({u} > {total!r}::DOUBLE)::INT")
        p /= k
    return " + ".join(steps)


#: Speaking weight and estimated frames of every document.
WEIGHED = r"""WITH c AS (SELECT doc_id, text, length(text) AS n, len(regexp_extract_all(text, '[\p{M}\x{0640}]')) AS m, len(regexp_extract_all(text, '[\p{P}\p{S}]')) AS p, len(regexp_extract_all(text, '\p{Z}')) AS z, len(regexp_extract_all(text, '\p{N}')) AS d,
      regexp_replace(text, '[\x00-\x{02AF}\x{0640}\p{M}\p{P}\p{S}\p{Z}\p{N}]', '', 'g') AS l FROM documents),
      w AS (SELECT doc_id, n - m + p * -0.5::DOUBLE + z * -0.8::DOUBLE + d * 2.5::DOUBLE + SCRIPTS AS w FROM c), r AS (SELECT *, w / (14.1::DOUBLE / 25) AS raw FROM w),
      est AS (SELECT r.doc_id, w, n, greatest(1, floor(CASE WHEN raw < 50 THEN 50 * pow(raw / 50, 1.0::DOUBLE / 3) ELSE raw END))::BIGINT AS frames FROM r JOIN c USING (doc_id))""".replace("SCRIPTS", " + ".join(f"len(regexp_extract_all(l, '[{ranges}]')) * {weight - 1!r}::DOUBLE" for weight, ranges in tx.SCRIPTS.items()))


def key_sql(column: str) -> str:
    """Spelling rules restated without look-around."""
    out = f"lower({column})"
    for pattern, to in (("chh|ch|c", "c"), ("ph", "f"), ("[vw]", "b"), ("z", "j"), ("q", "k"), ("x", "ks"), ("sh", "s"), ("ee|ii", "i"), ("oo|uu", "u"), ("ou", "au"), ("ei", "ai"), ("m([pbf])", r"n\1")):
        out = f"regexp_replace({out}, '{pattern}', '{to}', 'g')"
    for letter in "abcdefghijklmnopqrstuvwxyz":
        out = f"regexp_replace({out}, '{letter}{letter}+', '{letter}', 'g')"
    return out


ORACLES = {
    "cue_words": f"WITH {_CUES} SELECT rec, text, round(start, 6) AS start, round(lim, 6) AS \"limit\" FROM words",
    "word_end_times": f'WITH {_CUES} SELECT rec, text, round(start, 6) AS start, round(e, 6) AS "end" FROM timed',
    "words_in_segments": f"""WITH {_CUES}, {_SEG} SELECT seg.rec, round(s0, 6) AS seg_start, count(*) FILTER (start >= s0 AND start < s1) AS num_words,
      count(*) FILTER ((start < s0 AND s0 < e) OR (start >= s0 AND start < s1 AND e > s1 + 0.2)) AS cut_words,
      greatest(0, coalesce(sum(length(text) + 1) FILTER (start >= s0 AND start < s1), 0) - 1)::BIGINT AS n_text
      FROM seg LEFT JOIN timed t ON t.rec = seg.rec GROUP BY seg.rec, s0""",
    "points_in_segments": f"WITH {_CUES}, {_SEG} SELECT w.rec, count(*) AS n, round(sum(start - s0), 4) AS \"offset\" FROM words w JOIN seg ON w.rec = seg.rec AND start >= s0 AND start < s1 GROUP BY w.rec",
    "leak_semijoin": f"WITH {_CUES}, pr AS (SELECT conv_id AS rec, turn * 8.0 - 2.0 AS s0, turn * 8.0 + 0.5 AS s1 FROM conversations WHERE turn % 3 = 1) SELECT rec, i FROM cues WHERE EXISTS (SELECT 1 FROM pr WHERE pr.rec = cues.rec AND cues.start < s1 AND s0 < cues.e)",
    "rolling_dedupe": """WITH b AS (SELECT conv_id AS rec, turn AS i, list_filter(string_split_regex(lower(text), '[.!?\\n ]+'), lambda x: x <> '') AS body FROM conversations),
      p AS (SELECT *, coalesce(last_value(CASE WHEN len(body) > 0 THEN body END IGNORE NULLS) OVER (PARTITION BY rec ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), []) AS prev FROM b)
      SELECT rec, i, len(body)::BIGINT AS n_before, array_to_string(list_filter(body, lambda x: NOT list_contains(prev, x)), ' ') AS text FROM p""",
    "json_props": "WITH k AS (SELECT props, unnest(json_keys(props::JSON)) AS key FROM events) SELECT key, count(*) AS n, count(DISTINCT json_extract_string(props::JSON, '$.' || key)) AS n_values FROM k GROUP BY key",
    "tag_strip": r"WITH t AS (SELECT page_id, trim(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[\s\p{Z}]+', ' ', 'g')) AS t FROM pages) SELECT page_id, length(t) AS n, md5(t) AS digest FROM t",
    "id_sanitise": r"WITH c AS (SELECT page_id, regexp_replace(regexp_replace(regexp_replace(url, '^https?://', ''), '[^\p{L}\p{N}_.\-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS id FROM pages) SELECT page_id, CASE WHEN id = '' THEN '_' ELSE id END AS id FROM c",
    "voiceprint_centroids": f"WITH {EMBEDDINGS}, {_CENTRE} SELECT local_speaker, i - 1 AS i, round(c, 6) AS v FROM cent",
    "clip_similarity": f"WITH {EMBEDDINGS}, {_CENTRE} SELECT id, local_speaker, round(similarity, 6) AS similarity FROM sim",
    "outlier_rejection": f"""WITH {EMBEDDINGS}, {_CENTRE}, good AS (SELECT *, similarity >= 0.05 AS ok FROM sim), any_ok AS (SELECT local_speaker, bool_or(ok) AS any_good FROM good GROUP BY 1),
      use AS (SELECT flat.* FROM flat JOIN good USING (id) JOIN any_ok a ON a.local_speaker = flat.local_speaker WHERE ok OR NOT any_good), s2 AS (SELECT local_speaker, i, sum(duration * v) AS s FROM use GROUP BY 1, 2),
      c2 AS (SELECT local_speaker, max(s) FILTER (i = 1) / (sqrt(sum(s * s)) + 1e-9) AS c0 FROM s2 GROUP BY 1)
      SELECT g.local_speaker, g.recording, coalesce(sum(g.duration) FILTER (ok), 0)::DOUBLE AS seconds, count(*) AS clips, round(median(f0) FILTER (ok), 6) AS f0, round(any_value(c0), 6) AS c0
      FROM good g JOIN emb USING (id) JOIN c2 ON c2.local_speaker = g.local_speaker GROUP BY 1, 2""",
    "cluster_rank": f"WITH {CLIPS}, m AS (SELECT speaker % 20 AS cluster, sum(duration) AS total, min(speaker) AS f FROM clips GROUP BY 1) SELECT cluster, row_number() OVER (ORDER BY total DESC, f) - 1 AS rank FROM m",
    "stable_ids": f"""WITH RECURSIVE {CLIPS}, s AS (SELECT speaker, sum(duration) AS seconds, speaker % 20 AS cluster FROM clips GROUP BY 1),
      r AS (SELECT cluster, row_number() OVER (ORDER BY sum(seconds) DESC, min(speaker)) AS rk FROM s GROUP BY 1),
      v AS (SELECT cluster, 'S' || lpad((speaker % 7 + 1)::VARCHAR, 4, '0') AS old, sum(seconds + 1e-3) AS v FROM s WHERE speaker % 3 <> 0 GROUP BY 1, 2),
      l AS (SELECT r.cluster, rk, coalesce(list(old ORDER BY v DESC, old) FILTER (old IS NOT NULL), []) AS olds FROM r LEFT JOIN v ON v.cluster = r.cluster GROUP BY 1, 2),
      f AS (SELECT rk, cluster, olds[1] AS got, CASE WHEN len(olds) > 0 THEN [olds[1]] ELSE []::VARCHAR[] END AS taken FROM l WHERE rk = 1
        UNION ALL SELECT l.rk, l.cluster, list_filter(l.olds, lambda o: NOT list_contains(f.taken, o))[1], list_concat(f.taken, list_filter(l.olds, lambda o: NOT list_contains(f.taken, o))[1:1]) FROM f JOIN l ON l.rk = f.rk + 1),
      t AS (SELECT coalesce(max(substr(old, 2)::BIGINT), 0) AS top FROM v)
      SELECT cluster, coalesce(got, 'S' || lpad((top + sum((got IS NULL)::INT) OVER (ORDER BY rk))::BIGINT::VARCHAR, 4, '0')) AS speaker FROM f, t""",
    "voice_class_hours": """WITH r AS (SELECT source, n_chars / 15 AS seconds, CASE WHEN quality IS NULL THEN 'unknown' WHEN quality * 0.6::DOUBLE + toxic * 0.3::DOUBLE >= 0.7::DOUBLE THEN 'female' WHEN quality * 0.6::DOUBLE + toxic * 0.3::DOUBLE <= 0.3::DOUBLE THEN 'male' ELSE 'unclear' END AS voice FROM documents LEFT JOIN labels USING (doc_id))
      SELECT voice, count(DISTINCT source) AS sources, round(sum(seconds) / 3600, 4) AS hours, round(sum(seconds) / sum(sum(seconds)) OVER (), 6) AS share FROM r GROUP BY voice""",
    "speaker_registry": f"""WITH {EMBEDDINGS}, p AS (SELECT local_speaker, recording, sum(duration) AS seconds, count(*) AS clips, max(f0) AS f0, CASE WHEN recording % 4 = 0 THEN NULL ELSE (recording % 11) / 10 END AS pf FROM emb GROUP BY 1, 2)
      , r AS (SELECT recording % 6 AS speaker, sum(seconds) AS seconds, sum(clips)::BIGINT AS clips, count(DISTINCT recording) AS recordings, count(*) AS members, sum(seconds * f0) / sum(seconds) FILTER (f0 IS NOT NULL) AS f0, sum(seconds * pf) / sum(seconds) FILTER (pf IS NOT NULL) AS pf FROM p GROUP BY 1)
      SELECT speaker, seconds, clips, recordings, members, round(f0, 6) AS f0, round(pf, 6) AS p_female, CASE WHEN pf IS NULL THEN 'unknown' WHEN pf >= 0.7 THEN 'female' WHEN pf <= 0.3 THEN 'male' ELSE 'unclear' END AS voice FROM r""",
    "manifest_reasons": f"WITH {CLIPS} SELECT CASE WHEN trim(coalesce(text, '')) = '' THEN 'no_text' WHEN duration NOT BETWEEN 5 AND 40 THEN 'duration' ELSE 'keep' END AS reason, count(*) AS n, sum(duration) AS seconds FROM clips GROUP BY 1",
    "allow_list": f"WITH {CLIPS}, a AS (SELECT s_suppkey % 20 AS recording, s_suppkey AS speaker FROM supplier WHERE s_suppkey % 3 = 0) SELECT recording, count(*) AS n, count(DISTINCT speaker) AS speakers FROM clips c WHERE recording NOT IN (SELECT recording FROM a) OR EXISTS (SELECT 1 FROM a WHERE a.recording = c.recording AND a.speaker = c.speaker) GROUP BY 1",
    "map_global_ids": f"WITH {CLIPS} SELECT CASE WHEN s_suppkey IS NULL THEN speaker ELSE speaker % 10 + 1000 END AS speaker, count(*) AS n, count(DISTINCT c.speaker) AS locals FROM clips c LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 4 <> 0) ON s_suppkey = speaker GROUP BY 1",
    "round_robin_order": f"WITH {_TURNS} SELECT id, speaker, turn FROM turns",
    "cap_per_speaker": f"WITH RECURSIVE {_CAPPED} SELECT id, speaker, duration FROM fold WHERE kept",
    "cap_report": f"WITH RECURSIVE {_CAPPED}, a AS (SELECT speaker, sum(duration) AS s FROM clips GROUP BY 1), k AS (SELECT speaker, sum(duration) AS s FROM fold WHERE kept GROUP BY 1) SELECT a.speaker, round(a.s / 3600, 6) AS available, round(k.s / 3600, 6) AS kept FROM bud, a LEFT JOIN k ON a.speaker = k.speaker WHERE a.s > b",
    "holdout_split": f"WITH {_HOLD} SELECT recording, split, count(*) AS n FROM held GROUP BY 1, 2",
    "split_routing_stats": f"WITH {_HOLD} SELECT CASE WHEN split = 'dev' THEN 'dev' WHEN s_suppkey % 2 = 0 THEN 'train_female' ELSE 'train_main' END AS dataset, count(*) AS clips, round(sum(duration) / 3600, 2) AS hours, count(DISTINCT speaker) AS speakers FROM held LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 5 <> 0) ON s_suppkey = speaker GROUP BY 1",
    "systematic_sample": "WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS i, greatest(1, count(*) OVER (PARTITION BY lang) // 20) AS step FROM documents) SELECT doc_id, lang FROM r WHERE i % step = 0 AND i < 20 * step",
    "topk_per_group": f"WITH {CLIPS} SELECT id, speaker, duration FROM (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY duration DESC, id) AS r FROM clips) WHERE r <= 8",
    "text_normalise": r"WITH t AS (SELECT doc_id, trim(regexp_replace(lower(regexp_replace(regexp_replace(nfc_normalize(text), '[\x{200B}\x{200C}\x{200D}\x{FEFF}]', '', 'g'), '[\p{P}\p{S}]', ' ', 'g')), '[\s\p{Z}]+', ' ', 'g')) AS t FROM documents) SELECT doc_id, md5(t) AS digest, length(t) AS n FROM t",
    "cer_pairs": f"WITH {_PAIRS} SELECT conv_id, turn, round(levenshtein(replace(reference, ' ', ''), replace(hypothesis, ' ', '')) / greatest(1, length(replace(reference, ' ', ''))), 6) AS cer FROM pairs WHERE reference IS NOT NULL",
    "result_group_means": f'WITH {_GROUPED} SELECT model, g AS "group", count(*) AS n, round(avg(cer), 6) AS mean FROM grouped GROUP BY 1, 2',
    "paired_diffs": f"WITH {RESULTS} SELECT r.model, count(*) AS n, round(avg(r.cer - b.cer), 6) AS diff, round(avg((r.cer - b.cer < 0)::INT), 6) AS wins FROM results r JOIN results b ON b.model = 'click' AND b.item = r.item WHERE r.model <> 'click' GROUP BY 1",
    "best_model_per_group": f'WITH {_GROUPED}, m AS (SELECT model, g, avg(sim) AS s FROM grouped GROUP BY 1, 2) SELECT g AS "group", arg_max(model, s) AS model FROM m GROUP BY 1',
    "resume_antijoin": f"WITH {RESULTS} SELECT model, item FROM results WHERE NOT cer < 0.1",
    "first_match": "SELECT doc_id, source AS speaker, ref FROM documents JOIN (SELECT source, min(doc_id) AS ref FROM documents WHERE n_chars % 3 = 0 GROUP BY 1) USING (source)",
    "worklist_cross": "SELECT n_name AS model, count(*) AS n, sum(s_suppkey)::BIGINT AS items FROM nation, supplier GROUP BY 1",
    "preference_tally": f"""WITH {ROUNDS}, s AS (SELECT vote, slot, model FROM rounds JOIN re USING (round_id) WHERE blind AND vote IS NOT NULL), t AS (SELECT model, count(*) FILTER (slot = vote) AS wins, count(*) AS played, count(*) FILTER (vote = 'tie') AS ties FROM s GROUP BY 1)
      SELECT *, round(wins / played, 3) AS win_rate FROM t""",
    "pairwise_wins": f"WITH {ROUNDS}, s AS (SELECT * FROM rounds JOIN re USING (round_id) WHERE blind AND vote IS NOT NULL AND vote <> 'tie') SELECT a.model AS winner, b.model AS loser, count(*) AS n FROM s a JOIN s b ON a.round_id = b.round_id AND a.slot = a.vote AND b.slot <> b.vote AND a.model <> b.model GROUP BY 1, 2",
    "blind_slots": f"WITH {ROUNDS} SELECT CASE WHEN blind AND vote IS NULL THEN '?' ELSE model END AS model, count(*) AS n FROM rounds JOIN re USING (round_id) GROUP BY 1",
    "recall_grid": f"""WITH {FRAMES}, o AS (SELECT *, coalesce(max(p) OVER (PARTITION BY rec, t ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING EXCLUDE CURRENT ROW), 0.0) AS other FROM frames), e AS (SELECT rec, k, t // 9 AS event, max(p) AS p, max(other) AS other FROM o WHERE t % 9 < 4 GROUP BY 1, 2, 3),
      g AS (SELECT unnest([0.03, 0.3, 0.9])::DOUBLE AS threshold), h AS (SELECT 'p' AS signal, threshold, p > threshold AS hit FROM e, g UNION ALL SELECT 'other', threshold, other > threshold FROM e, g)
      SELECT signal, threshold, round(avg(hit::INT), 6) AS recall, count(*) FILTER (NOT hit) AS missed FROM h GROUP BY 1, 2""",
    "snapshot_diff": """WITH o AS (SELECT o_orderkey, o_totalprice AS price, md5(o_orderkey::VARCHAR) AS h FROM orders), a AS (SELECT * FROM o WHERE h[1] <> '0'), b AS (SELECT o_orderkey, CASE WHEN h[3] = '0' THEN price + 1 ELSE price END AS price FROM o WHERE h[2] <> '0'),
      j AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS k, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'not_in_input' WHEN a.price IS NOT DISTINCT FROM b.price THEN 'unchanged' ELSE 'updated' END AS change FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey)
      SELECT change, count(*) AS n, sum(k)::BIGINT AS keys FROM j GROUP BY 1""",
    "lexicon_counts": f"WITH {_WORDS} SELECT word, n, row_number() OVER (ORDER BY n DESC, word) - 1 AS code FROM lex WHERE n >= 5",
    "bigram_pmi": f"WITH {_PAIRED} SELECT a AS first, b AS second, bc.n, {_SCORE} AS score FROM t, bc LEFT JOIN l la ON la.word = a LEFT JOIN l lb ON lb.word = b",
    "bigram_context": f"""WITH {_PAIRED}, ask AS (SELECT b AS a, a AS b FROM bc), w AS (SELECT ask.a, ask.b, coalesce(bc.n, 0) AS n FROM ask LEFT JOIN bc ON bc.a = ask.a AND bc.b = ask.b)
      SELECT bc.a AS first, bc.b AS second, bc.n, {_SCORE} AS score FROM t, w bc LEFT JOIN l la ON la.word = bc.a LEFT JOIN l lb ON lb.word = bc.b""",
    "bootstrap_ci": f"""WITH {RESULTS}, dw AS (SELECT model, cer AS d, r.range AS r, {DRAW.format("'0:' || r.range || ':' || item || ':' || model")} AS u FROM results, range(2000) r), w AS (SELECT *, {poisson("u")} AS w FROM dw), m AS (SELECT model, r, sum(w * d) / sum(w) AS m FROM w GROUP BY 1, 2 HAVING sum(w) > 0),
      ci AS (SELECT model, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM m GROUP BY 1)
      SELECT r.model, count(*) AS n, round(avg(cer), 6) AS mean, round(any_value(low), 6) AS low, round(any_value(high), 6) AS high, CASE WHEN any_value(high) - 0.1 < 0 THEN 'good' WHEN any_value(low) - 0.1 > 0 THEN 'bad' END AS against_tenth FROM results r JOIN ci USING (model) GROUP BY 1""",
    "phonetic_buckets": f"""WITH {_WORDS}, k0 AS (SELECT word, {key_sql('word')} AS k FROM lex WHERE regexp_matches(word, '^[a-z]+$')), k AS (SELECT word, CASE WHEN length(k) > 1 AND k LIKE '%a' THEN substr(k, 1, length(k) - 1) ELSE k END AS key FROM k0)
      SELECT key, count(*) AS n, count(DISTINCT substr(key, 1, 1) || replace(substr(key, 2), 'a', '')) AS n_loose, min(word) AS first FROM k GROUP BY key""",
    "duration_estimate": WEIGHED + " SELECT doc_id, round(w, 3) AS weight, frames FROM est",
    "int8_quantise": """WITH f AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), s AS (SELECT vec_id, greatest(max(abs(v)) / 127, 1e-30) AS scale FROM f GROUP BY 1),
      q AS (SELECT vec_id, scale, i, greatest(-127, least(127, round_even(v / scale, 0)))::BIGINT AS q FROM f JOIN s USING (vec_id)) SELECT vec_id, round(scale, 9) AS scale, sum(q)::BIGINT AS total, sum(q * i)::BIGINT AS weighted FROM q GROUP BY 1, 2""",
}
