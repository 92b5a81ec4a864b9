"""Queries over window matching, candidates, shard lists, caches, codes and levels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import audio as au
from ..functions import text as tx
from ..functions import vectors as vx
from ..operators import assignment as asg
from ..operators import codebooks as cb
from ..operators import frames as fr
from ..operators import intervals as iv
from ..operators import lexicon as lx
from ..operators import segments as sg
from ..sources import ingest, manifests, transcripts
from ..sources.staging import staged
from .corpus_queries import key_sql
from .fixtures import FRAMES, frames, table


def _local(spark, d) -> DataFrame:
    """Windows of 48 hours every 24 with three local speakers, mixed from the recording's five."""
    f = frames(spark, d)
    w = f.where("k < 3").select("rec", "t", F.col("k").alias("l"), ((F.col("k") * 2 + 1) % 5).alias("k"))
    p = w.join(f, ["rec", "t", "k"]).select("rec", "t", "l", "p")
    starts = F.explode(fr.window_starts(F.lit(720), 48, 24)).alias("w")
    return p.select("rec", starts).distinct().join(p, "rec").where((F.col("t") >= F.col("w")) & (F.col("t") < F.col("w") + 48)).select("rec", F.col("w").cast("long").alias("w"), "t", "l", "p")


def co_activity(spark, d):
    return asg.co_activity(_local(spark, d), frames(spark, d))


def window_assignment(spark, d):
    return asg.assign(asg.co_activity(_local(spark, d), frames(spark, d)))


def others_of_window(spark, d):
    local = _local(spark, d)
    speakers = frames(spark, d).select("rec", "k").distinct()
    matched = local.select("rec", "w", "l").distinct().withColumn("k", (F.col("l") * 2 + 1) % 5)
    out = fr.combine_windows(asg.others_of(local, matched, speakers), ["rec", "t", "k"], "other")
    return out.where("other > 0.5").select("rec", "t", "k", F.round("other", 6).alias("other"))


def spelling_candidates(spark, d):
    words = staged(lx.counts(lx.words(table(spark, d, "documents"))).where(F.col("word").rlike("^[a-z]+$")), "words")
    out = lx.candidates(words.select(F.col("word").alias("typed")), words)
    return out.groupBy("typed").agg(F.count("*").alias("n"), F.sum("n").alias("total"))


def ranked_candidates(spark, d):
    words = staged(lx.counts(lx.words(table(spark, d, "documents"))).where(F.col("word").rlike("^[a-z]+$")), "words")
    out = lx.ranked(lx.candidates(words.select(F.col("word").alias("typed")), words), 1e5)
    return out.select("typed", "word", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def encoded_bigrams(spark, d):
    docs = table(spark, d, "documents")
    lexicon = lx.index(lx.counts(lx.words(docs), 5))
    return lx.encode_bigrams(lx.bigrams(docs).where("n >= 3"), lexicon)


def shard_list(spark, d):
    o = table(spark, d, "orders")
    name = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("D:\\data\\"), F.col("o_orderkey").cast("string"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("/data/"), F.col("o_orderkey").cast("string"))).otherwise(F.col("o_orderkey").cast("string"))
    lines = o.select(F.concat_ws(" ", F.concat(name, F.lit(".tar")), F.concat(name, F.lit(".lst")), (F.col("o_custkey") % 100).cast("string"), (F.col("o_custkey") % 7).cast("string")).alias("value"))
    return manifests.shard_list(lines, "/base/")


def cache_states(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("key"), F.col("o_custkey").alias("fingerprint"), (F.col("o_orderkey") % 11 != 0).alias("has_input"))
    done = table(spark, d, "orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("key"), (F.col("o_custkey") + (F.col("o_orderkey") % 4 == 0).cast("long")).alias("fingerprint"))
    return manifests.cache_state(o, done, ["key"]).groupBy("state").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


def stage_outcomes(spark, d):
    e = table(spark, d, "events").select(F.col("event_type").alias("stage"), F.when(F.col("user_id") % 7 == 0, "failed").when(F.col("user_id") % 3 == 0, "skipped").otherwise("ok").alias("kind"))
    return manifests.outcome_counts(e)


def invalidated_stages(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("size"), F.col("o_orderstatus").alias("modified"), F.sha1("o_orderpriority").alias("transcript_sha1"))
    new = o.withColumn("size", F.when(F.col("id") % 9 == 0, F.col("size") + 1).otherwise(F.col("size"))).withColumn("transcript_sha1", F.when(F.col("id") % 4 == 0, F.lit("new")).otherwise(F.col("transcript_sha1")))
    return ingest.invalidation(o.where("id % 13 <> 0"), new).groupBy("stage").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


def paired_files(spark, d):
    """Audio with its preferred transcript, from a listing made of pages."""
    p = table(spark, d, "pages").select("page_id", F.explode(F.array(*[F.lit(x) for x in ("wav", "txt", "vtt", "srt", "json")])).alias("ext"))
    kept = p.where((F.col("ext") == "wav") | ((F.col("ext") == "txt") & (F.col("page_id") % 2 == 0)) | ((F.col("ext") == "vtt") & (F.col("page_id") % 3 == 0)) | ((F.col("ext") == "srt") & (F.col("page_id") % 5 == 0)) | ((F.col("ext") == "json") & (F.col("page_id") % 7 == 0)))
    stem = F.concat(F.lit("take "), F.col("page_id").cast("string"))
    files = kept.select(F.lit("/in").alias("dir"), stem.alias("stem"), "ext", F.concat(F.lit("/in/"), stem, F.lit("."), F.col("ext")).alias("path"), F.lit(1).alias("size"), F.lit(1).alias("modified"))
    return ingest.require_unique(ingest.recordings(files)).select("id", "kind", F.col("sidecar").isNotNull().alias("has_sidecar"))


def cue_blocks(spark, d):
    """Caption files made of conversations, parsed back."""
    c = table(spark, d, "conversations")
    stamp = lambda s: F.format_string("%02d:%02d.%03d", F.floor(s / 60).cast("int"), (s % 60).cast("int"), F.lit(250))
    block = F.concat(stamp(F.col("turn") * 8), F.lit(" --> "), stamp(F.col("turn") * 8 + 5), F.lit("\n<b>"), F.regexp_replace("text", r"\s+", " "), F.lit("</b>"))
    files = c.groupBy(F.col("conv_id").alias("rec")).agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", block.alias("b")))), lambda x: x["b"]), "\n\n")).alias("text"))
    out = transcripts.cues(files)
    return out.select("rec", F.round("start", 3).alias("start"), F.round("end", 3).alias("end"), F.md5("text").alias("digest"))


def timed_text(spark, d):
    """Timed-text JSON made of conversations, parsed back."""
    c = table(spark, d, "conversations")
    event = F.struct((F.col("turn") * 8000).alias("tStartMs"), F.lit(4000).cast("long").alias("dDurationMs"), F.array(F.struct(F.col("text").alias("utf8"), F.lit(500).cast("long").alias("tOffsetMs"))).alias("segs"))
    files = c.groupBy(F.col("conv_id").alias("rec")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(event)).alias("events"))).alias("text"))
    return transcripts.word_times(transcripts.timed_text_words(files)).groupBy("rec").agg(F.count("*").alias("n"), F.round(F.min("start"), 3).alias("first"), F.round(F.max("start"), 3).alias("last"))


def loudness_gains(spark, d):
    c = table(spark, d, "customer")
    gain = au.loudness_gain(F.when(F.col("c_custkey") % 6 == 0, None).otherwise(-F.abs("c_acctbal") / 100), -F.abs("c_acctbal") / 300, -23.0, -1.0)
    return c.select("c_custkey", F.round(gain, 6).alias("gain"))


def faded_samples(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", au.fade_and_pad(F.col("embedding"), 10, 3).alias("x"))
    return e.select("vec_id", F.size("x").cast("long").alias("n"), F.round(au.peak(F.col("x")), 6).alias("peak"), F.round(au.rms(F.col("x")), 6).alias("rms"))


def prompt_texts(spark, d):
    t = tx.add_final_mark(tx.combine_prompt(F.lit("Nice to meet you."), F.col("text")))
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(t).alias("digest"))


def text_chunks(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", F.explode(tx.chunk_text(200)(F.col("text"))).alias("chunk")).groupBy("conv_id").agg(F.count("*").alias("n"), F.max(F.length("chunk")).alias("longest"))


def rotated_vectors(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", vx.hadamard(F.col("embedding"), 16).alias("h"), "embedding")
    return e.select("vec_id", F.round(vx.norm(F.col("h")), 5).alias("norm"), F.round(F.element_at("h", 1), 5).alias("first"))


def value_codebooks(spark, d):
    o = table(spark, d, "orders").select("o_orderstatus", F.log10(F.col("o_totalprice") + 1).alias("v"))
    return cb.encode_values(o, cb.fit_codebooks(o, "o_orderstatus", "v"), "o_orderstatus", "v").groupBy("o_orderstatus", "code").agg(F.count("*").alias("n"))


def split_long_runs(spark, d):
    """Runs of activity split at their longest gaps."""
    gaps = fr.islands(frames(spark, d), ["rec", "k"], F.col("p") <= 0.05)
    rows = gaps.groupBy("rec", "k").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("gaps")).withColumn("start", F.lit(0).cast("long")).withColumn("end", F.lit(720).cast("long"))
    return sg.split_long_spans(rows, ["rec", "k"], 40, 2)


def probe_frames(spark, d):
    a, b = iv.frame_slice(F.col("turn") * 0.37, F.col("turn") * 0.37 + 0.111, 0.01)
    return table(spark, d, "conversations").select("conv_id", "turn", a.alias("first"), b.alias("last"))


_LOCAL = FRAMES + """,
lc AS (SELECT w.range * 24 AS w, f.rec, f.t, l.range AS l, f.p FROM range(29) w, range(3) l, frames f WHERE w.range * 24 <= 672 AND f.k = (l.range * 2 + 1) % 5 AND f.t >= w.range * 24 AND f.t < w.range * 24 + 48)
"""

QUERIES = {
    f.__name__: f
    for f in (
        co_activity, window_assignment, others_of_window, spelling_candidates, ranked_candidates, encoded_bigrams, shard_list, cache_states, stage_outcomes, invalidated_stages, paired_files, cue_blocks, timed_text,
        loudness_gains, faded_samples, prompt_texts, text_chunks, rotated_vectors, value_codebooks, split_long_runs, probe_frames,
    )
}

ORACLES = {
    "co_activity": f"WITH {_LOCAL} SELECT lc.rec, w, l, f.k, sum((lc.p * f.p)::DECIMAL(20, 12))::DOUBLE AS score FROM lc JOIN frames f ON f.rec = lc.rec AND f.t = lc.t GROUP BY 1, 2, 3, 4",
    "window_assignment": f"""WITH {_LOCAL}, sc AS (SELECT lc.rec, w, l, f.k, sum(lc.p * f.p) AS s FROM lc JOIN frames f ON f.rec = lc.rec AND f.t = lc.t GROUP BY 1, 2, 3, 4),
      ways AS (SELECT a.rec, a.w, a.k AS a, b.k AS b, c.k AS c, a.s AS sa, b.s AS sb, c.s AS sc, row_number() OVER (PARTITION BY a.rec, a.w ORDER BY a.s + b.s + c.s DESC, a.k, b.k, c.k) AS r
        FROM sc a JOIN sc b ON a.rec = b.rec AND a.w = b.w AND a.l = 0 AND b.l = 1 AND a.k <> b.k JOIN sc c ON a.rec = c.rec AND a.w = c.w AND c.l = 2 AND c.k <> a.k AND c.k <> b.k)
      SELECT rec, w, 0::BIGINT AS l, a AS k FROM ways WHERE r = 1 AND sa > 0.5 UNION ALL SELECT rec, w, 1, b FROM ways WHERE r = 1 AND sb > 0.5 UNION ALL SELECT rec, w, 2, c FROM ways WHERE r = 1 AND sc > 0.5""",
    "others_of_window": f"WITH {_LOCAL} SELECT lc.rec, t, k.range AS k, round(max(p), 6) AS other FROM lc, range(5) k WHERE (l * 2 + 1) % 5 <> k.range GROUP BY 1, 2, 3 HAVING max(p) > 0.5",
    "shard_list": r"""WITH o AS (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 'file:///D:/data/' || o_orderkey WHEN 1 THEN '/data/' || o_orderkey ELSE '/base/' || o_orderkey END AS p FROM orders)
      SELECT p || '.tar' AS tar, p || '.lst' AS label, o_custkey % 100 AS n, (o_custkey % 7)::DOUBLE AS seconds FROM o""",
    "cache_states": """SELECT CASE WHEN o_orderkey % 11 = 0 THEN 'no_input' WHEN o_orderkey % 5 = 0 THEN 'missing' WHEN o_orderkey % 4 = 0 THEN 'stale' ELSE 'cached' END AS state, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY 1""",
    "stage_outcomes": "SELECT event_type AS stage, count(*) FILTER (user_id % 7 <> 0 AND user_id % 3 <> 0) AS ok, count(*) FILTER (user_id % 7 <> 0 AND user_id % 3 = 0) AS skipped, count(*) FILTER (user_id % 7 = 0) AS failed FROM events GROUP BY 1",
    "invalidated_stages": "SELECT CASE WHEN o_orderkey % 13 = 0 OR o_orderkey % 9 = 0 THEN 'detect' WHEN o_orderkey % 4 = 0 THEN 'select' ELSE 'none' END AS stage, count(*) AS n, sum(o_orderkey)::BIGINT AS ids FROM orders GROUP BY 1",
    "paired_files": "SELECT 'take_' || page_id AS id, CASE WHEN page_id % 5 = 0 THEN 'srt' WHEN page_id % 3 = 0 THEN 'vtt' WHEN page_id % 2 = 0 THEN 'txt' END AS kind, page_id % 7 = 0 AS has_sidecar FROM pages",
    "cue_blocks": r"""WITH c AS (SELECT conv_id AS rec, turn, trim(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '<[^>]*>', '', 'g')) AS t FROM conversations), p AS (SELECT *, lag(t) OVER (PARTITION BY rec ORDER BY turn) AS pt FROM c)
      SELECT rec, round((turn * 8 + 0.25)::DOUBLE, 3) AS start, round((turn * 8 + 5.25)::DOUBLE, 3) AS "end", md5(t) AS digest FROM p WHERE t <> '' AND t IS DISTINCT FROM pt""",
    "timed_text": r"""WITH w AS (SELECT conv_id AS rec, turn, len(list_filter(string_split_regex(replace(text, '>>', ''), '\s+'), lambda x: x <> '')) AS n FROM conversations)
      SELECT rec, sum(n)::BIGINT AS n, round(min(turn * 8 + 0.5) FILTER (n > 0)::DOUBLE, 3) AS first, round(max(turn * 8 + 0.5) FILTER (n > 0)::DOUBLE, 3) AS last FROM w GROUP BY rec HAVING sum(n) > 0""",
    "loudness_gains": "SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 0.0 ELSE round(least(-23.0 + abs(c_acctbal) / 100, -1.0 + abs(c_acctbal) / 300), 6) END AS gain FROM customer",
    "faded_samples": """WITH f AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i, len(embedding) AS n FROM embeddings),
      g AS (SELECT vec_id, n, v * CASE WHEN i < 10 THEN 0.5 - 0.5 * cos(pi() * (i + 0.5) / 10) WHEN i >= n - 10 THEN 0.5 - 0.5 * cos(pi() * (n - 1 - i + 0.5) / 10) ELSE 1.0 END AS v FROM f)
      SELECT vec_id, any_value(n)::BIGINT + 6 AS n, round(max(abs(v)), 6) AS peak, round(sqrt(sum(v * v) / (any_value(n) + 6) + 1e-12), 6) AS rms FROM g GROUP BY vec_id""",
    "encoded_bigrams": r"""WITH toks AS (SELECT list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents), lex AS (SELECT word, count(*) AS n FROM (SELECT unnest(w) AS word FROM toks) GROUP BY word HAVING count(*) >= 5),
      ix AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS code FROM lex), bg AS (SELECT w[i] AS a, w[i + 1] AS b FROM (SELECT w, unnest(range(1, len(w))) AS i FROM toks)), bc AS (SELECT a, b, count(*) AS n FROM bg GROUP BY 1, 2 HAVING count(*) >= 3)
      SELECT x.code AS i, y.code AS j, n FROM bc JOIN ix x ON x.word = a JOIN ix y ON y.word = b""",
    "rotated_vectors": "WITH f AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) SELECT vec_id, round(sqrt(sum(v * v)), 5) AS norm, round(sum(v) FILTER (i <= 16) / 4, 5) AS first FROM f GROUP BY vec_id",
    "split_long_runs": f"""WITH RECURSIVE {FRAMES}, g AS (SELECT rec, k, t, t - row_number() OVER (PARTITION BY rec, k ORDER BY t) AS g FROM frames WHERE p <= 0.05),
      i AS (SELECT rec, k, min(t) AS a, max(t) + 1 AS b FROM g GROUP BY rec, k, g), l AS (SELECT rec, k, list({{'n': b - a, 'a': a, 'b': b}}) FILTER (b - a >= 2) AS gaps FROM i GROUP BY 1, 2),
      sp AS (SELECT rec, k, 0::BIGINT AS s, 720::BIGINT AS e, coalesce(gaps, []) AS gaps FROM l UNION ALL
        SELECT rec, k, CASE side WHEN 0 THEN s ELSE cut.b END, CASE side WHEN 0 THEN cut.a ELSE e END, gaps FROM (SELECT *, list_max(list_filter(gaps, lambda x: x.a > s AND x.b < e)) AS cut FROM sp WHERE e - s > 40), (SELECT unnest([0, 1]) AS side) WHERE cut IS NOT NULL)
      SELECT rec, k, s AS start, e AS "end" FROM sp WHERE e - s <= 40""",
    "prompt_texts": r"""WITH a AS (SELECT conv_id, turn, translate('Nice to meet you. ' || regexp_replace(text, '^ +| +$', '', 'g'), '（）' || chr(9), '() ') AS t FROM conversations), b AS (SELECT conv_id, turn, regexp_replace(regexp_replace(t, '[\r\n]', '', 'g'), '  +', ' ', 'g') AS t FROM a),
      c AS (SELECT conv_id, turn, trim(regexp_replace(regexp_replace(t, '([一-鿿])\s+', '\1', 'g'), '\s+([一-鿿])', '\1', 'g')) AS t FROM b)
      SELECT conv_id, turn, md5(CASE WHEN t = '' OR regexp_matches(t, '[;:,.!?…)\]}"''“”‘’；：，。！？、）】।॥]$') THEN t ELSE t || '।' END) AS digest FROM c""",
    "spelling_candidates": f"""WITH toks AS (SELECT list_filter(string_split_regex(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM documents), lex AS (SELECT word, count(*) AS n, {key_sql('any_value(word)')} AS k FROM (SELECT unnest(w) AS word FROM toks) WHERE regexp_matches(word, '^[a-z]+$') GROUP BY word),
      ky AS (SELECT word, n, CASE WHEN length(k) > 1 AND k LIKE '%a' THEN substr(k, 1, length(k) - 1) ELSE k END AS key FROM lex), lo AS (SELECT *, substr(key, 1, 1) || replace(substr(key, 2), 'a', '') AS loose FROM ky),
      ex AS (SELECT key, count(*) AS c, sum(n) AS s FROM lo GROUP BY key), al AS (SELECT loose, count(*) AS c, sum(n) AS s FROM lo GROUP BY loose)
      SELECT word AS typed, (CASE WHEN ex.c >= 3 THEN ex.c ELSE al.c END)::BIGINT AS n, (CASE WHEN ex.c >= 3 THEN ex.s ELSE al.s END)::BIGINT AS total FROM lo JOIN ex USING (key) JOIN al USING (loose)""",
    "probe_frames": "SELECT conv_id, turn, floor((turn * 0.37::DOUBLE) / 0.01::DOUBLE)::BIGINT AS first, ceil((turn * 0.37::DOUBLE + 0.111::DOUBLE) / 0.01::DOUBLE)::BIGINT AS last FROM conversations",
}
