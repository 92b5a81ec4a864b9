"""Queries of sample arithmetic, scripts, checkpoints, caches, weights and what else works on single values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import audio as au
from ..functions import scripts as sc
from ..functions import text as tx
from ..functions import vectors as vx
from ..operators import codebooks as cb
from ..operators import dataset as ds
from ..operators import evaluation as ev
from ..operators import frames as fr
from ..operators import lexicon as lx
from ..operators import ranking as rk
from ..operators import speakers as sp
from ..operators import typing as ty
from ..sources import ingest, manifests, transcripts
from ..sources.staging import staged
from .corpus_queries import DRAW, WEIGHED, key_sql, poisson
from .fixtures import CLIPS, FRAMES, RESULTS, ROUNDS, clips, frames, results, rounds, table


def _samples(spark, d) -> DataFrame:
    """Vectors as samples, quiet in a stretch that depends on the row."""
    e = table(spark, d, "embeddings")
    a = (F.col("vec_id") % 20).cast("int")
    return e.select("vec_id", F.transform("embedding", lambda x, i: F.when((i >= a) & (i < a + 24), x.cast("double") * 0.01).otherwise(x.cast("double"))).alias("x"))


def silence_ranges(spark, d):
    s = _samples(spark, d).withColumn("silent", au.silent_ranges(F.col("x"), 6, 0.02, 2))
    return s.select("vec_id", F.array_join(F.transform("silent", lambda r: F.concat_ws("-", r["start"], r["end"])), " ").alias("silent"))


def silence_removal(spark, d):
    s = _samples(spark, d).withColumn("sound", au.sound_ranges(F.col("x"), au.silent_ranges(F.col("x"), 6, 0.02, 2)))
    s = s.withColumn("kept", au.kept_ranges(F.col("sound"), F.size("x").cast("bigint"), 6))
    y = au.cut_ranges(F.col("x"), F.col("kept"))
    return s.select("vec_id", F.size("sound").cast("long").alias("n_sound"), F.size(y).cast("long").alias("n"), F.round(au.rms_of(y), 6).alias("rms"), au.leading_silence(F.col("x"), 0.02, 4).cast("long").alias("lead"))


def cross_faded(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.array(F.slice("embedding", 1, 20), F.slice("embedding", 21, 7), F.slice("embedding", 28, 30)).alias("c"))
    y = au.cross_fade(F.col("c"), 15)
    return e.select("vec_id", F.size(y).cast("long").alias("n"), F.round(F.aggregate(y, F.lit(0.0), lambda s, x: s + F.abs(x)), 6).alias("total"))


def peak_normalised(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", au.normalise_peak(F.when(F.col("vec_id") % 9 == 0, F.transform("embedding", lambda x: x * 0)).otherwise(F.col("embedding")), -1.0).alias("r"))
    return e.select("vec_id", F.round(au.peak(F.col("r.samples")), 6).alias("peak"), F.round("r.gain_db", 6).alias("gain_db"))


def clip_plans(spark, d):
    c = table(spark, d, "customer")
    start = F.abs("c_acctbal")
    measured = F.when(F.col("c_custkey") % 6 == 0, None).otherwise(-F.abs("c_acctbal") / 100)
    plan = au.clip_plan(start, start + F.col("c_custkey") % 12 + 0.25, 44100, 24000, measured, -F.abs("c_acctbal") / 300, -23.0, -1.0, 0.01, 0.05)
    return c.select("c_custkey", plan.alias("p")).select("c_custkey", "p.*").withColumn("gain_db", F.round("gain_db", 6))


def mono_means(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", au.mono_at(F.array("embedding", F.reverse("embedding")), F.lit(16000), 16000).alias("m"))
    return e.select("vec_id", F.round(F.element_at("m", 1), 6).alias("first"), F.round(F.element_at("m", 2), 6).alias("second"))


def frame_energies(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "x"))
    return fr.frame_energy(e.withColumn("x", F.col("x").cast("double")), ["vec_id"], "i", "x", 10).withColumn("db", F.round("db", 5))


def byte_curves(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 9), lambda x: F.abs(x.cast("double")) * 3).alias("v"))
    return e.select("vec_id", au.byte_codes(F.col("v")).alias("codes"))


def unpacked_weights(spark, d):
    book = F.array(*[F.lit((i - 7.5) * 8) for i in range(16)])
    e = table(spark, d, "embeddings").select("vec_id", F.transform(F.slice("embedding", 1, 16), lambda x: (F.abs(x.cast("double")) * 500).cast("int") % 256).alias("b"))
    w = vx.unpack_weights(F.col("b"), book, F.array(F.lit(1.3), F.lit(2.7)), F.lit(0.01), 16)
    return e.select("vec_id", F.size(w).cast("long").alias("n"), F.round(F.aggregate(w, F.lit(0.0), lambda s, x: s + x), 6).alias("total"))


def restored_rows(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", "embedding", vx.quantise_rows(F.col("embedding")).alias("q"))
    back = vx.dequantise_rows(F.col("q.scale"), F.col("q.q"))
    return e.select("vec_id", F.round(vx.relative_error(back, F.transform("embedding", lambda x: x.cast("double"))), 9).alias("error"))


def fitted_scales(spark, d):
    book = F.array(*[F.lit(float(i * abs(i)) / 64) for i in range(-8, 8)])
    e = table(spark, d, "embeddings").select("vec_id", cb.fitted_scale(F.transform(F.slice("embedding", 1, 16), lambda x: x.cast("double")), book).alias("f"))
    return e.select("vec_id", F.round("f.scale", 6).alias("scale"), F.array_join(F.transform("f.codes", lambda i: i.cast("string")), " ").alias("codes"))


def standard_features(spark, d):
    e = table(spark, d, "embeddings").select("label", F.posexplode("embedding").alias("m", "x")).withColumn("x", F.col("x").cast("double"))
    out = fr.standardise(e, ["label", "m"], "x")
    return out.groupBy("label", "m").agg(F.round(F.min("normal"), 5).alias("low"), F.round(F.max("normal"), 5).alias("high"))


def powerset_groups(spark, d):
    f = frames(spark, d).groupBy("rec", "t").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "p"))), lambda x: x["p"]).alias("p"))
    return f.select("rec", "t", fr.by_cardinality(F.col("p"), [[0, 0, 0], [1, 0, 0], [0, 1, 0], [1, 1, 0], [1, 1, 1]]).alias("g")).select("rec", "t", F.round("g.none", 6).alias("none"), F.round("g.one", 6).alias("one"), F.round("g.more", 6).alias("more"))


def dense_pool(spark, d):
    f = frames(spark, d)
    grid = f.where("t < 400").select("rec", "k", "t")
    return fr.max_pool_dense(f.where("t < 650"), grid, ["rec", "k"], "p").select("rec", "k", "t", F.round("p", 6).alias("p"))


def gender_means(spark, d):
    c = clips(spark, d).select("id", F.col("speaker").alias("local_speaker"), "duration")
    return sp.gender_mean(c, c.select("id", (F.col("duration") / 64).alias("p")))


def length_batches(spark, d):
    c = clips(spark, d).select("id", "duration")
    return rk.batches(c, F.col("duration"), 32, "id").groupBy("batch").agg(F.count("*").alias("n"), F.max("duration").alias("longest"))


def clip_similarities(spark, d):
    c = clips(spark, d).select("id", "speaker")
    scores = c.where("speaker % 2 = 0").select("id", (F.col("speaker") / 1000).alias("similarity"))
    ids = table(spark, d, "supplier").where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("local"), (F.col("s_suppkey") % 10 + 1000).alias("global"))
    return ds.map_speakers(c, ids, scores).groupBy("speaker").agg(F.count("*").alias("n"), F.count("speaker_similarity").alias("scored"), F.round(F.max("speaker_similarity"), 6).alias("most"))


def repeated_rows(spark, d):
    s = table(spark, d, "supplier")
    return ds.repeat_rows(s.select("s_suppkey"), (F.col("s_suppkey") % 3 + 1).cast("int")).select("s_suppkey", F.col("copy").cast("long").alias("copy"))


def listed_files(spark, d):
    p = table(spark, d, "pages").select(F.concat(F.lit("/c/"), F.col("page_id").cast("string")).alias("audio_path"), "page_id")
    checked = ds.require_files(p, p.select("audio_path"))
    return ds.missing_files(checked, p.where("page_id % 5 <> 0")).select("page_id")


def paired_intervals(spark, d):
    out = ev.paired_summary(results(spark, d), "click", "cer", "item")
    return out.select("model", "n", *[F.round(c, 6).alias(c) for c in ("mean", "low", "high", "win_rate")])


def whole_tally(spark, d):
    models = spark.createDataFrame([("click",), ("never",)], "model string")
    return ev.preference_tally(rounds(spark, d), models)


def both_ways(spark, d):
    return ev.pairwise(rounds(spark, d))


def chosen_checkpoints(spark, d):
    o = table(spark, d, "orders").select(F.concat(F.lit("/exp/checkpoint-"), F.col("o_orderkey").cast("string")).alias("path"))
    there = manifests.checkpoints(o.unionByName(o.limit(1).select(F.lit("/exp/checkpoint-x").alias("path"))))
    losses = table(spark, d, "orders").where("o_orderkey % 3 = 0").select(F.concat(F.lit("checkpoint-"), F.col("o_orderkey").cast("string")).alias("name"), (F.col("o_totalprice") % 97).alias("loss"))
    named = [("last", None), ("best", losses), ("checkpoint-3", None)]
    out = None
    for choice, scores in named:
        one = ev.choose_checkpoint(there, choice, scores).select(F.lit(choice).alias("choice"), "path", "step")
        out = one if out is None else out.unionByName(one)
    return out


def best_takes(spark, d):
    r = results(spark, d).select("model", F.col("item").alias("take"), "cer", (F.col("item") % 7 / 2.0).alias("utmos"))
    return ev.best_take(r, ["model"])


def config_entries(spark, d):
    n = table(spark, d, "nation").select(F.when(F.col("n_nationkey") % 2 == 0, "train").otherwise("dev").alias("part"), F.lit("npi").alias("language_id"), F.concat(F.lit("/t/"), "n_name").alias("path"), (F.col("n_nationkey") % 3).alias("repeat"), (F.col("n_regionkey")).alias("clips"))
    return manifests.data_config(n).select("part", F.size(F.from_json("entries", "array<struct<language_id:string>>")).cast("long").alias("n"))


def hub_names(spark, d):
    c = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("/h/models--org--m"), F.col("c_nationkey").cast("string"), F.lit("/snapshots/"), F.lower(F.hex("c_custkey")), F.lit("/x")).alias("p"))
    return c.select("c_custkey", manifests.hub_snapshot(F.col("p")).alias("s")).select("c_custkey", "s.id", "s.revision")


def row_documents(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", "n_name", F.when(F.col("n_regionkey") > 1, F.col("n_regionkey")).alias("region"))
    return manifests.documents(n, "n_nationkey", ["n_name", "region"])


def sidecar_objects(spark, d):
    e = table(spark, d, "events").select(F.concat(F.lit("/m/"), F.col("event_id").cast("string")).alias("path"), F.col("props").alias("text"), "event_id")
    rows = e.select("event_id", F.when(F.col("event_id") % 3 != 0, F.col("path")).alias("sidecar"))
    return ingest.sidecar_metadata(rows, e.select("path", "text")).select("event_id", F.size("meta").cast("long").alias("n"))


def plain_texts(spark, d):
    return transcripts.plain_text(table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("rec"), "text")).select("rec", F.md5("text").alias("digest"))


def chunk_plans(spark, d):
    c = table(spark, d, "documents").select("doc_id", "text", tx.estimated_frames(F.col("text")).alias("frames"))
    return c.select("doc_id", tx.chunk_length(F.col("text"), F.col("frames")).cast("long").alias("length"))


def bigram_context(spark, d):
    """Pairs the other way round, many of which never occur."""
    docs = table(spark, d, "documents")
    pairs = staged(lx.bigrams(docs).where("n >= 3"), "pairs")
    out = lx.context_scores(pairs.select(F.col("second").alias("first"), F.col("first").alias("second")), staged(lx.counts(lx.words(docs), 5), "lexicon"), pairs)
    return out.select("first", "second", "n", F.round("score", 6).alias("score"))


def romanised_words(spark, d):
    words = lx.counts(lx.words(table(spark, d, "documents"))).where(F.col("word").rlike("^[a-z]+$"))
    return words.select("word", sc.devanagari(F.col("word")).alias("script"), sc.latin(sc.devanagari(F.col("word"))).alias("back"))


def typed_texts(spark, d):
    """Conversations in Devanagari, with the documents' words as lexicon."""
    docs = table(spark, d, "documents").where("lang = 'en'")
    script = lambda c: sc.devanagari(F.col(c))
    lexicon = staged(lx.counts(lx.words(docs), 3).where(F.col("word").rlike("^[a-z]+$")).select(script("word").alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n")), "lexicon")
    pairs = lx.bigrams(docs).where("n >= 3").select(script("first").alias("first"), script("second").alias("second"), "n").groupBy("first", "second").agg(F.sum("n").alias("n"))
    texts = table(spark, d, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id"), "text")
    return ty.convert(texts, lexicon, staged(pairs, "pairs")).select("id", F.md5("text").alias("digest"), F.length("text").cast("long").alias("n"))


def typed_keys(spark, d):
    n = table(spark, d, "nation").select("n_nationkey", sc.typed_latin(F.concat(F.translate("n_name", "0123456789", "abcdefghij"), F.lit("~_\\"))).alias("latin"))
    return n.select("n_nationkey", "latin", tx.phonetic_key(F.col("latin")).alias("key"))


QUERIES = {
    f.__name__: f
    for f in (
        silence_ranges, silence_removal, cross_faded, peak_normalised, clip_plans, mono_means, frame_energies, byte_curves, unpacked_weights, restored_rows, fitted_scales, standard_features, powerset_groups, dense_pool, gender_means,
        length_batches, clip_similarities, repeated_rows, listed_files, paired_intervals, whole_tally, both_ways, chosen_checkpoints, best_takes, config_entries, hub_names, row_documents, sidecar_objects, plain_texts,
        chunk_plans, bigram_context, romanised_words, typed_keys, typed_texts,
    )
}

_SAMPLES = """
sm AS (SELECT vec_id, list_transform(embedding, lambda x, i: CASE WHEN i - 1 >= vec_id % 20 AND i - 1 < vec_id % 20 + 24 THEN x::DOUBLE * 0.01::DOUBLE ELSE x::DOUBLE END) AS x FROM embeddings),
st AS (SELECT vec_id, x, unnest(list_distinct(list_append(range(0, len(x) - 5, 2), len(x) - 6))) AS i FROM sm),
qt AS (SELECT vec_id, i FROM st WHERE sqrt(list_sum(list_transform(x[i + 1 : i + 6], lambda v: v * v)) / 6) <= 0.02::DOUBLE),
qn AS (SELECT *, CASE WHEN i - lag(i) OVER w <= 6 THEN 0 ELSE 1 END AS new FROM qt WINDOW w AS (PARTITION BY vec_id ORDER BY i)),
qg AS (SELECT *, sum(new) OVER (PARTITION BY vec_id ORDER BY i) AS g FROM qn),
si AS (SELECT vec_id, g, min(i) AS a, max(i) + 6 AS b FROM qg GROUP BY vec_id, g)
"""

ORACLES = {
    "silence_ranges": f"WITH {_SAMPLES} SELECT sm.vec_id, coalesce(string_agg(a || '-' || b, ' ' ORDER BY a), '') AS silent FROM sm LEFT JOIN si USING (vec_id) GROUP BY 1",
    "silence_removal": f"""WITH {_SAMPLES}, fl AS (SELECT vec_id, unnest(x) AS v, unnest(range(0, len(x))) AS i, len(x) AS n FROM sm),
      iv AS (SELECT vec_id, b AS a, coalesce(lead(a) OVER (PARTITION BY vec_id ORDER BY a), 1000000) AS b FROM si UNION ALL SELECT sm.vec_id, 0, coalesce((SELECT min(a) FROM si WHERE si.vec_id = sm.vec_id), 1000000) FROM sm),
      so AS (SELECT iv.vec_id, iv.a, least(iv.b, len(x)) AS b, len(x) AS n FROM iv JOIN sm USING (vec_id) WHERE iv.a < least(iv.b, len(x))),
      wd AS (SELECT *, a - 6 AS a2, b + 6 AS b2, lag(b + 6) OVER w AS pb, lead(a - 6) OVER w AS na FROM so WINDOW w AS (PARTITION BY vec_id ORDER BY a)),
      kp AS (SELECT vec_id, greatest(0, CASE WHEN a2 < pb THEN floor((pb + a2) / 2) ELSE a2 END) AS a, least(n, CASE WHEN na < b2 THEN floor((b2 + na) / 2) ELSE b2 END) AS b FROM wd),
      y AS (SELECT fl.vec_id, v FROM fl JOIN kp ON kp.vec_id = fl.vec_id AND i >= a AND i < b),
      ld AS (SELECT vec_id, i // 4 AS c, sqrt(avg(v * v)) >= 0.02::DOUBLE AS loud, any_value(n) AS n FROM fl GROUP BY 1, 2), le AS (SELECT vec_id, coalesce(min(c * 4) FILTER (loud), any_value(n)) AS lead FROM ld GROUP BY 1)
      SELECT sm.vec_id, (SELECT count(*) FROM so WHERE so.vec_id = sm.vec_id) AS n_sound, (SELECT count(*) FROM y WHERE y.vec_id = sm.vec_id) AS n, round((SELECT coalesce(sqrt(avg(v * v)), 0) FROM y WHERE y.vec_id = sm.vec_id), 6) AS rms, lead::BIGINT AS lead FROM sm JOIN le USING (vec_id)""",
    "cross_faded": """WITH f AS (SELECT vec_id, unnest(embedding[1:57])::DOUBLE AS v, unnest(range(0, 57)) AS i FROM embeddings),
      w AS (SELECT vec_id, abs(v * CASE WHEN i >= 15 AND i < 20 THEN 1 - (i - 15) / 4.0::DOUBLE WHEN i >= 20 AND i < 27 THEN CASE WHEN i < 25 THEN (i - 20) / 4.0::DOUBLE ELSE 1 END * CASE WHEN i >= 22 THEN 1 - (i - 22) / 4.0::DOUBLE ELSE 1 END WHEN i >= 27 AND i < 32 THEN (i - 27) / 4.0::DOUBLE ELSE 1 END) AS v FROM f)
      SELECT vec_id, 67::BIGINT AS n, round(sum(v), 6) AS total FROM w GROUP BY 1""",
    "peak_normalised": """WITH p AS (SELECT vec_id, list_max(list_transform(embedding, lambda x: abs(x::DOUBLE))) AS m FROM embeddings)
      SELECT vec_id, CASE WHEN vec_id % 9 = 0 THEN 0.0 ELSE round(pow(10.0, -1.0 / 20), 6) END AS peak, CASE WHEN vec_id % 9 = 0 THEN 0.0 ELSE round(-1.0 - 20 * log10(greatest(m, 1e-10)), 6) END AS gain_db FROM p""",
    "clip_plans": """WITH c AS (SELECT c_custkey, abs(c_acctbal)::DOUBLE AS s, (abs(c_acctbal) + c_custkey % 12 + 0.25)::DOUBLE AS e, CASE WHEN c_custkey % 6 = 0 THEN 0.0 ELSE round(least(-23.0 + abs(c_acctbal) / 100, -1.0 + abs(c_acctbal) / 300), 6) END AS g FROM customer),
      r AS (SELECT *, floor((e - s) * 44100)::BIGINT AS read FROM c), k AS (SELECT *, ceil(read * 24000 / 44100)::BIGINT AS kept FROM r)
      SELECT c_custkey, floor(s * 44100)::BIGINT AS "offset", read, kept + 2400 AS written, g AS gain_db, least(240, kept // 2)::BIGINT AS fade, 1200::BIGINT AS pad FROM k""",
    "mono_means": "SELECT vec_id, round((embedding[1]::DOUBLE + embedding[-1]::DOUBLE) / 2, 6) AS first, round((embedding[2]::DOUBLE + embedding[-2]::DOUBLE) / 2, 6) AS second FROM embeddings",
    "frame_energies": "WITH f AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, unnest(range(0, len(embedding))) AS i FROM embeddings) SELECT vec_id, i // 10 AS t, round(10 * log10(sum(v * v) / 10 + 1e-10), 5) AS db FROM f GROUP BY 1, 2",
    "byte_curves": """WITH b AS (SELECT vec_id, list_transform(embedding[1:9], lambda x: round_even(least(1.0::DOUBLE, greatest(0.0::DOUBLE, abs(x::DOUBLE) * 3)) * 255, 0)::INT) AS v FROM embeddings)
      SELECT vec_id, base64(unhex(array_to_string(list_transform(v, lambda x: printf('%02X', x)), ''))) AS codes FROM b""",
    "unpacked_weights": """WITH b AS (SELECT vec_id, unnest(range(0, 16)) AS i, unnest(list_transform(embedding[1:16], lambda x: trunc(abs(x::DOUBLE) * 500)::INT % 256)) AS b FROM embeddings),
      c AS (SELECT vec_id, 2 * i AS i, b & 15 AS c FROM b UNION ALL SELECT vec_id, 2 * i + 1, (b >> 4) & 15 FROM b)
      SELECT vec_id, count(*) AS n, round(sum(greatest(-127, least(127, round_even((c - 7.5::DOUBLE) * 8 * CASE WHEN i < 16 THEN 1.3::DOUBLE ELSE 2.7::DOUBLE END, 0))) * 0.01::DOUBLE), 6) AS total FROM c GROUP BY 1""",
    "restored_rows": """WITH f AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings), s AS (SELECT vec_id, greatest(max(abs(v)) / 127, 1e-30) AS scale FROM f GROUP BY 1), q AS (SELECT vec_id, v, greatest(-127, least(127, round_even(v / scale, 0)))::INT * scale AS w FROM f JOIN s USING (vec_id))
      SELECT vec_id, round(sqrt(sum((w - v) * (w - v)) / sum(v * v)), 9) AS error FROM q GROUP BY 1""",
    "fitted_scales": """WITH b AS (SELECT list_transform(range(-8, 8), lambda i: (i * abs(i))::DOUBLE / 64) AS book), e AS (SELECT vec_id, list_transform(embedding[1:16], lambda x: x::DOUBLE) AS v, book FROM embeddings, b),
      s0 AS (SELECT *, greatest(list_max(list_transform(v, lambda x: abs(x))), 1e-8::DOUBLE) AS s FROM e), c0 AS (SELECT *, list_transform(v, lambda x: list_min(list_transform(range(1, 17), lambda i: {'d': abs(book[i] - x / s), 'i': i})).i) AS c FROM s0),
      s1 AS (SELECT vec_id, v, book, greatest(list_sum(list_transform(range(1, 17), lambda i: v[i] * book[c[i]])) / greatest(list_sum(list_transform(c, lambda i: book[i] * book[i])), 1e-8::DOUBLE), 1e-8::DOUBLE) AS s FROM c0), c1 AS (SELECT *, list_transform(v, lambda x: list_min(list_transform(range(1, 17), lambda i: {'d': abs(book[i] - x / s), 'i': i})).i) AS c FROM s1),
      s2 AS (SELECT vec_id, v, book, greatest(list_sum(list_transform(range(1, 17), lambda i: v[i] * book[c[i]])) / greatest(list_sum(list_transform(c, lambda i: book[i] * book[i])), 1e-8::DOUBLE), 1e-8::DOUBLE) AS s FROM c1), c2 AS (SELECT *, list_transform(v, lambda x: list_min(list_transform(range(1, 17), lambda i: {'d': abs(book[i] - x / s), 'i': i})).i) AS c FROM s2)
      SELECT vec_id, round(s, 6) AS scale, array_to_string(list_transform(c, lambda i: i - 1), ' ') AS codes FROM c2""",
    "standard_features": """WITH f AS (SELECT label, unnest(embedding)::DOUBLE AS v, unnest(range(0, len(embedding))) AS m FROM embeddings), s AS (SELECT label, m, avg(v) AS a, sqrt(greatest(coalesce(var_samp(v), 0), pow(2.0, -24))) + 1e-5 AS d FROM f GROUP BY 1, 2)
      SELECT label, m, round(min((v - a) / d), 5) AS low, round(max((v - a) / d), 5) AS high FROM f JOIN s USING (label, m) GROUP BY 1, 2""",
    "powerset_groups": f"WITH {FRAMES} SELECT rec, t, round(sum(p) FILTER (k = 0), 6) AS none, round(sum(p) FILTER (k IN (1, 2)), 6) AS one, round(sum(p) FILTER (k > 2), 6) AS more FROM frames GROUP BY 1, 2",
    "dense_pool": f"WITH {FRAMES}, m AS (SELECT rec, k, t // 2 AS t, max(p) AS p FROM frames WHERE t < 650 GROUP BY 1, 2, 3) SELECT f.rec, f.k, f.t, round(coalesce(m.p, 0), 6) AS p FROM frames f LEFT JOIN m ON m.rec = f.rec AND m.k = f.k AND m.t = f.t WHERE f.t < 400",
    "gender_means": f"WITH {CLIPS}, r AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY duration DESC, id) AS r FROM clips) SELECT speaker AS local_speaker, round(avg(duration / 64), 3) AS p_female FROM r WHERE r <= 8 GROUP BY 1",
    "length_batches": f"WITH {CLIPS}, r AS (SELECT duration, (row_number() OVER (ORDER BY duration, id) - 1) // 32 AS batch FROM clips) SELECT batch, count(*) AS n, max(duration) AS longest FROM r GROUP BY 1",
    "clip_similarities": f"WITH {CLIPS} SELECT CASE WHEN s_suppkey IS NULL THEN speaker ELSE speaker % 10 + 1000 END AS speaker, count(*) AS n, count(*) FILTER (speaker % 2 = 0) AS scored, round(max(speaker / 1000) FILTER (speaker % 2 = 0), 6) AS most FROM clips LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 4 <> 0) ON s_suppkey = speaker GROUP BY 1",
    "repeated_rows": "SELECT s_suppkey, unnest(range(1, s_suppkey % 3 + 2)) AS copy FROM supplier",
    "listed_files": "SELECT page_id FROM pages WHERE page_id % 5 = 0",
    "paired_intervals": f"""WITH {RESULTS}, pr AS (SELECT r.model, r.item, r.cer - b.cer AS d FROM results r JOIN results b ON b.model = 'click' AND b.item = r.item WHERE r.model <> 'click'),
      dw AS (SELECT model, d, r.range AS r, {DRAW.format("'0:' || r.range || ':' || item || ':' || model")} AS u FROM pr, range(2000) r), w AS (SELECT *, {poisson("u")} AS w FROM dw), m AS (SELECT model, r, sum(w * d) / sum(w) AS m FROM w GROUP BY 1, 2 HAVING sum(w) > 0),
      ci AS (SELECT model, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM m GROUP BY 1)
      SELECT model, count(*) AS n, round(avg(d), 6) AS mean, round(any_value(low), 6) AS low, round(any_value(high), 6) AS high, round(avg((d < 0)::INT), 6) AS win_rate FROM pr JOIN ci USING (model) GROUP BY 1""",
    "whole_tally": f"""WITH {ROUNDS}, s AS (SELECT vote, slot, model FROM rounds JOIN re USING (round_id) WHERE blind AND vote IS NOT NULL), t AS (SELECT model, count(*) FILTER (slot = vote) AS wins, count(*) AS played, count(*) FILTER (vote = 'tie') AS ties FROM s GROUP BY 1)
      SELECT *, round(wins / played, 3) AS win_rate FROM t UNION ALL SELECT 'never', 0, 0, 0, NULL""",
    "both_ways": f"""WITH {ROUNDS}, s AS (SELECT * FROM rounds JOIN re USING (round_id) WHERE blind AND vote IS NOT NULL AND vote <> 'tie'), p AS (SELECT a.model AS w, b.model AS l, count(*) AS n FROM s a JOIN s b ON a.round_id = b.round_id AND a.slot = a.vote AND b.slot <> b.vote AND a.model <> b.model GROUP BY 1, 2)
      SELECT model, other, sum(wins)::BIGINT AS wins, sum(losses)::BIGINT AS losses FROM (SELECT w AS model, l AS other, n AS wins, 0 AS losses FROM p UNION ALL SELECT l, w, 0, n FROM p) GROUP BY 1, 2""",
    "chosen_checkpoints": """WITH b AS (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 = 0 ORDER BY o_totalprice % 97, o_orderkey LIMIT 1), c AS (SELECT 'last' AS choice, max(o_orderkey) AS k FROM orders UNION ALL SELECT 'best', k FROM b UNION ALL SELECT 'checkpoint-3', 3)
      SELECT choice, '/exp/checkpoint-' || k AS path, k AS step FROM c""",
    "best_takes": f"WITH {RESULTS} SELECT model, item AS take FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY round(cer, 3), -(item % 7 / 2.0), item) AS r FROM results) WHERE r = 1",
    "config_entries": "SELECT CASE WHEN n_nationkey % 2 = 0 THEN 'train' ELSE 'dev' END AS part, count(*) AS n FROM nation WHERE n_regionkey > 0 GROUP BY 1",
    "hub_names": "SELECT c_custkey, 'org/m' || c_nationkey AS id, lower(to_hex(c_custkey)) AS revision FROM customer",
    "row_documents": """SELECT n_nationkey, '{"n_name":"' || n_name || '","region":' || CASE WHEN n_regionkey > 1 THEN n_regionkey::VARCHAR ELSE 'null' END || '}' AS document FROM nation""",
    "sidecar_objects": "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE len(json_keys(props::JSON)) END::BIGINT AS n FROM events",
    "chunk_plans": WEIGHED + " SELECT doc_id, CASE WHEN frames > 750 THEN floor(375.0::DOUBLE / (frames / n))::BIGINT END AS length FROM est",
    "typed_keys": f"""WITH n AS (SELECT n_nationkey, replace(replace(replace(replace(translate(n_name, '0123456789', 'abcdefghij'), 'R', 'ri'), 'M', 'n'), 'H', 'h'), '_', '') AS latin FROM nation), k AS (SELECT *, {key_sql('latin')} AS k FROM n)
      SELECT n_nationkey, latin, CASE WHEN length(k) > 1 AND k LIKE '%a' THEN substr(k, 1, length(k) - 1) ELSE k END AS key FROM k""",
    "plain_texts": r"SELECT conv_id || '-' || turn AS rec, md5(array_to_string(list_filter(string_split_regex(text, '\s+'), lambda w: w <> ''), ' ')) AS digest FROM conversations",

}

