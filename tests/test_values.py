"""Scripts, names, caches, files and ranks that no SQL states."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from voxlath.functions import scripts
from voxlath.operators import dataset, evaluation, lexicon, ranking, segments, speakers
from voxlath.sources import ingest, manifests


def test_romanised_words_and_back():
    said = {"paanii": "पानी", "namaste": "नमस्ते", "kSha": "क्ष", "Kathmandu": "कथ्मन्दु", "gy\\": "ज्ञ्", "k_h": "क्ह", "a.": "अ।", "3.5|": "३.५।", "{ok} ka": "ok क", "||": "॥", "aM": "अं"}
    assert {k: scripts.devanagari_of(k) for k in said} == said
    back = {"पानी": "paanii", "नमस्ते": "namaste", "ज्ञान": "gyaana", "ज़ू": "juu", "क़": "ka", "आउँछु": "aaunchhu", "x1": ""}
    assert {k: scripts.latin_of(k) for k in back} == back


def test_lexicon_files(spark, tmp_path):
    (tmp_path / "lexicon.tsv").write_text("b\t2\na\t2\nc\n\t9\nb\t5\n", encoding="utf-8")
    (tmp_path / "bigrams.tsv").write_text("a\tb\t3\nb\tx\t1\nbad line\nc\ta\t2\n", encoding="utf-8")
    words = lexicon.index(lexicon.read_lexicon(spark, str(tmp_path / "lexicon.tsv")))
    lexicon.write_lexicon(words, str(tmp_path / "out"))
    pairs = lexicon.encode_bigrams(lexicon.read_bigrams(spark, str(tmp_path / "bigrams.tsv")), words)
    lexicon.write_bigrams(pairs, str(tmp_path / "pairs"))
    lines = lambda name: "".join(p.read_text() for p in sorted((tmp_path / name).glob("part-*"))).split("\n")[:-1]
    assert lines("out") == ["b\t5", "a\t2", "c\t1"] and lines("pairs") == ["1\t0\t3", "2\t1\t2"]


def test_detector_cache_replaces_recordings(spark, tmp_path):
    cache = manifests.DetectorCache(spark, str(tmp_path), "diar")
    rows = spark.createDataFrame([("a", 0, 0.5), ("a", 1, 0.6), ("b", 0, 0.7)], "rec string, t long, p double")
    cache.put(rows, F.lit("v1"))
    cache.put(rows.where("rec = 'a' and t = 0"), F.lit("v2"))
    assert sorted(tuple(r) for r in cache.get().collect()) == [("a", 0, 0.5), ("b", 0, 0.7)]
    wanted = spark.createDataFrame([("a", "v1"), ("b", "v1")], "rec string, fingerprint string")
    assert [tuple(r) for r in cache.get(wanted).collect()] == [("b", 0, 0.7)]


def test_missing_things_raise(spark):
    rows = spark.createDataFrame([("x",), ("y",)], "audio_path string")
    with pytest.raises(Exception, match="listed but missing: y"):
        dataset.require_files(rows, rows.where("audio_path = 'x'")).collect()
    with pytest.raises(Exception, match="no checkpoint"):
        evaluation.choose_checkpoint(spark.createDataFrame([], "path string, step long"), "last").collect()
    sidecars = spark.createDataFrame([("p", "[1]")], "path string, text string")
    with pytest.raises(Exception, match="must hold a JSON object"):
        ingest.sidecar_metadata(spark.createDataFrame([("p",)], "sidecar string"), sidecars).collect()


def test_places_and_links(spark):
    rows = spark.createDataFrame([(i * 7919 % 1000,) for i in range(1000)], "x long")
    assert [r["place"] for r in ranking.placed(rows, [F.col("x").desc()]).orderBy(F.col("x").desc()).collect()] == list(range(1000))
    points = [(f"n{i}", [1.0, 0.0] if i % 3 else [0.0, 1.0]) for i in range(40)]
    links = speakers.near_links(spark.createDataFrame(points, "local_speaker string, centroid array<double>"), 0.9, block=7).collect()
    assert all((int(r["u"][1:]) % 3 == 0) == (int(r["v"][1:]) % 3 == 0) for r in links)
    found = speakers.connected(spark.createDataFrame([(r["u"], r["v"]) for r in links], "u string, v string")).collect()
    assert len(found) == 40 and len({r["component"] for r in found}) == 2


def test_stable_ids_take_turns(spark):
    members = spark.createDataFrame([("a", 0, 9.0, 0), ("b", 0, 1.0, 0), ("c", 1, 8.0, 1), ("d", 2, 7.0, 2), ("e", 3, 1.0, 3)], "local_speaker string, cluster long, seconds double, rank long")
    previous = spark.createDataFrame([("a", "S0001"), ("b", "S0002"), ("c", "S0001"), ("d", "S0001")], "local_speaker string, speaker string")
    got = {r["cluster"]: r["speaker"] for r in speakers.stable_ids(members, previous).collect()}
    assert got == {0: "S0001", 1: "S0003", 2: "S0004", 3: "S0005"}


def test_words_are_chosen_after_the_word_before(spark):
    import math

    from voxlath.functions import text as tx
    from voxlath.operators import typing

    freq = {"पानी": 3, "पनि": 40, "नेपाल": 20, "राम्रो": 9, "रमरो": 8, "छ": 50, "चा": 5, "पनी": 2, "घर": 12, "घरे": 4}
    pairs = {("घर", "पानी"): 30, ("नेपाल", "राम्रो"): 4, ("पनि", "छ"): 20, ("राम्रो", "छ"): 6}
    texts = ["pani", "ghar pani cha.", "Nepal ramro cha, ghar pani", "gh_ar {pani} pani", "ghar, pani 12", "", "ramro ramro  cha"]
    light = lambda w: spark.createDataFrame([(w,)], "w string").select(tx.light_spelling(F.col("w"))).first()[0]
    keys = {w: spark.createDataFrame([(scripts.latin_of(w),)], "w string").select(tx.phonetic_key(F.col("w"))).first()[0] for w in freq}
    total = sum(freq.values()) + len(freq) + 1

    def logp(w, prev):
        p = (freq.get(w, 0) + 1) / total
        return math.log(p) + (0 if prev is None else math.log((pairs.get((prev, w), 0) + 1) / (freq.get(prev, 0) * p + 1)))

    def plain(text):
        import re

        out, prev = "", None
        for t in re.findall(typing.TOKEN, text):
            if t.startswith("{") and len(t) > 1:
                out, prev = out + t[1:-1], None
            elif re.match(typing.WORD, t):
                w = t.lower() if re.match(typing.CAPITALISED, t) else t
                strict = scripts.devanagari_of(w, False, False)
                if re.search(typing.EXACT, w):
                    best = strict
                else:
                    key = spark.createDataFrame([(w,)], "w string").select(tx.phonetic_key(F.col("w"))).first()[0]
                    loose = lambda k: k[:1] + k[1:].replace("a", "")
                    found = [x for x in freq if keys[x] == key]
                    found += [x for x in freq if loose(keys[x]) == loose(key) and x not in found] if len(found) < 3 else []
                    found = {*found, strict}
                    cost = {x: float(tx.typing_costs([light(w)], [light(scripts.latin_of(x))])[0]) for x in found}
                    top = sorted(found, key=lambda x: (-(logp(x, None) - cost[x]), x))[:8]
                    best = min(top, key=lambda x: (-(logp(x, prev) - cost[x]), top.index(x)))
                out, prev = out + best, best
            else:
                out += scripts.devanagari_of(t)
                prev = prev if t.isspace() else None
        return out

    lex = spark.createDataFrame(list(freq.items()), "word string, n long")
    two = spark.createDataFrame([(*k, v) for k, v in pairs.items()], "first string, second string, n long")
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {r["id"]: r["text"] for r in typing.convert(rows, lex, two).collect()}
    assert got == {i: plain(t) for i, t in enumerate(texts)}
    assert got[1].startswith("घर पानी") and got[0] == "पनि"
    assert {r["id"]: r["text"] for r in typing.convert(rows.where("id = 0"), lex, two, {"pani": "X"}).collect()} == {0: "X"}


def test_mean_of_a_clip_is_the_same_in_any_order_of_frames(spark):
    p = [0.3147, 0.1213, 0.0, 0.22699999999999998, 0.0, 0.0, 0.0, 0.5490999999999999]  # 0.1515125 in this order, less in others
    clips = spark.createDataFrame([(0, 1, 4, 12, 4, 12), (0, 2, 4, 6, 5, 5)], "rec long, k long, start long, end long, speech_start long, speech_end long")
    for order in (range(8), (2, 3, 7, 4, 5, 6, 0, 1), (7, 3, 1, 0, 2, 4, 5, 6)):
        frames = spark.createDataFrame([(0, k, 4 + t, p[t], 0.5) for k in (1, 2) for t in order], "rec long, k long, t long, p double, other double").coalesce(1)
        got = {r["k"]: (r["mean_p"], r["max_other"]) for r in segments.segment_scores(clips.coalesce(1), frames.hint("broadcast"), ["other"]).collect()}
        assert got == {1: (0.1515125, 0.5), 2: (None, 0.5)}
        got = {r["k"]: r["mean_p"] for r in segments.segment_scores(clips.hint("broadcast"), frames, ["other"]).collect()}
        assert got == {1: 0.1515125, 2: None}
