"""Small scenarios with known answers for operators that no SQL counterpart covers."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxlath.functions import audio as au
from voxlath.functions import text as tx
from voxlath.functions import vectors as vx
from voxlath.operators import assignment, codebooks, dataset, evaluation, frames, segments, speakers
from voxlath.plans import config
from voxlath.sources import ingest, manifests, providers, transcripts
from voxlath.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_dilation_stops_at_barriers(spark):
    rows = spark.createDataFrame([("r", t, t == 5, t in (7, 8)) for t in range(12)], "rec string, t long, m boolean, b boolean")
    wide = {r["t"] for r in frames.dilate_within(rows, ["rec"], "m", "b", 4, "w").where("w").collect()}
    assert wide == {1, 2, 3, 4, 5, 6}
    assert {r["t"] for r in frames.dilate(rows, ["rec"], "m", 2, "w").where("w").collect()} == {3, 4, 5, 6, 7}
    assert frames.dilate(rows, ["rec"], "m", 0, "w").where("w").count() == 1


def test_isolated_detection_in_a_pause_is_padded_and_smear_is_not(spark):
    def unsafe(foreign, strong):
        data = [("r", 0, t, t in foreign, 20 <= t < 40, 9.0 if t in strong else 2.0 if t in foreign else 0.0) for t in range(60)]
        rows = spark.createDataFrame(data, "rec string, k int, t long, foreign boolean, barrier boolean, strength double")
        return {r["t"] for r in frames.padded_foreign(rows, 3, 2, 8.0).where("unsafe").collect()}

    assert unsafe({30}, set()) == set(range(27, 34))
    smeared = unsafe({17, 18, 19, 21, 40}, {17, 18, 19})
    assert smeared == {14, 15, 16, 17, 18, 19}


def test_long_pieces_split_at_the_longest_gap(spark):
    spans = [(0, 10, []), (1, 50, []), (2, 30, [(10, 14), (20, 23)]), (3, 30, [(10, 13), (20, 23)]), (4, 60, [(1, 9), (20, 26), (40, 45)])]
    rows = spark.createDataFrame([(i, 0, end, gaps) for i, end, gaps in spans], "i int, start long, end long, gaps array<struct<start: long, end: long>>")
    got = segments.split_long_spans(rows, ["i"], 20, 2).collect()
    assert sorted(tuple(r) for r in got) == [(0, 0, 10), (2, 0, 10), (2, 14, 30), (3, 0, 20), (3, 23, 30), (4, 0, 1), (4, 9, 20), (4, 26, 40), (4, 45, 60)]


def test_matching_is_optimal_before_the_threshold(spark):
    crossed = spark.createDataFrame([("r", 0, 0, 0, 5.0), ("r", 0, 0, 1, 4.0), ("r", 0, 1, 0, 4.5), ("r", 0, 1, 1, 0.1), ("r", 1, 7, 3, 1.0), ("r", 1, 7, 5, 2.0)], "rec string, w long, l long, k long, score double")
    assert sorted(tuple(r) for r in assignment.assign(crossed).collect()) == [("r", 0, 0, 1), ("r", 0, 1, 0), ("r", 1, 7, 5)]
    rows = spark.createDataFrame([("r", 0, 0, 0, 5.0), ("r", 0, 0, 1, 0.2), ("r", 0, 1, 0, 4.0), ("r", 0, 1, 1, 0.4)], "rec string, w long, l long, k long, score double")
    assert [(r["l"], r["k"]) for r in assignment.assign(rows).collect()] == [(0, 0)]


def test_rolling_captions_and_bom(spark):
    text = "WEBVTT\n\n00:00:01.000 --> 00:00:02.000\none <c>two</c>\n\n00:00:02.000 --> 00:00:03.000\none two\nthree\n\n00:00:03.000 --> 00:00:04.000\nthree\nfour"
    files = spark.createDataFrame([("r", text)], "rec string, text string")
    assert [r["text"] for r in transcripts.cues(files).orderBy("i").collect()] == ["one two", "three", "four"]
    words = transcripts.word_times(transcripts.cue_words(transcripts.cues(files))).orderBy("start").collect()
    assert [(r["text"], round(r["start"], 2), round(r["end"], 2)) for r in words] == [("one", 1.0, 1.5), ("two", 1.5, 2.0), ("three", 2.0, 3.0), ("four", 3.0, 4.0)]


def test_word_ends(spark):
    j = '{"events":[{"tStartMs":1000,"dDurationMs":2000,"segs":[{"utf8":">> a"},{"utf8":" b","tOffsetMs":600}]},{"tStartMs":5},{"tStartMs":2600,"segs":[{"utf8":"c"}]}]}'
    rows = transcripts.word_times(transcripts.timed_text_words(spark.createDataFrame([("r", j)], "rec string, text string"))).orderBy("start").collect()
    assert [(r["text"], r["start"], round(r["end"], 3)) for r in rows] == [("a", 1.0, 1.6), ("b", 1.6, 2.6), ("c", 2.6, 2.65)]


def test_average_linkage_cuts_inclusively():
    v = np.array([[1, 0, 0], [0.99, 0.14, 0], [0, 1, 0], [0, 0.98, 0.2], [0, 0, 1.0]])
    assert speakers.average_linkage(v, 0.2).tolist() == [0, 0, 2, 2, 4]


def test_clusters_and_stable_ids(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(3, 16))
    rows = [(f"{s}_{i}", 20.0 if i else 1.0, (base[s] + rng.normal(scale=0.02, size=16)).tolist()) for s in range(3) for i in range(3)]
    prints = spark.createDataFrame(rows, "local_speaker string, seconds double, centroid array<double>").withColumn("centroid", vx.unit(F.col("centroid")))
    got = {r["local_speaker"]: r["cluster"] for r in speakers.clusters(prints, 0.8, 10.0).collect()}
    assert got == {f"{s}_{i}": f"{s}_{1 if i else 0}" for s in range(3) for i in range(3)}
    members = spark.createDataFrame([("a", 0, 30.0, 1), ("b", 1, 50.0, 0), ("c", 1, 5.0, 0), ("d", 2, 3.0, 2)], "local_speaker string, cluster long, seconds double, rank int")
    previous = spark.createDataFrame([("a", "S0002"), ("b", "S0002"), ("c", "S0001")], "local_speaker string, speaker string")
    assert {r["cluster"]: r["speaker"] for r in speakers.stable_ids(members, previous).collect()} == {1: "S0002", 0: "S0003", 2: "S0004"}


def test_cap_is_exact_and_spread(spark):
    rows = spark.createDataFrame([(f"{r}-{i}", "s", f"r{r}", 10.0, "x") for r in range(6) for i in range(50)], "id string, speaker string, recording string, duration double, text string")
    kept = dataset.cap_speakers(rows, 1800.0)
    per = [r["count"] for r in kept.groupBy("recording").count().collect()]
    assert sum(per) == 180 and max(per) - min(per) <= 1
    sevens = spark.createDataFrame([(str(i), "s", "r", 7.0, "x") for i in range(100)], rows.schema)
    assert dataset.cap_speakers(sevens, 100.0).count() == 14


def test_held_out_recordings_are_whole(spark):
    rows = spark.createDataFrame([(f"{r}-{i}", "s", f"r{r}", 1.0, "x") for r in range(12) for i in range(4)], "id string, speaker string, recording string, duration double, text string")
    out = dataset.hold_out(rows, 0.2)
    dev, train = ({r["recording"] for r in out.where(F.col("split") == s).collect()} for s in ("dev", "train"))
    assert len(dev) == 2 and not dev & train
    assert dataset.hold_out(rows, 0.01).where("split = 'dev'").select("recording").distinct().count() == 1


def test_error_rates(spark):
    assert one(spark, tx.character_error_rate(F.lit("a b c"), F.lit("abc"))) == 0
    assert one(spark, tx.word_error_rate(F.lit("one two three"), F.lit("one too three"))) == pytest.approx(1 / 3)
    assert one(spark, tx.word_error_rate(F.lit(""), F.lit("x"))) == 1
    assert one(spark, tx.normalise(F.lit("Ｋए​क,  É।"), compose=True)) == "ｋएक é"


def test_spelling(spark):
    assert one(spark, tx.phonetic_key(F.lit("Chhora"))) == "cor"
    assert one(spark, tx.loose_key(F.lit("namaste"))) == "nmste"
    assert tx.typing_costs(["nmste", "ab", ""], ["namaste", "b", "xa"]).tolist() == [1.0, 5.0, 1.5]
    assert one(spark, tx.safe_id(F.lit("..a b/नमस्ते.x_"))) == "a_b_नमस_त_.x"
    assert one(spark, tx.timestamp_seconds(F.lit("1:02:03,5"))) == 3723.5 and one(spark, tx.timestamp_seconds(F.lit("x"))) is None
    assert tx.chunks("Mr. X ran. He fell! Ok", 10) == ["Mr. X ran.", "He fell!", "Ok"]


def test_votes_count_once(spark):
    slots = "array(named_struct('slot','A','model','m'), named_struct('slot','B','model','n'))"
    rounds = spark.sql(f"select 1 round_id, true blind, {slots} slots, cast(null as string) vote union all select 2, true, {slots}, 'A' union all select 3, false, {slots}, null")
    votes = spark.createDataFrame([(1, "A", 9), (1, "B", 2), (1, "C", 1), (2, "B", 1), (3, "A", 1)], "round_id int, vote string, at int")
    out = evaluation.apply_votes(rounds, votes)
    assert {r["round_id"]: r["vote"] for r in out.collect()} == {1: "B", 2: "A", 3: None}
    assert out.where("round_id = 3").select(evaluation.mask_slots(F.col("slots"), F.lit(True), F.col("vote"))[0]["model"]).first()[0] is None
    tally = {r["model"]: (r["wins"], r["played"]) for r in evaluation.preference_tally(out).collect()}
    assert tally == {"m": (1, 2), "n": (1, 2)}


def test_bootstrap_brackets_the_mean(spark):
    rows = spark.createDataFrame([("m", i, float(i % 10)) for i in range(200)] + [("m", 999, float("nan"))], "model string, item long, cer double")
    r = evaluation.bootstrap(rows, "cer", ["model"], "item", 300).first()
    assert r["n"] == 200 and r["low"] < r["mean"] == 4.5 < r["high"] and r["high"] - r["low"] < 1.5


def test_settings(tmp_path):
    file = tmp_path / "a.toml"
    file.write_text('[select]\npad = 1\nother_threshold = "off"\n[dataset]\nrepeat = {a = 2}\n')
    s = config.load([str(file)], ["select.min_words=3", "dataset.repeat={b = 1}"])
    assert s.select.pad == 1.0 and s.select.other_threshold is None and s.select.min_words == 3 and s.dataset.repeat == {"a": 2, "b": 1}
    again = tmp_path / "b.toml"
    again.write_text(config.to_toml(s))
    assert config.load([str(again)]) == s and config.fingerprint(s) == config.fingerprint(config.load([str(again)]))
    for bad in ("select.nothing=1", "nowhere.x=1", "select.pad='x'", "pad=1"):
        with pytest.raises(ValueError):
            config.load([], [bad])
    assert config.steps("select", "embed") == ["select", "export", "embed"] and config.steps(only=["splits", "detect"]) == ["detect", "splits"]
    with pytest.raises(ValueError):
        config.steps("embed", "select")


def test_folder_pairing(spark, tmp_path):
    for name in ("a b.WAV", "a b.srt", "a b.json3", "c.flac", "sub/d.mp3", "sub/d.txt", "sub/d.json", "note.md"):
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text("x")
    rows = ingest.recordings(ingest.listing(spark, str(tmp_path)))
    assert {(r["id"], r["kind"], r["sidecar"] is not None) for r in rows.collect()} == {("a_b", "json3", False), ("c", None, False), ("d", "txt", True)}
    assert ingest.orphans(rows).count() == 1 and ingest.duplicates(rows.union(rows)).count() == 3
    with pytest.raises(Exception, match="duplicate id"):
        ingest.require_unique(rows.union(rows)).collect()


def test_provider_errors_become_rows(spark):
    import pandas as pd

    def fake(row):
        if row["rec"].iloc[0] == "bad":
            raise ValueError("no audio")
        return pd.DataFrame({"rec": row["rec"], "t": [0], "db": [-20.0]})

    out = providers.run(spark.createDataFrame([("good",), ("bad",)], "rec string"), fake, providers.ENERGY)
    assert providers.good(out).count() == 1
    assert out.where("error is not null").first()["error"] == "ValueError: no audio"


def test_stream_resumes_and_invalidates(spark, tmp_path):
    schema = "id string, size long, modified long, transcript_sha1 string"
    inbox, seen = str(tmp_path / "in"), []
    catalog = incremental.Catalog(spark, f"file://{tmp_path}/catalog", schema)

    def handle(batch, number):
        seen.append({r["id"]: r["stage"] for r in catalog.merge(batch, number).collect()})

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        incremental.follow(spark, inbox, schema, str(tmp_path / "cp"), handle).awaitTermination()

    feed([("a", 1, 1, "x"), ("b", 1, 1, "x")])
    feed([("a", 1, 1, "y"), ("c", 5, 2, "z"), ("b", 1, 1, "x")])
    assert seen == [{"a": "detect", "b": "detect"}, {"a": "select", "b": "none", "c": "detect"}]
    assert catalog.read().count() == 3


def test_codes_and_levels(spark, tmp_path):
    book = codebooks.lloyd_max(np.array([0.0, 0.1, 1.0, 1.1, 5.0]), 3)
    assert np.allclose(book, [0.05, 1.05, 5.0])
    rows = spark.createDataFrame([([1.1, 0.0],), ([0.0, 2.2],)], "v array<double>")
    got = codebooks.residual_codes(rows, "v", [[[1.0, 0.0], [0.0, 2.0]], [[0.0, 0.0], [0.1, 0.0], [0.0, 0.2]]])
    assert [r["codes"] for r in got.collect()] == [[0, 1], [1, 2]]
    assert one(spark, au.peak_gain(F.array(F.lit(0.0)), -1.0)) == 0 and one(spark, au.peak_gain(F.array(F.lit(0.5)), 0.0)) == pytest.approx(6.0206, abs=1e-3)
    assert sum(one(spark, au.unmask_schedule(F.lit(100), 8))) == 100
    assert one(spark, au.quietest_cut(F.array(*[F.lit(x) for x in (5.0, 3.0, 1.0, 1.0, 0.5)]), 1, 4)) == 2
    packed = vx.unpack_nibbles(F.array(F.lit(0x21), F.lit(0x03)), F.array(*[F.lit(float(i)) for i in range(16)]), F.lit(0.5))
    assert one(spark, packed) == [0.5, 1.0, 1.5, 0.0]
    assert one(spark, au.mono(F.array(F.array(F.lit(1.0), F.lit(2.0)), F.array(F.lit(3.0), F.lit(4.0))))) == [2.0, 3.0]
    manifests.write_lines(spark.createDataFrame([("a", "p", "t")], "id string, audio_path string, text string"), str(tmp_path / "m"))
    assert manifests.read_lines(spark, str(tmp_path / "m")).count() == 1 and manifests.read_lines(spark, str(tmp_path / "none")).count() == 0
