from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from voxlath.llm import toxic_crf


def enumerated(e, step, start):
    total, out = 0.0, np.zeros(len(e))
    for y in itertools.product((0, 1), repeat=len(e)):
        w = np.exp(start[y[0]] + sum(a * b for a, b in zip(e, y)) + sum(step[a, b] for a, b in zip(y, y[1:])))
        total += w
        out += w * np.array(y)
    return out / total


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    counts = np.array([4, 0, 1, 7])
    e, step, start = rng.normal(size=12) * 2, rng.normal(size=(2, 2)), rng.normal(size=2)
    p, pair = toxic_crf.marginals(e, *toxic_crf._edges(counts), step, start)
    want = np.concatenate([enumerated(e[a:b], step, start) for a, b in ((0, 4), (4, 5), (5, 12))])
    assert np.allclose(p, want)
    assert np.allclose(pair[:, :, 6].sum(axis=0)[1], p[6])


def test_long_chain_stays_exact():
    rng = np.random.default_rng(2)
    n = 3000
    e, step, start = rng.normal(size=n) * 3, rng.normal(size=(2, 2)), rng.normal(size=2)
    p, _ = toxic_crf.marginals(e, *toxic_crf._edges(np.array([n])), step, start)
    a, row = [], np.exp(start) * [1, np.exp(e[0])]
    for i in range(n):
        row = row if i == 0 else (row @ np.exp(step)) * [1, np.exp(e[i])]
        row = row / row.sum()
        a.append(row)
    back = np.ones(2)
    for i in range(n - 1, -1, -1):
        both = a[i] * back
        assert abs(both[1] / both.sum() - p[i]) < 1e-8
        back = np.exp(step) @ ([1, np.exp(e[i])] * back)
        back /= back.sum()


def corpus(n):
    rng = np.random.default_rng(3)
    plain = [f"wo{i}rd" for i in range(200)]
    bad = ["vexling", "vexlard", "vexlost", "grumph"]
    rows = []
    for i in range(n):
        text = list(rng.choice(plain, size=rng.integers(5, 40)))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.integers(0, len(text)), str(rng.choice(bad)))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_learns_words_and_their_relatives(spark):
    rows = corpus(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    out = {r["doc_id"]: r for r in toxic_crf.score_held_out(docs, labels).collect()}
    held = [(r[2], out[r[0]]["predicted"]) for r in rows if out[r[0]]["held_out"]]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.97
    tagger = toxic_crf.train(docs, labels)
    new = spark.createDataFrame([(1, "wo1rd vexlorn wo2rd"), (2, "wo1rd wo2rd"), (3, None)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in toxic_crf.tag(new, tagger, ["doc_id"]).collect()}
    assert [(s["first"], s["last"]) for s in got[1]["spans"]] == [(6, 13)]
    assert got[1]["score"] > 0.5 > got[2]["score"] and got[3]["score"] < 0.5


def test_nasty_and_empty(spark, nasty, empty, labels):
    out = toxic_crf.score_held_out(nasty, labels).collect()
    assert len(out) == nasty.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxic_crf.score_held_out(empty, labels).count() == 0
    assert {r["score"] for r in toxic_crf.score_held_out(nasty, labels.limit(0)).collect()} == {0.0}


def planted(n):
    rng = np.random.default_rng(7)
    plain = [f"wo{i}rd" for i in range(300)]
    texts, toxic = [], []
    for i in range(n):
        words = [str(w) for w in rng.choice(plain, 60)]
        if i % 4 == 0:
            words[int(rng.integers(0, 60))] = ("vexling", "vexlard")[i // 4 % 2]
        texts.append(" ".join(words))
        toxic.append(i % 4 == 0)
    return texts, np.array(toxic)


def test_cover_explains_toxic_documents_and_no_others():
    texts, toxic = planted(200)
    column = pa.array(texts, pa.large_string())
    seeds = toxic_crf._cover(column, toxic)
    found = np.zeros(len(texts), dtype=bool)
    for i, _, data, starts, ends, counts, _ in toxic_crf._slices(column):
        doc = i + np.repeat(np.arange(len(counts)), counts)
        for kind in range(toxic_crf._KINDS):
            found[doc[np.isin(toxic_crf.feature(data, starts, ends, kind), seeds)]] = True
    assert len(seeds) and (found == toxic).all()


def test_windows_hold_all_words_near_labelled_ones():
    texts, toxic = planted(200)
    column = pa.array(texts, pa.large_string())
    seeds = toxic_crf._cover(column, toxic)
    cells, y, first = toxic_crf._windows(column, toxic, seeds, reach=5, words=10**9)
    assert len(y) == 200 * 60 and y.sum() == toxic.sum() and first.sum() == 200  # all words, a text each
    cells, y, first = toxic_crf._windows(column, toxic, seeds, reach=5, words=100)
    assert y.sum() == toxic.sum() and len(cells) == toxic_crf._KINDS and all(len(c) == len(y) for c in cells)
    near = 0
    for text, t in zip(texts, toxic):
        at = [i for i, w in enumerate(text.split()) if t and w.startswith("vexl")]
        near += len({j for i in at for j in range(max(0, i - 5), min(60, i + 6))})
    assert near <= len(y) < 200 * 60


def test_training_takes_rows_up_to_its_bounds(spark):
    texts, toxic = planted(80)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(t)) for i, t in enumerate(toxic)], "doc_id long, toxic int")
    whole = toxic_crf.train(docs, labels)
    order = [r["doc_id"] for r in docs.orderBy(F.xxhash64("doc_id")).collect()]
    same = toxic_crf.fit([texts[i] for i in order], toxic[order])
    assert np.array_equal(whole.emission, same.emission) and whole.calibration == same.calibration
    assert toxic_crf.train(docs, labels, max_bytes=1).constant == 0.0  # no text fits
    few = toxic_crf.train(docs, labels, max_toxic=5, max_clean=5)
    picked = [i for y in (True, False) for i in [i for i in order if toxic[i] == y][:5]]
    picked.sort(key=order.index)
    assert np.array_equal(few.emission, toxic_crf.fit([texts[i] for i in picked], toxic[picked]).emission)
