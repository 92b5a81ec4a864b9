"""Line dedup as a whole: short lines, and more than one edit."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxlath.llm import line_dedup


def test_equal_short_lines_go_and_near_ones_stay(spark):
    rows = [(1, "Read more\n\nsolo\nshare this page"), (2, "read  MORE\n \nsolo now\nshare that page"), (3, "x\nread more\n\nx"), (4, "solo")]
    got = {r["doc_id"]: (r["kept_text"], r["n_removed"]) for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["doc_id"]).collect()}
    assert got == {1: (rows[0][1], 0), 2: (" \nsolo now\nshare that page", 1), 3: ("x\n", 2), 4: ("", 1)}


def words(text):
    return text.lower().split()


def distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        before, row = row, [row[0] + 1]
        for j, y in enumerate(b):
            row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (x != y)))
    return row[-1]


def plain(rows, least, edits):
    """Texts without lines that are equal to an earlier one or, both of least words or more, near to it; by all pairs."""
    lines = sorted((i, k, words(x)) for i, t in rows for k, x in enumerate(t.split("\n")))
    gone = set()
    for n, (i, k, w) in enumerate(lines):
        if any(w == v or min(len(w), len(v)) >= least and distance(w, v) <= edits for _, _, v in lines[:n] if w):
            gone.add((i, k))
    return sorted((i, "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone)) for i, t in rows)


@pytest.mark.parametrize("edits, block", [(1, 2000), (2, 2000), (2, 4), (3, 2000)])
def test_near_lines_equal_all_pairs(spark, monkeypatch, edits, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng = np.random.default_rng(8)
    rows = []
    for i in range(120):
        w = [f"t{j}" for j in range((9, 12, 30)[i % 3])]
        for _ in range(int(rng.integers(0, 6))):
            at, kind = int(rng.integers(0, len(w))), int(rng.integers(0, 3))
            w[at : at + (kind > 0)] = [] if kind == 2 else [f"n{int(rng.integers(0, 3))}"]
        rows.append((i, " ".join(w) + f"\nshort {i % 7}\n"))
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["doc_id"], edits=edits).collect()
    assert sorted((r["doc_id"], r["kept_text"]) for r in got) == plain(rows, line_dedup.MIN_WORDS, edits)


def test_two_changed_words_of_sixty_are_near_by_default(spark):
    w = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(w)), (2, " ".join(["x" if i in (11, 47) else x for i, x in enumerate(w)])), (3, " ".join(["y" if i in (1, 22, 47) else x for i, x in enumerate(w)]))]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=12), st.lists(st.integers(0, 3), max_size=12), st.integers(0, 4))
def test_near_equals_the_edit_distance(a, b, edits):
    assert line_dedup.near(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), edits) == (distance(a, b) <= edits)


def changed(rng, base, edits):
    w = base.copy()
    for _ in range(edits):
        at, kind = int(rng.integers(0, len(w))), int(rng.integers(0, 3))
        w = np.concatenate([w[:at], rng.integers(1, 1 << 63, int(kind < 2)).astype(np.uint64), w[at + (kind > 0) :]])
    return w


def test_many_changed_copies_of_a_line_are_measured_few_times(monkeypatch):
    rng = np.random.default_rng(5)
    base = rng.integers(1, 1 << 63, 50).astype(np.uint64)
    lines = [changed(rng, base, int(rng.integers(1, 6))) for _ in range(400)]
    want = [any(line_dedup.near(y, x, 2) for y in lines[:k]) for k, x in enumerate(lines)]
    measured, near = [], line_dedup.near
    monkeypatch.setattr(line_dedup, "near", lambda *a: measured.append(1) or near(*a))
    assert line_dedup.near_earlier(lines, 2).tolist() == want
    assert len(measured) < 3 * len(lines)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=3, max_size=9), min_size=2, max_size=14), st.integers(0, 4), st.sampled_from([1, 7, 1 << 18]))
def test_near_earlier_equals_all_pairs(lines, edits, pairs):
    was, line_dedup.PAIRS = line_dedup.PAIRS, pairs
    try:
        got = line_dedup.near_earlier([np.array(x, dtype=np.uint64) for x in lines], edits).tolist()
    finally:
        line_dedup.PAIRS = was
    assert got == [any(distance(y, x) <= edits for y in lines[:k]) for k, x in enumerate(lines)]
