"""Queries over whole texts and tables, against plain Python."""

from __future__ import annotations

import re

import pytest

import __spark_entry__


def distance(a, b):
    row = list(range(len(b) + 1))
    for x in a:
        before, row = row, [row[0] + 1]
        for j, y in enumerate(b):
            row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (x != y)))
    return row[-1]


@pytest.fixture
def tables(spark, tmp_path):
    said = "the first sixty letters of both of these long lines are the same and then "
    turns = [(1, 0, f"{said}one ends here"), (1, 1, f"{said}the other one goes on there"), (1, 2, "short"), (1, 3, "a last turn"), (2, 4, "only late turns")]
    spark.createDataFrame(turns, "conv_id long, turn long, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.createDataFrame([(i, 10 * i) for i in range(1, 23)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path), turns


@pytest.mark.parametrize("name, split", [("cer_pairs", lambda t: t.replace(" ", "")), ("wer_pairs", str.split)])
def test_error_rates_are_of_whole_texts(spark, tables, name, split):
    path, turns = tables
    want = {}
    for (c, _, x), (d, turn, y) in zip(turns, turns[1:]):
        if c == d:
            a, b = (split(re.sub(" +", " ", re.sub("[^a-z ]", "", t.lower())).strip()) for t in (x, y))
            want[d, turn] = round(distance(a, b) / max(1, len(a)), 6)
    assert {(r[0], r[1]): r[2] for r in __spark_entry__.queries()[name](spark, path).collect()} == want


def test_timed_text_has_all_turns(spark, tables):
    got = {r["rec"]: (r["n"], r["first"], r["last"]) for r in __spark_entry__.queries()["timed_text"](spark, tables[0]).collect()}
    assert got == {1: (sum(len(t.split()) for c, _, t in tables[1] if c == 1), 0.5, 24.5), 2: (3, 32.5, 32.5)}


def test_shard_list_has_all_orders(spark, tables):
    assert __spark_entry__.queries()["shard_list"](spark, tables[0]).count() == 22
