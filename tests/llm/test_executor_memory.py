"""What operators leave in executors and their Python workers, which in a pipeline adds up."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from voxlath.llm import components, line_dedup, toxic_crf


def plain_components(links):
    root = {}

    def of(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in links:
        if u is not None and v is not None and u != v:
            a, b = of(u), of(v)
            root[max(a, b)] = min(a, b)
    return {x: of(x) for x in list(root)}


def some_links():
    rng = np.random.default_rng(3)
    pairs = [tuple(x) for x in rng.integers(-60, 60, (55, 2)).tolist()]
    return [*pairs, (None, 4), (5, 5), (-(1 << 63), (1 << 63) - 1), *((1000 + i, 1001 + i) for i in range(60)), *((2000, 2001 + i) for i in range(30))]


@pytest.mark.parametrize("most", [0, 100, None])
def test_rounds_and_the_task_for_the_rest_give_the_same_components(spark, monkeypatch, most):
    if most is not None:
        monkeypatch.setattr(components, "TASK_LINKS", most)
    got = components.components(spark.createDataFrame(some_links(), "u long, v long")).collect()
    assert len(got) == len({r["id"] for r in got})
    assert {r["id"]: r["component"] for r in got} == plain_components(some_links())


def test_components_of_few_links_take_no_rounds(spark, monkeypatch):
    written, plain = [], components.materialize
    monkeypatch.setattr(components, "materialize", lambda df, name: written.append(name) or plain(df, name))
    got = components.components(spark.createDataFrame([(i, i + 1) for i in range(60)], "u long, v long"))
    assert {r["component"] for r in got.collect()} == {0}
    assert len(written) == 2


def test_line_dedup_leaves_no_tables_in_workers():
    text = "\n".join(f"{i} two three four five six seven eight nine ten" for i in range(50))
    batch = pa.record_batch([pa.array([text, None, ""]), pa.array([1, 2, 3], pa.int64())], names=["text", "doc"])
    assert sum(b.num_rows for b in line_dedup._tidy(line_dedup._scan(8, 2))([batch])) == 50
    assert line_dedup._table.cache_info().currsize == 0
    assert len(line_dedup._power(line_dedup._P, 10)) < 1 << 20
    line_dedup._release()


def test_learning_starts_no_workers_for_rows_of_the_driver(spark, labels, nasty, monkeypatch):
    def refused(*a, **b):
        raise AssertionError("rows of the driver")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    assert isinstance(toxic_crf.train(nasty, labels), toxic_crf.Tagger)
