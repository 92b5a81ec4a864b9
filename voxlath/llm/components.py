"""Connected components of a table of links, by alternating large and small stars.

Every round rewrites the links of a node to its least neighbour.  Minima are summed before the
shuffle, and a node's links meet its minimum in SALTS parts, so that no task holds all links of a
node that has very many.  The rounds end when the links form stars around the least node of each
component, or when so few links are left that one task can do the rest, which saves the many short
stages of the last rounds and what these leave in an executor's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, tidy

MAX_ROUNDS = 60
#: Links that one task takes at most; while there are more, rounds go on.
TASK_LINKS = 1 << 17
#: Parts in which the links of one node are dealt out.
SALTS = 8


def _star(links: DataFrame) -> DataFrame:
    """(u, v, m): all links with the least neighbour of u."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(least, ["u", "salt"]).drop("salt")


def _state(links: DataFrame) -> tuple:
    """Number of links and two sums over them, to tell whether a round changed any."""
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("u", "v"))).first())


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least): every node of links that isn't the least of its component, with that one."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        x, y = root[a], root[b]
        open_ = x != y
        if not open_.any():
            break
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, root[root]):
            root = root[root]
    own = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[own], nodes[root[own]]


def _rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [(batch.column(0).to_numpy(), batch.column(1).to_numpy()) for batch in batches]
    if held:
        node, least = stars(*(np.concatenate(x) for x in zip(*held)))
        yield pa.record_batch([pa.array(node), pa.array(least)], names=["u", "v"])


def components(links: DataFrame) -> DataFrame:
    """(id, component): every node of links (u, v) with the least node that it reaches.  Rows with nulls or loops count as no link."""
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    links = materialize(links, "links")
    before = _state(links)
    whole = all(f.dataType.simpleString() == "bigint" for f in links.schema.fields)
    for _ in range(MAX_ROUNDS if before[0] else 0):
        if whole and before[0] <= TASK_LINKS:
            links = materialize(links.coalesce(1).mapInArrow(tidy(_rest), "u long, v long"), "links")
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).select(F.col("v").alias("u"), F.least("m", "u").alias("v"), F.col("u").alias("own")).where("u > own").select("u", "v").where("u > v").distinct()
        small = _star(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u > v").distinct()
        links = materialize(small, "links")
        now = _state(links)
        if now == before:
            break
        before = now
    else:
        if before[0]:
            raise RuntimeError("components did not settle")
    nodes = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return nodes.unionByName(links.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
