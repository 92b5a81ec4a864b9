"""LM scoring: an interpolated modified Kneser-Ney n-gram model.

Counting runs in Spark: every task turns its texts into n-grams of 64-bit word hashes and
pre-aggregates them; a shuffle by context bucket sums them; the distinct n-grams of one level
give the continuation counts of the next lower one.  Every bucket is written to the shared
folder as sorted hash arrays, which scoring tasks map into memory and search.

Nulls and empty texts hold no word: they have just the end token.  A null id is never held
out.  Repeated rows count as often as they occur.  An empty training table gives a model
whose only probability is the uniform one.  Other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import json
import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays as arrays_
from . import common
from .hashing import chain, mix, string_buffers, text_slices, word_hashes, word_spans

BEGIN = mix(np.array([11], dtype=np.uint64))[0]
END = mix(np.array([12], dtype=np.uint64))[0]
#: Tokens that a counting task holds before it passes on what it has summed.
FLUSH = 1_000_000
#: Parts of a level for each partition of the input.
PARTS = 4
_BLOCK = "level int, bucket int, data binary"


@dataclass(frozen=True)
class LanguageModel:
    """Place and constants of a model; small, whatever the corpus."""

    path: str
    order: int
    buckets: int
    tokens: int
    vocabulary: int
    #: Per level: discounts for the counts 1, 2 and 3 or more.
    discounts: tuple
    #: Sum of the unigrams' continuation counts, and how many have 1, 2, 3 or more.
    continuation: tuple


def _tokens(column: pa.Array, order: int):
    """Slices of texts as (first text, tokens with order-1 begins before each text, texts' offsets in these)."""
    data, offsets = string_buffers(column)
    for i, j in text_slices(offsets):
        part = data[offsets[i] : offsets[j]]
        starts, ends, counts = word_spans(part, offsets[i : j + 1] - offsets[i])
        lengths = counts + order
        at = np.concatenate([[0], np.cumsum(lengths)])
        out = np.full(at[-1], BEGIN, dtype=np.uint64)
        out[at[1:] - 1] = END
        place = np.arange(len(starts)) + np.repeat(at[:-1] + order - 1 - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        out[place] = word_hashes(part, starts, ends)
        yield i, j, out, at


def _real(at: np.ndarray, order: int) -> np.ndarray:
    """Places of words and ends, without begins."""
    keep = np.ones(at[-1], dtype=bool)
    for k in range(order - 1):
        keep[at[:-1] + k] = False
    return np.flatnonzero(keep)


def _hash(columns: list[np.ndarray]) -> np.ndarray:
    return functools.reduce(chain, columns)


def _bucket(columns: list[np.ndarray], buckets: int) -> np.ndarray:
    """By context, so that a context's continuations meet; by the word itself for unigrams."""
    key = mix(_hash(columns[:-1] or columns))
    return ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _summed(columns: list[np.ndarray], sums: list[np.ndarray]) -> tuple[list, list]:
    """Distinct n-grams in the order of their hash, with their sums."""
    if not len(columns[0]):
        return columns, sums
    key = _hash(columns)
    order = np.argsort(key)
    first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    pick = order[first]
    return [c[pick] for c in columns], [np.add.reduceat(s[order], first) for s in sums]


def _blocks(level: int, columns: list[np.ndarray], sums: list[np.ndarray], buckets: int):
    """Rows of _BLOCK; within one, n-grams are in the order of their contexts, which compresses."""
    where = _bucket(columns, buckets)
    order = np.lexsort((columns[0], where))
    edges = np.searchsorted(where[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        pick = order[edges[b] : edges[b + 1]]
        yield level, int(b), np.concatenate([c[pick] for c in columns] + [s[pick].astype(np.uint64) for s in sums]).tobytes()


def _batch(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.record_batch([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["level", "bucket", "data"])


def _counter(order: int, buckets: int):
    def count(batches):
        held, n = [], 0

        def flush():
            columns, sums = _summed([np.concatenate([h[k] for h in held]) for k in range(order)], [np.ones(n, dtype=np.int64)])
            return _batch(_blocks(order, columns, sums, buckets))

        for batch in batches:
            for _, _, tokens, at in _tokens(batch.column(0), order):
                place = _real(at, order)
                held.append([tokens[place - (order - 1 - k)] for k in range(order)])
                n += len(place)
                if n >= FLUSH:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    return count


def _small(a: np.ndarray) -> np.ndarray:
    return a.astype(np.min_scalar_type(int(a.max()))) if len(a) else a.astype(np.uint8)


def _merger(level: int, buckets: int, path: str, top: bool):
    """Sums a bucket, writes its arrays, returns its statistics and the blocks of the level below.

    Blocks of the top level have one sum, as an n-gram's count is how often it occurs; below, the
    continuation count and the occurrences are two.
    """
    width = level + (1 if top else 2)

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        parts = [np.frombuffer(x.as_py(), dtype=np.uint64).reshape(width, -1) for x in table.column("data")]
        whole = np.concatenate(parts, axis=1)
        del parts
        columns, sums = _summed(list(whole[:level]), [s.astype(np.int64) for s in whole[level:]])
        count, raw = sums[0], sums[-1]
        del whole
        arrays = {"hash": _hash(columns), "count": _small(count)}
        if level == 1:
            arrays["raw"] = _small(raw)
        else:
            context = _hash(columns[:-1])
            order = np.argsort(context)
            first = np.flatnonzero(np.concatenate([[True], np.diff(context[order]) != 0]))
            arrays["context"] = context[order][first]
            for name, v in (("total", count), ("n1", count == 1), ("n2", count == 2), ("n3", count >= 3)):
                arrays[name] = _small(np.add.reduceat(v[order].astype(np.int64), first))
        arrays_.save(f"{path}/{level}-{bucket}", arrays)
        stats = {"n": [int((count == i).sum()) for i in range(1, 5)], "more": int((count >= 3).sum()), "total": int(count.sum()), "raw": int(raw.sum()), "distinct": len(count)}
        rows = [(-level, bucket, json.dumps(stats).encode())]
        if level > 1:
            columns, sums = _summed(columns[1:], [np.ones(len(count), dtype=np.int64), raw])
            rows += _blocks(level - 1, columns, sums, buckets)
        return pa.Table.from_batches([_batch(rows)])

    return merge


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts; 0.5, 1, 1.5 where counts are too few to estimate them."""
    n1, n2, n3, n4 = n
    if not min(n1, n2, n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.01), i + 0.99) for i, d in enumerate(found))


def train(texts: DataFrame, text_col: str = "text", order: int = 3, buckets: int | None = None) -> LanguageModel:
    """Count all texts and store the model in the shared folder.

    buckets: parts of each level; by default PARTS for each partition of the input, so that a
    part stays bounded as an input partition is.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    spark = texts.sparkSession
    common.short_batches(spark)
    texts = texts.select(F.col(text_col).cast("string"))
    buckets = buckets or max(8, PARTS * texts.rdd.getNumPartitions())
    path = common.fresh_path(spark, "lm")
    if (local := common.local_path(path)) is not None:
        os.makedirs(local, exist_ok=True)
    blocks = texts.mapInArrow(common.tidy(_counter(order, buckets)), _BLOCK)
    stats = {}
    for level in range(order, 0, -1):
        made = common.materialize(blocks.where(F.col("level") == level).groupBy("bucket").applyInArrow(_merger(level, buckets, path, level == order), _BLOCK), f"lm-level{level}")
        found = {"n": [0] * 4, "more": 0, "total": 0, "raw": 0, "distinct": 0}
        for row in made.where(F.col("level") == -level).toLocalIterator():  # one small row for each bucket
            s = json.loads(bytes(row["data"]))
            found = {k: [a + b for a, b in zip(v, s[k])] if k == "n" else v + s[k] for k, v in found.items()}
        stats[level] = found
        blocks = made
    uni = stats[1]
    return LanguageModel(path, order, buckets, uni["raw"], uni["distinct"], tuple(_discounts(stats[k]["n"]) for k in range(1, order + 1)), (uni["total"], uni["n"][0], uni["n"][1], uni["more"]))


def _lookup(model: LanguageModel, level: int, bucket: np.ndarray, key: np.ndarray, by: str, names: list[str]) -> list[np.ndarray]:
    """Values for sorted (bucket, key) pairs; 0 for what isn't there."""
    out = [np.zeros(len(key), dtype=np.int64) for _ in names]
    edges = np.flatnonzero(np.concatenate([[True], np.diff(bucket) != 0, [True]])) if len(key) else []
    for i, j in zip(edges[:-1], edges[1:]):
        if (arrays := arrays_.mapped(f"{model.path}/{level}-{bucket[i]}")) is None:
            continue
        there = arrays[by]
        at = np.minimum(np.searchsorted(there, key[i:j]), len(there) - 1)
        hit = np.flatnonzero(there[at] == key[i:j])
        for o, name in zip(out, names):
            o[i + hit] = arrays[name][at[hit]]
    return out


def _found(model: LanguageModel, level: int, columns: list[np.ndarray], by: str, names: list[str]) -> list[np.ndarray]:
    """Values for n-grams in any order, each distinct one searched once."""
    key = _hash(columns if by == "hash" else columns[:-1])
    order = np.argsort(key)
    first = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0]))
    pick = order[first]
    bucket = _bucket([c[pick] for c in columns], model.buckets)
    by_bucket = np.argsort(bucket, kind="stable")
    values = _lookup(model, level, bucket[by_bucket], key[pick][by_bucket], by, names)
    group = np.empty(len(key), dtype=np.int64)
    group[order] = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
    back = np.empty(len(pick), dtype=np.int64)
    back[by_bucket] = np.arange(len(pick))
    return [v[back][group] for v in values]


def _less(count: np.ndarray, d: tuple) -> np.ndarray:
    return np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0.0)


def _probabilities(model: LanguageModel, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The model's probability of each n-gram's last word, and that word's count."""
    count, raw = _found(model, 1, columns[-1:], "hash", ["count", "raw"])
    total, *n = model.continuation
    d = model.discounts[0]
    uniform = 1.0 / (model.vocabulary + 1)
    p = (_less(count, d) + sum(a * b for a, b in zip(d, n)) * uniform) / total if total else np.full(len(count), uniform)
    for level in range(2, model.order + 1):
        own, d = columns[-level:], model.discounts[level - 1]
        (count,) = _found(model, level, own, "hash", ["count"])
        total, n1, n2, n3 = _found(model, level, own, "context", ["total", "n1", "n2", "n3"])
        seen = total > 0
        mixed = (_less(count, d) + (d[0] * n1 + d[1] * n2 + d[2] * n3) * p) / np.maximum(total, 1)
        p = np.where(seen, mixed, p)
    return p, raw


def _scorer(model: LanguageModel):
    def score(batches):
        for batch in batches:
            n = batch.num_rows
            tokens_of, known, base, own = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
            for i, j, tokens, at in _tokens(batch.column(0), model.order):
                place = _real(at, model.order)
                p, raw = _probabilities(model, [tokens[place - (model.order - 1 - k)] for k in range(model.order)])
                first = at[:-1] - np.arange(j - i) * (model.order - 1)
                tokens_of[i:j] = np.diff(at) - (model.order - 1)
                known[i:j] = np.add.reduceat((raw > 0).astype(np.int64), first)
                own[i:j] = np.add.reduceat(np.log10(p), first)
                base[i:j] = np.add.reduceat(np.log10((raw + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1))), first)
            perplexity = 10.0 ** (-own / np.maximum(tokens_of, 1))
            yield pa.record_batch([*(batch.column(c) for c in range(1, batch.num_columns)), pa.array(tokens_of), pa.array(known), pa.array(base), pa.array(own), pa.array(perplexity)], names=[*batch.schema.names[1:], "n_tokens", "n_known", "base_score", "score", "perplexity"])

    return score


def score(docs: DataFrame, model: LanguageModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep's columns of every row with n_tokens, n_known, base_score, score (log10) and perplexity."""
    held = docs.select(F.col(text_col).cast("string").alias("__text"), *keep)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields[1:]] + ["n_tokens long, n_known long, base_score double, score double, perplexity double"])
    common.short_batches(docs.sparkSession)
    return held.mapInArrow(common.tidy(_scorer(model)), schema)


def score_held_out(docs: DataFrame, order: int = 3) -> DataFrame:
    """op1: every document, scored by a model of those outside fold 1."""
    docs = docs.select("doc_id", "text", F.coalesce(common.fold() == 1, F.lit(False)).alias("held_out"))
    model = train(docs.where(~F.col("held_out")), order=order)
    return score(docs, model, ["doc_id", "held_out"]).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
