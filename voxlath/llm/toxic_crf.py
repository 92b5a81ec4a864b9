"""Toxicity: a linear-chain conditional random field over the words of a text.

Labels are given for documents, so the words to tag are found first: a greedy cover picks the
word features (whole words and beginnings of words) that occur in labelled toxic documents and
hardly in others, until the toxic documents are explained.  Words with these features in toxic
documents are the labelled tokens from which the field learns emissions of hashed word features
and transitions.  Forward-backward marginals of all words of a text give its score, and spans of
likely words the offending offsets.

Learning uses a bounded sample, by parameters of `train`: of the labelled rows those of each label
with the least hash of their id, up to a number of rows and of bytes; of their words those near
labelled ones, and windows of 50 words all over the texts, `words` of them about or 25 for each
labelled word.  Scoring covers every row and whole texts.

Null and empty texts have no words and get the score that the calibration gives to none.  Rows
without a label, or with a null one, teach nothing; where a document has several labels, it is
toxic if one says so.  Without labelled rows of both kinds every score is the share of toxic
ones, 0 for no rows at all.  Only the columns named are kept.
"""

from __future__ import annotations

import io
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .hashing import LOWER, part_hashes, string_buffers, text_slices, word_spans

_SEPARATOR = np.array([not (48 <= b <= 57 or 97 <= LOWER[b] <= 122 or b >= 128) for b in range(256)])
#: Lengths in bytes of the beginnings of a word that are features, besides the word and its last three bytes.
BEGINNINGS = (3, 4, 5, 6, 7)
BITS = 18
_KINDS = len(BEGINNINGS) + 2
#: Marginal from which on a word belongs to an offending span.
SPAN_AT = 0.5
#: Words away from labelled ones that the field learns from, about.
WORDS = 100_000
_BLOCK = 64
_TINY = 1e-30


@dataclass(frozen=True)
class Tagger:
    """Weights of the field and of the calibration; of a fixed size."""

    emission: np.ndarray
    transition: np.ndarray
    start: np.ndarray
    calibration: tuple[float, float, float]
    #: Score of every text where there was nothing to learn from.
    constant: float | None = None


def _spans(starts: np.ndarray, ends: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(starts, ends), *((starts, np.minimum(starts + k, ends)) for k in BEGINNINGS), (np.maximum(starts, ends - 3), ends)]


def feature(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int) -> np.ndarray:
    """64-bit feature of one kind of every word: itself, a beginning, its end."""
    return part_hashes(data, starts, ends, [_spans(starts, ends)[kind]])[0] ^ np.uint64(0x9E3779B97F4A7C15 * (kind + 1) % (1 << 64))


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int64)


def _products(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Scaled products of 2x2 matrices, elementwise over the last axis."""
    out = np.einsum("ijn,jkn->ikn", first, second)
    return out / np.maximum(out.max(axis=(0, 1)), _TINY)


def _scan(matrices: np.ndarray) -> np.ndarray:
    """Rows that come of multiplying (1, 0) by all matrices up to each one; each scaled to sum 1.

    Works in blocks: the products of whole blocks first, then the row that enters each block, then
    the rows within blocks, so that long texts cost no more steps than short ones.
    """
    n = matrices.shape[2]
    blocks = -(-n // _BLOCK)
    padded = np.zeros((2, 2, blocks * _BLOCK))
    padded[0, 0] = padded[1, 1] = 1.0
    padded[:, :, :n] = matrices
    padded = padded.reshape(2, 2, blocks, _BLOCK)
    row = np.zeros((2, blocks))
    row[0] = 1.0
    if blocks > 1:
        whole = padded[..., 0]
        for k in range(1, _BLOCK):
            whole = _products(whole, padded[..., k])
        row[:, 1:] = _scan(whole[:, :, :-1])
    out = np.empty((2, blocks, _BLOCK))
    for k in range(_BLOCK):
        m = padded[..., k]
        row = np.stack([row[0] * m[0, 0] + row[1] * m[1, 0], row[0] * m[0, 1] + row[1] * m[1, 1]])
        row = row / np.maximum(row.sum(axis=0), _TINY)
        out[:, :, k] = row
    return out.reshape(2, -1)[:, :n]


def marginals(emission: np.ndarray, first: np.ndarray, last: np.ndarray, transition: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) of each word, and each word's expected transitions from the word before (2x2).

    emission: scores of the label toxic; first, last: marks of the words that begin and end a text.
    """
    n = len(emission)
    if not n:
        return np.zeros(0), np.zeros((2, 2, 0))
    top = np.maximum(emission, 0.0)
    weight = np.stack([np.exp(-top), np.exp(emission - top)])
    step, begin = np.exp(transition - transition.max()), np.exp(start - start.max())
    forward = step[:, :, None] * weight[None]
    forward[:, :, first] = (begin[:, None] * weight[:, first])[None]
    alpha = _scan(forward)
    # Backwards, the row after word t is (weight of t+1 * row after t+1) * transposed step; 1 after a text's last word.
    backward = np.empty((2, 2, n))
    backward[:, :, 1:] = (weight[:, None, 1:] * step.T[:, :, None]) if n > 1 else 0
    backward[:, :, 0] = 1.0
    shifted = np.concatenate([backward[:, :, 1:], np.ones((2, 2, 1))], axis=2)
    shifted[:, :, last] = 1.0
    beta = _scan(shifted[:, :, ::-1])[:, ::-1]
    both = alpha * beta
    p = both[1] / np.maximum(both.sum(axis=0), _TINY)
    before = np.concatenate([np.zeros((2, 1)), alpha[:, :-1]], axis=1)
    pair = before[:, None, :] * step[:, :, None] * (weight * beta)[None]
    pair[:, :, first] = 0
    return p, pair / np.maximum(pair.sum(axis=(0, 1)), _TINY)


def _edges(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the first and last words of texts with so many words."""
    first, last = np.zeros(counts.sum(), dtype=bool), np.zeros(counts.sum(), dtype=bool)
    ends = np.cumsum(counts)[counts > 0]
    last[ends - 1] = True
    first[ends - counts[counts > 0]] = True
    return first, last


def _scores(weights: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return sum((weights[_cells(feature(data, starts, ends, kind))] for kind in range(_KINDS)), np.zeros(len(starts)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return np.log(p) - np.log1p(-p)


def _text_features(p: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Logit of the largest marginal, and the log of the expected number of toxic words that are likely ones."""
    most, expected = np.zeros(len(counts)), np.zeros(len(counts))
    if len(p):
        at = (np.cumsum(counts) - counts)[counts > 0]
        most[counts > 0] = np.maximum.reduceat(p, at)
        expected[counts > 0] = np.add.reduceat(np.where(p > 0.1, p, 0.0), at)
    return _logit(most), np.log1p(expected)


def _slices(column: pa.Array):
    data, offsets = string_buffers(column)
    for i, j in text_slices(offsets, 1 << 20):
        part = data[offsets[i] : offsets[j]]
        yield i, j, part, *word_spans(part, offsets[i : j + 1] - offsets[i], _SEPARATOR), offsets[i:j] - offsets[i]


def _families(column: pa.Array) -> np.ndarray:
    """A hash for each text that copies of it share, mostly: the least of its words'."""
    out = np.zeros(len(column), dtype=np.uint64)
    for i, _, data, starts, ends, counts, _ in _slices(column):
        if len(starts):
            own = feature(data, starts, ends, 0)
            out[i + np.flatnonzero(counts)] = np.minimum.reduceat(own, (np.cumsum(counts) - counts)[counts > 0])
    return out


def _counted(column: pa.Array, toxic: np.ndarray, kind: int, family: np.ndarray) -> tuple[np.ndarray, ...]:
    """(feature, document) of one kind for features that mark toxic documents, with these features' counts in clean ones, what counts as often, and the features that do so without copies."""
    found, docs = [], []
    for i, _, data, starts, ends, counts, _ in _slices(column):
        f, doc = feature(data, starts, ends, kind), i + np.repeat(np.arange(len(counts)), counts)
        order = np.lexsort((doc, f))
        f, doc = f[order], doc[order]
        new = np.concatenate([[True], (np.diff(f) != 0) | (np.diff(doc) != 0)]) if len(f) else np.zeros(0, dtype=bool)
        found.append(f[new]), docs.append(doc[new].astype(np.int32))
    f, doc = np.concatenate(found), np.concatenate(docs)
    order = np.argsort(f, kind="stable")
    f, doc = f[order], doc[order]
    new = np.concatenate([[True], np.diff(f) != 0])
    group = np.cumsum(new) - 1
    dirty = np.bincount(group[toxic[doc]], minlength=group[-1] + 1)
    clean = np.bincount(group[~toxic[doc]], minlength=group[-1] + 1)
    needed = (np.log(_KINDS * len(dirty)) + 2) / -np.log(toxic.mean())  # hardly any feature is so often in toxic documents alone by chance
    good = (dirty >= needed) & (clean <= 0.02 * dirty)
    use = good[group] & toxic[doc]
    pairs = np.unique(np.stack([group[use].astype(np.uint64), family[doc[use]]], axis=1), axis=0)
    apart = np.bincount(pairs[:, 0].astype(np.int64), minlength=len(dirty))
    return f[use], doc[use], clean[group[use]], needed, f[new][good & (apart >= needed)]


def _cover(column: pa.Array, toxic: np.ndarray) -> np.ndarray:
    """Features that explain toxic documents: each adds documents that no feature before explains.

    Those that mark as many documents that are no copies of each other are there too, so that a word
    isn't held to be harmless for always standing beside another one.
    """
    family = _families(column)
    parts = [_counted(column, toxic, kind, family) for kind in range(_KINDS)]
    least = max(2.0, 0.5 * max(p[3] for p in parts))
    keys, key = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    where, clean = np.concatenate([p[1] for p in parts]), np.zeros(len(keys))
    clean[key] = np.concatenate([p[2] for p in parts])
    picked, open_ = [], toxic.copy()
    while len(key):
        gain = np.bincount(key, minlength=len(keys))
        gain = gain - 5.0 * clean * (gain > 0)
        best = int(gain.argmax())
        if gain[best] < least:
            break
        picked.append(keys[best])
        open_[where[key == best]] = False
        rest = open_[where]
        key, where = key[rest], where[rest]
    return np.unique(np.concatenate([np.array(picked, dtype=np.uint64), *[p[4] for p in parts]]))


def _windows(column: pa.Array, toxic: np.ndarray, seeds: np.ndarray, reach: int, words: int):
    """Features' cells, labels and first marks of the words to learn from: those near labelled ones, and windows all over the texts."""
    total, labels = 0, []
    for i, _, data, starts, ends, counts, _ in _slices(column):
        label = np.zeros(len(starts), dtype=bool)
        for kind in range(_KINDS):
            label |= np.isin(feature(data, starts, ends, kind), seeds)
        labels.append(label & toxic[i + np.repeat(np.arange(len(counts)), counts)])
        total += len(label)
    stride = max(1, total // max(words, 25 * sum(int(x.sum()) for x in labels)))
    cells, y, first = [[] for _ in range(_KINDS)], [], []
    for (i, _, data, starts, ends, counts, _), label in zip(_slices(column), labels):
        if not len(starts):
            continue
        near, at = np.zeros(len(starts) + 1), np.flatnonzero(label)
        np.add.at(near, np.maximum(at - reach, 0), 1)
        np.add.at(near, np.minimum(at + reach + 1, len(starts)), -1)
        keep = np.flatnonzero((np.cumsum(near[:-1]) > 0) | ((np.arange(len(starts)) // 50) % stride == 0))
        doc = np.repeat(np.arange(len(counts)), counts)[keep]
        first.append(np.concatenate([[True], (np.diff(keep) > 1) | (np.diff(doc) > 0)]))
        y.append(label[keep])
        for kind in range(_KINDS):
            cells[kind].append(_cells(feature(data, starts[keep], ends[keep], kind)))
    return [np.concatenate(c) for c in cells], np.concatenate(y).astype(float), np.concatenate(first)


def fit(texts: list[str], toxic: np.ndarray, rounds: int = 80, reach: int = 12, words: int = WORDS) -> Tagger:
    """Learn from whole labelled texts; the field from the words around labelled tokens and windows all over."""
    if not len(texts) or toxic.all() or not toxic.any():
        return Tagger(np.zeros(1), np.zeros((2, 2)), np.zeros(2), (0.0, 0.0, 0.0), float(toxic.mean()) if len(texts) else 0.0)
    column = pa.array(texts, pa.large_string())
    if not any(len(starts) for _, _, _, starts, _, _, _ in _slices(column)):
        return Tagger(np.zeros(1), np.zeros((2, 2)), np.zeros(2), (0.0, 0.0, 0.0), float(toxic.mean()))
    cells, y, first = _windows(column, toxic, _cover(column, toxic), reach, words)
    last = np.concatenate([first[1:], [True]])
    weights, transition, start = np.zeros(1 << BITS), np.zeros((2, 2)), np.zeros(2)
    g_w, g_t, g_s = np.full(1 << BITS, 1e-6), np.full((2, 2), 1e-6), np.full(2, 1e-6)
    pair_y = np.zeros((2, 2))
    inner = np.flatnonzero(~first)
    np.add.at(pair_y, (y[inner - 1].astype(int), y[inner].astype(int)), 1)
    start_y = np.bincount(y[first].astype(int), minlength=2)
    for _ in range(rounds):
        p, pair = marginals(sum(weights[c] for c in cells), first, last, transition, start)
        d = p - y
        grad = 0.05 * weights
        for c in cells:
            grad += np.bincount(c, d, minlength=1 << BITS)
        d_t = pair.sum(axis=2) - pair_y + 0.05 * transition
        d_s = np.array([(1 - p[first]).sum(), p[first].sum()]) - start_y + 0.05 * start
        for x, g, d_x in ((weights, g_w, grad), (transition, g_t, d_t), (start, g_s, d_s)):
            g += d_x * d_x
            x -= 0.3 * d_x / np.sqrt(g)
    weights = weights.astype(np.float32)
    figures = []
    for _, _, data, starts, ends, counts, _ in _slices(column):
        p, _ = marginals(_scores(weights, data, starts, ends), *_edges(counts), transition, start)
        figures.append(_text_features(p, counts))
    most, expected = (np.concatenate(x) for x in zip(*figures))
    return Tagger(weights, transition, start, _calibrate(most, expected, toxic))


def _calibrate(a: np.ndarray, b: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic regression of the label on a text's two figures, by damped Newton steps."""
    x = np.stack([a, b, np.ones(len(a))], axis=1)
    w = np.array([0.3, 0.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - toxic) + 0.1 * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(3)
        w -= np.clip(np.linalg.solve(hess, grad), -1, 1)
    return tuple(float(v) for v in w)


def train(
    docs: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic",
    max_toxic: int = 1000, max_clean: int = 2500, max_bytes: int = 32 << 20, words: int = WORDS,
) -> Tagger:
    """Learn from at most max_toxic and max_clean labelled rows and max_bytes of either kind, whole texts.

    The rows go to one task, which learns; the driver gets weights, of a bounded size, and never a
    text.  The ids are written and broadcast, since rows made of the driver's own start workers of
    another kind, whose memory every executor keeps.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("__id")).agg(F.max(F.col(label_col).cast("int")).alias("__y"))
    there = docs.select(F.col(id_col).alias("__id")).join(known, "__id")  # ids alone, so no text is shuffled
    chosen = [
        there.where((F.col("__y") > 0) == F.lit(y)).select("__id", F.xxhash64("__id").alias("__h")).distinct().orderBy("__h", "__id").limit(most).select("__id", F.lit(y).alias("toxic"))
        for y, most in ((True, max_toxic), (False, max_clean))
    ]
    picked = common.materialize(chosen[0].unionByName(chosen[1]), "labelled-ids")
    body = docs.select(F.col(id_col).alias("__key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = body.join(F.broadcast(picked), F.col("__key") == F.col("__id")).select(F.xxhash64("__key").alias("h"), "toxic", "text")
    place = Window.partitionBy("toxic").orderBy("h", "text")
    upto = F.sum(F.octet_length("text")).over(place.rowsBetween(Window.unboundedPreceding, 0))
    most = F.when(F.col("toxic"), max_toxic).otherwise(max_clean)
    rows = rows.withColumn("upto", upto).withColumn("place", F.row_number().over(place)).where((F.col("place") <= most) & (F.col("upto") <= max_bytes))
    common.short_batches(docs.sparkSession)
    made = rows.select("text", "toxic", "h").repartition(1).mapInArrow(common.tidy(_learner(words)), "tagger binary").collect()  # one row, the weights
    return _unpacked(made[0]["tagger"]) if made else fit([], np.zeros(0, dtype=bool))


def _learner(words: int):
    def learn(batches):
        held = [row for batch in batches for row in zip(batch.column(2).to_pylist(), batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        held.sort()
        toxic = np.array([r[2] for r in held], dtype=bool)
        texts = [r[1] for r in held]
        del held
        yield pa.record_batch([pa.array([_packed(fit(texts, toxic, words=words))], pa.binary())], names=["tagger"])

    return learn


def _packed(tagger: Tagger) -> bytes:
    buffer = io.BytesIO()
    constant = np.array([] if tagger.constant is None else [tagger.constant])
    np.savez(buffer, emission=tagger.emission, transition=tagger.transition, start=tagger.start, calibration=np.array(tagger.calibration), constant=constant)
    return buffer.getvalue()


def _unpacked(data: bytes) -> Tagger:
    own = np.load(io.BytesIO(data))
    return Tagger(own["emission"], own["transition"], own["start"], tuple(own["calibration"].tolist()), float(own["constant"][0]) if len(own["constant"]) else None)


def _tagged(tagger: Tagger, column: pa.Array, spans: bool):
    n = len(column)
    score, found = np.full(n, tagger.constant or 0.0), [[] for _ in range(n)]
    if tagger.constant is None:
        a, b, c = tagger.calibration
        for i, j, part, starts, ends, counts, base in _slices(column):
            p, _ = marginals(_scores(tagger.emission, part, starts, ends), *_edges(counts), tagger.transition, tagger.start)
            most, expected = _text_features(p, counts)
            score[i:j] = 1 / (1 + np.exp(-np.clip(a * most + b * expected + c, -30, 30)))
            for w in np.flatnonzero(p >= SPAN_AT) if spans else ():
                k = int(np.searchsorted(np.cumsum(counts), w, side="right"))
                own = found[i + k]
                lo, hi = int(starts[w] - base[k]), int(ends[w] - base[k])
                if own and own[-1]["word"] == w - 1:
                    own[-1].update(last=hi, word=w, marginal=max(own[-1]["marginal"], float(p[w])))
                else:
                    own.append({"first": lo, "last": hi, "marginal": float(p[w]), "word": w})
    return score, [[{k: s[k] for k in ("first", "last", "marginal")} for s in own] for own in found]


def tag(docs: DataFrame, tagger: Tagger, keep: list[str], text_col: str = "text", spans: bool = True) -> DataFrame:
    """keep's columns with score and, if asked for, spans: byte offsets [first, last) in the UTF-8 text and the largest marginal."""
    held = docs.select(F.col(text_col).cast("string").alias("__text"), *keep)
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    span = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("marginal", pa.float64())]))
    more = "score double" + (", spans array<struct<first: long, last: long, marginal: double>>" if spans else "")

    def run(batches):
        for batch in batches:
            score, found = _tagged(shared.value, batch.column(0), spans)
            extra = [pa.array(score)] + ([pa.array(found, span)] if spans else [])
            yield pa.record_batch([*(batch.column(c) for c in range(1, batch.num_columns)), *extra], names=[*batch.schema.names[1:], "score", *["spans"] * spans])

    common.short_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields[1:]), more])
    return held.mapInArrow(common.tidy(run), schema)


def score_held_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """op3: every document's score, learnt from labelled documents outside fold 0."""
    docs = docs.select("doc_id", "text", F.coalesce(common.fold() == 0, F.lit(False)).alias("held_out"))
    tagger = train(docs.where(~F.col("held_out")), labels)
    out = tag(docs, tagger, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), F.size("spans").cast("long").alias("n_spans"))
