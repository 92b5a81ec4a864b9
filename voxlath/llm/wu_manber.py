"""Benchmark decontamination: Wu-Manber search for all windows of the test items at once.

The alphabet is words: bytes other than ASCII letters, digits and non-ASCII are separators and
A-Z count as a-z.  A window is `width` consecutive words of an item; an item with fewer words,
but not none, is one window.  Windows of one length make one search: a shift table over blocks
of two words skips positions where no window can end, windows are kept in buckets by their last
block and first word, and comparing the words confirms an occurrence.  The tables are sorted hash
arrays, some ten times the size of the items; cursors walk over the texts of a batch side by side.

Items come to the tasks in blocks of a bounded size.  Each further block is another narrow pass
over what the pass before has written, so that neither the tables that a task holds nor the
workers of a stage grow with the benchmark.

Null or empty texts and items hold no word and match nothing; a null item_id counts as no item,
though its words still count as hit.  Repeated rows of documents are each judged, repeated items
count once for each distinct id.  An empty benchmark leaves every document clean.  Only the
columns named are kept, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, short_batches, tidy
from .hashing import chain, string_buffers, text_slices, word_hashes, word_spans

#: Bytes of item text that one pass holds.
ITEM_BLOCK = 4 << 20
#: Bytes of words in lower case, blanks for all others.
_TO_WORD = np.array([b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], dtype=np.uint8)
_BLANK = np.arange(256) == 32
#: Words that one cursor walks over, and pairs of an occurrence and a window that are compared at once.
_WALK, _PAIRS = 512, 1 << 18
_FOUND = "n_words long, spans array<struct<first: int, last: int>>, items array<string>"


class Words:
    """Words of a slice of texts: byte spans, 64-bit hashes, and hashes of each word with the one before."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = _TO_WORD[data]
        self.starts, self.ends, self.counts = word_spans(self.data, offsets, _BLANK)
        self.hash = word_hashes(self.data, self.starts, self.ends)
        self.pair = self.hash.copy()
        self.pair[1:] = chain(self.hash[:-1], self.hash[1:])
        self.last = np.cumsum(self.counts)
        self.first = self.last - self.counts

    def block(self, size: int) -> np.ndarray:
        """Hashes of the blocks of one or two words that end at each word."""
        return self.pair if size == 2 else self.hash

    def text(self, first: int, n: int) -> list[bytes]:
        return [self.data[self.starts[j] : self.ends[j]].tobytes() for j in range(first, first + n)]


class WindowIndex:
    """Shift and bucket tables for windows of one length, as sorted hash arrays."""

    def __init__(self, items: Words, which: np.ndarray, length: int):
        """which: the items whose windows have this length."""
        self.items, self.length, self.size = items, length, min(2, length)
        self.default = length - self.size + 1
        first, last = items.first[which], items.last[which]
        block = items.block(self.size)
        # A block that ends at a word is as far from the end of a window as the earliest window of its item leaves it.
        n = last - first - (self.size - 1)
        ends = np.repeat(first + self.size - 1, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        shift = np.maximum(np.repeat(first, n) + length - 1 - ends, 0)
        order = np.lexsort((shift, block[ends]))
        key = block[ends][order]
        once = np.concatenate([[True], np.diff(key) != 0])
        self.keys, self.shift = key[once], shift[order][once].astype(np.int32)
        # Buckets: windows by their last block, and within it by their first word.
        n = last - first - (length - 1)
        starts = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        bucket = chain(block[starts + length - 1], items.hash[starts])
        order = np.argsort(bucket, kind="stable")
        self.buckets, self.windows, self.owner = bucket[order], starts[order].astype(np.int32), np.repeat(which, n)[order].astype(np.int32)

    def _ends(self, own: Words) -> np.ndarray:
        """Words at which a window may end: many cursors walk over the texts side by side and skip by the shift table."""
        at = own.first[own.counts >= self.length] + self.length - 1
        last = own.last[own.counts >= self.length]
        parts = -(-(last - at) // _WALK)
        begin = np.repeat(at, parts) + _WALK * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        stop = np.minimum(begin + _WALK, np.repeat(last, parts))
        block, found = own.block(self.size), []
        while len(begin):
            key = block[begin]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            skip = np.where(self.keys[place] == key, self.shift[place], self.default)
            found.append(begin[skip == 0])
            begin = begin + np.maximum(skip, 1)
            going = begin < stop
            begin, stop = begin[going], stop[going]
        return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)

    def search(self, own: Words) -> tuple[np.ndarray, np.ndarray]:
        """(first word, item) of every occurrence."""
        ends = self._ends(own)
        key = chain(own.block(self.size)[ends], own.hash[ends - self.length + 1])
        low, high = np.searchsorted(self.buckets, key, side="left"), np.searchsorted(self.buckets, key, side="right")
        some = high > low
        ends, low, n = ends[some], low[some], (high - low)[some]
        words, owners = [], []
        edges = np.searchsorted(np.cumsum(n), np.arange(0, n.sum() + _PAIRS, _PAIRS)) if len(n) else []
        for i, j in zip(edges, edges[1:]):
            m = n[i : j + 1] if j < len(n) else n[i:]
            upto = i + len(m)
            first = np.repeat(ends[i:upto] - self.length + 1, m)
            place = np.repeat(low[i:upto], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            window = self.windows[place]
            for k in range(self.length):
                same = own.hash[first + k] == self.items.hash[window + k]
                first, window, place = first[same], window[same], place[same]
            good = [own.text(int(f), self.length) == self.items.text(int(w), self.length) for f, w in zip(first, window)]
            words.append(first[good]), owners.append(self.owner[place[good]])
        if not words:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32)
        return np.concatenate(words), np.concatenate(owners)


@dataclass(frozen=True)
class Tables:
    """Indexes of a block of items, by length of their windows, and the items' ids."""

    indexes: list[WindowIndex]
    ids: list[str | None]


def build(items: Iterable[tuple[str | None, str | None]], width: int) -> Tables:
    items = list(items)
    own = Words(*string_buffers(pa.array([t for _, t in items], pa.large_string())))
    length = np.minimum(own.counts, width)
    return Tables([WindowIndex(own, np.flatnonzero(length == n), int(n)) for n in np.unique(length) if n], [i for i, _ in items])


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unite overlapping or touching spans [first, last)."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def find(column: pa.Array, tables: Tables) -> Iterator[tuple[int, list[tuple[int, int]], set[str]]]:
    """(number of words, spans of hit words, items) of every text of a column."""
    data, offsets = string_buffers(column)
    for i, j in text_slices(offsets, 1 << 20):
        own = Words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        spans: list[list[tuple[int, int]]] = [[] for _ in range(i, j)]
        items: list[set[str]] = [set() for _ in range(i, j)]
        for index in tables.indexes:
            words, owners = index.search(own)
            docs = np.searchsorted(own.last, words, side="right")
            for d, first, owner in zip(docs.tolist(), (words - own.first[docs]).tolist(), owners.tolist()):
                spans[d].append((first, first + index.length))
                if tables.ids[owner] is not None:
                    items[d].add(tables.ids[owner])
        yield from zip(own.counts.tolist(), map(merged, spans), items)


def _pass(shared, names: list[str], again: bool):
    def search(batches):
        for batch in batches:
            found = find(batch.column(0), shared.value)
            if again:
                before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist())
                found = ((n, merged([*spans, *((s["first"], s["last"]) for s in a)]), items | set(b)) for (n, spans, items), (a, b) in zip(found, before))
            rows = list(found)
            made = [
                pa.array([r[0] for r in rows], pa.int64()),
                pa.array([[{"first": a, "last": b} for a, b in r[1]] for r in rows], pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                pa.array([sorted(r[2]) for r in rows], pa.list_(pa.string())),
            ]
            yield pa.record_batch([batch.column(c) for c in range(len(names))] + made, names=[*names, "n_words", "spans", "items"])

    return tidy(search)


def _item_blocks(items: DataFrame, limit: int) -> Iterator[list[tuple[str | None, str | None]]]:
    block, size = [], 0
    for item_id, text in items.toLocalIterator():
        block.append((item_id, text))
        size += len(text or "")
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(docs: DataFrame, items: DataFrame, keep: list[str], width: int = 10, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", item_block: int = ITEM_BLOCK) -> DataFrame:
    """keep's columns of every document with n_words, spans of hit words and the items that occur."""
    spark: SparkSession = docs.sparkSession
    short_batches(spark)
    held = docs.select(F.col(text_col).cast("string").alias("__text"), *keep)
    base = [(f.name, f.dataType.simpleString()) for f in held.schema.fields]
    names = [n for n, _ in base]
    schema = ", ".join(f"`{n}` {t}" for n, t in base) + ", " + _FOUND
    wanted = items.select(F.col(item_id_col).cast("string"), F.col(item_text_col).cast("string"))
    again = False
    for block in _item_blocks(wanted, item_block):
        held = materialize(held, "searched") if again else held
        held = held.mapInArrow(_pass(spark.sparkContext.broadcast(build(block, width)), names, again), schema)
        again = True
    if not again:
        held = held.mapInArrow(_pass(spark.sparkContext.broadcast(build([], width)), names, False), schema)
    return held.drop("__text")


def contamination(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """op7: per document, how many words and items are hit and which items they are."""
    found = search(docs, items, ["doc_id"], width)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The documents that hold no window of any item, with all their columns."""
    columns = docs.columns
    kept = search(docs.select(F.struct(*columns).alias("__row"), F.col("text").alias("__own")), items, ["__row"], width, text_col="__own")
    return kept.where(F.size("spans") == 0).select(*[F.col("__row").getField(c).alias(c) for c in columns])
