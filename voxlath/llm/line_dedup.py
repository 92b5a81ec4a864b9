"""Line dedup across documents by a join on shared parts of lines, with an edit bound over words.

Two lines are near if their words (lower-cased A-Z, split at white space) are at most `edits`
insertions, deletions or substitutions of a word apart.  A line goes if an equal or near line comes
earlier, in the order of (order of the document, line number); so the earliest always stays.
Lines of fewer than `min_words` words go only for an equal one; lines without words always stay.

Equal lines are first summed to one row with their earliest place.  Near ones are found by a
deletion-neighbourhood join: lines emit hashed variants with words deleted, lines with an equal
variant are verified by their edit distance.  All variants within the bound would be quadratic in a
line's words, so the bound is split first: of the parts of the shorter line one has at most one
edit, and the variants are that part's, with one word deleted or none, at all places where it may
stand in the longer line.

What can't have a partner emits no variants.  Of two near lines the shorter one, cut into edits + 1
parts, also has a part that stands whole in the longer one, at one of few places that the lengths
fix; lines that share such a part with no other are out, and so are those whose word bitmap, in
which an edit changes at most two bits, differs too much from all with the same part.  The variants
of the others are joined in the tasks that the shared parts deal them to; a part that very many
lines have is dealt by pairs of blocks.

Null texts stay null and have no lines; empty ones have one empty line.  A null document id is
the earliest, and all rows with the same id and place are one place, so that repeated rows are
treated alike.  An empty table gives an empty result.  Other columns pass through unread.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bit_set, members
from .common import give_back, materialize, short_batches
from .hashing import _powers, mix, string_buffers, text_slices, word_hashes, word_spans

MIN_WORDS = 8
#: Words by which two lines may differ.
EDITS = 2
#: Lines of one part that are compared with each other in one go.
BLOCK = 2000
#: Pairs of lines, or of spans, that are looked at in one go.
PAIRS = 1 << 18
_P, _Q = 0xB5297A4D3F84D5A9, 0x68E31DA4C6D8E8F5
_INVERSE = {b: pow(b, -1, 1 << 64) for b in (_P, _Q)}
_EARLIEST = -(1 << 63)


@functools.lru_cache(maxsize=16)
def _table(base: int, size: int) -> np.ndarray:
    return _powers(base, size)


def _power(base: int, n: int) -> np.ndarray:
    return _table(base, 1 << max(16, int(n).bit_length()))


def _release() -> None:
    """Give back the tables of powers, as workers outlive tasks."""
    _table.cache_clear()
    give_back()


def _tidy(f):
    def run(batches):
        try:
            yield from f(batches)
        finally:
            _release()

    return run


def _sums(hashes: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _power(base, len(hashes))[: len(hashes)], out=out[1:])
    return out


def _span(sums: np.ndarray, base: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of the words [first, last), wherever they stand."""
    return mix((sums[last] - sums[first]) * _power(_INVERSE[base], len(sums))[first] + (last - first).astype(np.uint64))


class Lines:
    """Lines of a slice of texts: text, number in it, span of words, and hashes."""

    def __init__(self, part: np.ndarray, offsets: np.ndarray):
        starts, ends, _ = word_spans(part, offsets)
        self.words = word_hashes(part, starts, ends)
        breaks = np.flatnonzero(part == 10)
        of_break = np.searchsorted(offsets, breaks, side="right") - 1
        at = np.concatenate([offsets[:-1], breaks + 1])
        doc = np.concatenate([np.arange(len(offsets) - 1), of_break])
        order = np.lexsort((at, doc))
        self.doc = doc[order]
        self.number = np.arange(len(doc)) - np.searchsorted(self.doc, self.doc)
        count = np.bincount(np.searchsorted(at[order], starts, side="right") - 1, minlength=len(doc)) if len(starts) else np.zeros(len(doc), dtype=np.int64)
        self.last = np.cumsum(count)
        self.first = self.last - count
        self.sums = _sums(self.words, _P)
        self.a = _span(self.sums, _P, self.first, self.last)

    @functools.cached_property
    def b(self) -> np.ndarray:
        """A second hash of each line."""
        return _span(_sums(self.words, _Q), _Q, self.first, self.last)

    def parts(self, pick: np.ndarray, edits: int) -> np.ndarray:
        """Keys of the picked lines: first their own parts, then where they may hold a part of another line, as short or shorter by up to edits words."""
        first, n = self.first[pick], self.last[pick] - self.first[pick]
        out = []
        for shorter, part, shift in _places(edits):
            length = np.maximum(n - shorter, 0)
            at, to = length * part // (edits + 1) + shift, length * (part + 1) // (edits + 1) + shift
            good = (at >= 0) & (to <= n)
            at, to = np.where(good, at, 0), np.where(good, to, 0)
            key = _span(self.sums, _P, first + at, first + to)
            out.append(mix(key ^ (length * (edits + 1) + part).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        return np.stack(out, axis=1)

    def bags(self, pick: np.ndarray) -> np.ndarray:
        """64 bits of each picked line: which of 64 classes of words it has an odd number of."""
        bits = np.zeros(len(self.words) + 1, dtype=np.uint64)
        np.bitwise_xor.accumulate(np.uint64(1) << (self.words >> np.uint64(58)), out=bits[1:])
        return bits[self.last[pick]] ^ bits[self.first[pick]]


def _places(edits: int) -> list[tuple[int, int, int]]:
    """(words fewer, part, shift): parts of the shorter line and how far they may have moved in the longer; a line's own parts first.

    Some part has no more edits before it than its number, and no more after it than parts follow.
    """
    own = [(0, part, 0) for part in range(edits + 1)]
    moved = [(d, i, x) for d in range(edits + 1) for i in range(edits + 1) for x in range(-edits, edits + 1) if abs(x) <= i and abs(x - d) <= edits - i]
    return own + [p for p in moved if p not in own]


def _slices(column: pa.Array):
    data, offsets = string_buffers(column)
    for i, j in text_slices(offsets, 1 << 20):
        yield i, j, Lines(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def _scan(min_words: int, edits: int):
    width = len(_places(edits))

    def scan(batches):
        for batch in batches:
            ids = batch.column(1).to_numpy(zero_copy_only=False)
            for i, _, lines in _slices(batch.column(0)):
                n = lines.last - lines.first
                pick = np.flatnonzero(n > 0)
                long = n[pick] >= min_words
                keys = _long(lines.parts(pick[long], edits).reshape(-1))
                edges = np.concatenate([[0], np.cumsum(width * long)]).astype(np.int32)
                yield pa.record_batch(
                    [_long(lines.a[pick]), _long(lines.b[pick]), pa.array(ids[i + lines.doc[pick]]), pa.array(lines.number[pick].astype(np.int32)), pa.array(n[pick].astype(np.int32)), _long(lines.bags(pick)), pa.ListArray.from_arrays(pa.array(edges), keys)],
                    names=["a", "b", "doc", "line", "n", "bag", "keys"],
                )

    return scan


def _words_of(bits, min_words: int):
    """Words of lines that may be candidates; of equal lines in a slice one."""

    def scan(batches):
        own = bits.value
        for batch in batches:
            for _, _, lines in _slices(batch.column(0)):
                pick = np.flatnonzero((lines.last - lines.first >= min_words) & members(own, lines.a))
                pick = pick[np.unique(lines.a[pick], return_index=True)[1]]
                if len(pick):
                    yield pa.record_batch([_long(lines.a[pick]), _long(lines.b[pick]), pa.array([lines.words[lines.first[p] : lines.last[p]].tobytes() for p in pick], pa.binary())], names=["wa", "wb", "words"])

    return scan


def near(first: np.ndarray, second: np.ndarray, edits: int) -> bool:
    """Whether two lines' words are at most so many edits apart: how far each diagonal gets with 0, 1, ... edits."""
    n, m = len(first), len(second)
    if abs(n - m) > edits:
        return False
    stops: dict[int, np.ndarray] = {}

    def slide(i: int, d: int) -> int:
        if d not in stops:
            low, high = max(0, -d), min(n, m - d)
            stops[d] = np.append(np.flatnonzero(first[low:high] != second[low + d : high + d]) + low, high)
        return int(stops[d][np.searchsorted(stops[d], i)]) if i < stops[d][-1] else i

    reach = {0: slide(0, 0)}
    for e in range(edits + 1):
        if reach.get(m - n, -1) >= n:
            return True
        if e < edits:
            new = {}
            for d in range(-e - 1, e + 2):
                if not -n <= d <= m:
                    continue
                i = max(reach.get(d, -2) + 1, reach.get(d - 1, -1), reach.get(d + 1, -2) + 1)
                i = min(i, n, m - d)
                if i >= max(0, -d):
                    new[d] = slide(i, d)
            reach = new
    return False


def _spans(n: np.ndarray, edits: int):
    """Word spans of lines of n words that take part in the join, as (whose, part, length of the shorter line, first, last, whether it is an own part, with the span itself, with a word deleted).

    The shorter of two near lines, cut into edits // 2 + 1 parts, has one with at most one edit.
    Lines give their own parts, and what would stand there in a line longer by up to edits words:
    moved by as many words as the edits before it allow, and a word longer or shorter.
    """
    parts = edits // 2 + 1
    for fewer in range(edits + 1):
        m = n - fewer
        for part in range(parts):
            at, to = m * part // parts, m * (part + 1) // parts
            for shift in range(-edits, edits + 1):
                for change in (-1, 0, 1):
                    before, after = abs(shift), abs(fewer - shift - change)
                    if before + after + abs(change) > edits or part == 0 and shift or part == parts - 1 and after:
                        continue
                    whose = np.flatnonzero((m > 0) & (at + shift >= 0) & (to + shift + change <= n) & (to + change >= at))
                    yield whose, part, m[whose], at[whose] + shift, to[whose] + shift + change, fewer == shift == change == 0, change <= 0, change >= 0


class Spans:
    """Distinct word spans of lines given as words flat[starts : starts + n], the lines that have each, and what span variants join."""

    def __init__(self, flat: np.ndarray, starts: np.ndarray, n: np.ndarray, edits: int):
        self.flat, self.sums, self.power = flat, _sums(flat, _P), _power(_INVERSE[_P], len(flat) + 1)
        found = []
        for whose, part, shorter, first, last, own, with_all, with_less in _spans(n, edits):
            a, b = starts[whose] + first, starts[whose] + last
            tag = mix((shorter * (edits + 1) + part).astype(np.uint64) + np.uint64(edits))
            key = mix((self.sums[b] - self.sums[a]) * self.power[a] + (b - a).astype(np.uint64)) ^ tag
            found.append((key, whose, np.full(len(whose), not own), a, b, tag, np.full(len(whose), with_all), np.full(len(whose), with_less)))
        key, line, other, a, b, tag, with_all, with_less = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((line, other, key))  # of a span, the lines whose own part it is come first
        key, self.line, other = key[order], line[order], other[order]
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.key, self.start = key[edges], edges
        self.size = np.diff(np.append(edges, len(key)))
        self.own = self.size - np.add.reduceat(other.astype(np.int64), edges)
        one = order[edges]
        self.a, self.b, self.tag, self.with_all, self.with_less = a[one], b[one], tag[one], with_all[one], with_less[one]

    def variants(self) -> tuple[np.ndarray, np.ndarray]:
        """(span, key): spans as they are, and with each word deleted."""
        whole, less = np.flatnonzero(self.with_all), np.flatnonzero(self.with_less)
        a, b = self.a[less], self.b[less]
        size = b - a
        of = np.repeat(np.arange(len(less)), size)
        gone = a[of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)  # the deleted word's place
        rest = (self.sums[gone] - self.sums[a[of]]) + (self.sums[b[of]] - self.sums[gone + 1]) * self.power[1]
        short = mix(rest * self.power[a[of]] + (size[of] - 1).astype(np.uint64)) ^ self.tag[less][of]
        return np.concatenate([whole, less[of]]), np.concatenate([self.key[whole], short])

    def joined(self):
        """Pairs of spans that share a variant and of which one is some line's own part, each once; in pieces.

        Each span is joined with itself; as spans of many lines are one, what many lines share is
        joined once and not by each word that may be deleted.
        """
        whole = np.flatnonzero((self.own > 0) & (self.size > 1))
        yield whole, whole
        span, key = self.variants()
        order = np.lexsort((span, key))
        span, key = span[order], key[order]
        once = np.concatenate([[True], (np.diff(span) != 0) | (np.diff(key) != 0)])
        span, key = span[once], key[once]
        edges = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        rank = np.arange(len(key)) - np.repeat(edges, np.diff(np.append(edges, len(key))))
        live, back, held, count = np.flatnonzero(rank > 0), 1, [], 0
        while len(live):
            x, y = span[live - back], span[live]  # x < y
            good = (self.own[x] > 0) | (self.own[y] > 0)
            held.append(x[good] * len(self.key) + y[good])
            count += len(held[-1])
            back += 1
            live = live[rank[live] >= back]
            if count > PAIRS or not len(live):
                codes = np.unique(np.concatenate(held))
                yield codes // len(self.key), codes % len(self.key)
                held, count = [], 0

    def pairs(self):
        """(line, line): all pairs of lines that have joined spans, the one or the other as its own part; in pieces of some PAIRS."""
        for x, y in self.joined():
            start, size = np.concatenate([self.start[x], self.start[x] + self.own[x]]), np.concatenate([self.own[x], self.size[x] - self.own[x]])
            against, width = np.tile(self.start[y], 2), np.concatenate([self.size[y], np.where(x == y, 0, self.own[y])])
            full = np.flatnonzero(size * width > 0)
            start, size, against, width = start[full], size[full], against[full], width[full]
            tall = np.maximum(1, PAIRS // width)  # lines of the first span in a piece
            pieces = -(-size // tall)
            of = np.repeat(np.arange(len(size)), pieces)
            skip = (np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * tall[of]
            start, against, width, rows = start[of] + skip, against[of], width[of], np.minimum(tall[of], size[of] - skip)
            upto = np.cumsum(rows * width)
            i = 0
            while i < len(of):
                j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + PAIRS, side="right")))
                total = rows[i:j] * width[i:j]
                piece = np.repeat(np.arange(i, j), total)
                at = np.arange(len(piece)) - np.repeat(np.cumsum(total) - total, total)
                yield self.line[start[piece] + at // width[piece]], self.line[against[piece] + at % width[piece]]
                i = j


def _odd(values: np.ndarray, line: np.ndarray, lines: int) -> np.ndarray:
    """512 bits of each line: which of 512 classes it has an odd number of."""
    bits = np.zeros((lines, 8), dtype=np.uint64)
    np.bitwise_xor.at(bits, (line, (values >> np.uint64(61)).astype(np.int64)), np.uint64(1) << ((values >> np.uint64(55)) & np.uint64(63)))
    return bits


def near_earlier(words: list[np.ndarray], edits: int) -> np.ndarray:
    """Which of the lines, the earliest first, are near to an earlier one: equal variants join them, the edit distance decides.

    Before it is measured, bitmaps rule pairs out: an edit changes at most two words, and four pairs of neighbours.
    """
    n = np.array([len(w) for w in words], dtype=np.int64)
    flat, found = np.concatenate(words), np.zeros(len(words), dtype=bool)
    line = np.repeat(np.arange(len(words)), n)
    mixed = mix(flat)
    single = _odd(mixed, line, len(words))
    beside = np.flatnonzero(line[1:] == line[:-1])
    double = _odd(mix(mixed[beside] * np.uint64(_P) + mixed[beside + 1]), line[beside], len(words))
    few = np.bitwise_xor.reduce(single, axis=1)
    for x, y in Spans(flat, np.cumsum(n) - n, n, edits).pairs():
        late, early = np.maximum(x, y), np.minimum(x, y)
        at = np.flatnonzero((late != early) & ~found[late])
        at = at[np.bitwise_count(few[late[at]] ^ few[early[at]]) <= 2 * edits]
        at = at[np.abs(n[late[at]] - n[early[at]]) <= edits]
        for bits, most in ((single, 2 * edits), (double, 4 * edits)):
            at = at[np.bitwise_count(bits[late[at]] ^ bits[early[at]]).sum(axis=1, dtype=np.int64) <= most]
        for code in np.unique(late[at] * len(words) + early[at]).tolist():
            k, j = divmod(code, len(words))
            if not found[k] and near(words[j], words[k], edits):
                found[k] = True
    return found


def _ordered(table: pa.Table, names: list[str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A table's rows by names, each once, and the columns of those."""
    columns = {c: table.column(c).to_numpy() for c in names}
    order = np.lexsort([columns[c] for c in reversed(names)])
    columns = {c: x[order] for c, x in columns.items()}
    if len(order):
        once = np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in columns.values()])])
        order, columns = order[once], {c: x[once] for c, x in columns.items()}
    return order, columns


def _marked(a: np.ndarray, b: np.ndarray, found: np.ndarray) -> pa.Table:
    out = np.unique(np.stack([a[found], b[found]], axis=1), axis=0)
    _release()
    return pa.table({"a": pa.array(out[:, 0]), "b": pa.array(out[:, 1])})


def _maybe(edits: int):
    """Of the lines of one part, those whose bitmaps and lengths let a pair be near."""

    def lines_of(n: np.ndarray, bag: np.ndarray) -> np.ndarray:
        n = n.astype(np.int16 if n.max() < 1 << 14 else np.int64)
        found = np.zeros(len(n), dtype=bool)
        for start in range(0, len(n), 256):
            upto = min(len(n), start + 256)
            own = slice(start, upto)
            pairs = (np.bitwise_count(bag[own, None] ^ bag[None, :upto]) <= 2 * edits) & (np.abs(n[own, None] - n[None, :upto]) <= edits)
            pairs &= np.arange(upto)[None, :] < np.arange(start, upto)[:, None]
            found[own] |= pairs.any(axis=1)
            found[:upto] |= pairs.any(axis=0)
        return found

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, columns = _ordered(table, ["key", "cell", "a", "b", "n", "bag"])
        edges = np.concatenate([[0], np.flatnonzero((np.diff(columns["key"]) != 0) | (np.diff(columns["cell"]) != 0)) + 1, [len(columns["key"])]])
        found = np.zeros(len(columns["key"]), dtype=bool)
        for i, j in zip(edges.tolist(), edges[1:].tolist()):
            if j - i > 1:
                found[i:j] = lines_of(columns["n"][i:j], columns["bag"][i:j].view(np.uint64))
        return _marked(columns["a"], columns["b"], found)

    return compare


def _near(edits: int):
    """Lines that are near to an earlier one of the same bucket."""

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        order, columns = _ordered(table, ["doc", "line", "a", "b"])
        blobs = table.column("words").combine_chunks()
        words = [np.frombuffer(blobs[k].as_py(), dtype=np.uint64) for k in order.tolist()]
        found = near_earlier(words, edits) if len(words) > 1 else np.zeros(len(words), dtype=bool)
        return _marked(columns["a"], columns["b"], found)

    return compare


def _place(df: DataFrame, id_col: str) -> F.Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(_EARLIEST))


def kept_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, edits: int = EDITS) -> DataFrame:
    """(doc, line, a): the place and hash of each line with words that stays."""
    spark = docs.sparkSession
    short_batches(spark)
    own = docs.select(F.col(text_col).cast("string").alias("__text"), _place(docs, id_col).alias("__doc"))
    rows = own.mapInArrow(_tidy(_scan(min_words, edits)), "a long, b long, doc long, line int, n int, bag long, keys array<long>")
    first = F.min(F.struct("doc", "line"))
    lines = rows.groupBy("a", "b").agg(first.alias("at"), F.any_value("n").alias("n"), F.any_value("bag").alias("bag"), F.any_value("keys").alias("keys"))
    lines = materialize(lines.select("a", "b", "at.doc", "at.line", "n", "bag", "keys"), "lines")

    exploded = lines.select(F.posexplode("keys").alias("at", "key"), "a")
    shared = exploded.groupBy("key").agg(F.count("*").alias("lines"), F.min("at").alias("at")).where((F.col("lines") > 1) & (F.col("at") <= edits)).select("key", F.ceil(F.col("lines") / BLOCK).cast("int").alias("blocks"))
    held = materialize(exploded.select("key", "a").join(shared, "key").distinct(), "line-parts")
    block = F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.least(x, block) * F.col("blocks") + F.greatest(x, block))
    dealt = held.select("key", "a", F.explode(cells).alias("cell"))
    buckets = max(8, 4 * own.rdd.getNumPartitions())
    bucket = F.pmod(F.xxhash64("key", "cell"), F.lit(buckets)).alias("bucket")

    members = dealt.join(lines.select("a", "b", "doc", "line", "n", "bag"), "a")
    maybe = members.groupBy(bucket).applyInArrow(_maybe(edits), "a long, b long").distinct()
    maybe = materialize(maybe, "line-candidates")
    bits = spark.sparkContext.broadcast(bit_set(maybe, "a"))
    words = own.select("__text").mapInArrow(_tidy(_words_of(bits, min_words)), "wa long, wb long, words binary").groupBy("wa", "wb").agg(F.any_value("words").alias("words"))
    worded = lines.select("a", "b", "doc", "line", "n", "bag").join(maybe, ["a", "b"], "left_semi").join(words, (F.col("a") == F.col("wa")) & (F.col("b") == F.col("wb"))).drop("wa", "wb")
    gone = dealt.join(worded, "a").groupBy(bucket).applyInArrow(_near(edits), "a long, b long").distinct()
    return lines.join(gone, ["a", "b"], "left_anti").select("doc", "line", "a")


def _staying(lines: Lines, kept: pa.ListArray) -> np.ndarray:
    """Which lines of a slice are among those that stay, by document, number and hash."""
    places, doc = kept.flatten(), np.repeat(np.arange(len(kept)), kept.value_lengths().fill_null(0).to_numpy())
    size = len(lines.doc)
    doc = np.concatenate([lines.doc, doc])
    number = np.concatenate([lines.number, places.field("line").to_numpy().astype(np.int64)])
    hashed = np.concatenate([lines.a.view(np.int64), places.field("a").to_numpy()])
    order = np.lexsort((np.arange(len(doc)) < size, hashed, number, doc))  # a line comes after its equals that stay
    doc, number, hashed = doc[order], number[order], hashed[order]
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (number[1:] != number[:-1]) | (hashed[1:] != hashed[:-1])])
    first = order[np.flatnonzero(new)] >= size
    out = np.zeros(len(order), dtype=bool)
    out[order] = first[np.cumsum(new) - 1]
    return out[:size]


def _rewrite(batches):
    for batch in batches:
        texts, kept = batch.column(0), batch.column(1)
        n_lines, n_removed, parts = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64), []
        valid = texts.is_valid().to_numpy(zero_copy_only=False)
        for i, j, lines in _slices(texts):
            flags = (lines.last == lines.first) | _staying(lines, kept.slice(i, j - i))
            edges = np.searchsorted(lines.doc, np.arange(j - i + 1))
            gone = np.concatenate([[0], np.cumsum(~flags)])[edges]
            n_lines[i:j], n_removed[i:j] = np.where(valid[i:j], np.diff(edges), 0), np.where(valid[i:j], np.diff(gone), 0)
            changed = np.flatnonzero(n_removed[i:j])
            for d in changed.tolist():
                own = flags[edges[d] : edges[d + 1]].tolist()
                parts.append("\n".join(x for x, f in zip(texts[i + d].as_py().split("\n"), own) if f))
        out = pc.replace_with_mask(texts, pa.array(n_removed > 0), pa.array(parts, pa.string())) if parts else texts
        yield pa.record_batch([*(batch.column(c) for c in range(2, batch.num_columns)), out, pa.array(n_lines), pa.array(n_removed)], names=[*batch.schema.names[2:], "text", "n_lines", "n_removed"])


def dedup(docs: DataFrame, keep: list[str], id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, edits: int = EDITS) -> DataFrame:
    """keep's columns of every document with its remaining text, n_lines it had and n_removed of them."""
    kept = kept_lines(docs, id_col, text_col, min_words, edits).groupBy(F.col("doc").alias("__of")).agg(F.collect_list(F.struct("line", "a")).alias("__kept"))  # the lines of one document
    rows = docs.select(F.col(text_col).cast("string").alias("__text"), _place(docs, id_col).alias("__doc"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)])
    joined = rows.join(kept.hint("shuffle_hash"), F.col("__doc") == F.col("__of"), "left").select("__text", "__kept", *[f"__k{i}" for i in range(len(keep))])
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields[2:]), "text string, n_lines long, n_removed long"])
    out = joined.mapInArrow(_tidy(_rewrite), schema)
    return out.select(*[F.col(f"__k{i}").alias(c) for i, c in enumerate(keep)], F.col("text").alias("kept_text"), "n_lines", "n_removed")


def digests(docs: DataFrame, min_words: int = MIN_WORDS, edits: int = EDITS) -> DataFrame:
    """op4: per document the number of lines, of removed ones, and the hash of what stays; a null text gives null."""
    out = dedup(docs, ["doc_id"], min_words=min_words, edits=edits)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))
