"""N-gram Jaccard join: documents whose sets of word shingles overlap enough, as classes.

Documents with equal sets are summed to one set first.  Sets that may link share a signature: a
set is dealt by hash into more segments than its link can have differences, so that one segment
agrees whole; segments' hashes are the keys on which sets meet.  Keys that come twice are found
from the keys alone, and only these are passed on with their sets; they join sets into candidate
groups, as stars around the least set of each key, never as pairs.

Inside a group the links are found by T-occurrence search over an inverted index: a set must
share T shingles with its partner, so the T-1 longest of its lists are set aside, the short
lists are merged on a heap, and what comes up is probed for in the long lists by binary search
(DivideSkip).  Searches skip sets that are linked already and stop when one class is left.

Chance agreements can chain unrelated sets into groups larger than a block.  In such groups the
sets of each key are compared by parity bitmaps first: bits that differ are at most the shingles
that differ, so what exceeds the bound can't link.  The sets that may link form the new groups.
Those that are still larger than a block are dealt into blocks which all hold the group's pilot,
the set that most others may link with; sets that are not of the pilot's class afterwards are
searched in all blocks of the group.

Null and empty texts have no shingles and link with nothing; each is its own class.  A text of
fewer words than a shingle has is one shingle.  Repeated rows are exact copies.  A null id is in
a class like any other and never its name unless all are null.  Only the columns named are used.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import bit_set, members
from .common import give_back, materialize, short_batches, tidy
from .components import components
from .hashing import chain, mix, string_buffers, text_slices, word_hashes, word_spans

#: Sets, and shingles, of a group that one task searches at once.
BLOCK_SETS, BLOCK_SHINGLES = 1500, 1_500_000
#: Keys that a task holds before it passes them on.
KEYS_HELD = 500_000
#: Sets of a key that are compared by bitmaps; with more, all may link.
KEY_SETS = 2000
#: Rows of bitmaps that one task compares, about, and bits of a bitmap at most.
BITMAP_ROWS, BITMAP_BITS = 50_000, 4096
#: Parts in which the documents of one set are joined with its class.
SALTS = 16
#: Ratio of the sizes at which segments' numbers change.
_STEP = 1.3
_OTHER = np.uint64(0x2545F4914F6CDD1D)


def shingle_sets(column: pa.Array, width: int):
    """(text's place, sorted distinct shingle hashes) of every text of a column."""
    data, offsets = string_buffers(column)
    for i, j in text_slices(offsets, 1 << 20):
        part = data[offsets[i] : offsets[j]]
        starts, ends, counts = word_spans(part, offsets[i : j + 1] - offsets[i])
        words = word_hashes(part, starts, ends)
        grams = words
        for k in range(1, width):
            grams = chain(grams[:-1], words[k:]) if len(grams) > 1 else grams[:0]
        at = 0
        for d, n in enumerate(counts.tolist()):
            if n >= width:
                yield i + d, np.unique(grams[at : at + n - width + 1])
            elif n:
                short = words[at : at + 1]
                for k in range(1, n):
                    short = chain(short, words[at + k : at + k + 1])
                yield i + d, mix(short + np.uint64(n))
            else:
                yield i + d, words[:0]
            at += n


class Segments:
    """Numbers of segments by set size, for links of at least `percent` Jaccard similarity."""

    def __init__(self, percent: int):
        self.percent = percent
        self.bounds = [1]

    def _bound(self, i: int) -> int:
        while len(self.bounds) <= i:
            self.bounds.append(max(self.bounds[-1] + 1, int(self.bounds[-1] * _STEP)))
        return self.bounds[i]

    def _class(self, size: int) -> int:
        i = 0
        while self._bound(i + 1) <= size:
            i += 1
        return i

    def keys(self, own: np.ndarray) -> np.ndarray:
        """Keys of a set: for each class of sizes that the smaller of two linked sets can have.

        Linked sets differ in at most (100 - percent) / percent of the smaller one's size; with
        one segment more than that, and one more for each that is empty in both, one segment
        that isn't empty agrees.  A set with too many empty segments is dealt once more.
        """
        n, out = len(own), []
        if not n:
            return own
        for c in range(self._class(-(-n * self.percent // 100)), self._class(n) + 1):
            differ = (self._bound(c + 1) - 1) * (100 - self.percent) // self.percent
            if not differ:
                continue  # only equal sets link
            spare = 1 + (differ + 1) // 16
            parts = differ + 1 + spare
            seed = 0
            while True:
                tag = np.uint64((c << 40 | seed << 32) * 0x9E3779B9 % (1 << 64))
                part = (mix(own + tag) >> np.uint64(16)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                edge = np.flatnonzero(np.concatenate([[True], np.diff(part[order]) > 0]))
                total = np.add.reduceat(mix(own[order] ^ _OTHER), edge)
                out.append(mix(total ^ mix(part[order][edge] + tag)))
                if parts - len(edge) <= spare:
                    break
                seed += 1
        return np.concatenate(out) if out else own[:0]


def _set_id(own: np.ndarray) -> tuple[int, int]:
    if not len(own):
        return 0, 0
    return tuple(int(mix(np.add.reduce(mix(own ^ tag), keepdims=True) + np.uint64(len(own)))[0].view(np.int64)) for tag in (np.uint64(0), _OTHER))


def _measure(width: int):
    def measure(batches):
        for batch in batches:
            rows = [(len(own), *_set_id(own)) for _, own in shingle_sets(batch.column(0), width)]
            yield pa.record_batch([batch.column(1), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3))], names=["id", "n", "lo", "hi"])

    return measure


def _keys(batches, width: int, percent: int, bits: np.ndarray | None):
    """Distinct (key, set) pairs as two arrays, a bounded number at a time; only keys that bits may hold."""
    segments, keys, sets, held = Segments(percent), [], [], 0

    def pairs():
        key, own = np.concatenate(keys), np.concatenate(sets)
        order = np.lexsort((own, key))
        key, own = key[order], own[order]
        new = np.concatenate([[True], (np.diff(key) != 0) | (np.diff(own) != 0)])
        return key[new], own[new]

    for batch in batches:
        for _, own in shingle_sets(batch.column(0), width):
            found = segments.keys(own)
            if bits is not None:
                found = found[members(bits, found)]
            if len(found):
                keys.append(found), sets.append(np.full(len(found), _set_id(own)[0], dtype=np.int64))
                held += len(found)
            if held >= KEYS_HELD:
                yield pairs()
                keys, sets, held = [], [], 0
    if held:
        yield pairs()


def _key_blocks(width: int, percent: int, buckets: int):
    """Keys alone, one for each set of a task that has them, as blocks by bucket."""

    def emit(batches):
        for key, _ in _keys(batches, width, percent, None):
            where = (key >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array([key[order[edges[b] : edges[b + 1]]].tobytes() for b in full], pa.binary())], names=["bucket", "data"])

    return emit


def _repeated(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """A bucket's keys that come more than once."""
    keys = np.sort(np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("data")]))
    return pa.table({"key": pa.array(np.unique(keys[1:][keys[1:] == keys[:-1]]).view(np.int64))})


def _keyed(bits, width: int, percent: int):
    def emit(batches):
        for key, own in _keys(batches, width, percent, bits.value):
            yield pa.record_batch([pa.array(key.view(np.int64)), pa.array(own)], names=["key", "lo"])

    return emit


def _fetch(bits, width: int, form):
    """Sets that may be wanted, from the one row that stands for each set, as the array that form makes of them."""

    def fetch(batches):
        for batch in batches:
            rows = []
            mark = batch.column(1).to_numpy(zero_copy_only=False)
            for i, own in shingle_sets(batch.column(0), width):
                a, b = _set_id(own)
                if len(own) and members(bits.value, np.array([a ^ int(mark[i])], dtype=np.int64).view(np.uint64))[0]:
                    rows.append((a, b, int(mark[i]), form(own).tobytes()))
                if len(rows) >= 500:
                    yield _set_batch(rows)
                    rows = []
            if rows:
                yield _set_batch(rows)

    return fetch


def _set_batch(rows) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=["slo", "shi", "smark", "data"])


def _fetched(own: DataFrame, wanted: DataFrame, width: int, form) -> DataFrame:
    """The wanted sets (lo, hi, mark, more columns) with their data, in one pass over the texts."""
    bits = own.sparkSession.sparkContext.broadcast(bit_set(wanted.select(F.col("lo").bitwiseXOR(F.col("mark")).alias("h")), "h"))
    found = own.select("__text", "mark").mapInArrow(tidy(_fetch(bits, width, form)), "slo long, shi long, smark long, data binary")
    found = wanted.join(found, (F.col("lo") == F.col("slo")) & (F.col("hi") == F.col("shi")) & (F.col("mark") == F.col("smark")))
    return found.drop("slo", "shi", "smark").dropDuplicates(["lo", "hi", "mark"])


class Index:
    """Inverted lists of a block of sets."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets = sets
        self.n = len(sets)
        flat = np.concatenate(sets)
        self.shingles, rank = np.unique(flat, return_inverse=True)
        entries = rank.astype(np.int64) * self.n + np.repeat(np.arange(self.n), [len(s) for s in sets])
        entries.sort()
        self.entries = entries
        self.edges = np.searchsorted(entries, np.arange(len(self.shingles) + 1) * self.n)
        self.sizes = np.array([len(s) for s in sets])

    def search(self, own: np.ndarray, percent: int, wanted: np.ndarray) -> np.ndarray:
        """Places of the wanted sets whose Jaccard similarity with own reaches percent."""
        need = -(-len(own) * percent // 100)  # shared shingles that any partner has
        at = np.searchsorted(self.shingles, own)
        at = at[(at < len(self.shingles)) & (self.shingles[np.minimum(at, len(self.shingles) - 1)] == own)]
        if len(at) < need:
            return at[:0]
        length = self.edges[at + 1] - self.edges[at]
        order = at[np.argsort(length, kind="stable")]
        short, long = order[: len(order) - need + 1], order[len(order) - need + 1 :]
        counts = self._merge(short)
        found = []
        for place, count in counts:
            if not wanted[place] or count + len(long) < need or 100 * min(len(own), self.sizes[place]) < percent * max(len(own), self.sizes[place]):
                continue
            key = long * self.n + place  # binary probe of the long lists
            spot = np.minimum(np.searchsorted(self.entries, key), len(self.entries) - 1)
            shared = count + int((self.entries[spot] == key).sum())
            if 100 * shared >= percent * (len(own) + int(self.sizes[place]) - shared):
                found.append(place)
        return np.array(found, dtype=np.int64)

    def _merge(self, short: np.ndarray):
        """(place, number of lists) over the short lists."""
        lists = [self.entries[self.edges[r] : self.edges[r + 1]] - r * self.n for r in short]
        if sum(map(len, lists)) <= 2048:
            return [(place, sum(1 for _ in same)) for place, same in groupby(heapq.merge(*[x.tolist() for x in lists]))]
        places, counts = np.unique(np.concatenate(lists), return_counts=True)
        return list(zip(places.tolist(), counts.tolist()))


class Classes:
    """Disjoint sets of places."""

    def __init__(self, n: int):
        self.root = np.arange(n)
        self.left = n

    def of(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.of(i), self.of(j)
        if i != j:
            self.root[max(i, j)] = min(i, j)
            self.left -= 1
        return i != j

    def all(self) -> np.ndarray:
        while not np.array_equal(self.root, self.root[self.root]):
            self.root = self.root[self.root]
        return self.root


def link_block(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that make the block's classes.

    Of two linked sets of different classes one is outside the largest class so far; only such
    sets are searched for, besides the first one.
    """
    if len(sets) < 2:
        return []
    index, classes, links = Index(sets), Classes(len(sets)), []
    todo = np.ones(len(sets), dtype=bool)
    query = 0
    while classes.left > 1:
        todo[query] = False
        root = classes.all()
        for place in index.search(sets[query], percent, root != root[query]).tolist():
            if classes.join(query, place):
                links.append((query, place))
        root = classes.all()
        largest = np.bincount(root).argmax()
        rest = np.flatnonzero(todo & (root != largest))
        if not len(rest):
            break
        query = int(rest[0])
    return links


def _links(ids: list[int], pairs: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"u": pa.array([ids[a] for a, _ in pairs], pa.int64()), "v": pa.array([ids[b] for _, b in pairs], pa.int64())})


def _search_blocks(percent: int):
    """All blocks of a bucket, one after the other."""

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("block", "ascending"), ("part", "ascending"), ("lo", "ascending")])
        names = list(zip(table.column("block").to_pylist(), table.column("part").to_pylist()))
        ids, blobs = table.column("lo").to_pylist(), table.column("shingles")
        out, at = [_links([], [])], 0
        for _, same in groupby(names):
            n = sum(1 for _ in same)
            out.append(_links(ids[at : at + n], link_block([np.frombuffer(blobs[i].as_py(), dtype=np.uint64) for i in range(at, at + n)], percent)))
            at += n
        give_back()
        return pa.concat_tables(out)

    return search


def _search_rest(percent: int):
    """Sets outside the main class of a large group, against one block of the group."""

    def search(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("lo", "ascending"), ("asks", "ascending")])
        asks = np.array(table.column("asks").to_pylist(), dtype=bool)
        ids = table.column("lo").to_pylist()
        sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("shingles")]
        there = np.flatnonzero(~asks)
        if not len(there):
            return _links([], [])
        index, known, pairs = Index([sets[i] for i in there]), Classes(len(ids)), []
        for q in np.flatnonzero(asks).tolist():
            root = known.all()
            for p in there[index.search(sets[q], percent, root[there] != root[q])].tolist():
                if known.join(q, p):  # of a class only the links that make it
                    pairs.append((q, p))
        give_back()
        return _links(ids, pairs)

    return search


def parity_bitmap(own: np.ndarray) -> np.ndarray:
    """A set's shingles as bits by hash, each bit the parity of its shingles' number; a power of two of 64-bit words."""
    m = 64
    while m < min(len(own), BITMAP_BITS):
        m *= 2
    odd = np.bincount((mix(own ^ _OTHER) & np.uint64(m - 1)).astype(np.int64), minlength=m) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def may_link(sizes: np.ndarray, bitmaps: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of places that connect all sets whose bitmaps don't rule out a link.

    Bitmaps are folded to the shortest one's length.  Sets a and b link if they differ in at most
    (100 - percent) / (100 + percent) * (|a| + |b|) shingles.
    """
    words = min(map(len, bitmaps))
    bits = np.stack([np.bitwise_xor.reduce(x.reshape(-1, words), axis=0) for x in bitmaps])
    left, pairs = np.arange(1, len(sizes)), []
    queue = [0]
    while len(left):
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        q = queue.pop()
        differ = np.bitwise_count(bits[left] ^ bits[q]).sum(axis=1, dtype=np.int64)
        differ = np.maximum(differ, np.abs(sizes[left] - sizes[q]))
        near = (100 + percent) * differ <= (100 - percent) * (sizes[left] + sizes[q])
        pairs += [(q, p) for p in left[near].tolist()]
        queue += left[near].tolist()
        left = left[~near]
    return pairs


def _compare(percent: int):
    """May-links of all keys of a bucket."""

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("lo", "ascending")])
        keys, sizes, ids = (table.column(c).to_numpy() for c in ("key", "n", "lo"))
        blobs, pairs = table.column("bits").to_pylist(), []
        edges = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1, [len(keys)]])
        for i, j in zip(edges[:-1].tolist(), edges[1:].tolist()):
            pairs += [(i + a, i + b) for a, b in may_link(sizes[i:j], [np.frombuffer(x, dtype=np.uint64) for x in blobs[i:j]], percent)]
        give_back()
        return _links(ids, pairs)

    return compare


def _may_links(large: DataFrame, keyed: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """May-links (u, v) between sets of large groups; keys with the same sets are compared once."""
    own = materialize(keyed.join(large.select("lo"), "lo", "left_semi").distinct(), "large-keys")
    members = own.groupBy("key").agg(F.count("*").alias("k"), F.sum(F.xxhash64("lo").cast("decimal(38,0)")).alias("who"), F.bit_xor(F.xxhash64("lo")).alias("too")).where("k > 1")
    chosen = materialize(members.groupBy("k", "who", "too").agg(F.min("key").alias("key")).select("key", "k"), "chosen-keys")
    met = own.join(chosen, "key")
    bitmaps = _fetched(texts, large.select("lo", "hi", "mark", "n"), width, parity_bitmap).select("lo", "n", F.col("data").alias("bits"))
    few = met.where(F.col("k") <= KEY_SETS).select("key", "lo")
    buckets = max(8, few.count() // BITMAP_ROWS)
    near = few.join(bitmaps, "lo").groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")).applyInArrow(_compare(percent), "u long, v long")
    many = met.where(F.col("k") > KEY_SETS)
    stars = many.join(many.groupBy("key").agg(F.min("lo").alias("hub")), "key").where("lo <> hub").select(F.col("lo").alias("u"), F.col("hub").alias("v"))
    return materialize(near.unionByName(stars).distinct(), "may-links")


def _dealt(groups: DataFrame) -> DataFrame:
    """(block, parts) of every group of sets."""
    parts = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    return groups.groupBy("block").agg(parts.alias("parts"))


def _set_links(sets: DataFrame, own: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (u, v) between sets, enough to make all classes."""
    spark = sets.sparkSession
    buckets = max(8, 2 * own.rdd.getNumPartitions())
    # Most keys come once: a first pass finds the others from the keys alone, a second passes on who has them.
    blocks = own.select("__text").mapInArrow(tidy(_key_blocks(width, percent, buckets)), "bucket int, data binary")
    again = materialize(blocks.groupBy("bucket").applyInArrow(_repeated, "key long"), "repeated-keys")
    repeated = spark.sparkContext.broadcast(bit_set(again, "key"))
    keyed = materialize(own.select("__text").mapInArrow(tidy(_keyed(repeated, width, percent)), "key long, lo long"), "keys")
    shared = keyed.groupBy("key").agg(F.min("lo").alias("hub"), F.max("lo").alias("most")).where("hub <> most").select("key", "hub")
    stars = keyed.join(shared, "key").where("lo <> hub").select(F.col("lo").alias("u"), F.col("hub").alias("v"))
    sizes = components(stars).withColumnRenamed("id", "lo").join(sets.select("lo", "hi", "n", "mark"), "lo")
    sizes = materialize(sizes.withColumnRenamed("component", "block"), "candidate-sets")
    sizes = sizes.join(_dealt(sizes), "block").withColumn("pilot", F.col("block"))
    large = sizes.where("parts > 1").drop("block", "parts", "pilot")
    if not large.isEmpty():
        may = _may_links(large, keyed, own, width, percent)
        groups = components(may).select(F.col("id").alias("lo"), F.col("component").alias("block"))
        groups = materialize(groups.join(large, "lo"), "narrower-groups")
        ends = may.select("u").unionByName(may.select(F.col("v").alias("u"))).groupBy(F.col("u").alias("lo")).count()
        pilots = groups.join(ends, "lo").groupBy("block").agg(F.max_by("lo", F.struct("count", -F.col("lo"))).alias("pilot"))
        sizes = sizes.where("parts = 1").unionByName(groups.join(_dealt(groups).join(pilots, "block"), "block"))
    full = _fetched(own, materialize(sizes.drop("n"), "wanted-sets"), width, np.asarray)
    full = materialize(full.select("block", "parts", "pilot", "lo", F.col("data").alias("shingles")), "candidate-shingles")

    dealt = full.withColumn("part", F.pmod(F.xxhash64("lo"), F.col("parts")).cast("int"))
    first = full.where("parts > 1 and lo = pilot")  # the pilot of a large group goes to all its blocks
    spread = dealt.where("parts = 1 or lo <> pilot").unionByName(first.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))))
    bucket = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("block"), F.lit(buckets)).cast("long")).otherwise(F.xxhash64("block", "part"))
    schema = "u long, v long"
    spread = spread.select(bucket.alias("bucket"), "block", "part", "lo", "shingles")
    links = materialize(spread.groupBy("bucket").applyInArrow(_search_blocks(percent), schema), "links-in-blocks")

    dealt = dealt.where("parts > 1")
    if dealt.isEmpty():
        return links
    classes = components(links)
    named = dealt.join(classes.select(F.col("id").alias("lo"), F.col("component").alias("own")), "lo", "left")
    main = named.where("lo = pilot").select("block", F.coalesce("own", "lo").alias("main"))
    named = materialize(named.join(main, "block").withColumn("asks", F.coalesce("own", "lo") != F.col("main")), "large-groups")
    turns = F.floor(F.pmod(F.xxhash64("lo", F.lit(1)), F.lit(1 << 30)) / F.lit(1 << 30) * F.col("turns")).cast("int")
    count = named.where("asks").groupBy("block").agg(F.ceil(F.count("*") / BLOCK_SETS).cast("int").alias("turns"))
    asking = named.where("asks").join(count, "block").withColumn("turn", turns).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    there = named.join(count, "block").withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)))
    columns = ["block", "part", "turn", "lo", "shingles", "asks"]
    rest = asking.select(*columns).unionByName(there.withColumn("asks", F.lit(False)).select(*columns))
    return links.unionByName(rest.groupBy("block", "part", "turn").applyInArrow(_search_rest(percent), schema))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, percent: int = 90) -> DataFrame:
    """(id, n_shingles, component): every document with the least id that it reaches by links."""
    own = docs.select(F.col(text_col).cast("string").alias("__text"), F.col(id_col).alias("id"), F.xxhash64(F.col(id_col)).alias("mark"))
    short_batches(docs.sparkSession)
    kind = own.schema["id"].dataType.simpleString()
    measured = materialize(own.select("__text", "id").mapInArrow(tidy(_measure(width)), f"id {kind}, n long, lo long, hi long"), "shingle-counts")
    sets = materialize(
        measured.where("n > 0").groupBy("lo", "hi").agg(F.min("id").alias("first"), F.min(F.xxhash64("id")).alias("mark"), F.count("*").alias("copies"), F.any_value("n").alias("n")), "shingle-sets"
    )
    linked = components(_set_links(sets, own, width, percent))
    named = sets.select("lo", "hi", "first", "copies").join(linked.select(F.col("id").alias("lo"), "component"), "lo", "left")
    named = named.where("copies > 1 or component is not null")
    least = named.groupBy(F.coalesce("component", "lo").alias("class")).agg(F.min("first").alias("least"))
    final = named.select("lo", "hi", F.coalesce("component", "lo").alias("class")).join(least, "class")
    # Sets that have one document and no link need no join; the others meet their documents in SALTS parts.
    final = final.select(F.col("lo").alias("l"), F.col("hi").alias("h"), "least", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("p"))
    rows = measured.select("id", "n", "lo", "hi", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt"))
    return rows.join(final, (F.col("lo") == F.col("l")) & (F.col("hi") == F.col("h")) & (F.col("salt") == F.col("p")), "left").select("id", F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component"))


def join(docs: DataFrame, width: int = 3, percent: int = 90) -> DataFrame:
    """op5: doc_id, n_shingles and component_id of every document."""
    return classes(docs, width=width, percent=percent).select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))
