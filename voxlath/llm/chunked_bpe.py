"""BPE encoding and decoding with content-defined chunk reuse.

A rolling hash over the last bytes picks the cuts, so that a passage shared by documents falls
into the same chunks wherever it stands.  Chunks that two documents or more have are encoded once:
a first pass over the texts sends hashes of chunks alone and finds those that come again, a second
one sends these chunks, each once from every task, and their ids are stored in the shared folder as
arrays sorted by hash, which the encoding workers map.  All other chunks are encoded where they
stand.  Where two chunks meet, the tokens on both sides are encoded again together; the window
grows until its outer tokens agree with those already there, and what it then gives stands.

`Codec.encode` is the same for one worker: it encodes a distinct chunk once and keeps its ids in a
bounded cache, the oldest going first.

Null texts count as empty and give no ids.  The special token's string in a text is that token.
Repeated rows give repeated results, an empty table an empty one; only the columns named are
kept.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import os
from array import array
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import arrays
from .bloom import bit_set, members
from .common import fresh_path, local_path, materialize, short_batches, tidy
from .hashing import SPACE, mix

SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
#: Bytes that the rolling hash covers, and the share of eligible places (a space after a word) that are cuts: 1 / (CUT_MASK + 1).
WINDOW, CUT_MASK = 16, 63
#: Bytes of chunks whose ids a worker keeps.
CACHE_BYTES = 16 << 20
_PIECE = 1 << 18
_CODE = mix(np.arange(1000, 1256, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C55
_POWER = np.multiply.accumulate(np.array([1] + [_BASE] * (_PIECE + WINDOW), dtype=np.uint64))
_UNPOWER = np.multiply.accumulate(np.array([1] + [pow(_BASE, -1, 1 << 64)] * (_PIECE + WINDOW), dtype=np.uint64))


def cuts(data: np.ndarray) -> np.ndarray:
    """Where chunks after the first begin: spaces that follow a word, picked by the hash of the bytes before."""
    n = len(data)
    place = np.flatnonzero((data[1:] == 32) & ~SPACE[data[:-1]]) + 1 if n > 1 else np.zeros(0, dtype=np.int64)
    place = place[place >= WINDOW]
    picked = []
    for base in range(0, n, _PIECE):
        own = place[(place >= base) & (place < base + _PIECE)] if n > _PIECE else place
        if not len(own):
            continue
        low = max(0, base - WINDOW)
        part = data[low : min(n, base + _PIECE)]
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_CODE[part] * _POWER[: len(part)], out=total[1:])
        at = own - low
        rolling = mix((total[at] - total[at - WINDOW]) * _UNPOWER[at - WINDOW])
        picked.append(own[(rolling & np.uint64(CUT_MASK)) == 0])
    return np.concatenate(picked) if picked else np.zeros(0, dtype=np.int64)


def chunks(text: str | None) -> list[bytes]:
    """A text's bytes in content-defined chunks."""
    data = (text or "").encode("utf-8", "replace")
    edges = [0, *cuts(np.frombuffer(data, dtype=np.uint8)).tolist(), len(data)]
    return [data[a:b] for a, b in zip(edges, edges[1:]) if b > a]


def names_of(parts: list[bytes]) -> np.ndarray:
    """Two 64-bit hashes of every chunk."""
    return np.frombuffer(b"".join(hashlib.blake2b(c, digest_size=16).digest() for c in parts), dtype=np.uint64).reshape(-1, 2)


@dataclass(frozen=True)
class SharedChunks:
    """Place of the ids of chunks that documents share, and bits that tell which chunks may be there."""

    path: str
    buckets: int
    bits: np.ndarray

    def find(self, parts: list[bytes]) -> dict[bytes, np.ndarray]:
        """Ids of those of the chunks that are shared."""
        parts = list(dict.fromkeys(parts))
        if not parts:
            return {}
        names, out = names_of(parts), {}
        for i in np.flatnonzero(members(self.bits, names[:, 0])).tolist():
            held = arrays.mapped(f"{self.path}/{int(names[i, 0]) % self.buckets}")
            at = int(np.searchsorted(held["key"], names[i, 0])) if held else 0
            if held and at < len(held["key"]) and held["key"][at] == names[i, 0] and held["check"][at] == names[i, 1]:
                out[parts[i]] = held["ids"][held["edges"][at] : held["edges"][at + 1]]
        return out


def _named(batches, most: int = 1 << 18):
    """Hashes of the chunks of texts, each chunk of a text once, a bounded number at a time."""
    held, n = [], 0
    for batch in batches:
        for text in batch.column(0):
            held.append(names_of(list(dict.fromkeys(chunks(text.as_py()))))[:, 0])
            n += len(held[-1])
            if n >= most:
                yield np.concatenate(held)
                held, n = [], 0
    if held:
        yield np.concatenate(held)


def _hashes(buckets: int):
    def emit(batches):
        for key in _named(batches):
            where = (key >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(where, kind="stable")
            edges = np.searchsorted(where[order], np.arange(buckets + 1))
            full = np.flatnonzero(np.diff(edges))
            yield pa.record_batch([pa.array(full.astype(np.int32)), pa.array([key[order[edges[b] : edges[b + 1]]].tobytes() for b in full], pa.binary())], names=["bucket", "data"])

    return emit


def _again(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    keys = np.sort(np.concatenate([np.frombuffer(x.as_py(), dtype=np.uint64) for x in table.column("data")]))
    return pa.table({"key": pa.array(np.unique(keys[1:][keys[1:] == keys[:-1]]).view(np.int64))})


def _wanted(bits, most: int = 1 << 24):
    """Chunks that may be shared, each once while a task remembers it."""

    def emit(batches):
        sent, size = set(), 0
        own = bits.value
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                parts = list(dict.fromkeys(c for t in batch.column(0).slice(start, 200) for c in chunks(t.as_py())))
                if not parts:
                    continue
                names = names_of(parts)
                new = [i for i in np.flatnonzero(members(own, names[:, 0])).tolist() if parts[i] not in sent]
                size += sum(len(parts[i]) for i in new)
                if size > most:
                    sent, size = set(), 0
                sent.update(parts[i] for i in new)
                if new:
                    yield pa.record_batch([pa.array(names[new, 0].view(np.int64)), pa.array([parts[i] for i in new], pa.binary())], names=["key", "chunk"])

    return emit


def _stored(path: str, files: tuple[str, str]):
    """Encode a bucket's chunks and write the arrays."""

    def store(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        own, parts = codec(*files), table.column("chunk").to_pylist()
        names = names_of(parts)
        order = np.argsort(names[:, 0])
        ids = [np.array(own._encode(parts[i].decode("utf-8", "replace")), dtype=np.uint32) for i in order.tolist()]
        edges = np.concatenate([[0], np.cumsum([len(x) for x in ids])])
        arrays.save(f"{path}/{key[0].as_py()}", {"key": names[order, 0], "check": names[order, 1], "edges": edges, "ids": np.concatenate(ids) if ids else np.zeros(0, np.uint32)})
        return pa.table({"n": pa.array([len(parts)], pa.int64())})

    return store


def share_chunks(docs: DataFrame, text_col: str = "text", files: tuple[str, str] | None = None) -> SharedChunks:
    """Encode every chunk that two texts or more have, once."""
    spark, files = docs.sparkSession, files or vocabulary_files()
    short_batches(spark)
    texts = docs.select(F.col(text_col).cast("string").alias("__text"))
    buckets = max(8, 2 * texts.rdd.getNumPartitions())
    path = fresh_path(spark, "chunks")
    if (local := local_path(path)) is not None:
        os.makedirs(local, exist_ok=True)
    again = materialize(texts.mapInArrow(tidy(_hashes(buckets)), "bucket int, data binary").groupBy("bucket").applyInArrow(_again, "key long"), "shared-chunks")
    bits = bit_set(again, "key")
    shared = spark.sparkContext.broadcast(bits)
    # A task sends a chunk once; the copies that tasks send are one row after the first aggregation.
    sent = texts.mapInArrow(tidy(_wanted(shared)), "key long, chunk binary").groupBy("key").agg(F.min("chunk").alias("chunk")).join(again, "key", "left_semi")
    bucket = F.expr(f"cast(pmod(cast(key as decimal(20,0)) + if(key < 0, 18446744073709551616, 0), {buckets}) as int)")
    materialize(sent.withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_stored(path, files), "n long"), "stored-chunks")
    return SharedChunks(path, buckets, bits)


class Codec:
    """Encodes and decodes with one vocabulary, reusing chunks."""

    def __init__(self, vocabulary: str, whole: str | None = None):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._core = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
        self._whole_path = whole
        self._chunks: dict[bytes, array] = {}
        self._held = 0
        self._joins: dict[tuple[int, int], bool] = {}

    @functools.cached_property
    def _whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self._whole_path)

    def _encode(self, text: str) -> list[int]:
        try:
            return self._core.encode(text, allowed_special="all") if SPECIAL in text else self._core.encode_ordinary(text)
        except ValueError:  # the pattern engine gave up on a run of bytes that it can't backtrack over
            return self._whole.encode(text, add_special_tokens=False).ids if self._whole_path else self._pieces(text)

    def _pieces(self, text: str) -> list[int]:
        """Ids piece by piece, by an engine that has no limit."""
        import regex
        from public_tokenizers import PATTERN

        ids: list[int] = []
        for i, part in enumerate(text.split(SPECIAL)):
            ids += [SPECIAL_ID] * (i > 0)
            for piece in regex.findall(PATTERN, part):
                ids += self._core._encode_single_piece(piece.encode())
        return ids

    def _chunk(self, chunk: bytes) -> list[int]:
        held = self._chunks.get(chunk)
        if held is not None:
            return held.tolist()
        ids = self._encode(chunk.decode("utf-8", "replace"))
        if len(chunk) * 8 <= CACHE_BYTES:
            self._chunks[chunk] = array("I", ids)
            self._held += len(chunk)
            while self._held > CACHE_BYTES:
                old = next(iter(self._chunks))
                self._held -= len(old)
                del self._chunks[old]
        return ids

    def _join(self, left: list[int], right: list[int]) -> list[int]:
        """left and right as one, encoded again around where they meet."""
        if not left or not right:
            return left + right
        pair = (left[-1], right[0])
        good = self._joins.get(pair)
        if good is None:
            if len(self._joins) > 1 << 16:
                self._joins.clear()
            good = self._joins[pair] = self._agrees(pair)
        if good:
            left += right
            return left
        size = 1
        while True:
            size *= 2
            old = left[-size:] + right[:size]
            try:
                new = self._encode(self._core.decode_bytes(old).decode("utf-8"))
            except UnicodeDecodeError:
                new = None
            whole = size >= len(left) and size >= len(right)
            if new is None and whole:
                return left + right
            if new is not None and (whole or (new[:1] == old[:1] or size >= len(left)) and (new[-1:] == old[-1:] or size >= len(right))):
                left[-size:] = new
                left += right[size:]
                return left

    def _agrees(self, pair: tuple[int, int]) -> bool:
        try:
            return self._encode(self._core.decode_bytes(list(pair)).decode("utf-8")) == list(pair)
        except UnicodeDecodeError:
            return False

    def encode(self, text: str | None) -> list[int]:
        return self._joined(chunks(text), self._chunk)

    def whole(self, text: str | None) -> list[int]:
        """Ids of a text in one go, without chunks."""
        return self._encode((text or "").encode("utf-8", "replace").decode("utf-8"))

    def _joined(self, parts: list[bytes], ids_of) -> list[int]:
        ids: list[int] = []
        for part in parts:
            ids = self._join(ids, ids_of(part))
        return ids

    def encode_all(self, texts: list[str | None], table: SharedChunks) -> list[list[int]]:
        """Ids of every text; those of shared chunks come from the table."""
        cut = [chunks(t) for t in texts]
        shared = table.find([c for own in cut for c in own])
        direct = lambda c: shared[c].tolist() if c in shared else self._encode(c.decode("utf-8", "replace"))
        return [self._joined(own, direct) for own in cut]

    def decode(self, ids: list[int]) -> str:
        return self._core.decode_bytes(ids).decode("utf-8", "replace")


@functools.lru_cache(maxsize=4)
def codec(vocabulary: str, whole: str | None) -> Codec:
    """A worker's codec; it and its cache live as long as the worker."""
    return Codec(vocabulary, whole)


def vocabulary_files() -> tuple[str, str]:
    """The public byte-level vocabulary: its ranks, and the same for whole texts."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")


def _schema(df: DataFrame, more: str) -> str:
    return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[1:]), more])


def _mapped(docs: DataFrame, keep: list[str], text_col: str, more: str, columns, files: tuple[str, str] | None, share: bool) -> DataFrame:
    files = files or vocabulary_files()
    table = docs.sparkSession.sparkContext.broadcast(share_chunks(docs, text_col, files)) if share else None
    held = docs.select(F.col(text_col).cast("string").alias("__text"), *keep)

    def run(batches):
        own = codec(*files)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = part.column(0).to_pylist()
                made = columns(own, own.encode_all(texts, table.value) if table else [own.whole(t) for t in texts])
                yield pa.record_batch([*(part.column(c) for c in range(1, part.num_columns)), *made.values()], names=[*part.schema.names[1:], *made])

    short_batches(docs.sparkSession)
    return held.mapInArrow(tidy(run), _schema(held, more))


def encode(docs: DataFrame, keep: list[str], text_col: str = "text", files: tuple[str, str] | None = None, share: bool = True) -> DataFrame:
    """keep's columns of every row with ids, array<int>; without share, every text is encoded in one go, which costs less where few chunks come again."""
    return _mapped(docs, keep, text_col, "ids array<int>", lambda own, ids: {"ids": pa.array(ids, pa.list_(pa.int32()))}, files, share)


def decode(encoded: DataFrame, keep: list[str], ids_col: str = "ids", files: tuple[str, str] | None = None) -> DataFrame:
    """keep's columns of every row with the text that the ids stand for; null ids give an empty text."""
    files = files or vocabulary_files()
    held = encoded.select(F.col(ids_col).cast("array<int>").alias("__ids"), *keep)

    def run(batches):
        own = codec(*files)
        for batch in batches:
            yield pa.record_batch([*(batch.column(c) for c in range(1, batch.num_columns)), pa.array([own.decode(x.as_py() or []) for x in batch.column(0)], pa.string())], names=[*batch.schema.names[1:], "text"])

    return held.mapInArrow(run, _schema(held, "text string"))


def _digests(own: Codec, encoded: list[list[int]]) -> dict[str, pa.Array]:
    ids_sha = [hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest() for ids in encoded]
    text_sha = [hashlib.sha256(own.decode(ids).encode()).hexdigest() for ids in encoded]
    return {"n_tokens": pa.array([len(ids) for ids in encoded], pa.int64()), "ids_sha256": pa.array(ids_sha), "decoded_sha256": pa.array(text_sha)}


def digests(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """op8: every text encoded and decoded again, with the number of tokens and the hashes of ids and text."""
    return _mapped(docs, keep or ["doc_id"], "text", "n_tokens long, ids_sha256 string, decoded_sha256 string", _digests, None, True)
