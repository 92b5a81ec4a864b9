"""Token-ID output: documents packed into rows of a fixed length.

Ids are given as an array column, as the query does with token ids, or are a text's UTF-8 bytes
from 3 on, with an end mark after each document.  A document longer than a row is split into pieces, all but the last
as long as a row.  The pieces of a group of documents, whole ones and remainders, are packed by
best fit decreasing: a segment tree over remaining capacities finds the fullest row that a piece
still fits into.  A group is what a task has read up to a bounded number of ids, so packing needs
no shuffle and its memory doesn't grow with the input.

Each packed row holds the ids as little-endian unsigned integers of `id_bytes` bytes padded with 0,
the cumulative lengths of its segments, the place where position numbering starts again for each,
and whose pieces they are.  An id that doesn't fit into id_bytes fails the job.

Null and empty texts have the end mark alone; null ids none at all, and then no piece; a null in
an array of ids is left out.  Repeated rows are packed each.  An empty table makes no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunked_bpe
from .common import fresh_path, short_batches, tidy
from .hashing import string_buffers

PAD, BEGIN, END, FIRST = 0, 1, 2, 3
#: Ids of a row, and ids that a task packs at once.
LENGTH, GROUP_IDS = 8192, 1 << 22
_SCHEMA = "ids binary, cu_seqlens array<int>, position_resets array<int>, segments array<struct<row_id: long, id: {}, piece: int, n: int>>"


class CapacityTree:
    """Segment tree over remaining capacities 1..length: how many open rows have each."""

    def __init__(self, length: int):
        self.size = 1 << max(1, (length + 1).bit_length())
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def _change(self, capacity: int, by: int) -> None:
        i = capacity + self.size
        while i:
            self.count[i] += by
            i >>= 1

    def add(self, capacity: int, row: int) -> None:
        if capacity > 0:
            self.rows.setdefault(capacity, []).append(row)
            self._change(capacity, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(capacity, row) of the row with the least capacity of need or more, taken out."""
        i = need + self.size
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):  # up, until a right neighbour has some
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        capacity = i - self.size
        self._change(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit(lengths: list[int], length: int) -> list[list[int]]:
    """Rows of pieces' places, best fit decreasing; equal lengths in order of place."""
    tree, rows = CapacityTree(length), []
    for place in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[place]
        found = tree.take(need)
        if found is None:
            found = length, len(rows)
            rows.append([])
        capacity, row = found
        rows[row].append(place)
        tree.add(capacity - need, row)
    return rows


def _pack(ids: list[np.ndarray], names: list[tuple], length: int, kind: pa.DataType, dtype: np.dtype) -> pa.RecordBatch:
    pieces = [(d, k, x[at : at + length]) for d, x in enumerate(ids) for k, at in enumerate(range(0, len(x), length))]
    out, seqlens, resets, segments = [], [], [], []
    for row in best_fit([len(p[2]) for p in pieces], length):
        own = [pieces[i] for i in row]
        ends = np.cumsum([len(p[2]) for p in own])
        data = np.zeros(length, dtype=dtype)
        data[: ends[-1]] = np.concatenate([p[2] for p in own])
        out.append(data.tobytes())
        seqlens.append([0, *ends.tolist()])
        resets.append([0, *ends[:-1].tolist()])
        segments.append([{"row_id": names[d][0], "id": names[d][1], "piece": k, "n": len(x)} for d, k, x in own])
    segment = pa.struct([("row_id", pa.int64()), ("id", kind), ("piece", pa.int32()), ("n", pa.int32())])
    return pa.record_batch(
        [pa.array(out, pa.binary()), pa.array(seqlens, pa.list_(pa.int32())), pa.array(resets, pa.list_(pa.int32())), pa.array(segments, pa.list_(segment))], names=["ids", "cu_seqlens", "position_resets", "segments"]
    )


def byte_ids(column: pa.Array) -> list[np.ndarray]:
    data, offsets = string_buffers(column)
    shifted = data.astype(np.uint16) + FIRST
    return [np.append(shifted[a:b], np.uint16(END)) for a, b in zip(offsets[:-1], offsets[1:])]


def array_ids(column: pa.Array, dtype: np.dtype) -> list[np.ndarray]:
    """The arrays' ids without nulls; ValueError for one that the type can't hold."""
    out = []
    for x in column:
        own = x.values.drop_null().to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, dtype=np.int64)
        if len(own) and not 0 <= own.min() <= own.max() <= np.iinfo(dtype).max:
            raise ValueError(f"ids from {own.min()} to {own.max()} don't fit into {dtype.itemsize} bytes")
        out.append(own.astype(dtype))
    return out


def _type(id_bytes: int) -> np.dtype:
    if id_bytes not in (2, 4):
        raise ValueError("id_bytes must be 2 or 4")
    return np.dtype(f"<u{id_bytes}")


def _packer(length: int, group_ids: int, texts: bool, dtype: np.dtype):
    def run(batches):
        held, names, n = [], [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = byte_ids(part.column(0)) if texts else array_ids(part.column(0), dtype)
                kind = part.column(2).type
                for own, name in zip(ids, zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    held.append(own), names.append(name)
                    n += len(own)
                    if n >= group_ids:
                        yield _pack(held, names, length, kind, dtype)
                        held, names, n = [], [], 0
        if held:
            yield _pack(held, names, length, kind, dtype)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ids_col: str | None = None, length: int = LENGTH, group_ids: int = GROUP_IDS, id_bytes: int = 2) -> DataFrame:
    """Packed rows: ids, cu_seqlens, position_resets and segments, from texts or from an array of ids.

    A segment names its document by id and by row_id, which tells repeated ids apart within one
    run of the plan; so write the rows before reading them more than once.
    """
    source = F.col(text_col).cast("string") if ids_col is None else F.col(ids_col).cast("array<bigint>")
    own = docs.select(source.alias("__ids"), F.monotonically_increasing_id().alias("__row"), F.col(id_col).alias("__id"))
    short_batches(docs.sparkSession)
    return own.mapInArrow(tidy(_packer(length, group_ids, ids_col is None, _type(id_bytes))), _SCHEMA.format(own.schema["__id"].dataType.simpleString()))


def _pieces(dtype: np.dtype):
    """Every segment's ids back from the packed rows, as 32-bit integers."""

    def run(batches):
        for batch in batches:
            segments = batch.column(2)
            flat = segments.flatten()
            n, sha = [], []
            for ids, edges in zip(batch.column(0), batch.column(1).to_pylist()):
                data = np.frombuffer(ids.as_buffer(), dtype=dtype)
                for a, b in zip(edges, edges[1:]):
                    n.append(b - a)
                    sha.append(hashlib.sha256(data[a:b].astype("<u4").tobytes()).hexdigest())
            yield pa.record_batch([flat.field("row_id"), flat.field("id"), flat.field("piece"), pa.array(n, pa.int64()), pa.array(sha)], names=["row_id", "doc_id", "piece", "n", "sha"])

    return run


def written(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """op10: every document as it stands in the packed rows: token ids, pieces, and the hash of its pieces' hashes.

    Ids are those of the tokenizer that op8 encodes with, which fit into two bytes, with its
    end-of-text token after each document.  The rows are written to the shared folder as compressed
    Parquet and read again.
    """
    spark = docs.sparkSession
    path = fresh_path(spark, "packed")
    tokens = chunked_bpe.encode(docs, ["doc_id"], share=False).select("doc_id", F.concat("ids", F.array(F.lit(chunked_bpe.SPECIAL_ID))).alias("ids"))
    pack(tokens, ids_col="ids", length=length, id_bytes=2).write.option("compression", "zstd").parquet(path)
    back = spark.read.parquet(path).select("ids", "cu_seqlens", "segments")
    kind = docs.schema["doc_id"].dataType.simpleString()
    pieces = back.mapInArrow(tidy(_pieces(_type(2))), f"row_id long, doc_id {kind}, piece int, n long, sha string")
    whole = pieces.groupBy("row_id", "doc_id").agg(F.sum("n").alias("n_ids"), F.count("*").alias("n_pieces"), F.array_sort(F.collect_list(F.struct("piece", "sha"))).alias("p"))  # the pieces of one document
    return whole.select("doc_id", "n_ids", "n_pieces", F.sha2(F.array_join(F.col("p.sha"), ","), 256).alias("pieces_sha256"))

