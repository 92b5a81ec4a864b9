"""op10 packs token ids of the tokenizer that op8 encodes with."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from voxlath.llm import chunked_bpe, sequence_packing


def test_ids_of_an_array_column(spark):
    rows = [(1, [70_000, None, 5]), (2, None), (3, []), (4, list(range(10)))]
    docs = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    got = {}
    for r in sequence_packing.pack(docs, ids_col="ids", length=8, id_bytes=4).collect():
        ids = np.frombuffer(r["ids"], dtype="<u4")
        assert len(ids) == 8 and r["position_resets"] == r["cu_seqlens"][:-1]
        for s, a, b in zip(r["segments"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            got[s["id"], s["piece"]] = ids[a:b].tolist()
    assert got == {(1, 0): [70_000, 5], (4, 0): list(range(8)), (4, 1): [8, 9]}
    with pytest.raises(Exception, match="don't fit into 2 bytes"):
        sequence_packing.pack(docs, ids_col="ids", length=8).collect()


def test_written_rows_hold_token_ids(spark, nasty):
    codec = chunked_bpe.codec(*chunked_bpe.vocabulary_files())
    want = []
    for r in nasty.collect():
        ids = np.array([*codec.encode(r["text"]), chunked_bpe.SPECIAL_ID], dtype="<u4")
        pieces = [hashlib.sha256(ids[i : i + 512].tobytes()).hexdigest() for i in range(0, len(ids), 512)]
        want.append((str(r["doc_id"]), len(ids), len(pieces), hashlib.sha256(",".join(pieces).encode()).hexdigest()))
    got = [(str(r["doc_id"]), r["n_ids"], r["n_pieces"], r["pieces_sha256"]) for r in sequence_packing.written(nasty, length=512).collect()]
    assert sorted(got) == sorted(want)
