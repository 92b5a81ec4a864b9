from __future__ import annotations

import hashlib
import re
import struct
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxlath.llm import chunked_bpe, jaccard_join, line_dedup, sequence_packing, wu_manber
from voxlath.llm.components import components

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def near(a, b):
    if abs(len(a) - len(b)) > line_dedup.EDITS:
        return False
    row = list(range(len(b) + 1))
    for x in a:
        before, row = row, [row[0] + 1]
        for j, y in enumerate(b):
            row.append(min(before[j + 1] + 1, row[j] + 1, before[j] + (x != y)))
    return row[-1] <= line_dedup.EDITS


def plain_line_dedup(rows, least):
    """Lines go that are equal to an earlier one with words, or near to one if both have least words or more."""
    lines = sorted(((-(10**18) if i is None else i), k, x) for i, t in rows if t is not None for k, x in enumerate(t.split("\n")))
    gone = set()
    for n, (i, k, x) in enumerate(lines):
        w = words(x)
        if w and any((j, m) != (i, k) and (w == words(y) or min(len(w), len(words(y))) >= least and near(w, words(y))) for j, m, y in lines[:n]):
            gone.add((i, k))
    return [(i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if ((-(10**18) if i is None else i), k) not in gone)) for i, t in rows]


def test_line_dedup_equals_all_pairs(spark, nasty):
    rows = [(r["doc_id"], r["text"]) for r in nasty.where("doc_id is null or doc_id not in (8, 9)").collect()]
    base = [f"t{i}" for i in range(12)]
    rng = np.random.default_rng(5)
    for i in range(40):
        w = list(base)
        for _ in range(int(rng.integers(0, 3))):
            at, kind = int(rng.integers(0, len(w))), int(rng.integers(0, 3))
            w[at : at + (kind > 0)] = [] if kind == 2 else [f"n{int(rng.integers(0, 3))}"]
        rows.append((100 + i, " ".join(w) + "\nother"))
    got = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), ["doc_id"]).collect()
    assert sorted(((r["doc_id"], r["kept_text"]) for r in got), key=str) == sorted(plain_line_dedup(rows, line_dedup.MIN_WORDS), key=str)


def test_line_dedup_of_nasty_and_empty(spark, nasty, empty):
    out = {r["doc_id"]: r for r in line_dedup.digests(nasty).collect()}
    assert out[2]["kept_sha256"] is None and out[2]["n_lines"] == 0
    assert out[3]["n_lines"] == 1 and out[3]["n_removed"] == 0
    assert out[1]["n_removed"] == 1 and out[5]["n_removed"] == 1 and out[6]["n_removed"] == 1 and out[7]["n_removed"] == 1
    assert out[8]["n_removed"] == 0 and out[9]["n_removed"] == 1
    assert line_dedup.digests(empty).count() == 0


def plain_classes(rows, width, percent):
    sets = []
    for _, t in rows:
        w = words(t)
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    root = list(range(len(rows)))
    of = lambda i: i if root[i] == i else of(root[i])
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[of(i)] = of(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[of(i)].append(d)
    return [(str(d), len(sets[i]), str(min(least[of(i)]) if least[of(i)] else None)) for i, (d, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [1500, 3])
def test_jaccard_classes_equal_all_pairs(spark, nasty, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    rows = [(r["doc_id"], r["text"]) for r in nasty.collect()]
    rng = np.random.default_rng(6)
    base = [f"t{i}" for i in range(60)]
    for i in range(60):
        w = list(base[: int(rng.integers(12, 60))])
        for _ in range(int(rng.integers(0, 4))):
            w[int(rng.integers(0, len(w)))] = f"n{int(rng.integers(0, 4))}"
        rows.append((100 + i, " ".join(w)))
    got = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == sorted(plain_classes(rows, 3, 90))


def test_jaccard_of_empty(spark, empty):
    assert jaccard_join.join(empty).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(9, 400), st.integers(0, 45), st.integers(0, 45), st.integers(0, 1 << 30))
def test_linked_sets_share_a_segment(common, left, right, seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 1 << 63, size=common + left + right).astype(np.uint64)
    a, b = np.unique(pool[: common + left]), np.unique(np.concatenate([pool[:common], pool[common + left :]]))
    both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
    if 100 * both >= 90 * either and both < either:
        keys = jaccard_join.Segments(90)
        assert set(keys.keys(a).tolist()) & set(keys.keys(b).tolist())


def test_bitmaps_rule_out_no_link():
    rng = np.random.default_rng(5)
    for n in (3, 60, 70, 900, 6000):
        base = rng.integers(1, 1 << 63, n).astype(np.uint64)
        sets = [np.unique(base)]
        for share in (0.82, 0.9, 0.97, 0.1):
            sets.append(np.unique(np.concatenate([base[: int(n * share)], rng.integers(1, 1 << 63, max(1, n // 9)).astype(np.uint64)])))
        pairs = jaccard_join.may_link(np.array([len(s) for s in sets]), [jaccard_join.parity_bitmap(s) for s in sets], 80)
        classes = jaccard_join.Classes(len(sets))
        for a, b in pairs:
            classes.join(a, b)
        for a, b in combinations(range(len(sets)), 2):
            same = len(np.intersect1d(sets[a], sets[b]))
            if 100 * same >= 80 * (len(sets[a]) + len(sets[b]) - same):
                assert classes.of(a) == classes.of(b)
        if n in (900, 6000):
            assert classes.of(4) != classes.of(0)


@pytest.mark.parametrize("key_sets", [2, 2000])
def test_percolated_groups_keep_their_classes(spark, monkeypatch, key_sets):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 5)
    monkeypatch.setattr(jaccard_join, "KEY_SETS", key_sets)
    passage = "shared words that very many of the texts have among their own ones here"
    rows = [(i, f"{passage} " + " ".join(f"v{i // 3}x{j}" for j in range(80)) + (f" end{i}" if i % 3 else "")) for i in range(60)]
    got = jaccard_join.classes(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), width=1, percent=80).collect()
    assert {r["id"]: r["component"] for r in got} == {i: i - i % 3 for i in range(60)}


def test_search_equals_direct_comparison():
    rng = np.random.default_rng(7)
    sets = [np.unique(rng.choice(40, size=int(rng.integers(5, 40)), replace=False).astype(np.uint64)) for _ in range(80)]
    index = jaccard_join.Index(sets)
    for own in sets:
        want = [i for i, s in enumerate(sets) if 100 * len(np.intersect1d(own, s)) >= 70 * len(np.union1d(own, s))]
        assert sorted(index.search(own, 70, np.ones(80, dtype=bool)).tolist()) == want


def test_components(spark):
    links = [(1, 2), (2, 3), (10, 11), (7, 3), (5, 5), (None, 4), (11, 10)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 10: 10, 11: 10, **{100 + i: 100 for i in range(41)}}


ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_contamination(text, items, width):
    own = ITEM.findall((text or "").translate(LOWER))
    hit, ids = set(), set()
    for i, t in items:
        w = ITEM.findall((t or "").translate(LOWER))
        n = min(width, len(w))
        for j in range(len(w) - n + 1) if n else ():
            for at in range(len(own) - n + 1):
                if own[at : at + n] == w[j : j + n]:
                    hit |= set(range(at, at + n))
                    ids.add(str(i))
    return len(own), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


ITEMS = [(1, "Three four five six seven eight nine ten eleven twelve, thirteen"), (2, "solo"), (3, None), (4, ""), (20, "one TWO; three-four five six seven eight nine ten"), (20, "short line"), (5, "नमस्ते 日本語"), (6, "w5x5")]


@pytest.mark.parametrize("block", [1 << 20, 1])
def test_search_of_windows_equals_plain_search(spark, nasty, block):
    docs = nasty.where("doc_id is null or doc_id not in (8, 9)")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = wu_manber.search(docs, items, ["doc_id", "text"], 10, item_block=block).collect()
    got = sorted((str(r["doc_id"]), r["n_words"], sum(s["last"] - s["first"] for s in r["spans"]), len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest()) for r in found)
    assert got == sorted((str(r["doc_id"]), *plain_contamination(r["text"], ITEMS, 10)) for r in docs.collect())


def test_contamination_of_long_and_empty(spark, nasty, empty):
    items = spark.createDataFrame([(1, " ".join(words(nasty.where("doc_id = 8").first()["text"])[500:530]))], "item_id long, text string")
    assert {r["doc_id"] for r in wu_manber.contamination(nasty, items).where("contaminated").collect()} == {8, 9}
    assert wu_manber.contamination(nasty, items.limit(0)).where("contaminated").count() == 0
    assert wu_manber.contamination(empty, items).count() == 0
    assert wu_manber.clean(nasty, items).columns == nasty.columns


@pytest.fixture(scope="module")
def whole():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(chunked_bpe.vocabulary_files()[1])


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=400) | st.lists(st.sampled_from(["the", " a", "  ", "\n", "नम", "é", "'s", "<|endoftext|>", "12", "日本", "!?", "\t", " endoftext|>"]), max_size=120).map("".join))
def test_codec_equals_whole_text_encoding(text):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(chunked_bpe.vocabulary_files()[1])
    own = chunked_bpe.codec(*chunked_bpe.vocabulary_files())
    want = tok.encode(text, add_special_tokens=False).ids
    assert own.encode(text) == want
    assert own.decode(want) == tok.decode(want, skip_special_tokens=False)


def test_chunks_are_shared_and_joins_repaired():
    own = chunked_bpe.Codec(*chunked_bpe.vocabulary_files())
    passage = " ".join(f"piece{i}" for i in range(6000))
    own.encode("first " + passage)
    before = len(own._chunks)
    own.encode("quite another start " + passage)
    assert len(own._chunks) - before < before / 4
    left, right = own._encode("hel"), own._encode("lo world")
    assert own._join(list(left), list(right)) == own._encode("hello world")


def test_chunks_of_two_documents_are_encoded_once(spark):
    passage = " ".join(f"piece{i}" for i in range(2000))
    docs = spark.createDataFrame([(1, "first " + passage), (2, "quite another start " + passage), (3, " ".join(f"own{i}" for i in range(500))), (4, None)], "doc_id long, text string").repartition(3)
    table = chunked_bpe.share_chunks(docs)
    own = chunked_bpe.Codec(*chunked_bpe.vocabulary_files())
    parts = [chunked_bpe.chunks(r["text"]) for r in docs.orderBy("doc_id").collect()]
    both = set(parts[0]) & set(parts[1])
    found = table.find([c for own_parts in parts for c in own_parts])
    assert set(found) == both and len(both) > 10
    assert all(ids.tolist() == own._encode(c.decode()) for c, ids in found.items())
    asked = []
    own._encode, direct = lambda t: asked.append(t.encode()) or direct(t), own._encode
    texts = [r["text"] for r in docs.orderBy("doc_id").collect()]
    assert own.encode_all(texts, table) == [direct(t or "") for t in texts]
    assert not both & set(asked)


def test_bpe_of_nasty_and_empty(spark, nasty, empty, whole):
    got = sorted((str(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in chunked_bpe.digests(nasty).collect())
    want = []
    for r in nasty.collect():
        ids = whole.encode(r["text"] or "", add_special_tokens=False).ids
        want.append((str(r["doc_id"]), len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest()))
    assert got == sorted(want)
    back = chunked_bpe.decode(chunked_bpe.encode(nasty, ["doc_id"]), ["doc_id"])
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == sorted((str(r["doc_id"]), r["text"] or "") for r in nasty.collect())
    assert chunked_bpe.digests(empty).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit_equals_a_plain_scan(lengths):
    rows, left = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in range(len(rows)) if left[r] >= lengths[i]]
        if fits:
            best = min(left[r] for r in fits)
            assert best >= lengths[i]
        rows_before = len(rows)
        del rows_before
        if not fits:
            rows.append([]), left.append(50)
            fits = [len(rows) - 1]
        r = min(fits, key=lambda r: left[r])
        rows[r].append(i)
        left[r] -= lengths[i]
    packed = sequence_packing.best_fit(lengths, 50)
    assert sorted(i for r in packed for i in r) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in r) <= 50 for r in packed)
    assert sorted(sum(lengths[i] for i in r) for r in packed) == sorted(50 - x for x in left)


def test_packed_rows_give_back_every_text(spark, nasty, empty):
    rows = sequence_packing.pack(nasty, length=64).collect()
    back = defaultdict(dict)
    for r in rows:
        ids = np.frombuffer(r["ids"], dtype="<u2")
        assert len(ids) == 64 and r["cu_seqlens"][0] == 0 and r["position_resets"] == r["cu_seqlens"][:-1]
        assert (ids[r["cu_seqlens"][-1] :] == sequence_packing.PAD).all()
        for a, b, s in zip(r["cu_seqlens"], r["cu_seqlens"][1:], r["segments"]):
            assert s["n"] == b - a
            back[s["row_id"], s["id"]][s["piece"]] = ids[a:b]
    texts = []
    for (_, i), pieces in back.items():
        ids = np.concatenate([pieces[k] for k in sorted(pieces)])
        assert ids[-1] == sequence_packing.END
        texts.append((str(i), (ids[:-1] - sequence_packing.FIRST).astype(np.uint8).tobytes().decode()))
    assert sorted(texts) == sorted((str(r["doc_id"]), r["text"] or "") for r in nasty.collect())
    assert sequence_packing.written(empty).count() == 0
    assert sequence_packing.written(nasty).count() == nasty.count()
