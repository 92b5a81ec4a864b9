from __future__ import annotations

import functools
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from voxlath.llm import ngram_lm

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def brute(train, order):
    """Interpolated modified Kneser-Ney in plain dictionaries."""
    grams = [Counter() for _ in range(order + 1)]
    raw = Counter()
    for text in train:
        t = ["<s>"] * (order - 1) + tokens(text)
        for i in range(order - 1, len(t)):
            grams[order][tuple(t[i - order + 1 : i + 1])] += 1
            raw[t[i]] += 1
    for k in range(order - 1, 0, -1):
        grams[k] = Counter(g[1:] for g in grams[k + 1])

    def discounts(c):
        n = [sum(v == i for v in c.values()) for i in range(1, 5)]
        if not min(n[:3]):
            return 0.5, 1.0, 1.5
        y = n[0] / (n[0] + 2 * n[1])
        d = 1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]
        return tuple(min(max(x, 0.01), i + 0.99) for i, x in enumerate(d))

    cut = [None] + [discounts(grams[k]) for k in range(1, order + 1)]
    follow = [None, *(defaultdict(list) for _ in range(order))]
    for k in range(1, order + 1):
        for g, v in grams[k].items():
            follow[k][g[:-1]].append(v)

    sums = [None] + [{context: (sum(own), sum(cut[k][min(v, 3) - 1] for v in own)) for context, own in follow[k].items()} for k in range(1, order + 1)]

    @functools.lru_cache(maxsize=None)
    def p(gram):
        k = len(gram)
        if k == 0:
            return 1 / (len(raw) + 1)
        if gram[:-1] not in sums[k]:
            return p(gram[1:])
        total, cuts = sums[k][gram[:-1]]
        c = grams[k].get(gram, 0)
        less = max(c - ([0, *cut[k]][min(c, 3)]), 0)
        return (less + cuts * p(gram[1:])) / total

    return p, raw


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_plain_dictionaries(spark, nasty, order):
    rows = [(r["doc_id"], r["text"]) for r in nasty.collect()]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    p, raw = brute([t for i, t in rows if not held(i)], order)
    n, v = sum(raw.values()), len(raw)
    want = []
    for i, t in rows:
        x = ["<s>"] * (order - 1) + tokens(t)
        own = [tuple(x[j - order + 1 : j + 1]) for j in range(order - 1, len(x))]
        base = sum(math.log10((raw[g[-1]] + 0.5) / (n + 0.5 * (v + 1))) for g in own)
        want.append((str(i), held(i), len(own), sum(raw[g[-1]] > 0 for g in own), n, round(base, 5), round(sum(math.log10(p(g)) for g in own), 5)))
    got = [(str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5), round(r["score"], 5)) for r in ngram_lm.score_held_out(nasty, order).collect()]
    assert sorted(got) == sorted(want)


def test_empty_tables(spark, empty, nasty):
    assert ngram_lm.score_held_out(empty).count() == 0
    model = ngram_lm.train(empty, order=2)
    assert model.tokens == 0
    row = ngram_lm.score(nasty.where("doc_id = 11"), model, ["doc_id"]).first()
    assert row["score"] == 0.0 and row["n_known"] == 0
