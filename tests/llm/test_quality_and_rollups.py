from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from voxlath.llm import host_quality, shard_store, token_rollup
from voxlath.llm.common import fresh_path


def figures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w, n in Counter(windows).items() if n > 1}
    hit = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    base = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit), base


def test_figures_equal_plain_python(spark, nasty):
    got = sorted((str(r["doc_id"]), r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in host_quality.judge(nasty, ["doc_id"]).collect())
    assert got == sorted((str(r["doc_id"]), *figures(r["text"])) for r in nasty.collect())


def test_bad_host_takes_its_good_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, good if i % 10 == 0 else "too short", "bad") for i in range(400)] + [(1000 + i, good, f"fine{i % 8}") for i in range(800)] + [(5000, "too short", "tiny")]
    out = host_quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string"), ["doc_id"])
    kept = {r["doc_id"] for r in out.where("kept").collect()}
    assert kept == set(range(1000, 1800))
    assert not out.where("doc_id = 5000").first()["kept"]


def test_prior_shrinks_small_hosts_more():
    a, b = host_quality.beta_prior(10, 1000.0, 110_000.0, 300.0, 130.0)
    assert 0 < a < b
    small, large = (1 + a) / (1 + a + b), (100 + a) / (100 + a + b)
    assert a / (a + b) < small < large < 1
    assert host_quality.beta_prior(0, 0, 0, 0, 0) == (0.5, 0.5)


def test_hosts_of_pages(spark, smallest):
    urls = {"https://www.Example.org:80/a?b": "example.org", "//u:p@x.y/z": "x.y", "ftp://h#f": "h", "no host": None, "": None, None: None}
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", host_quality.host(F.col("url")).alias("h")).collect()
    assert {r["url"]: r["h"] for r in rows} == urls
    good = " ".join(f"word{i}" for i in range(30))
    pages = spark.read.parquet(f"{smallest}/pages.parquet").select("page_id", host_quality.host(F.col("url")).alias("host"))
    one = pages.where("host is not null").groupBy("host").count().orderBy(F.col("count").desc(), "host").first()["host"]
    texts = pages.withColumn("text", F.when((F.col("host") == one) & (F.col("page_id") % 5 > 0), "too short").otherwise(good))
    more = spark.range(60).select((F.col("id") + 10**6).alias("page_id"), F.lit(one).alias("host"), F.when(F.col("id") < 50, "short").otherwise(good).alias("text"))
    out = host_quality.judge(texts.unionByName(more), ["page_id", "host"], host_col="host")
    assert out.where(F.col("host") == one).where("kept").count() == 0 and out.where(F.col("host") != one).where("not kept").count() == 0


def test_quality_of_empty_table(spark, empty):
    assert host_quality.judge(empty, ["doc_id"]).count() == 0


def test_rollup_is_idempotent_and_additive(spark):
    rollup = token_rollup.TokenRollup(spark, fresh_path(spark, "t"))
    schema = "source string, lang string, tokenizer string, n_tokens long, sign int"
    first = spark.createDataFrame([("a", "en", "v1", 10, 1), ("a", "en", "v1", 10, 1), (None, None, "v1", None, None)], schema)
    second = spark.createDataFrame([("a", "en", "v1", 10, -1), ("a", "en", "v1", 7, 1)], schema)
    assert rollup.apply("1", first) and rollup.apply("2", second)
    assert not rollup.apply("1", first) and not rollup.apply("2", second)
    want = [("a", 2, 17), (None, 1, 0)]
    read = lambda: sorted([(r["source"], r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect()], key=str)
    assert read() == want
    assert rollup.compact() == 1
    assert read() == want
    assert rollup.apply("3", spark.createDataFrame([("a", "en", "v1", 10, -1), ("a", "en", "v1", 7, -1)], schema))
    assert read() == want[1:]


def test_replay_equals_counts_by_a_whole_tokenizer(spark, nasty, empty, smallest):
    import base64

    import public_tokenizers
    import tiktoken

    codecs = {}
    for name, file in token_rollup.TOKENIZERS.items():
        with open(public_tokenizers.path(file), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        codecs[name] = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": 50256})
    for docs in (nasty, spark.read.parquet(f"{smallest}/documents.parquet")):
        want = defaultdict(lambda: [0, 0])
        for r in docs.collect():
            lines = (r["text"] or "").split("\n")
            if re.search(r"[^\W\d_]{4}", r["text"] or ""):
                for name, codec in codecs.items():
                    own = want[r["source"], r["lang"], name]
                    own[0] += 1
                    own[1] += len(codec.encode("\n".join(dict.fromkeys(lines)), allowed_special="all"))
        got = {(r["source"], r["lang"], r["tokenizer"]): [r["n_docs"], r["n_tokens"]] for r in token_rollup.replay(docs).collect()}
        assert got == dict(want)
    assert token_rollup.replay(empty).count() == 0


def test_two_drivers_with_one_batch_id(spark):
    path, schema = fresh_path(spark, "t"), "source string, lang string, tokenizer string, n_tokens long, sign int"
    rows = spark.createDataFrame([("a", "en", "v1", 10, 1)], schema)
    one, two = token_rollup.TokenRollup(spark, path), token_rollup.TokenRollup(spark, path)
    two.batches = lambda: []  # the second driver looked before the first one had committed
    assert one.apply("1", rows) and not two.apply("1", rows)
    assert [tuple(r) for r in one.totals().collect()] == [("a", "en", "v1", 1, 10)]


def test_store_keeps_every_row_through_compactions(spark, nasty):
    store = shard_store.ShardStore(spark, fresh_path(spark, "s"), target_bytes=1 << 20, fanout=2)
    versions = []
    for _ in range(5):
        store.append(nasty)
        store.compact()
        versions.append(store.manifest()["version"])
    store.append(nasty.limit(0))
    assert versions == sorted(set(versions))
    assert store.read().count() == 5 * nasty.count()
    assert store.read().exceptAll(nasty.union(nasty).union(nasty).union(nasty).union(nasty)).count() == 0
    before = store.manifest()
    assert before["retired"]
    store.vacuum()
    assert not store.manifest()["retired"]
    assert store.read().count() == 5 * nasty.count()
    assert len(store.manifest()["runs"]) < 5


def test_arrivals_may_have_other_columns_and_any_names(spark):
    store = shard_store.ShardStore(spark, fresh_path(spark, "s"), fanout=2)
    first = spark.createDataFrame([(i, "x") for i in range(6)], "__arrival long, __ARRIVAL_ string")
    for _ in store.append_dealt(first, F.col("__arrival") % 2):
        pass
    store.append(spark.createDataFrame([(6, 1.5)], "__arrival long, more double"))
    store.compact()
    assert sorted(tuple(r) for r in store.read().select("__arrival", "__ARRIVAL_", "more").collect()) == [*((i, "x", None) for i in range(6)), (6, None, 1.5)]
    assert len(store.manifest()["runs"]) == 2 and "files" in store.manifest()["runs"][0]


def test_two_writers_of_one_store(spark):
    path = fresh_path(spark, "s")
    one, two = shard_store.ShardStore(spark, path), shard_store.ShardStore(spark, path)
    stale = two.manifest()
    one.append(spark.createDataFrame([(1,)], "a long"))
    seen = iter([stale])
    fresh = two.manifest
    two.manifest = lambda: next(seen, None) or fresh()  # the second writer read before the first one committed
    two.append(spark.createDataFrame([(2,)], "a long"))
    assert fresh()["version"] == 2 and sorted(r["a"] for r in one.read().collect()) == [1, 2]


def test_contents_of_nasty_and_empty(spark, nasty, empty):
    assert shard_store.contents(empty).count() == 0
    assert shard_store.contents(nasty).exceptAll(nasty.select("doc_id", "lang", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"), F.sha2("text", 256))).count() == 0
    assert shard_store.contents(nasty).count() == nasty.count()
