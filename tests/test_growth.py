"""What a step moves and how often it looks at a text, by its plan."""

from __future__ import annotations

from pyspark.sql import functions as F


def moved(df) -> int:
    """Bytes of the rows that a query's shuffles deal out, once it has run."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                total += node.metrics().apply("dataSize").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_a_text_carries_only_pairs_of_its_own_neighbours(spark):
    from voxlath.operators import typing

    follow = [f"त{chr(0x0915 + i // 20)}{chr(0x0915 + i % 20)}" for i in range(400)]
    lexicon = spark.createDataFrame([("घर", 500), ("पानी", 30), ("पनि", 40)] + [(w, 3) for w in follow], "word string, n long")
    pairs = spark.createDataFrame([("घर", "पानी", 30)] + [("घर", w, 3) for w in follow], "first string, second string, n long")
    texts = spark.createDataFrame([(i, " ghar pani,  pani {ok} 1.") for i in range(200)], "id long, text string")
    out = typing.convert(texts, lexicon, pairs)
    assert moved(out) < 400_000  # 586,336 with all words that ever follow the first one in each text's row, 263,232 without
    assert {r["text"] for r in out.collect()} == {" घर पानी,  पनि ok १।"}


def test_other_characters_by_themselves(spark):
    from voxlath.functions.scripts import devanagari_of
    from voxlath.operators import typing

    others = "0123456789|.,;}{()-–।é?!\"'🙂"
    rows = typing.tokens(spark.createDataFrame([(0, " ".join(others)), (1, "\n ab \t.Da.D{a b}  c"), (2, ""), (3, None)], "id long, text string"), "id", "text").orderBy("id", "pos").collect()
    assert [(r["src"], r["plain"]) for r in rows if r["id"] == 0] == [(c, devanagari_of(c)) for c in others]
    assert [(r["src"], r["gap"], r["kind"], r["before"]) for r in rows if r["id"] > 0] == [("", "\n ", "other", None), ("ab", " \t", "word", None), (".Da.D", "", "word", "ab"), ("{a b}", "  ", "escape", None), ("c", "", "word", None)]


def test_texts_are_split_once_for_their_pairs(spark):
    from voxlath.operators import lexicon

    docs = spark.createDataFrame([("A b, a B! a",), ("one",), ("",), (None,), ("...",), ("b a",)], "text string")
    found = lexicon.bigrams(docs)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1  # four times before
    assert sorted(tuple(r) for r in found.collect()) == [("a", "b", 2), ("b", "a", 3)]
    assert sorted((r["i"], r["word"]) for r in lexicon.words(docs).collect()) == [(0, "a"), (0, "b"), (0, "one"), (1, "a"), (1, "b"), (2, "a"), (3, "b"), (4, "a")]


def test_words_are_keyed_before_they_are_joined(spark):
    from voxlath.operators import lexicon

    words = spark.createDataFrame([("paani", 5), ("pani", 3), ("phani", 1), ("fani", 2), ("pan", 9), ("pna", 1), ("pin", 1)], "word string, n long")
    found = lexicon.candidates(words.select(F.col("word").alias("typed")), words, 2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and plan.count("Join") == 4  # keys stand in a table; pairs are not joined with each other
    groups = [{"paani", "pani"}, {"phani", "fani"}, {"pan", "pna"}, {"pin"}]  # of one key, one key, and one loose key of two
    want = {(t, w) for g in groups for t in g for w in g}
    assert sorted((r["typed"], r["word"]) for r in found.collect()) == sorted(want)


def test_costs_of_words_of_any_length(spark):
    import numpy as np

    from voxlath.functions import text as tx

    def plain(a, b):
        row = [0.0]
        for c in b:
            row.append(row[-1] + (0.5 if c == "a" else 1.0))
        for x in a:
            new = [row[0] + 5.0]
            for j, y in enumerate(b):
                new.append(min(row[j + 1] + 5.0, new[j] + (0.5 if y == "a" else 1.0), row[j] + (0.0 if x == y else 3.0)))
            row = new
        return row[-1]

    rng = np.random.default_rng(3)
    pairs = [tuple("".join(rng.choice(list("abcé")) for _ in range(rng.integers(0, 20))) for _ in range(2)) for _ in range(200)]
    want = [plain(a, b) for a, b in pairs]
    assert tx.typing_costs([a for a, _ in pairs], [b for _, b in pairs]).tolist() == want
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)] + [(200, None, "a")], "i long, a string, b string").coalesce(1)
    got = rows.select("i", tx.typing_distance(F.col("a"), F.col("b")).alias("d")).orderBy("i").collect()
    assert [r["d"] for r in got[:200]] == want and (got[200]["d"] is None or np.isnan(got[200]["d"]))


#: Characters of each kind; those from U+0898 to U+061D at its end are newer than Java 17's patterns, the last two newer than Unicode 15.
SAID = "a é Ⴀ 1² - ।٪    ا ก ก็ क कि 한 あ 漢 \U00020010 ـ࢙࢘ ؝\u2ffc\u31ef"


def test_a_weight_is_one_look_at_the_text(spark, tmp_path):
    import __spark_entry__
    from voxlath.functions import text as tx

    texts = [SAID, "", None, SAID * 500, "Nice to meet you."]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = __spark_entry__.queries()["duration_estimate"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "regexp" not in plan and plan.count("speaking_weight(") == 1
    said = out.orderBy("doc_id").collect()
    assert [said[1]["weight"], said[2]["weight"], said[4]["weight"]] == [0.0, None, 14.1]
    duckdb = __import__("pytest").importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(f"SELECT * FROM ({__spark_entry__.oracle_sql()['duration_estimate']}) WHERE weight IS NOT NULL AND doc_id <> 1 ORDER BY 1").fetchall()
    assert [tuple(r) for r in said if r["doc_id"] in (0, 3, 4)] == want
    assert tx.speaking_weights([]).shape == (0,)


def test_chunk_lengths_are_as_in_sql(spark, tmp_path):
    import __spark_entry__

    texts = [SAID, SAID * 500, "a" * 600, "؝" * 900 + "a" * 700, None]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    out = __spark_entry__.queries()["chunk_plans"](spark, str(tmp_path))
    assert "regexp" not in out._jdf.queryExecution().executedPlan().toString()
    duckdb = __import__("pytest").importorskip("duckdb")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert [tuple(r) for r in out.orderBy("doc_id").collect()] == con.sql(f"SELECT * FROM ({__spark_entry__.oracle_sql()['chunk_plans']}) ORDER BY 1").fetchall()
