"""Typed romanised text to Devanagari, word by word, each word chosen after the one before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scripts import devanagari, latin, typed_latin
from ..functions.text import light_spelling, loose_key, phonetic_key, typing_distance
from ..sources.staging import staged
from .lexicon import PAIR_PRIOR, norm

#: What is a word, marks of a spelling that is meant exactly, and words kept for ranking in context.
TOKEN = r"(\{[^{}]*\}|(?:\.D|[A-Za-z~_\\])+|\s+|[\s\S])"
WORD, EXACT, CAPITALISED = r"^(?:\.D|[A-Za-z~_\\])+$", r"[_\\]|\.D", r"^[A-Z][^A-Z]*[a-z][^A-Z]*$"
BEAM = 8


#: White space, and what a single character other than a word's stands for.
SPACE, OTHER_FROM, OTHER_TO = " \t\n\x0b\f\r", "0123456789|.", "०१२३४५६७८९।।"


def tokens(texts: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """(key, pos, src, gap, kind, plain, before): words, {escapes} and other characters of a text in order.

    gap: the white space after it; plain: the form of what is no word; before: the word that only
    white space parts from this word.  White space at a text's beginning is the gap of an empty one.
    """
    found = F.regexp_extract_all(text, F.lit(TOKEN + r"\s*"), F.lit(0))
    whole = texts.select(key, F.transform(found, lambda x: F.struct(F.rtrim(x, F.lit(SPACE)).alias("src"), x.alias("whole"))).alias("__t"))
    beside = F.transform("__t", lambda x, i: F.struct(x["src"].alias("src"), x["whole"].alias("whole"), F.get("__t", i - 1)["src"].alias("before")))
    rows = whole.select(key, F.posexplode(beside).alias("pos", "x")).select(key, "pos", "x.src", F.expr("substring(x.whole, length(x.src) + 1)").alias("gap"), "x.before")
    kind = F.when(F.col("src").rlike(r"^\{[^{}]*\}$"), "escape").when(F.col("src").rlike(WORD), "word").otherwise("other")
    plain = F.when(F.col("kind") == "escape", F.expr("substring(src, 2, length(src) - 2)")).when(F.col("kind") == "other", F.translate("src", OTHER_FROM, OTHER_TO))
    return rows.withColumn("kind", kind).select(key, "pos", "src", "gap", "kind", plain.alias("plain"), F.when((F.col("kind") == "word") & F.col("before").rlike(WORD), F.col("before")).alias("before"))


def options(words: DataFrame, lexicon: DataFrame, weight: float = 1.0, few: int = 3) -> DataFrame:
    """(src, word, penalty, n, rank) of distinct typed words: what stands in the lexicon under their key, and the word by the fixed rules.

    Where a key has fewer than `few` words, those of the loose key are there too.  Penalties are
    weighted typing distances; the BEAM best by log-probability less penalty stay.  A word that is
    spelt exactly has just its own form.
    """
    one = words.select("src").distinct().withColumn("typed", F.when(F.col("src").rlike(CAPITALISED), F.lower("src")).otherwise(F.col("src")))
    one = staged(one.withColumn("strict", devanagari(F.col("typed"), False, False)).withColumn("exact", F.col("typed").rlike(EXACT)).withColumn("latin", typed_latin(F.col("typed"))).withColumn("key", phonetic_key(F.col("latin"))), "typed")
    own = one.where("not exact").withColumn("loose", loose_key(F.col("key")))
    have = staged(lexicon.select("word", "n", latin(F.col("word")).alias("own")).withColumn("key", phonetic_key(F.col("own"))), "spelt").withColumn("loose", loose_key(F.col("key")))
    near = staged(own.join(have.select("key", "word"), "key").select("src", "word"), "near")
    enough = near.groupBy("src").agg(F.count("*").alias("c")).where(F.col("c") >= few)
    more = own.join(enough, "src", "left_anti").join(have.select("loose", "word"), "loose").select("src", "word")
    asked = near.unionByName(more).unionByName(own.select("src", F.col("strict").alias("word"))).distinct()
    spelt = asked.join(own.select("src", light_spelling(F.col("latin")).alias("a")), "src").join(lexicon.select("word", "n"), "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    cost = F.lit(weight) * typing_distance(F.col("a"), light_spelling(latin(F.col("word"))))
    scored = spelt.withColumn("penalty", cost).join(F.broadcast(norm(lexicon)))  # one row
    score = F.ln((F.col("n") + 1) / F.col("norm")) - F.col("penalty")
    best = F.slice(F.array_sort(F.collect_list(F.struct((-score).alias("cost"), "word", "penalty", "n"))), 1, BEAM)  # the words of one key
    ranked = scored.groupBy("src").agg(best.alias("b")).select("src", F.posexplode("b").alias("rank", "x")).select("src", "x.word", "x.penalty", "x.n", "rank")
    exact = one.where("exact").select("src", F.col("strict").alias("word")).join(lexicon, "word", "left")
    return ranked.unionByName(exact.select("src", "word", F.lit(0.0).alias("penalty"), F.coalesce("n", F.lit(0)).cast("long").alias("n"), F.lit(0).alias("rank")))


def convert(texts: DataFrame, lexicon: DataFrame, pairs: DataFrame, fixed: dict[str, str] | None = None, key: str = "id", text: str = "text", weight: float = 1.0) -> DataFrame:
    """(key, text): texts with every word as its best option after the word before; other things but spaces break that context.

    Ids are unique; a null text stays null.  fixed: forms by lower-case typed word that are taken as they are.  One text is one ordered fold
    over its words' few options; which pairs of options occur is looked up for distinct neighbours, and goes only to where these stand.
    """
    all_ = staged(tokens(texts, key, text), "tokens")
    words = all_.where("kind = 'word'")
    forced = F.create_map(*[F.lit(x) for pair in (fixed or {"": ""}).items() for x in pair])
    form = F.try_element_at(forced, F.lower("src"))
    set_ = F.array(F.struct(F.lit(0).alias("rank"), form.alias("word"), F.lit(0.0).alias("penalty"), F.lit(0).cast("bigint").alias("n")))
    lists = options(words, lexicon, weight).groupBy("src").agg(F.array_sort(F.collect_list(F.struct("rank", "word", "penalty", "n"))).alias("o"))
    lists = staged(lists.select("src", F.when(form.isNotNull(), set_).otherwise(F.col("o")).alias("o")), "options")
    known = lexicon.select("word", "n")

    # Pairs of options of neighbours that were ever seen, by typed words; a token carries only those of its own two words.
    choice = lists.select("src", F.explode("o.word").alias("word"))
    firsts, seconds = (choice.join(pairs.select(F.col(c).alias("word")).distinct(), "word", "left_semi").groupBy("src").agg(F.collect_list("word").alias(c)).withColumnRenamed("src", by) for c, by in (("first", "before"), ("second", "src")))
    asked = words.where("before is not null").select("before", "src").distinct().join(firsts, "before").join(seconds, "src")
    asked = asked.select("before", "src", F.explode("first").alias("first"), "second").select("before", "src", "first", F.explode("second").alias("second"))
    seen = asked.join(pairs.select("first", "second", F.col("n").alias("pair")), ["first", "second"]).groupBy("before", "src").agg(F.collect_list(F.struct("first", "second", "pair")).alias("counts"))

    told = words.where("before is not null").join(seen, ["before", "src"], "left").select(key, "pos", "src", "gap", "counts")
    told = told.unionByName(words.where("before is null").select(key, "pos", "src", "gap"), allowMissingColumns=True).join(lists, "src", "left")
    others = all_.where("kind <> 'word'").select(key, "pos", "gap", "plain")
    rows = told.select(key, "pos", "gap", "o", "counts").unionByName(others, allowMissingColumns=True)
    ordered = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "gap", "o", "plain", "counts"))).alias("t"))  # the tokens of one text
    whole = ordered.join(F.broadcast(norm(known)))  # one row

    def score(o: Column, x: Column, state: Column) -> Column:
        p = (o["n"] + 1) / F.col("norm")
        both = F.filter(x["counts"], lambda c: (c["first"] == state["prev"]) & (c["second"] == o["word"]))
        pair = F.coalesce(F.get(both, F.lit(0))["pair"], F.lit(0))
        context = F.ln((pair + PAIR_PRIOR) / (state["n"] * p + PAIR_PRIOR))
        return F.ln(p) + F.when(state["prev"].isNotNull(), context).otherwise(0.0) - o["penalty"]

    def step(state: Column, x: Column) -> Column:
        best = F.array_min(F.transform(x["o"], lambda o: F.struct((-score(o, x, state)).alias("cost"), o["rank"].alias("rank"), o["word"].alias("word"), o["n"].alias("n"))))
        word = F.struct(best["word"].alias("prev"), best["n"].alias("n"), F.concat(state["out"], best["word"], x["gap"]).alias("out"))
        other = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(0).cast("bigint").alias("n"), F.concat(state["out"], x["plain"], x["gap"]).alias("out"))
        return F.when(x["plain"].isNull(), word).otherwise(other)

    start = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(0).cast("bigint").alias("n"), F.lit("").alias("out"))
    made = whole.select(key, F.aggregate("t", start, step)["out"].alias("__made"))
    return texts.select(key, F.col(text).alias("__text")).join(made, key, "left").select(key, F.when(F.col("__text").isNotNull(), F.coalesce("__made", F.lit(""))).alias("text"))
