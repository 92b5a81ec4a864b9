"""Word and bigram counts, spelling keys and ranked candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import light_spelling, loose_key, phonetic_key, typing_distance
from ..sources.staging import staged
from .ranking import placed


def _parts(text: str) -> Column:
    return F.array_remove(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), "")


def words(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(keep, i, word): lower-case words of letters and digits in order."""
    return docs.select(*keep, F.posexplode(_parts(text)).alias("i", "word"))


def counts(tokens: DataFrame, least: int = 1) -> DataFrame:
    return tokens.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def index(lexicon: DataFrame) -> DataFrame:
    """Adds code: the place by falling count, then word."""
    return placed(lexicon, [F.col("n").desc(), F.col("word")], "code").select("word", "n", "code")


def read_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """(word, n) of lines word<TAB>count; a missing count is 1, lines without a word are left out, and of a repeated word the last line counts."""
    lines = spark.read.text(path).withColumn("__at", F.monotonically_increasing_id())
    parts = F.split("value", "\t", 2)
    rows = lines.select(F.get(parts, F.lit(0)).alias("word"), F.coalesce(F.nullif(F.trim(F.coalesce(F.get(parts, F.lit(1)), F.lit(""))), F.lit("")).cast("long"), F.lit(1)).alias("n"), "__at")
    return rows.where("word <> ''").groupBy("word").agg(F.max_by("n", "__at").alias("n"))


def read_bigrams(spark: SparkSession, path: str) -> DataFrame:
    """(first, second, n) of lines with three fields; other lines are left out."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p")).where(F.size("p") == 3)
    return parts.select(F.col("p")[0].alias("first"), F.col("p")[1].alias("second"), F.col("p")[2].cast("long").alias("n"))


def write_lexicon(indexed: DataFrame, path: str) -> None:
    """Lines word<TAB>count in the order of the codes."""
    lines = indexed.repartitionByRange("code").sortWithinPartitions("code")
    lines.select(F.concat_ws("\t", "word", F.col("n").cast("string"))).write.mode("overwrite").text(path)


def write_bigrams(encoded: DataFrame, path: str) -> None:
    """Lines of the two codes and the count, sorted."""
    lines = encoded.repartitionByRange("i", "j").sortWithinPartitions("i", "j", "n")
    lines.select(F.concat_ws("\t", *[F.col(c).cast("string") for c in ("i", "j", "n")])).write.mode("overwrite").text(path)


def bigrams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(first, second, n): pairs of neighbouring words, paired inside the row."""
    w, n = docs.select(_parts(text).alias("w")), F.greatest(F.lit(0), F.size("w") - 1)  # a column of its own: inside the pairs, or in a filter, the text would be split anew
    pairs = w.select(F.explode(F.arrays_zip(F.slice("w", 1, n).alias("a"), F.slice("w", 2, n).alias("b"))).alias("p"))
    return pairs.groupBy(F.col("p.a").alias("first"), F.col("p.b").alias("second")).agg(F.count("*").alias("n"))


def encode_bigrams(pairs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """(i, j, n) by lexicon codes; pairs with an unknown word go."""
    a, b = lexicon.select(F.col("word").alias("first"), F.col("code").alias("i")), lexicon.select(F.col("word").alias("second"), F.col("code").alias("j"))
    return pairs.join(a, "first").join(b, "second").select("i", "j", "n")


#: Fixed value: added to observed and expected counts of pairs.
PAIR_PRIOR = 1.0


def norm(lexicon: DataFrame) -> DataFrame:
    """One row: what counts plus one are divided by."""
    return lexicon.agg((F.coalesce(F.sum("n"), F.lit(0)) + F.count("*") + 1).alias("norm"))


def context_scores(wanted: DataFrame, lexicon: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs (first, second) that are asked for, with n, how often they were seen, 0 for never, and their score.

    The score is the smoothed log-probability of the second word, and how much more often than by
    chance it followed the first.
    """
    a, b = lexicon.select(F.col("word").alias("first"), F.col("n").alias("na")), lexicon.select(F.col("word").alias("second"), F.col("n").alias("nb"))
    seen = pairs.select("first", "second", F.col("n").alias("__n"))
    rows = wanted.select("first", "second").distinct().join(seen, ["first", "second"], "left").join(a, "first", "left").join(b, "second", "left").join(F.broadcast(norm(lexicon)))  # one row
    n, p = F.coalesce("__n", F.lit(0)), (F.coalesce("nb", F.lit(0)) + 1) / F.col("norm")
    score = F.ln(p) + F.ln((n + PAIR_PRIOR) / (F.coalesce("na", F.lit(0)) * p + PAIR_PRIOR))
    return rows.select("first", "second", n.alias("n"), score.alias("score"))


def keyed(lexicon: DataFrame) -> DataFrame:
    return lexicon.withColumn("key", phonetic_key(F.col("word"))).withColumn("loose", loose_key(F.col("key")))


def candidates(typed: DataFrame, lexicon: DataFrame, few: int = 3) -> DataFrame:
    """(typed, word, n): words with the typed key; where these are fewer than few, also those with the loose key."""
    own, have = staged(keyed(typed.select(F.col("typed").alias("word"), F.col("typed"))).select("typed", "key", "loose"), "typed"), staged(keyed(lexicon).select("word", "n", "key", "loose"), "keyed")
    enough = have.groupBy("key").agg(F.count("*").alias("c")).where(F.col("c") >= few).select("key")
    exact = own.join(enough, "key", "left_semi").select("typed", "key").join(have.select("key", "word", "n"), "key").select("typed", "word", "n")
    loose = own.join(enough, "key", "left_anti").select("typed", "loose").join(have.select("loose", "word", "n"), "loose").select("typed", "word", "n")  # the same key has the same loose one
    return exact.unionByName(loose)


def ranked(found: DataFrame, total: float, penalty: float = 1.0, best: int = 8) -> DataFrame:
    """The best candidates of each typed word by log-probability less the typing distance."""
    score = F.ln((F.col("n") + 1) / total) - penalty * typing_distance(light_spelling(F.col("typed")), light_spelling(F.col("word")))
    w = Window.partitionBy("typed").orderBy(F.col("score").desc(), "word")
    return found.withColumn("score", score).withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= best)
