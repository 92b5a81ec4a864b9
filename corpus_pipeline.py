"""A training-data pipeline: toxicity, line dedup, near-duplicate removal, decontamination, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the next one reads what it
wrote.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlath.llm import chunked_bpe, jaccard_join, line_dedup, toxic_crf, wu_manber
from voxlath.llm.common import materialize, read


def _row(docs: DataFrame, *more: str) -> DataFrame:
    """A document's columns as one struct, so that no name of theirs can clash, beside the columns that a stage reads."""
    return docs.select(F.struct(*docs.columns).alias("__row"), *more)


def _columns(docs: DataFrame) -> list:
    return [F.col("__row").getField(c).alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score under 0.5; the tagger learns from all labelled documents.  Null and empty texts stay."""
    tagger = toxic_crf.train(docs, read(spark, sf_dir, "labels"))
    return toxic_crf.tag(_row(docs, "text"), tagger, ["__row"], spans=False).where("score < 0.5").select(*_columns(docs))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are equal or near to earlier ones; one that loses all its text goes.

    n_chars follows a changed text.  Null texts and texts that had no words stay as they are.
    """
    out = line_dedup.dedup(_row(docs, "doc_id", "text"), ["__row"])
    changed = F.col("n_removed") > 0
    emptied = changed & ~F.coalesce(F.col("kept_text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    new = {"text": F.col("kept_text"), "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("__row.n_chars"))}
    return out.where(~emptied).select(*[new.get(c, F.col("__row").getField(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of word 5-gram sets with a Jaccard similarity of 0.8: the one with the least id, null ids last, the first of equals.

    Rows are judged one by one, also those that share an id.  docs must give its rows in the same
    partitions each time, as a written table does.
    """
    row = _row(docs, "text", F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.monotonically_increasing_id().alias("at")).alias("__id"))
    classes = jaccard_join.classes(row.select("text", "__id"), id_col="__id", width=5, percent=80)
    stay = materialize(classes.where("id.at = component.at").select(F.col("id.at").alias("__stays")), "stays")
    return row.join(stay, F.col("__id.at") == F.col("__stays"), "left_semi").select(*_columns(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten words in a row of a benchmark item."""
    return wu_manber.clean(docs, read(spark, sf_dir, "benchmark"), width=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, with the hashes of ids and of the text they decode to."""
    return chunked_bpe.digests(docs, ["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("jaccard_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("bpe", encode),
]

#: No SQL expresses the conditional random field of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
