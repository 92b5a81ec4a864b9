"""Token counts: rollups by source, language and tokenizer version, maintained by signed deltas.

A batch holds rows that add (sign 1) or take away (sign -1) the count of a document; a revised
count is one of each.  A batch is summed by group before it is written, so that what is stored
grows with groups and batches, never with documents.  One small file, created under the batch's
id, commits it; a batch whose id is there already changes nothing, whoever sends it again.
Totals are the sum of a base and of the deltas committed after it; `compact` makes a new base.

Nulls in source, language or tokenizer are groups of their own; a null count is none, a null
sign is 1.  Null and empty texts have no tokens but count as documents.  A batch id is used once
for ever: of two drivers that send one id at once, the first to commit counts.  Repeated rows count
as often as they occur.  Groups without documents and tokens are left out.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chunked_bpe
from .common import fresh_path, materialize, short_batches, tidy
from .manifest import Conflict, Folder

GROUP = ["source", "lang", "tokenizer"]
_SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"
#: Tokenizer versions by their public vocabulary files.
TOKENIZERS = {"byte-bpe-50k": "byte_bpe_50k.tiktoken", "byte-bpe-multi-50k": "byte_bpe_multi_50k.tiktoken"}



class TokenRollup:
    """Totals in a folder: commits/<batch> names a delta, bases/<version> a base and the batches in it."""

    def __init__(self, spark: SparkSession, path: str):
        self._spark, self._folder = spark, Folder(spark, path)

    def batches(self) -> list[str]:
        return self._folder.names("commits")

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch of rows (source, lang, tokenizer, n_tokens, sign); False if its id is committed."""
        if batch in self.batches():
            return False
        sign = F.coalesce(F.col("sign"), F.lit(1)).cast("long")
        # Two steps: a group may hold a third of all rows, whose partial sums are one row a task.
        delta = changes.groupBy(*GROUP).agg(F.sum(sign).alias("n_docs"), F.sum(sign * F.coalesce(F.col("n_tokens"), F.lit(0))).cast("long").alias("n_tokens"))
        path = f"{self._folder.path}/deltas/{batch}-{uuid.uuid4().hex}"
        delta.coalesce(1).write.parquet(path)
        try:
            self._folder.create(f"commits/{batch}", {"delta": path})
        except Conflict:  # another driver was first with the same batch
            self._folder.delete(path)
            return False
        return True

    def _base(self) -> tuple[int, dict]:
        names = self._folder.names("bases")
        return (int(names[-1]), self._folder.read(f"bases/{names[-1]}")) if names else (0, {"path": None, "batches": []})

    def _sum(self, base: dict, batches: list[str]) -> DataFrame:
        done = set(base["batches"])
        paths = [self._folder.read(f"commits/{b}")["delta"] for b in batches if b not in done] + ([base["path"]] if base["path"] else [])
        rows = self._spark.read.schema(_SCHEMA).parquet(*paths) if paths else self._spark.createDataFrame([], _SCHEMA)
        return rows.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).where("n_docs <> 0 or n_tokens <> 0")

    def totals(self) -> DataFrame:
        return self._sum(self._base()[1], self.batches())

    def compact(self) -> int:
        """Sum everything committed so far into a new base; returns its version."""
        version, base = self._base()
        batches = self.batches()
        path = f"{self._folder.path}/sums/{uuid.uuid4().hex}"
        self._sum(base, batches).coalesce(1).write.parquet(path)
        try:
            self._folder.create(f"bases/{version + 1:012d}", {"path": path, "batches": batches})
        except Conflict:
            self._folder.delete(path)
        return self._base()[0]


def counted(docs: DataFrame, keep: list[str], text_col: str = "text", tokenizers: dict[str, str] | None = None) -> DataFrame:
    """keep's columns of every row with n_tokens: a map from tokenizer version to the number of tokens of the whole text; null texts have none."""
    import public_tokenizers

    files = {name: public_tokenizers.path(file) for name, file in (tokenizers or TOKENIZERS).items()}
    held = docs.select(F.col(text_col).cast("string").alias("__text"), *keep)
    kind = pa.map_(pa.string(), pa.int64())

    def run(batches):
        own = {name: chunked_bpe.codec(path, None) for name, path in files.items()}
        for batch in batches:
            counts = [[(name, len(c.whole(t.as_py()))) for name, c in own.items()] for t in batch.column(0)]
            yield pa.record_batch([*(batch.column(c) for c in range(1, batch.num_columns)), pa.array(counts, kind)], names=[*batch.schema.names[1:], "n_tokens"])

    short_batches(docs.sparkSession)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in held.schema.fields[1:]), "n_tokens map<string,bigint>"])
    return held.mapInArrow(tidy(run), schema)


def _rows(docs: DataFrame, sign: int) -> DataFrame:
    """A row for each document and tokenizer version of the map column n_tokens."""
    return docs.select("source", "lang", F.explode("n_tokens").alias("tokenizer", "n_tokens"), F.lit(sign).alias("sign"))


def replay(docs: DataFrame) -> DataFrame:
    """op6: totals after a history over all documents.

    All documents are loaded; those whose lines repeat get the count of their distinct lines
    instead; documents without a word of four letters or more are deleted; the first and the
    last batch arrive again, and a base is made in between.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.split(text, "\n")
    distinct = F.array_distinct(lines)
    named = docs.select("source", "lang", text.alias("whole"), F.when(F.size(distinct) < F.size(lines), F.array_join(distinct, "\n")).alias("fewer"), (~text.rlike(r"\p{L}{4}")).alias("deleted"))
    # What a document counted before its lines were revised, and what it counts now.
    states = F.array(F.struct(F.col("whole").alias("text"), F.lit(False).alias("revised")), F.struct(F.col("fewer").alias("text"), F.lit(True).alias("revised")))
    rows = named.select("source", "lang", "deleted", F.col("fewer").isNotNull().alias("changed"), F.explode(F.filter(states, lambda s: s["text"].isNotNull())).alias("s"))
    counts = materialize(counted(rows.select("source", "lang", "deleted", "changed", "s.revised", "s.text"), ["source", "lang", "deleted", "changed", "revised"]), "token-counts")
    rollup = TokenRollup(spark, fresh_path(spark, "token-rollup"))
    load = _rows(counts.where("not revised"), 1)
    revise = _rows(counts.where("changed and not revised"), -1).unionByName(_rows(counts.where("revised"), 1))
    delete = _rows(counts.where("deleted and changed = revised"), -1)
    rollup.apply("0001-load", load)
    rollup.apply("0002-revise", revise)
    rollup.compact()
    rollup.apply("0003-delete", delete)
    rollup.apply("0001-load", load)
    rollup.apply("0003-delete", delete)
    return rollup.totals()
