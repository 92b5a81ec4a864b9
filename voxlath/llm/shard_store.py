"""Sharding: a store of immutable shards with size-tiered compaction, in DataFrame functions only.

Every arrival becomes a run: small Parquet shards as its tasks wrote them, without a shuffle.  A
run's tier is the logarithm of its size to the base `fanout`.  When `fanout` runs stand in one
tier, they are merged into one run of files of about the target size, merges of other runs at the
same time; a run whose files have that size already is never rewritten.  What the store holds is
said by its manifest alone: a new version is committed by one atomic rename, and readers of an
older one keep its files until `vacuum`.  A run is a folder that nothing changes once it is
committed, so the manifest has one line for each run, not for each file.

Nulls, empty and very long texts and repeated rows are stored as they are; an arrival without
rows adds none.  Columns may have any names, and arrivals different ones: each run keeps its
own schema, and a column that a run doesn't have is null in its rows.
"""

from __future__ import annotations

import json
import math
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import fresh_path
from .manifest import Conflict, Folder

TARGET_BYTES = 64 << 20
#: Merges that run at once.
MERGES = 4


class ShardStore:
    def __init__(self, spark: SparkSession, path: str, target_bytes: int = TARGET_BYTES, fanout: int = 4):
        self._spark, self._folder = spark, Folder(spark, path)
        self.target_bytes, self.fanout = target_bytes, fanout

    def manifest(self) -> dict:
        names = self._folder.names("manifests")
        return self._folder.read(f"manifests/{names[-1]}") if names else {"version": 0, "schemas": [], "runs": [], "retired": []}

    def _commit(self, change) -> dict:
        """Apply a change to the newest manifest, again if another writer was first."""
        while True:
            old = self.manifest()
            new = change(old)
            if new is None:
                return old
            new = new | {"version": old["version"] + 1}
            try:
                self._folder.create(f"manifests/{new['version']:012d}", new)
                return new
            except Conflict:
                continue

    def _run(self, path: str) -> dict:
        files, size = self._folder.size(path)
        return {"path": f"{self._folder.path}/{path}", "files": files, "bytes": size}

    def append(self, rows: DataFrame) -> dict:
        """One arrival."""
        path = f"data/{uuid.uuid4().hex}"
        rows.write.parquet(f"{self._folder.path}/{path}")
        return self._add(self._run(path), rows.schema.json())

    def _add(self, run: dict, schema: str) -> dict:
        def change(old: dict) -> dict | None:
            if not run["files"]:
                return None
            schemas = old["schemas"] if schema in old["schemas"] else [*old["schemas"], schema]
            return old | {"schemas": schemas, "runs": [*old["runs"], run | {"schema": schemas.index(schema)}]}

        return self._commit(change)

    def append_dealt(self, rows: DataFrame, arrival: Column):
        """Arrivals by the values of an expression, written in one pass; yields after each commit."""
        path, name = f"data/{uuid.uuid4().hex}", "__arrival"
        while name.lower() in (c.lower() for c in rows.columns):
            name += "_"
        rows.withColumn(name, arrival).write.partitionBy(name).parquet(f"{self._folder.path}/{path}")
        for folder in self._folder.names(path):
            if folder.startswith(f"{name}="):
                yield self._add(self._run(f"{path}/{folder}"), rows.schema.json())

    def tier(self, run: dict) -> int:
        return int(math.log(max(run["bytes"], 1), self.fanout))

    def _settled(self, run: dict) -> bool:
        """No merge would make the run's files better."""
        return run["bytes"] >= 0.5 * self.target_bytes * run["files"]

    def _due(self, manifest: dict) -> list[list[dict]]:
        """Groups of `fanout` runs or more of one tier and schema; no run is in two."""
        tiers: dict[tuple[int, int], list[dict]] = {}
        for run in manifest["runs"]:
            if not self._settled(run):
                tiers.setdefault((self.tier(run), run["schema"]), []).append(run)
        out = []
        for _, runs in sorted(tiers.items()):
            groups = len(runs) // self.fanout
            out += [runs[g::groups] for g in range(groups)]
        return out

    def compact(self) -> int:
        """Merge full tiers until none is full, up to MERGES groups at once; returns the number of merges."""
        merges = 0
        while due := self._due(self.manifest()):
            with ThreadPoolExecutor(MERGES) as pool:
                list(pool.map(self._merge, due))
            merges += len(due)
        return merges

    def finish(self) -> bool:
        """Merge all runs that aren't settled, such as those that wait for their tier to fill."""
        open_ = [r for r in self.manifest()["runs"] if not self._settled(r)]
        due = [g for s in {r["schema"] for r in open_} if len(g := [r for r in open_ if r["schema"] == s]) > 1]
        for group in due:
            self._merge(group)
        return bool(due)

    def _merge(self, due: list[dict]) -> None:
        total = sum(r["bytes"] for r in due)
        path = f"data/{uuid.uuid4().hex}"
        files = max(1, math.ceil(total / self.target_bytes))
        self._read(due).coalesce(files).write.parquet(f"{self._folder.path}/{path}")
        run, gone = self._run(path) | {"schema": due[0]["schema"]}, {r["path"] for r in due}

        def change(old: dict) -> dict | None:
            if not gone <= {r["path"] for r in old["runs"]}:
                return None  # another compaction took these runs
            return old | {"runs": [r for r in old["runs"] if r["path"] not in gone] + [run], "retired": [*old["retired"], *sorted(gone)]}

        new = self._commit(change)
        if run["path"] not in {r["path"] for r in new["runs"]}:
            self._folder.delete(run["path"])

    def vacuum(self) -> None:
        """Delete runs that merges have replaced; readers of older versions must be done."""
        gone = self.manifest()["retired"]
        for path in gone:
            self._folder.delete(path)
        if gone:
            self._commit(lambda old: old | {"retired": [p for p in old["retired"] if p not in gone]})

    def _read(self, runs: list[dict]) -> DataFrame:
        schemas = self.manifest()["schemas"]
        parts = [
            self._spark.read.option("recursiveFileLookup", "true").schema(StructType.fromJson(json.loads(schemas[s]))).parquet(*[r["path"] for r in runs if r["schema"] == s])
            for s in sorted({r["schema"] for r in runs})
        ]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def read(self) -> DataFrame:
        """All rows of the newest version; ValueError for a store that never held a row."""
        runs = self.manifest()["runs"]
        if not runs:
            raise ValueError("the store is empty")
        return self._read(runs)


def ingest(docs: DataFrame, arrivals: int = 16, target_bytes: int = TARGET_BYTES) -> ShardStore:
    """Whole documents as so many arrivals, compacted as they come."""
    spark = docs.sparkSession
    store = ShardStore(spark, fresh_path(spark, "shards"), target_bytes)
    for _ in store.append_dealt(docs, F.pmod(F.xxhash64("doc_id"), F.lit(arrivals))):
        if store.compact():
            store.vacuum()
    if store.finish():
        store.vacuum()
    return store


def contents(docs: DataFrame) -> DataFrame:
    """op9: what the store holds after all arrivals: every document with the hash of its text."""
    store = ingest(docs)
    rows = store.read() if store.manifest()["runs"] else docs.limit(0)
    return rows.select("doc_id", "lang", "source", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.sha2(F.col("text"), 256).alias("text_sha256"))


SQL = """
SELECT doc_id, lang, source, coalesce(strlen(text), 0)::BIGINT AS n_bytes, sha256(text) AS text_sha256 FROM documents
"""
