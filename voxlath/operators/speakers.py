"""Voiceprints and identities: centroids, outliers, clusters, ranks, stable ids, registry."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import dot, unit
from ..sources.staging import staged
from .ranking import placed


def centroids(clips: DataFrame, by: str = "local_speaker", weight: str = "duration", vector: str = "embedding") -> DataFrame:
    """(by, centroid): length-normalised weighted sums; summed by dimension, so no group of vectors is collected."""
    flat = clips.select(by, F.col(weight).alias("__w"), F.posexplode(vector).alias("__i", "__v"))
    sums = flat.groupBy(by, "__i").agg(F.sum(F.col("__w") * F.col("__v")).alias("__s"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("__i", "__s"))), lambda x: x["__s"])  # as many values as dimensions
    return sums.groupBy(by).agg(unit(ordered).alias("centroid"))


def similarity(clips: DataFrame, centres: DataFrame, by: str = "local_speaker", vector: str = "embedding") -> DataFrame:
    """Clips with their cosine to their speaker's centroid."""
    return clips.join(centres, by).withColumn("similarity", dot(unit(F.col(vector)), F.col("centroid"))).drop("centroid")


def voiceprints(clips: DataFrame, outlier: float, by: str = "local_speaker") -> tuple[DataFrame, DataFrame]:
    """(voiceprints, clips with their similarity to the final centroid).

    A first centroid finds outliers, below the similarity; a second one leaves them out where
    anything is left.  Seconds and pitch count the good clips, clips all.
    """
    first = similarity(clips, centroids(clips, by), by)
    good = first.where(F.col("similarity") >= outlier).drop("similarity")
    any_good = good.select(by).distinct().withColumn("__g", F.lit(True))
    use = good.unionByName(clips.join(any_good, by, "left_anti"))
    centre = centroids(use, by)
    scored = similarity(clips, centre, by).withColumnRenamed("similarity", "final")
    marked = scored.join(first.select("id", "similarity"), "id").withColumn("good", F.col("similarity") >= outlier)
    pitch = F.when(F.col("good"), F.when(~F.isnan("f0"), F.col("f0")))
    prints = marked.groupBy(by, "recording").agg(F.sum(F.when(F.col("good"), F.col("duration")).otherwise(0.0)).alias("seconds"), F.count("*").alias("clips"), F.median(pitch).alias("f0"))
    return prints.join(centre, by), marked.select("id", by, F.col("final").alias("similarity"), "good")


def average_linkage(vectors: np.ndarray, limit: float) -> np.ndarray:
    """Labels of average-linkage clusters under cosine distance, merged up to the limit (inclusive)."""
    unit_rows = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    distance = 1.0 - unit_rows @ unit_rows.T
    np.fill_diagonal(distance, np.inf)
    size, label = np.ones(len(vectors)), np.arange(len(vectors))
    while len(vectors) > 1:
        i, j = sorted(divmod(int(distance.argmin()), len(distance)))
        if not distance[i, j] <= limit:
            break
        row = (size[i] * distance[i] + size[j] * distance[j]) / (size[i] + size[j])
        distance[i], distance[:, i] = row, row
        distance[i, i] = distance[j] = distance[:, j] = np.inf
        size[i] += size[j]
        label[label == j] = i
    return label


#: Voiceprints of a block; a task compares two blocks by one matrix product.
BLOCK = 2000


def near_links(prints: DataFrame, same: float, name: str = "local_speaker", vector: str = "centroid", block: int = BLOCK) -> DataFrame:
    """Links (u, v) between voiceprints of a similarity of at least same, enough to make all components.

    Names are dealt to blocks by hash, and every two blocks meet in one task, once; a task links
    what its matrix product finds, leaving out links between what it has linked already.
    """
    n = prints.count()
    blocks = max(1, -(-n // block))
    own = prints.select(F.col(name).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("x"), F.pmod(F.xxhash64(name), F.lit(blocks)).cast("int").alias("b"))
    cell = lambda other: F.least(F.col("b"), other) * blocks + F.greatest(F.col("b"), other)
    dealt = own.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(blocks - 1)), cell)))
    kind = prints.schema[name].dataType.simpleString()

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids, b = table.column("id"), table.column("b").to_numpy()
        x = np.array(table.column("x").to_pylist(), dtype=float)
        near = x @ x.T >= same - 1e-12
        if key[0].as_py() // blocks != key[0].as_py() % blocks:
            near &= b[:, None] != b[None, :]
        root, pairs = list(range(len(x))), []

        def of(i: int) -> int:
            while root[i] != i:
                root[i] = i = root[root[i]]
            return i

        for i, k in zip(*(p.tolist() for p in np.nonzero(np.triu(near, 1)))):
            if (a := of(i)) != (c := of(k)):
                root[max(a, c)] = min(a, c)
                pairs.append((i, k))
        take = lambda places: ids.take(pa.array(places, pa.int64()))
        return pa.table({"u": take([k for _, k in pairs]), "v": take([i for i, _ in pairs])})

    return dealt.groupBy("cell").applyInArrow(compare, f"u {kind}, v {kind}")


def clusters(prints: DataFrame, same: float, min_seconds: float, name: str = "local_speaker") -> DataFrame:
    """(name, cluster): cluster is the least name of its members.

    Two clusters merge only if some pair across them is within the limit, so clusters never leave
    the components of the graph of such pairs, and each component is clustered on its own, exactly.
    Voiceprints with little speech stay alone.
    """
    prints = staged(prints.select(name, "seconds", "centroid"), "voiceprints")
    trusted = prints.where(F.col("seconds") >= min_seconds).select(name, "centroid")
    parts = connected(near_links(trusted, same, name))
    kind = trusted.schema[name].dataType.simpleString()

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(name).reset_index(drop=True)
        label = average_linkage(np.array(pdf["centroid"].tolist(), dtype=float), 1.0 - same)
        return pd.DataFrame({name: pdf[name], "cluster": pdf[name].to_numpy()[label]})

    grouped = trusted.join(parts.select(F.col("id").alias(name), "component"), name).groupBy("component").applyInPandas(own, f"{name} {kind}, cluster {kind}")
    out = prints.select(name).join(grouped, name, "left")
    return out.select(name, F.coalesce("cluster", name).alias("cluster"))


def connected(links: DataFrame, rounds: int = 30) -> DataFrame:
    """(id, component) of links (u, v): labels fall to the least label near until nothing changes; every round is a written table."""
    edges = staged(links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = staged(edges.groupBy(F.col("u").alias("id")).agg(F.least(F.first("u"), F.min("v")).alias("component")), "labels")
    for _ in range(rounds):
        heard = edges.join(labels, edges["v"] == labels["id"]).groupBy("u").agg(F.min("component").alias("m"))
        own = labels.join(heard, labels["id"] == heard["u"]).select("id", "component", F.least("component", "m").alias("near"))
        # A label's own label, so that chains halve.
        new = own.join(labels.select(F.col("id").alias("near"), F.col("component").alias("far")), "near").select("id", F.col("component").alias("old"), F.least("near", "far").alias("component"))
        new = staged(new, "labels")
        if not new.where("old <> component").take(1):
            return new.drop("old")
        labels = new.drop("old")
    raise RuntimeError("components did not settle")


def rank_clusters(members: DataFrame, cluster: str = "cluster", seconds: str = "seconds", first: str = "first") -> DataFrame:
    """(cluster, rank): 0 for the most speech, ties by the first member."""
    totals = members.groupBy(cluster).agg(F.sum(seconds).alias("total"), F.min(first).alias("__first"))
    return placed(totals, [F.col("total").desc(), F.col("__first")], "rank").select(cluster, "total", "rank")


def stable_ids(members: DataFrame, previous: DataFrame) -> DataFrame:
    """(cluster, speaker): clusters by speech take the old id with most of their speech that is left, others new numbers.

    members: (local_speaker, cluster, seconds, rank); previous: (local_speaker, speaker).  Clusters
    ask for their best id in rounds; an id stays with the cluster of the best rank that has asked
    so far, and is out of reach for those behind it.  When no two ask for the same id, everyone has
    what taking turns by rank would give.
    """
    votes = members.join(previous, "local_speaker").groupBy("cluster", "rank", "speaker").agg(F.sum(F.col("seconds") + 1e-3).alias("v"))
    left = staged(votes, "votes")
    while True:
        asks = left.groupBy("cluster", "rank").agg(F.min_by("speaker", F.struct(-F.col("v"), "speaker")).alias("speaker"))
        holders = asks.groupBy("speaker").agg(F.min("rank").alias("__holder"), F.count("*").alias("__asked"))
        if not holders.where("__asked > 1").take(1):
            break
        left = staged(left.join(holders, "speaker", "left").where(F.col("__holder").isNull() | (F.col("rank") <= F.col("__holder"))).drop("__holder", "__asked"), "votes")
    ranks = members.groupBy("cluster").agg(F.min("rank").alias("rank"))
    claimed = ranks.join(asks.select("cluster", "speaker"), "cluster", "left")
    used = previous.where(F.col("speaker").rlike(r"^.\d+$")).agg(F.coalesce(F.max(F.substring("speaker", 2, 20).cast("long")), F.lit(0)).alias("top"))
    new = placed(claimed.where("speaker is null"), [F.col("rank"), F.col("cluster")], "n").join(F.broadcast(used))  # one row
    number = F.concat(F.lit("S"), F.lpad((F.col("top") + F.col("n") + 1).cast("string"), 4, "0"))
    return claimed.where("speaker is not null").select("cluster", "speaker").unionByName(new.select("cluster", number.alias("speaker")))


def voice_class(p_female: Column) -> Column:
    return F.when(p_female.isNull() | F.isnan(p_female), "unknown").when(p_female >= 0.7, "female").when(p_female <= 0.3, "male").otherwise("unclear")


def weighted_average(value: Column, weight: Column) -> Column:
    """Over rows with a finite value and a positive weight; null without any."""
    ok = value.isNotNull() & ~F.isnan(value) & (weight > 0)
    return F.sum(F.when(ok, weight * value)) / F.sum(F.when(ok, weight))


def registry(prints: DataFrame, ids: DataFrame) -> DataFrame:
    """Per global speaker: seconds, clips, recordings and members, pitch and voice class."""
    rows = prints.join(ids, "local_speaker")
    out = rows.groupBy("speaker").agg(
        F.sum("seconds").alias("seconds"), F.sum("clips").alias("clips"), F.array_sort(F.collect_set("recording")).alias("recordings"), F.array_sort(F.collect_list("local_speaker")).alias("members"),
        weighted_average(F.col("f0"), F.col("seconds")).alias("f0"), weighted_average(F.col("p_female"), F.col("seconds")).alias("p_female"),
    )
    return out.withColumn("voice", voice_class(F.col("p_female")))


def top_clips(clips: DataFrame, by: str, n: int, size: str = "duration", tie: str = "id") -> DataFrame:
    """The n largest rows of each group."""
    w = Window.partitionBy(by).orderBy(F.col(size).desc(), tie)
    return clips.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= n).drop("__r")


def gender_mean(clips: DataFrame, scores: DataFrame, n: int = 8, by: str = "local_speaker") -> DataFrame:
    """(by, p_female): the mean score of the n longest clips of a speaker, rounded; scores: (id, p)."""
    best = top_clips(clips, by, n)
    return best.join(scores, "id").groupBy(by).agg(F.round(F.avg("p"), 3).alias("p_female"))
