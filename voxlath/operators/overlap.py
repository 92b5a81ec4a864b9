"""Benchmark of the detectors on sessions with known second voices, and lanes of overlapped speech."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import between, choice, uniform
from . import frames as fr
from .intervals import frame_slice

#: Seconds and levels of inserted snippets, thresholds of the recall grid, pauses between turns.
SNIPPETS, GAINS = [0.15, 0.3, 0.5, 1.0, 2.0], [0.0, -6.0, -12.0, -18.0, -24.0]
GRID = [0.05, 0.1, 0.2, 0.3, 0.5]
GAP, TURN, APART = 0.4, 20.0, (3.0, 6.0)
#: Detector thresholds of the benchmark's configurations; None switches a detector off, "base" keeps the default.
CONFIGS = {
    "other_only@0.15": {"other": 0.15, "overlap": None, "local_other": None, "mode": "acoustic"},
    "overlap_only@0.2": {"other": None, "overlap": 0.2, "local_other": None, "mode": "acoustic"},
    "local_other_only@0.2": {"other": None, "overlap": None, "local_other": 0.2, "mode": "acoustic"},
    "union@0.2": {"other": 0.15, "overlap": 0.2, "local_other": 0.2, "mode": "acoustic"},
    "speaker_gap": {"other": "base", "overlap": "base", "local_other": "base", "mode": "speaker_gap"},
    "default": {"other": "base", "overlap": "base", "local_other": "base", "mode": "acoustic"},
}


def lanes(frames: DataFrame, speech: float = 0.5, multi: float = 0.5, hop: float = 0.01, rec: str = "rec") -> DataFrame:
    """(rec, lane, start, end) in seconds: where two speakers or more are active, where the detector of several voices is on, and either.

    frames: (rec, t, k, p, p_multi), p_multi the same for all speakers of a frame.
    """
    by = frames.groupBy(rec, "t").agg(F.count_if(F.col("p") > speech).alias("n"), F.max("p_multi").alias("m"))
    active, several = F.col("n") >= 2, F.coalesce(F.col("m") > multi, F.lit(False))
    marks = F.array(*[F.struct(F.lit(name).alias("lane"), on.alias("on")) for name, on in (("active", active), ("detected", several), ("any", active | several))])
    rows = by.select(rec, "t", F.explode(marks).alias("x")).select(rec, "t", "x.lane", "x.on")
    return seconds(fr.islands(rows, [rec, "lane"], "on"), hop)


def seconds(runs: DataFrame, hop: float, digits: int = 2) -> DataFrame:
    """Runs of frames as rounded seconds."""
    return runs.withColumn("start", F.round(F.col("start") * hop, digits)).withColumn("end", F.round(F.col("end") * hop, digits))


def frames_of(intervals: DataFrame, hop: float, before: float = 0.0, after: float = 0.0, keep: Sequence[str] = ("rec",)) -> DataFrame:
    """(keep, t): the frames that intervals (start, end in seconds) cover, widened; each once."""
    first, last = frame_slice(F.greatest(F.lit(0.0), F.col("start") - before), F.col("end") + after, hop)
    return intervals.select(*keep, F.explode(F.when(last > first, F.sequence(first, last - 1))).alias("t")).distinct()


def primary_channel(frames: DataFrame, turns: DataFrame, hop: float, speech: float = 0.5) -> DataFrame:
    """(rec, k): the speaker with most active frames in the turns, the first of equals."""
    inside = frames.join(frames_of(turns, hop), ["rec", "t"])
    n = inside.groupBy("rec", "k").agg(F.count_if(F.col("p") > speech).alias("n"))
    return n.groupBy("rec").agg(F.max_by("k", F.struct("n", -F.col("k"))).alias("k"))


def untouched(frames: DataFrame, turns: DataFrame, insertions: DataFrame, hop: float, speech: float = 0.5, apart: float = 1.0) -> DataFrame:
    """(rec, t, k, signals): the main speaker's own speech in turns, away from any insertion."""
    own = frames.join(primary_channel(frames, turns, hop, speech), ["rec", "k"]).where(F.col("p") > speech)
    return own.join(frames_of(turns, hop), ["rec", "t"], "left_semi").join(frames_of(insertions, hop, apart, apart), ["rec", "t"], "left_anti")


def kept_clean(clean: DataFrame, segments: DataFrame, hop: float) -> DataFrame:
    """(rec, frames, kept, share): how much of the untouched frames the segments (rec, start, end) keep."""
    kept = frames_of(segments, hop).withColumn("__kept", F.lit(1))
    out = clean.join(kept, ["rec", "t"], "left").groupBy("rec").agg(F.count("*").alias("frames"), F.count("__kept").alias("kept"))
    return out.withColumn("share", F.round(F.col("kept") / F.col("frames"), 3))


def signal_recall(frames: DataFrame, turns: DataFrame, insertions: DataFrame, signals: Sequence[str], hop: float, thresholds: Sequence[float] = GRID, speech: float = 0.5) -> DataFrame:
    """(signal, threshold, recall, flagged_clean, misses): per signal of the main speaker, how many insertions exceed the threshold anywhere and how many clean frames do.

    insertions: (rec, id, start, end, length, gain_db); misses is a map from length@gain to
    missed / all, of kinds with any.  Signals of several ways to combine windows are so many columns.
    """
    main = primary_channel(frames, turns, hop, speech)
    cells = frames_of(insertions, hop, keep=("rec", "id")).join(main, "rec").join(frames.select("rec", "t", "k", *signals), ["rec", "t", "k"])
    peaks = insertions.join(cells.groupBy("rec", "id").agg(*[F.max(s).alias(s) for s in signals]), ["rec", "id"], "left")
    grid = lambda: F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.lit(float(th)).alias("threshold"), F.coalesce(F.col(s) > th, F.lit(False)).alias("hit")) for s in signals for th in thresholds])).alias("g")
    kind = F.format_string("%.2fs@%+.0fdB", F.col("length"), F.col("gain_db") + 0.0).alias("kind")
    hits = peaks.select(kind, grid()).select("kind", "g.*").groupBy("signal", "threshold", "kind").agg(F.count("*").alias("n"), F.count_if(~F.col("hit")).alias("missed"))
    entry = F.struct("kind", F.concat(F.col("missed").cast("string"), F.lit("/"), F.col("n").cast("string")))
    found = hits.groupBy("signal", "threshold").agg(
        F.round(1 - F.sum("missed") / F.sum("n"), 3).alias("recall"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("missed") > 0, entry)))).alias("misses")
    )  # as many entries as kinds
    clean = untouched(frames, turns, insertions, hop, speech).select(grid()).select("g.*").groupBy("signal", "threshold").agg(F.round(F.avg(F.col("hit").cast("double")), 3).alias("flagged_clean"))
    return found.join(clean, ["signal", "threshold"], "left").select("signal", "threshold", "recall", "flagged_clean", "misses")


def config_table(spark, base: Mapping[str, float]) -> DataFrame:
    """(config, mode, thresholds by detector): the benchmark's configurations, over the default thresholds."""
    names = list(base)
    rows = [(c, x["mode"], *[base[n] if x[n] == "base" else x[n] for n in names]) for c, x in CONFIGS.items()]
    return spark.createDataFrame(rows, ", ".join(["config string", "mode string", *[f"{n} double" for n in names]]))


def session_plan(clips: DataFrame, seed: int = 0, minutes: float = 15.0) -> tuple[DataFrame, DataFrame]:
    """(turns, insertions) of a synthetic session of two speakers: (turn, start, end) and (turn, at, length, gain_db).

    clips: (id, speaker, duration).  The speaker with most seconds speaks in turns of clips of 4 s
    or more, in seeded order, up to TURN seconds each; a clip of the second one and two gaps stand
    before and after each.  Snippets start 1.5 to 3 s into a turn and follow each other 3 to 6 s
    apart.  One speaker's clips are one ordered fold.
    """
    totals = clips.groupBy("speaker").agg(F.sum("duration").alias("s")).orderBy(F.col("s").desc(), "speaker").limit(2)
    pair = totals.agg(F.array_sort(F.collect_list(F.struct((-F.col("s")).alias("s"), "speaker"))).alias("p")).select(F.get("p", F.lit(0))["speaker"].alias("a"), F.get("p", F.lit(1))["speaker"].alias("b"))  # two rows
    order = F.array_sort(F.collect_list(F.struct(uniform(seed, "id").alias("u"), "id", F.col("duration").cast("double").alias("d"))))
    long = clips.join(F.broadcast(pair), F.col("speaker") == F.col("a")).where("duration >= 4").agg(order.alias("own"))
    other = clips.join(F.broadcast(pair), F.col("speaker") == F.col("b")).agg(F.transform(order, lambda x: x["d"]).alias("other"))

    def step(acc: Column, x: Column) -> Column:
        last = F.element_at(acc, -1)
        full = F.struct(F.lit(0.0).alias("have"), (last["have"] + x["d"]).alias("length"))
        added = F.struct((last["have"] + x["d"]).alias("have"), F.lit(0.0).alias("length"))
        return F.concat(F.slice(acc, 1, F.size(acc) - 1), F.when(last["have"] + x["d"] >= TURN, F.array(full, F.struct(F.lit(0.0).alias("have"), F.lit(0.0).alias("length")))).otherwise(F.array(added)))

    start = F.array(F.struct(F.lit(0.0).alias("have"), F.lit(0.0).alias("length")))
    lengths = F.transform(F.filter(F.aggregate("own", start, step), lambda t: (t["length"] > 0) | (t["have"] > 0)), lambda t: F.greatest(t["length"], t["have"]))
    turns = long.select(lengths.alias("lengths")).join(F.broadcast(other)).select("other", F.posexplode("lengths").alias("turn", "length"))  # one row each
    lead = F.get("other", (F.col("turn") % F.size("other")).cast("int")) + GAP
    before = F.sum(lead + F.col("length") + GAP).over(Window.orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)) - F.col("length") - GAP  # the turns of one session
    placed = turns.select("turn", before.alias("start"), "length", lead.alias("lead")).where(F.col("start") - F.col("lead") < minutes * 60)
    turns = placed.select("turn", "start", (F.col("start") + F.col("length")).alias("end"))
    tries = placed.select("turn", "start", "length", F.explode(F.sequence(F.lit(0), F.floor(F.col("length") / APART[0]).cast("int"))).alias("i"))
    drawn = tries.withColumn("size", choice(seed + 1, SNIPPETS, "turn", "i")).withColumn("gain_db", choice(seed + 2, GAINS, "turn", "i"))
    step_on = F.when(F.col("i") == 0, between(seed + 3, 1.5, 3.0, "turn", "i")).otherwise(F.lag("size").over(Window.partitionBy("turn").orderBy("i")) + between(seed + 3, *APART, "turn", "i"))
    at = drawn.withColumn("step", step_on).withColumn("at", F.sum("step").over(Window.partitionBy("turn").orderBy("i")))
    return turns, at.where(F.col("at") < F.col("length") - 2.5).select("turn", (F.col("start") + F.col("at")).alias("at"), F.col("size").alias("length"), "gain_db")


def loudest_crop(energies: DataFrame, keys: Sequence[str], size: int, seed: int = 0, tries: int = 8) -> DataFrame:
    """(keys, at, level): of some crops at drawn places the one with the most energy, the first drawn of equals.

    energies: (keys, t, e) dense from 0; a row shorter than the crop gives none.
    """
    n = energies.groupBy(*keys).agg((F.max("t") + 1).alias("n")).where(F.col("n") >= size)
    places = n.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.lit(tries - 1))).alias("i"))
    places = places.withColumn("at", F.floor(uniform(seed, *keys, "i") * F.greatest(F.lit(1), F.col("n") - size)))
    cells = places.select(*keys, "i", "at", F.explode(F.sequence(F.col("at"), F.col("at") + size - 1)).alias("t")).join(energies, [*keys, "t"])
    level = cells.groupBy(*keys, "i", "at").agg(F.avg("e").alias("level"))
    return level.groupBy(*keys).agg(F.max_by(F.struct("at", "level"), F.struct("level", -F.col("i"))).alias("b")).select(*keys, "b.at", "b.level")
