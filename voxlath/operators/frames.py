"""Operators over frame tables: one row per recording, frame and speaker, frames numbered from 0.

Windows are partitioned by recording (and speaker), so a task holds one recording's frames at a
time.  All functions are lazy DataFrame transforms over built-in functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

#: dB of a frame without a measured energy.
SILENCE_DB = -100.0


def union_mask(signals: Mapping[str, float | None]) -> Column:
    """True where any signal exceeds its threshold (strictly); None switches a signal off, a null signal is below."""
    on = [F.coalesce(F.col(s) > th, F.lit(False)) for s, th in signals.items() if th is not None]
    out = F.lit(False)
    for c in on:
        out = out | c
    return out


def strength(signals: Mapping[str, float | None]) -> Column:
    """Largest signal relative to its threshold; 1 is just flagged, 0 where nothing is on."""
    on = [F.coalesce(F.col(s) / th, F.lit(0.0)) for s, th in signals.items() if th is not None]
    return F.greatest(F.lit(0.0), F.lit(0.0), *on)


def others_max(frames: DataFrame, keys: Sequence[str] = ("rec", "t"), k: str = "k", value: str = "p", out: str = "other") -> DataFrame:
    """Adds the largest value among the other rows of a frame; 0 where there is none."""
    w = Window.partitionBy(*keys).orderBy(k)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    return frames.withColumn(out, F.coalesce(F.greatest(F.max(value).over(before), F.max(value).over(after)), F.lit(0.0)))


def islands(rows: DataFrame, keys: Sequence[str], mask: Column | str, t: str = "t", aggs: Sequence[Column] = ()) -> DataFrame:
    """Runs of consecutive frames where mask holds, as half-open [start, end), with aggregates over their rows."""
    kept = rows.where(mask)
    run = F.col(t) - F.row_number().over(Window.partitionBy(*keys).orderBy(t))
    return kept.withColumn("__run", run).groupBy(*keys, "__run").agg(F.min(t).alias("start"), (F.max(t) + 1).alias("end"), *aggs).drop("__run")


def run_ids(rows: DataFrame, keys: Sequence[str], mask: str, out: str, t: str = "t") -> DataFrame:
    """Adds the number of mask changes before each frame: equal inside a run of equal values."""
    w = Window.partitionBy(*keys).orderBy(t)
    change = (F.col(mask) != F.lag(mask).over(w)).cast("int")
    return rows.withColumn("__c", F.coalesce(change, F.lit(0))).withColumn(out, F.sum("__c").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__c")


def dilate(rows: DataFrame, keys: Sequence[str], mask: Column | str, pad: int, out: str, t: str = "t") -> DataFrame:
    """Adds the mask widened by pad frames both ways; by frame numbers, so gaps in the table are gaps in time."""
    mask = F.expr(mask) if isinstance(mask, str) else mask
    w = Window.partitionBy(*keys).orderBy(F.col(t).cast("long")).rangeBetween(-pad, pad)
    return rows.withColumn(out, F.max(mask).over(w) if pad else mask)


def dilate_within(rows: DataFrame, keys: Sequence[str], mask: Column | str, barrier: str, pad: int, out: str, t: str = "t") -> DataFrame:
    """Adds the mask outside barriers widened by pad frames that never step onto or over a barrier frame."""
    numbered = run_ids(rows, keys, barrier, "__b", t)
    seed = (F.expr(mask) if isinstance(mask, str) else mask) & ~F.col(barrier)
    return dilate(numbered, [*keys, "__b"], seed, pad, out, t).drop("__b")


def frame_energy(samples: DataFrame, keys: Sequence[str], i: str, x: str, hop: int) -> DataFrame:
    """(keys, t, db): energy of frames of hop samples; a short last frame is divided by hop too."""
    return samples.groupBy(*keys, F.floor(F.col(i) / hop).alias("t")).agg((10 * F.log10(F.sum(F.col(x) * F.col(x)) / hop + F.lit(1e-10))).alias("db"))


def speech_level(frames: DataFrame, energy: DataFrame, threshold: float = 0.5, share: float = 0.9, rec: str = "rec") -> DataFrame:
    """(rec, level): percentile of energy while anyone speaks; no row where nobody does."""
    active = frames.where(F.col("p") > threshold).select(rec, "t").distinct()
    return active.join(energy, [rec, "t"]).groupBy(rec).agg(F.percentile("db", share).alias("level"))


def pauses(frames: DataFrame, energy: DataFrame, pause_db: float, min_pause: int, threshold: float = 0.5, rec: str = "rec") -> DataFrame:
    """(rec, t, quiet, barrier) for every frame: below the speech level by pause_db, and in a quiet run of min_pause frames."""
    spine = frames.select(rec, "t").distinct()
    level = speech_level(frames, energy, threshold, rec=rec)
    db = spine.join(energy, [rec, "t"], "left").join(level, rec, "left")
    quiet = db.select(rec, "t", F.coalesce(F.coalesce("db", F.lit(SILENCE_DB)) < F.col("level") + pause_db, F.lit(False)).alias("quiet"))
    numbered = run_ids(quiet, [rec], "quiet", "__q")
    size = F.count("*").over(Window.partitionBy(rec, "__q"))
    return numbered.withColumn("barrier", F.col("quiet") & (size >= min_pause)).drop("__q")


def mark_pauses(rows: DataFrame, pause_db: float, min_pause: int, threshold: float = 0.5, share: float = 0.9, rec: str = "rec", k: str = "k") -> DataFrame:
    """Adds quiet and barrier as `pauses` has them, for dense rows (rec, t, k, p, db), by windows within a recording alone."""
    frame, speaker = Window.partitionBy(rec, "t"), Window.partitionBy(rec, k).orderBy("t")
    once = (F.col(k) == F.min(k).over(frame)) & F.max(F.col("p") > threshold).over(frame)
    out = rows.withColumn("__a", F.when(once, F.coalesce("db", F.lit(SILENCE_DB))))
    level = F.percentile("__a", share).over(Window.partitionBy(rec))
    out = out.withColumn("quiet", F.coalesce(F.coalesce("db", F.lit(SILENCE_DB)) < level + pause_db, F.lit(False))).drop("__a")
    out = _numbered(out, speaker, F.col("quiet"), "__q")
    return out.withColumn("barrier", F.col("quiet") & (F.count("*").over(Window.partitionBy(rec, k, "__q")) >= min_pause)).drop("__q")


def _numbered(rows: DataFrame, w: WindowSpec, value: Column, out: str, t: str = "t") -> DataFrame:
    """Adds the number of the run of equal values in consecutive frames."""
    new = (value != F.lag(value).over(w)) | (F.col(t) != F.lag(t).over(w) + 1)
    return rows.withColumn("__new", F.coalesce(new, F.lit(False)).cast("int")).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def smear_trim(rows: DataFrame, max_frames: int, max_strength: float, keys: Sequence[str] = ("rec", "k")) -> DataFrame:
    """Adds trimmed (the foreign mask without detector smear at pauses) and smear (frames of smear pauses).

    rows: dense frames with foreign, barrier and strength.  A weak run outside pauses is at most
    max_frames long with a peak of at most max_strength; a pause that touches any other run
    outside is a smear pause: its weak frames and the weak runs that touch it are cleared.
    Everything is a window within the keys, so rows are dealt once.
    """
    w = Window.partitionBy(*keys).orderBy("t")
    kind = F.when(F.col("barrier"), 2).when(F.col("foreign"), 1).otherwise(0)
    out = _numbered(rows.withColumn("__kind", kind), w, F.col("__kind"), "__run")
    run = Window.partitionBy(*keys, "__run")
    weak = (F.count("*").over(run) <= max_frames) & (F.max("strength").over(run) <= max_strength)
    out = out.withColumn("__strong", (F.col("__kind") == 1) & ~weak)

    def touches(flag: str) -> Column:
        """Whether the frame before or after in time has the flag."""
        before = F.lag(flag).over(w) & (F.lag("t").over(w) == F.col("t") - 1)
        after = F.lead(flag).over(w) & (F.lead("t").over(w) == F.col("t") + 1)
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    out = out.withColumn("__touch", touches("__strong")).withColumn("smear", (F.col("__kind") == 2) & F.max("__touch").over(run))
    out = out.withColumn("__touch", touches("smear")).withColumn("__cleared", (F.col("__kind") == 1) & ~F.col("__strong") & F.max("__touch").over(run))
    trimmed = F.col("foreign") & ~F.col("__cleared") & (~F.col("smear") | (F.col("strength") > max_strength))
    return out.withColumn("trimmed", trimmed).drop("__kind", "__run", "__strong", "__touch", "__cleared")


def in_runs(rows: DataFrame, keys: Sequence[str], mask: Column, start: str = "run_start", end: str = "run_end", t: str = "t") -> DataFrame:
    """Rows where mask holds, with the bounds of their run."""
    out = _numbered(rows.withColumn("__mask", mask), Window.partitionBy(*keys).orderBy(t), F.col("__mask"), "__run")
    run = Window.partitionBy(*keys, "__run")
    return out.withColumn(start, F.min(t).over(run)).withColumn(end, F.max(t).over(run) + 1).where("__mask").drop("__mask", "__run")


def padded_foreign(rows: DataFrame, pad: int, max_frames: int, max_strength: float, keys: Sequence[str] = ("rec", "k")) -> DataFrame:
    """Adds unsafe: where another voice may be heard, with the pad; rows as for smear_trim."""
    out = smear_trim(rows, max_frames, max_strength, keys)
    out = dilate_within(out, keys, "trimmed", "barrier", pad, "__o")
    out = dilate(out, keys, F.col("trimmed") & F.col("barrier") & ~F.col("smear"), pad, "__i")
    return out.withColumn("unsafe", F.col("trimmed") | F.col("__o") | F.col("__i")).drop("__o", "__i")


def upsample(rows: DataFrame, frames: DataFrame, keys: Sequence[str], values: Sequence[str], ratio: int = 2, t: str = "t") -> DataFrame:
    """A coarse table on the fine frames' grid: each fine frame takes its coarse one, past the end the last one."""
    last = rows.groupBy(*keys).agg(F.max(t).alias("__last"))
    fine = frames.join(last, list(keys)).withColumn("__t", F.least(F.floor(F.col(t) / ratio), F.col("__last")))
    coarse = rows.select(*keys, F.col(t).alias("__t"), *values)
    return fine.join(coarse, [*keys, "__t"]).drop("__t", "__last")


def max_pool(rows: DataFrame, keys: Sequence[str], value: str, ratio: int = 2, t: str = "t") -> DataFrame:
    """Largest value of each group of ratio frames; a short last group counts what it has."""
    return rows.groupBy(*keys, F.floor(F.col(t) / ratio).alias(t)).agg(F.max(value).alias(value))


def window_starts(n_frames: Column, size: int, step: int) -> Column:
    """Starts of windows of size frames every step frames, and one more that ends with the last frame."""
    last = F.greatest(F.lit(0), n_frames - size)
    return F.array_distinct(F.array_append(F.sequence(F.lit(0), last, F.lit(step)), last))


def combine_windows(rows: DataFrame, keys: Sequence[str], value: str, how: str = "max") -> DataFrame:
    """One value per frame from overlapping windows: the largest, or the mean over the windows that cover it."""
    if how not in ("max", "mean"):
        raise ValueError(f"unknown combination {how!r}")
    return rows.groupBy(*keys).agg((F.max(value) if how == "max" else F.sum(value) / F.greatest(F.count(value), F.lit(1))).alias(value))


def overlap_add(rows: DataFrame, keys: Sequence[str], values: Sequence[str], weight: str) -> DataFrame:
    """Weighted means over the windows that cover a frame."""
    total = F.greatest(F.sum(weight), F.lit(1e-8))
    return rows.groupBy(*keys).agg(*[(F.sum(F.col(v) * F.col(weight)) / total).alias(v) for v in values])


def hamming(i: Column, size: int) -> Column:
    """Window weight with a floor that keeps the ends from vanishing."""
    return 0.54 - 0.46 * F.cos(2 * F.pi() * i / (size - 1)) + 1e-3


def collapse(rows: DataFrame, keys: Sequence[str], blank: int, t: str = "t", k: str = "k", p: str = "p") -> DataFrame:
    """Best path: the most likely label of each frame (the first of equals), repeats and blanks dropped, as one array."""
    best = rows.groupBy(*keys, t).agg(F.max_by(k, F.struct(F.col(p), -F.col(k))).alias("label"))
    new = best.withColumn("__before", F.lag("label").over(Window.partitionBy(*keys).orderBy(t)))
    kept = new.where((F.col("label") != blank) & (F.col("__before").isNull() | (F.col("label") != F.col("__before"))))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct(t, "label"))), lambda x: x["label"])
    return kept.groupBy(*keys).agg(ordered.alias("labels"))


def peak_envelope(rows: DataFrame, keys: Sequence[str], value: str, ratio: int, t: str = "t") -> DataFrame:
    """Largest magnitude per group of frames, relative to the 99.9th percentile, clipped and square-rooted."""
    peaks = rows.groupBy(*keys, F.floor(F.col(t) / ratio).alias(t)).agg(F.max(F.abs(value)).alias("peak"))
    top = peaks.groupBy(*keys).agg(F.percentile("peak", 0.999).alias("__top"))
    scaled = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("peak") / F.greatest(F.col("__top"), F.lit(1e-9))))
    return peaks.join(top, list(keys)).select(*keys, t, F.sqrt(scaled).alias("envelope"))


def max_pool_dense(rows: DataFrame, grid: DataFrame, keys: Sequence[str], value: str, ratio: int = 2, t: str = "t") -> DataFrame:
    """max_pool on every coarse frame of the grid (keys, t); 0 where rows end before it."""
    return grid.join(max_pool(rows, keys, value, ratio, t), [*keys, t], "left").withColumn(value, F.coalesce(value, F.lit(0.0)))


def by_cardinality(probabilities: Column, mapping: Sequence[Sequence[int]]) -> Column:
    """struct<none, one, more>: probabilities of classes, each a set of speakers, summed by how many speakers a class has."""
    sizes = F.array(*[F.lit(sum(m)) for m in mapping])
    total = lambda keep: F.aggregate(F.zip_with(probabilities, sizes, lambda p, n: F.when(keep(n), p).otherwise(0.0)), F.lit(0.0), lambda s, x: s + x)
    return F.struct(total(lambda n: n == 0).alias("none"), total(lambda n: n == 1).alias("one"), total(lambda n: n >= 2).alias("more"))


def standardise(rows: DataFrame, by: Sequence[str], value: str, eps: float = 1e-5, least: float = 2.0**-24) -> DataFrame:
    """Adds normal: a feature less its mean over its deviation, which is the sample's and at least a little."""
    stats = rows.groupBy(*by).agg(F.avg(value).alias("__m"), F.sqrt(F.greatest(F.coalesce(F.var_samp(value), F.lit(0.0)), F.lit(least))).alias("__s"))
    return rows.join(stats, list(by)).withColumn("normal", (F.col(value) - F.col("__m")) / (F.col("__s") + eps)).drop("__m", "__s")
