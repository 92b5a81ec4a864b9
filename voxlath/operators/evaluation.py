"""Evaluation: group means with bootstrap intervals, paired differences, preferences, detector recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.draws import uniform

LOWER_IS_BETTER = {"cer": True, "wer": True, "sim": False, "utmos": False}


def grouped(rows: DataFrame) -> DataFrame:
    """A row for each group that a result belongs to: all, seen or unseen, and female or male."""
    pairs = F.array(F.struct(F.lit("all").alias("g"), F.lit(True).alias("ok")), F.struct(F.lit("seen").alias("g"), F.col("seen").alias("ok")), F.struct(F.lit("unseen").alias("g"), (~F.col("seen")).alias("ok")), F.struct(F.lit("female").alias("g"), (F.col("voice") == "female").alias("ok")), F.struct(F.lit("male").alias("g"), (F.col("voice") == "male").alias("ok")))
    return rows.withColumn("group", F.explode(F.transform(F.filter(pairs, lambda x: x["ok"]), lambda x: x["g"])))


def group_means(rows: DataFrame, metric: str, by: list[str]) -> DataFrame:
    value = F.when(~F.isnan(metric), F.col(metric))
    return rows.groupBy(*by).agg(F.count(value).alias("n"), F.avg(value).alias("mean"))


def bootstrap(rows: DataFrame, metric: str, by: list[str], item: str, resamples: int = 2000, seed: int = 0) -> DataFrame:
    """Means with 95 % intervals of resampled means.

    Draws are by md5 of (seed, resample, item, group), so they are the same on every run and in any engine.  Each row
    counts in a resample as often as it is drawn: a Poisson(1) weight by inverse of its
    distribution, so that no rows are collected and resamples are summed before the shuffle.
    """
    value = F.when(~F.isnan(metric), F.col(metric))
    draws = rows.where(value.isNotNull()).select(*by, value.alias("v"), F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))).alias("r"), F.col(item).alias("__i"))
    u = uniform(seed, "r", "__i", *by)
    steps, p, total = F.lit(0), 0.36787944117144233, 0.0
    for k in range(1, 9):
        total += p
        steps = steps + (u > total).cast("int")
        p /= k
    means = draws.withColumn("w", steps).groupBy(*by, "r").agg(F.sum(F.col("w") * F.col("v")).alias("s"), F.sum("w").alias("n")).where("n > 0").withColumn("m", F.col("s") / F.col("n"))
    return group_means(rows, metric, by).join(means.groupBy(*by).agg(F.percentile("m", 0.025).alias("low"), F.percentile("m", 0.975).alias("high")), by, "left")


def paired(rows: DataFrame, baseline: str, metric: str, order: str, real: str = "real speech") -> DataFrame:
    """Per model and item the difference to the baseline's result, real speech left out; of a repeated baseline item the last in order counts."""
    base = rows.where(F.col("model") == baseline).groupBy("item").agg(F.max_by(metric, order).alias("__b"))
    return rows.where(~F.col("model").isin(baseline, real)).join(base, "item").withColumn("diff", F.col(metric) - F.col("__b")).drop("__b")


def paired_summary(rows: DataFrame, baseline: str, metric: str, order: str, resamples: int = 2000, seed: int = 0) -> DataFrame:
    """(model, n, mean, low, high, win_rate): paired differences with their interval, and the share of items that a model wins."""
    pairs = paired(rows, baseline, metric, order)
    return bootstrap(pairs, "diff", ["model"], "item", resamples, seed).join(pairs.groupBy("model").agg(win_rate(metric).alias("win_rate")), "model")


def win_rate(metric: str) -> Column:
    better = F.col("diff") < 0 if LOWER_IS_BETTER[metric] else F.col("diff") > 0
    return F.avg(better.cast("double"))


def significance(low: Column, high: Column, lower_is_better: bool) -> Column:
    """good or bad where the interval excludes zero."""
    good, bad = (high < 0, low > 0) if lower_is_better else (low > 0, high < 0)
    return F.when(good, "good").when(bad, "bad")


def best_model(means: DataFrame, by: list[str], lower_is_better: bool, real: str = "real speech") -> DataFrame:
    """Each group's best model; real speech is none."""
    pick, means = F.min_by if lower_is_better else F.max_by, means.where(F.col("model") != real)
    return means.groupBy(*by).agg(pick("model", "mean").alias("model"))


def preference_tally(rounds: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """Per model over blind rounds with a vote: wins, played, ties and the win rate, wins over played.

    models: (model) that are configured; those that never played are there with 0 and no win rate.
    """
    voted = rounds.where(F.col("blind") & F.col("vote").isNotNull())
    slots = voted.select("vote", F.explode("slots").alias("s"))
    tie = F.col("vote") == "tie"
    out = slots.groupBy(F.col("s.model").alias("model")).agg(F.count_if(F.col("s.slot") == F.col("vote")).alias("wins"), F.count("*").alias("played"), F.count_if(tie).alias("ties"))
    if models is not None:
        out = out.join(models.select("model").distinct(), "model", "full").fillna(0, ["wins", "played", "ties"])
    return out.withColumn("win_rate", F.when(F.col("played") > 0, F.round(F.col("wins") / F.col("played"), 3)))


def pairwise_wins(rounds: DataFrame) -> DataFrame:
    """(winner, loser, n) over blind rounds that one slot won; a round's slots are few, so they are paired in the row."""
    won = rounds.where(F.col("blind") & F.col("vote").isNotNull() & (F.col("vote") != "tie"))
    best = F.get(F.filter("slots", lambda s: s["slot"] == F.col("vote")), F.lit(0))["model"]
    pairs = won.select(best.alias("winner"), F.explode(F.filter("slots", lambda s: s["slot"] != F.col("vote"))).alias("s"))
    return pairs.select("winner", F.col("s.model").alias("loser")).where(F.col("winner") != F.col("loser")).groupBy("winner", "loser").agg(F.count("*").alias("n"))


def pairwise(rounds: DataFrame) -> DataFrame:
    """(model, other, wins, losses) in both directions."""
    won = pairwise_wins(rounds)
    both = won.select(F.col("winner").alias("model"), F.col("loser").alias("other"), F.col("n").alias("wins"), F.lit(0).cast("long").alias("losses"))
    return both.unionByName(won.select(F.col("loser").alias("model"), F.col("winner").alias("other"), F.lit(0).cast("long").alias("wins"), F.col("n").alias("losses"))).groupBy("model", "other").agg(F.sum("wins").alias("wins"), F.sum("losses").alias("losses"))


def choose_checkpoint(checkpoints: DataFrame, choice: str, losses: DataFrame | None = None) -> DataFrame:
    """The one row of checkpoints (path, step) that is chosen: last, best by dev loss (name, loss) of those that are there, or one by its name.

    An error at run time where there is none.
    """
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    if choice == "last":
        one = checkpoints.agg(F.max_by(F.struct("path", "step"), "step").alias("c"))
    elif choice == "best":
        if losses is None:
            raise ValueError("the best checkpoint needs dev losses")
        scored = checkpoints.join(losses.select(F.col("name").alias("__n"), "loss"), name == F.col("__n"))
        one = scored.agg(F.min_by(F.struct("path", "step"), F.struct("loss", "step")).alias("c"))
    else:
        one = checkpoints.where(name == choice).agg(F.any_value(F.struct("path", "step")).alias("c"))
    there = F.when(F.col("c").isNull(), F.raise_error(F.lit(f"no checkpoint for {choice!r}")).cast("string")).otherwise(F.col("c.path"))
    return one.select(there.alias("path"), "c.step")


def mask_slots(slots: Column, blind: Column, vote: Column) -> Column:
    """Slots whose model is hidden until a blind round has its vote."""
    hide = blind & vote.isNull()
    return F.transform(slots, lambda s: F.struct(s["slot"].alias("slot"), F.when(~hide, s["model"]).alias("model")))


def apply_votes(rounds: DataFrame, votes: DataFrame) -> DataFrame:
    """Rounds with new votes (round_id, vote, at): only blind ones, only once, the first in time, and only for a slot that there is, or a tie."""
    slots = rounds.select("round_id", F.transform("slots", lambda s: s["slot"]).alias("__s"))
    valid = votes.join(slots, "round_id").where((F.col("vote") == "tie") | F.array_contains("__s", F.col("vote")))
    first = valid.groupBy("round_id").agg(F.min_by("vote", F.struct("at", "vote")).alias("__v"))
    new = rounds.join(first, "round_id", "left")
    there = (F.col("__v") == "tie") | F.exists("slots", lambda s: s["slot"] == F.col("__v"))
    return new.withColumn("vote", F.when(F.col("vote").isNull() & F.col("blind") & there, F.col("__v")).otherwise(F.col("vote"))).drop("__v")


def recall_grid(events: DataFrame, cells: DataFrame, signals: list[str], thresholds: list[float], keys: list[str]) -> DataFrame:
    """Per signal and threshold: the share of events in which it exceeds the threshold anywhere, and the misses.

    events: (keys, event); cells: frames of events (keys, event, signals).
    """
    peaks = cells.groupBy(*keys, "event").agg(*[F.max(s).alias(s) for s in signals])
    grid = F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.col(s).alias("peak"), F.lit(t).alias("threshold")) for s in signals for t in thresholds])).alias("g")
    hits = events.join(peaks, [*keys, "event"], "left").select(grid).select("g.*").withColumn("hit", F.coalesce(F.col("peak") > F.col("threshold"), F.lit(False)))
    return hits.groupBy("signal", "threshold").agg(F.avg(F.col("hit").cast("double")).alias("recall"), F.count_if(~F.col("hit")).alias("missed"))


def first_match(left: DataFrame, right: DataFrame, on: str, order: str) -> DataFrame:
    """Each left row with the first right row of its key; left rows without one go."""
    first = right.withColumn("__r", F.row_number().over(Window.partitionBy(on).orderBy(order))).where("__r = 1").drop("__r")
    return left.join(first, on)


def resume(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Work that has no result yet."""
    return work.join(done.select(*keys), keys, "left_anti")


def work_list(models: DataFrame, items: DataFrame) -> DataFrame:
    """Every model with every item; the models are a configuration, so they are an array in each row, not a join side."""
    names = models.select("model").distinct().agg(F.array_sort(F.collect_list("model")).alias("__m"))
    return items.join(F.broadcast(names)).withColumn("model", F.explode("__m")).drop("__m")  # one row


def best_take(rows: DataFrame, by: list[str]) -> DataFrame:
    """Per group the row with the least (rounded error, negative score), the first of equals."""
    return rows.groupBy(*by).agg(F.min_by("take", F.struct(F.round("cer", 3), -F.col("utmos"), "take")).alias("take"))
