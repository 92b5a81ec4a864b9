"""Quality rules with host verdicts, in DataFrame functions only.

Every document is measured once and the figures are written to the shared folder.  Failures of
each rule are summed by host; a beta prior, fitted to all hosts by moments, shrinks each host's
rate towards the corpus' rate, the more the fewer documents the host has; a host fails where a
shrunk rate exceeds the rule's limit, and its documents are not kept.

Null and empty texts have no words and fail the length rule.  Documents without a host form a
host of their own.  Repeated rows are each measured and each count.  An empty table gives an
empty result.  Only the columns named are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_SPLIT, materialize

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Words of a window that must not come twice, fewest words, and the share of repeated words that fails.
WINDOW, FEWEST, REPEATED = 5, 10, 0.2
#: Shrunk rates above which a host fails, by rule.
HOST_LIMITS = {"base": 0.5, "symbols": 0.5, "lines": 0.5}
#: Parts in which the rows of one host are joined with its verdict.
SALTS = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once for a row, however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def host(url: Column) -> Column:
    """Host of a URL in lower case, without www. and port; null where there is none."""
    name = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(name, r"^www\.", ""), F.lit(""))


def _repeated(words: Column) -> Column:
    """Words in windows that a text holds twice or more, each word once."""
    n = F.size(words)
    none = F.lit(0)

    def covered(hashes: Column) -> Column:
        ranked = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        places = lambda s: F.sort_array(
            F.transform(
                F.filter(s, lambda x, i: (F.get(s, i - 1)["h"] == x["h"]) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))),
                lambda x: x["i"],
            )
        )
        total = lambda p: F.aggregate(
            p,
            F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")),
            lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), x - acc["last"])).alias("n")),
        )["n"]
        return let(let(ranked, places), total)

    def windows(w: Column) -> Column:
        own = F.transform(w, lambda x: F.xxhash64(x))
        hashed = lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])
        )
        return let(own, hashed)

    repeats = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(covered(h))
    return F.when(n <= WINDOW, none).otherwise(let(windows(words), repeats))


def _fewer(text: Column, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measure(docs: DataFrame, keep: list[str], text_col: str = "text") -> DataFrame:
    """keep's columns of every row with the figures that the rules use, and whether the row fails by itself."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    held = docs.select(*keep, text.alias("__text"))
    figures = let(
        F.array_remove(F.split(F.col("__text"), WORD_SPLIT), ""),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).cast("long").alias("n_repeat_words")),
    )
    line_figures = let(
        F.filter(F.split(F.col("__text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")),
    )
    out = held.select(
        *keep,
        figures.alias("__w"),
        line_figures.alias("__l"),
        _fewer(F.col("__text"), SPACES).cast("long").alias("word_chars"),
        (F.length("__text") - _fewer(F.col("__text"), SYMBOLS)).cast("long").alias("n_symbols"),
    ).select(*keep, "__w.n_words", "word_chars", "n_symbols", "__l.n_lines", "__l.n_dup_lines", "__w.n_repeat_words")
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > round(100 * REPEATED) * F.col("n_words"))
    return out.withColumn("base_failed", failed)


def rule_failures() -> dict[str, Column]:
    """Failures that are summed by host."""
    return {
        "base": F.col("base_failed"),
        "symbols": 10 * F.col("n_symbols") > 3 * F.col("n_words"),
        "lines": 10 * F.col("n_dup_lines") > 5 * F.col("n_lines"),
    }


def host_rates(measured: DataFrame, host_col: str, rules: dict[str, Column]) -> DataFrame:
    """Per host: documents, and per rule the failures and the rate shrunk towards the corpus'."""
    hosts = materialize(
        measured.groupBy(host_col).agg(F.count("*").alias("n"), *[F.sum(c.cast("long")).alias(f"failed_{r}") for r, c in rules.items()]), "host-counts"
    )
    n = F.col("n").cast("double")
    totals = hosts.agg(
        F.count("*").alias("hosts"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"), *[F.sum(f"failed_{r}").alias(r) for r in rules], *[F.sum(F.col(f"failed_{r}") * F.col(f"failed_{r}") / n).alias(f"sq_{r}") for r in rules]
    ).first()  # one row of sums
    out = hosts
    for rule in rules:
        alpha, beta = beta_prior(totals["hosts"], totals["n"] or 0.0, totals["nn"] or 0.0, float(totals[rule] or 0), totals[f"sq_{rule}"] or 0.0)
        out = out.withColumn(f"rate_{rule}", (F.col(f"failed_{rule}") + alpha) / (n + (alpha + beta)))
    return out


def beta_prior(hosts: int, n: float, nn: float, failed: float, squares: float) -> tuple[float, float]:
    """Moment estimate of the beta distribution of the hosts' rates.

    n, nn: sums of the hosts' numbers of documents and of their squares; squares: sum of
    failed**2 / n.  With one host, or rates that differ no more than chance makes them, the
    prior is so narrow that every host gets the corpus' rate.
    """
    if not n:
        return 0.5, 0.5
    mean = failed / n
    spread = mean * (1 - mean)
    room = n - nn / n - (hosts - 1)
    within = 1e-6
    if spread > 0 and room > 0:
        within = min(max(((squares - n * mean * mean) / spread - (hosts - 1)) / room, 1e-6), 1 - 1e-6)
    weight = 1 / within - 1
    mean = min(max(mean, 1e-6), 1 - 1e-6)
    return mean * weight, (1 - mean) * weight


def judge(docs: DataFrame, keep: list[str], host_col: str = "source", text_col: str = "text", limits: dict[str, float] | None = None) -> DataFrame:
    """keep's columns with the figures, base_failed, host_failed and kept."""
    limits = limits or HOST_LIMITS
    rules = {r: c for r, c in rule_failures().items() if r in limits}
    inner = [f"__k{i}" for i in range(len(keep))]
    named = docs.select(*[F.col(c).alias(i) for c, i in zip(keep, inner)], F.col(host_col).cast("string").alias("__host"), F.col(text_col).alias("__body"))
    measured = materialize(measure(named, [*inner, "__host"], "__body"), "quality")
    rates = host_rates(measured, "__host", rules)
    bad = None
    for rule in rules:
        over = F.col(f"rate_{rule}") > limits[rule]
        bad = over if bad is None else bad | over
    # Only failing hosts are joined, each in SALTS parts, so that no host's rows meet in one task.
    failing = rates.where(bad).select(F.col("__host").alias("__bad"), F.lit(True).alias("__failed"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__part"))
    rows = measured.withColumn("__salt", F.pmod(F.xxhash64(*inner, "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    joined = rows.join(failing, (F.col("__salt") == F.col("__part")) & F.col("__host").eqNullSafe(F.col("__bad")), "left")
    host_failed = F.coalesce(F.col("__failed"), F.lit(False))
    return joined.select(
        *[F.col(i).alias(c) for c, i in zip(keep, inner)],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        host_failed.alias("host_failed"),
        (~F.col("base_failed") & ~host_failed).alias("kept"),
    )
