"""Reproducible draws: functions of a seed and of what a row is, the same in any engine with md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, *of: str | Column) -> Column:
    """A number in (0, 1) for the values of a row."""
    name = F.concat_ws(":", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in of])
    return (F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("long") + 0.5) / float(1 << 32)


def choice(seed: int, values: list, *of: str | Column) -> Column:
    """One of the values, each as likely."""
    at = F.floor(uniform(seed, *of) * len(values)).cast("int")
    return F.get(F.array(*[F.lit(v) for v in values]), at)


def between(seed: int, low: float, high: float, *of: str | Column) -> Column:
    return F.lit(low) + uniform(seed, *of) * (high - low)
