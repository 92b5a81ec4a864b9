"""Quantisation with learned or given codes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import nearest_code


def lloyd_max(values: np.ndarray, codes: int = 16, rounds: int = 25) -> np.ndarray:
    """Codes with the least squared error on a line: from quantiles, means of what is nearest, in turns."""
    book = np.quantile(values, (np.arange(codes) + 0.5) / codes)
    for _ in range(rounds):
        nearest = np.searchsorted((book[1:] + book[:-1]) / 2, values)
        total, n = np.bincount(nearest, values, minlength=codes), np.bincount(nearest, minlength=codes)
        book = np.sort(np.where(n > 0, total / np.maximum(n, 1), book))
    return book


def fit_codebooks(rows: DataFrame, by: str, value: str, codes: int = 16, bins: int = 4096) -> DataFrame:
    """(by, codebook): fitted on a histogram of each group's values, which is bounded whatever the group's size.

    A bin stands for its values by their mean and number, so a value moves by less than
    (largest - least) / bins; with no two different values in a bin the fit is exact.
    """
    span = rows.groupBy(by).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.least(F.lit(bins - 1), F.floor((F.col(value) - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-30)) * bins))
    hist = rows.join(span, by).groupBy(by, at.alias("b")).agg(F.count("*").alias("n"), F.avg(value).alias("v"))
    kind = rows.schema[by].dataType.simpleString()

    def own(pdf: pd.DataFrame) -> pd.DataFrame:
        v, n = pdf["v"].to_numpy(), pdf["n"].to_numpy()
        order = np.argsort(v)
        v, n = v[order], n[order]
        place = np.searchsorted(np.cumsum(n), (np.arange(codes) + 0.5) / codes * n.sum())
        book = v[np.minimum(place, len(v) - 1)]
        for _ in range(25):
            nearest = np.searchsorted((book[1:] + book[:-1]) / 2, v)
            total, weight = np.bincount(nearest, v * n, minlength=codes), np.bincount(nearest, n, minlength=codes)
            book = np.sort(np.where(weight > 0, total / np.maximum(weight, 1), book))
        return pd.DataFrame({by: [pdf[by].iloc[0]], "codebook": [book.tolist()]})

    return hist.groupBy(by).applyInPandas(own, f"{by} {kind}, codebook array<double>")


def encode_values(rows: DataFrame, books: DataFrame, by: str, value: str) -> DataFrame:
    """Adds code: the nearest of the group's codes, the first of equals."""
    near = F.array_min(F.transform("codebook", lambda c, i: F.struct(F.abs(c - F.col(value)).alias("d"), i.alias("i"))))["i"]
    return rows.join(books, by).withColumn("code", near).drop("codebook")


def residual_codes(vectors: DataFrame, vector: str, books: list[list[list[float]]]) -> DataFrame:
    """Adds codes: per stage the nearest code of what the stages before left."""
    out = vectors.withColumn("__rest", F.col(vector).cast("array<double>"))
    names: list[Column] = []
    for stage, book in enumerate(books):
        codes = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in book])
        out = out.withColumn(f"__c{stage}", nearest_code(F.col("__rest"), codes))
        out = out.withColumn("__rest", F.zip_with("__rest", F.element_at(codes, F.col(f"__c{stage}") + 1), lambda a, b: a - b))
        names.append(F.col(f"__c{stage}"))
    return out.withColumn("codes", F.array(*names)).drop("__rest", *[f"__c{s}" for s in range(len(books))])


def fitted_scale(values: Column, book: Column, rounds: int = 2, least: float = 1e-8) -> Column:
    """struct<scale, codes> of a group of values: codes of the values over the scale, and the scale that fits the codes best, in turns.

    The scale begins as the largest magnitude; a value's code is the nearest, the lower of equals.
    """
    nearest = lambda scale: F.transform(values, lambda v: F.array_min(F.transform(book, lambda c, i: F.struct(F.abs(c - v / scale).alias("d"), i.alias("i"))))["i"])

    def state(scale: Column) -> Column:
        return F.element_at(F.transform(F.array(F.greatest(scale, F.lit(least))), lambda s: F.struct(s.alias("scale"), nearest(s).alias("codes"))), 1)

    def step(old: Column, _: Column) -> Column:
        level = F.transform(old["codes"], lambda i: F.get(book, i))
        total = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
        return state(total(values, level) / F.greatest(total(level, level), F.lit(least)))

    top = F.aggregate(values, F.lit(0.0), lambda t, x: F.greatest(t, F.abs(x)))
    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), state(top), step)
