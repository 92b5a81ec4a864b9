"""Boundaries of what needs codecs or model weights: a provider turns batches of files into table rows.

A provider is a function over pandas frames with a declared schema; the library brings none of
the models.  Errors become rows of the failure log instead of ending the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FRAMES = "rec string, t int, k int, p float"
ENERGY = "rec string, t int, db float"
LOCAL = "rec string, w int, t int, l int, p float"
EMBEDDINGS = "id string, embedding array<float>, f0 double"
VOICES = "id string, p_female double"
SCORES = "model string, item string, asr string, sim double, utmos double"


def run(files: DataFrame, provider: Callable[[pd.DataFrame], pd.DataFrame], schema: str, key: str = "rec") -> DataFrame:
    """Provider rows, and one row with error for each input row that the provider raised on.

    The provider gets whole batches; only a batch that raised is given to it again row by row.
    """
    names = [c.split()[0] for c in schema.split(", ")]
    full = schema + (f", {key} string" if key not in names else "") + ", error string"

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in full.split(", ")]
        for batch in batches:
            try:
                yield provider(batch).assign(error=None)[columns]
                continue
            except Exception:  # some row of the batch
                pass
            for i in range(len(batch)):
                row = batch.iloc[i : i + 1]
                try:
                    out = provider(row).assign(error=None)
                except Exception as e:
                    out = pd.DataFrame({n: [None] for n in names}).assign(**{key: str(row[key].iloc[0]), "error": f"{type(e).__name__}: {e}"})
                yield out[columns]

    return files.mapInPandas(each, full)


def good(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("error").isNull()).drop("error")
