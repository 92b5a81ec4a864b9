"""Every query of the engine against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

import math
import os

import pandas as pd
import pytest

import __spark_entry__
from voxlath.plans import registry

duckdb = pytest.importorskip("duckdb")


def plain(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    if isinstance(v, float):
        return int(v) if v.is_integer() else v
    return v if isinstance(v, int) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def con(smallest):
    c = duckdb.connect()
    for name in os.listdir(smallest):
        c.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{smallest}/{name}'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_same_rows(spark, con, smallest, name):
    got, want = __spark_entry__.queries()[name](spark, smallest).toPandas(), con.sql(registry.ORACLES[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    # Sums come in another order, so figures of one row may differ in their last digits.
    coarse = lambda row: [f"{v:.4g}" if isinstance(v, float) else str(v) for v in row]
    rows = lambda df: sorted([tuple(map(plain, r)) for r in df[columns].itertuples(index=False)], key=coarse)
    got, want = rows(got), rows(want)
    assert len(got) == len(want)
    close = lambda a, b: math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-6) if isinstance(a, (int, float)) and isinstance(b, (int, float)) else a == b
    assert [x for x in zip(got, want) if not all(map(close, *x))] == []


def test_entry_points(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
