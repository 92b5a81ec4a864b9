"""A bit set over 64-bit hashes, to keep a second scan from passing on what no join needs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of the number of bits, by the number of members: 16 bits for each, between 8 KB and 32 MB.
#: With more than 2**MOST / 16 members it lets more rows pass, which only the join after it pays.
LEAST, MOST = 16, 28


def _size(members: int) -> int:
    return min(max(LEAST, (16 * max(members, 1) - 1).bit_length()), MOST)


def bit_set(rows: DataFrame, column: str) -> np.ndarray:
    """Bits of the column's values; rows is a written table, as it is read twice.  At most 2**(MOST - 6) rows come to the driver."""
    bits = _size(rows.count())
    spread = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = rows.select(F.shiftright(spread, 6).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(shiftrightunsigned(`{column}`, {64 - bits}), 64) as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    found = words.toArrow()
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    out[found.column("w").to_numpy()] = found.column("b").to_numpy().view(np.uint64)
    return out


def members(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the uint64 hashes may be in the set; those that are always pass."""
    at = values >> np.uint64(64 - (len(bits).bit_length() + 5))
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0
