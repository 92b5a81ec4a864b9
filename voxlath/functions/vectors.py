"""Vector arithmetic on array columns, in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPS = 1e-9


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """The vector divided by its length plus a small number, which keeps a zero vector zero."""
    n = norm(a) + EPS
    return F.transform(a, lambda x: x.cast("double") / n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / ((norm(a) + EPS) * (norm(b) + EPS))


def quantise_rows(a: Column) -> Column:
    """struct<scale, q>: row-wise 8-bit codes, round half to even, scale at least 1e-30."""
    top = F.aggregate(a, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x.cast("double"))))
    scale = F.greatest(top / 127, F.lit(1e-30))
    one = F.transform(F.array(scale), lambda s: F.struct(s.alias("scale"), F.transform(a, lambda x: F.least(F.lit(127.0), F.greatest(F.lit(-127.0), F.rint(x.cast("double") / s))).cast("int")).alias("q")))
    return F.element_at(one, 1)


def dequantise_rows(scale: Column, q: Column) -> Column:
    return F.transform(q, lambda x: x * scale)


def relative_error(a: Column, b: Column) -> Column:
    """Length of the difference over the length of b."""
    return F.sqrt(dot(F.zip_with(a, b, lambda x, y: x - y), F.zip_with(a, b, lambda x, y: x - y)) / dot(b, b))


def hadamard(a: Column, size: int) -> Column:
    """Groups of `size` (a power of two) values rotated by the normalised Hadamard matrix."""
    sign = lambda i, j: F.when(F.bit_count(i.bitwiseAND(j)) % 2 == 0, 1.0).otherwise(-1.0)

    def cell(i: Column) -> Column:
        base, row = F.floor(i / size).cast("int") * size, (i % size).cast("int")
        part = F.slice(a, base + 1, size)
        return F.aggregate(F.transform(part, lambda x, j: x.cast("double") * sign(row, j)), F.lit(0.0), lambda s, x: s + x) / float(size) ** 0.5

    return F.transform(F.sequence(F.lit(0), F.size(a) - 1), cell)


def unpack_nibbles(packed: Column, codebook: Column, scale: Column) -> Column:
    """Values of 4-bit codes, the low one of a byte first, looked up and scaled."""
    pair = F.flatten(F.transform(packed, lambda b: F.array(b.bitwiseAND(F.lit(15)), F.shiftright(b, 4).bitwiseAND(F.lit(15)))))
    return F.transform(pair, lambda c: F.element_at(codebook, c.cast("int") + 1) * scale)


def unpack_weights(packed: Column, codebook: Column, relative: Column, channel: Column, group: int) -> Column:
    """Weights of packed 4-bit codes: looked up, scaled by their group to 8-bit steps (half to even, at most 127), and by the channel."""
    codes = unpack_nibbles(packed, codebook, F.lit(1.0))
    return F.transform(codes, lambda v, i: F.greatest(F.lit(-127.0), F.least(F.lit(127.0), F.rint(v * F.element_at(relative, F.floor(i / group).cast("int") + 1)))) * channel)


def nearest_code(vector: Column, codes: Column) -> Column:
    """Place of the code with the least |c|^2 - 2 v.c, the first of equals."""
    cost = F.transform(codes, lambda c, i: F.struct((dot(c, c) - 2 * dot(vector, c)).alias("d"), i.alias("i")))
    return F.array_min(cost)["i"]
