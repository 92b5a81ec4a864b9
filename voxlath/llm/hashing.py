"""Vectorised word hashing shared by the operators that work on word n-grams.

A word is a maximal run of bytes other than space and \\t..\\r, after lower-casing A-Z
only.  Every word gets a 64-bit polynomial hash over random byte codes, computed for a
whole Arrow buffer at once; n-gram hashes chain word hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX_A = np.uint64(0xBF58476D1CE4E5B9)
_MIX_B = np.uint64(0x94D049BB133111EB)
_STEP = 0xD6E8FEB86659FD93  # odd, hence invertible modulo 2**64
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
#: Bytes hashed at once; a longer single word makes a longer piece.
PIECE = 1 << 19

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64, elementwise on uint64."""
    x = x + _GOLDEN
    x = (x ^ (x >> np.uint64(30))) * _MIX_A
    x = (x ^ (x >> np.uint64(27))) * _MIX_B
    return x ^ (x >> np.uint64(31))


_CODE = mix(np.arange(1, 257, dtype=np.uint64))[LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_POWER = _powers(_STEP, PIECE + 1)
_UNPOWER = _powers(_STEP_INVERSE, PIECE + 1)


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if column.buffers()[2] is None or not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, counts): byte spans of all words, and the number of words of each text."""
    if not len(data):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, np.zeros(len(offsets) - 1, dtype=np.int64)
    word = ~separator[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    end = word.copy()
    end[:-1] &= ~word[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    start[inner] = word[inner]
    end[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.diff(np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the lower-cased words."""
    return part_hashes(data, starts, ends, [(starts, ends)])[0]


def part_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """64-bit hashes of parts of the words, given as (starts, ends) within the words' own."""
    out = [np.empty(len(starts), dtype=np.uint64) for _ in parts]
    i = 0
    while i < len(starts):
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        n = int(ends[j - 1] - base)
        power, unpower = (_POWER, _UNPOWER) if n <= PIECE else (_powers(_STEP, n + 1), _powers(_STEP_INVERSE, n + 1))
        total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_CODE[data[base : base + n]] * power[:n], out=total[1:])
        for o, (first, last) in zip(out, parts):
            s, e = first[i:j] - base, last[i:j] - base
            o[i:j] = mix((total[e] - total[s]) * unpower[s] + (e - s).astype(np.uint64) * _GOLDEN)
        i = j
    return out


def chain(prefix: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of an n-gram from the hash of all but its last word and that of its last word."""
    return mix(prefix * np.uint64(3) + (last ^ _GOLDEN))


def text_slices(offsets: np.ndarray, limit: int = 1 << 22):
    """Ranges of texts that hold about `limit` bytes; one longer text makes a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
