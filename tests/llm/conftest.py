from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, line int, id string, n_lines long"
LINE = "one two three four five six seven eight nine ten"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))

ROWS = [
    (1, f"{LINE}\nshort line\n{LINE}"),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, f"{LINE.replace('five', 'FIVE')}\nelse is new here and long enough to count as one line"),
    (6, LINE.replace("seven", "7")),
    (6, LINE.replace("seven", "7")),
    (7, LINE + " eleven"),
    (8, LONG),
    (9, LONG + " tail"),
    (None, "a row without an id but with words in it and a few more"),
    (10, "Ünïcödé ñandú naïve <|endoftext|> नमस्ते 日本語 " + LINE),
    (11, "solo"),
    (12, "Solo"),
]


@pytest.fixture(scope="session")
def nasty(spark):
    """Nulls, empty and very long texts, ties, repeated rows, and columns with clashing names."""
    rows = [(i, t, "en" if i != 7 else None, f"s{(i or 0) % 3}" if i != 5 else None, None if t is None else len(t), 0.9, 7, "x", 3) for i, t in ROWS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (5, None, 1), (6, 1, None), (None, 0, 1), (7, 0, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
