"""Tables of odd rows: nulls, empty and very long texts, repeated rows, columns named like results."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = [x.split()[0] for x in SCHEMA.split(", ")]


def prose(words: int, seed: int) -> str:
    rnd = random.Random(seed)
    stems = ["the", "of", "and", "tion", "ther", "ing", "and", "rest", "blean", "ore"]
    out = []
    for k in range(words):
        out.append(rnd.choice(stems) + (rnd.choice(stems) if rnd.random() < 0.6 else ""))
        if k % 12 == 11:
            out[-1] += ".\n"
    return " ".join(out)


LONG = prose(30_000, 1)
ROWS = [
    (1, prose(120, 2), "en", "a", 5),
    (2, prose(120, 2), "en", "b", 5),
    (3, None, "en", "a", None),
    (4, "", None, None, 0),
    (5, LONG, "en", "a", 5),
    (6, "one two three", "de", "b", 13),
    (7, "one two three", "de", "b", 13),
    (7, "one two three", "de", "b", 13),
    (None, prose(60, 3), None, "c", 1),
    (None, None, None, None, None),
    (8, " \t\n ", "fr", "c", 4),
    (9, "é" * 50 + " 日本 \U0001f600", "fr", "c", 4),
]


def frame(spark, rows=ROWS, extra: dict[str, str] | None = None):
    """The rows as a table; ``extra`` adds columns with these names and values."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA)
    return df.withColumns({k: F.lit(v) for k, v in (extra or {}).items()})
