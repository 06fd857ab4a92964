"""Words, five-word windows and their 64-bit hashes, shared by the operators that read whole texts.

A word is a run of bytes other than space and 0x09-0x0D, which is what ``bytes.split`` yields. Hashes of windows are
sums of word hashes with odd factors, mixed; two different windows collide with a chance of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 5
_FACTORS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, on arrays of unsigned 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def window_hashes(hashes: np.ndarray) -> np.ndarray:
    """One hash for each window of ``WINDOW`` words; a shorter, not empty sequence is one window."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(n, WINDOW)
    total = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        total += hashes[k : n - width + 1 + k] * _FACTORS[k]
    return mix(total)


def shingles(text: str | None) -> np.ndarray:
    """The sorted distinct window hashes of a text whose A-Z are lower-cased; empty without words."""
    return np.unique(window_hashes(word_hashes((text or "").encode().lower().split())))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, few at a time, so that what is made of a long batch of texts never lies in memory whole."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def add_fields(df: DataFrame, fields: Column, names: list[str]) -> DataFrame:
    """``df`` with the fields of a struct as columns; a column of ``df`` with such a name is replaced.

    Columns that operators add for their own use and drop again begin with ``_dedup_``, ``_group_``, ``_mix_``,
    ``_rules_`` or ``_fields_``; such names are not for input columns.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in {n.lower() for n in names}]
    packed = df.select(*kept, fields.alias("_fields_of_row"))
    return packed.select(*kept, *[F.col(f"_fields_of_row.{n}").alias(n) for n in names])
