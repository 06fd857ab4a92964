"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often they stand. For each of ``SAMPLES`` draws every term has two
gamma variables and a uniform one, made from the term and the draw alone; the term whose sample is least, and its
quantised weight, are the draw's value. Two documents agree in a draw with a probability equal to the generalised Jaccard
similarity of their weights, sum of minima over sum of maxima. Terms are told apart by ``SLOTS`` hash slots, whose
variables are one table per worker.

``near_next`` compares each document with the next by id. Ids are cut in ranges at quantiles; every range is sorted in one
pass, and the head of the next range is sent along with it, so each text is shuffled once and no range waits for another.

Defined cases. Null and empty texts, and texts without words, have the fingerprint of no terms; two such are alike (1),
one such and another are not (0). Equal texts have equal fingerprints. A null id comes after all others; rows of equal id
are ordered by their text. The document after the last is the first; a lone document is its own next. An empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.words import mix

SAMPLES = 64
SLOTS = 1 << 16
SEED = 41
#: Ranges of ids for each partition of a shuffle, so that uneven ranges even out.
RANGES = 4
_SMALLEST = -(2**63)


class Sampler:
    """The table of the variables of all slots: r and c from Gamma(2, 1), beta from 0 to 1."""

    def __init__(self, samples: int = SAMPLES, slots: int = SLOTS):
        def uniform(stream: int) -> np.ndarray:
            cells = np.arange(slots * samples, dtype=np.uint64) + np.uint64((SEED * 16 + stream) << 40)
            return ((mix(mix(cells)) >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53

        shape = (slots, samples)
        self.r = (-np.log(uniform(0) * uniform(1))).astype(np.float32).reshape(shape)
        self.log_c = np.log(-np.log(uniform(2) * uniform(3))).astype(np.float32).reshape(shape)
        self.beta = uniform(4).astype(np.float32).reshape(shape)
        self.empty = np.full(samples, 0xFFFFFFFF, np.uint32)

    def terms(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Slots and weights of a text; each slot once."""
        counts = Counter((text or "").encode().split())
        slots = np.fromiter((zlib.crc32(w) % len(self.r) for w in counts), np.int64, len(counts))
        slots, place = np.unique(slots, return_inverse=True)
        return slots, np.bincount(place, weights=np.fromiter(counts.values(), np.float64, len(counts)), minlength=len(slots))

    def sample(self, slots: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 32-bit value for each draw: a hash of the slot drawn and its quantised weight."""
        if not len(slots):
            return self.empty
        r, beta = self.r[slots], self.beta[slots]
        steps = np.floor(np.log(weights).astype(np.float32)[:, None] / r + beta)
        log_a = self.log_c[slots] - r * (steps - beta + np.float32(1))
        won = log_a.argmin(0)
        drawn = steps[won, np.arange(steps.shape[1])].astype(np.int64).astype(np.uint64)
        return (mix(slots[won].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + drawn) >> np.uint64(33)).astype(np.uint32)

    def fingerprint(self, text: str | None) -> np.ndarray:
        return self.sample(*self.terms(text))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The text whose last half (rounded down) is replaced by as much of the start of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``, the values of all draws as hex digits."""

    def rows_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        sampler = Sampler()
        for texts in batches:
            yield pd.Series([sampler.fingerprint(x).tobytes().hex() for x in texts], dtype=object)

    return docs.withColumn("fingerprint", F.pandas_udf(rows_of, "string")(F.col(text)))


def _range_of(ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The range of each id, 0 for the largest ids."""
    return len(cuts) - np.searchsorted(cuts, ids, side="right")


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by range, then descending id: each row that is not a copy of the next range's head, with the next."""
    sampler = Sampler()
    held = None  # (doc_id, text, fingerprint) of the row before
    for batch in batches:
        rows = []
        for part, doc_id, copy, text in zip(*(batch[c].to_pylist() for c in ("_range", "doc_id", "_copy", "_t"))):
            text = text or ""
            own = sampler.fingerprint(text)
            if held is not None and held[0] == part:
                _, before_id, before, mark = held
                new = edited(before, text)
                changed = sampler.fingerprint(new)
                rows.append(
                    (
                        before_id,
                        len(before),
                        hashlib.sha256(new.encode()).hexdigest(),
                        mark.tobytes().hex(),
                        changed.tobytes().hex(),
                        likeness(mark, changed),
                        likeness(mark, own),
                    )
                )
            held = None if copy else (part, doc_id, text, own)
        columns = list(zip(*rows)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [x.split()[0] for x in _RESULT.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def compared_with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of each document."""
    spark = docs.sparkSession
    count = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_SMALLEST)).alias("_id"),
        F.col(text).alias("_t"),
    )
    shares = [k / count for k in range(1, count)]
    cuts = np.unique(np.array(keyed.agg(F.percentile_approx("_id", shares, 10_000)).first()[0] or [], np.int64))

    def part_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            yield pd.Series(_range_of(ids.to_numpy(), cuts))

    # The head of each range: as many rows as there are ranges come to the driver.
    parts = keyed.groupBy(F.pandas_udf(part_of, "long")("_id").alias("part"))
    heads = parts.agg(F.max("_id").alias("head")).orderBy("part").collect()
    # Each head is also sent to the range before its own, the first one to the last.
    known = np.array(sorted((h["head"], heads[k - 1]["part"]) for k, h in enumerate(heads)), np.int64).reshape(-1, 2)

    def places_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for ids in batches:
            ids = ids.to_numpy()
            found = np.minimum(np.searchsorted(known[:, 0], ids), len(known) - 1)
            copied = known[found, 0] == ids
            yield pd.Series(
                [
                    [{"_range": p, "_copy": False}, {"_range": q, "_copy": True}] if c else [{"_range": p, "_copy": False}]
                    for p, c, q in zip(_range_of(ids, cuts).tolist(), copied.tolist(), known[found, 1].tolist())
                ],
                dtype=object,
            )

    places = F.pandas_udf(places_of, "array<struct<_range:long,_copy:boolean>>")("_id")
    placed = keyed.select("doc_id", "_id", "_t", F.inline(places))
    # Copies come last in the range they are sent to. Of rows with the head's id only the first counts as the head.
    order = [F.col("_range"), F.col("_copy"), F.col("_id").desc(), F.col("_t")]
    return placed.repartition("_range").sortWithinPartitions(*order).mapInArrow(_compare, _RESULT)
