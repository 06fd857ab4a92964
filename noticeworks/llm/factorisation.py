"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

Features of a text: its words (A-Z lower-cased) hashed into ``WORD_SLOTS`` slots, with log counts scaled to length 1; and
statistics of its structure and its length, each binned into a slot of its own. Every pair of features interacts by the
product of two vectors of ``RANK`` numbers; a score takes linear time by the identity
sum over pairs of <v_i, v_j> x_i x_j = half the sum over f of (sum v_if x_i)^2 - sum (v_if x_i)^2.

The model is fitted by the driver on a bounded sample: of the labelled documents, those ``sample`` with the smallest hash
of their id. Their features, at most ``WORD_SLOTS`` + statistics numbers each, are what the driver gets. Scoring covers
every document in tasks, without a shuffle. Reruns agree.

Defined cases. Null and empty texts are scored by their statistics alone. Labels with a null id, a null label or two
different labels for a document are left out. Without usable labels every score is 0.5. Repeated rows are scored alike.
An empty table gives an empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.quality_rules import SYMBOLS, repeated_lines, repeated_words
from noticeworks.llm.words import add_fields

WORD_SLOTS = 4096
RANK = 8
SAMPLE = 4000
EPOCHS = 12
RATE = 0.1
DECAY = 1e-5
SEED = 17
THRESHOLD = 0.7

#: Bin limits of each statistic.
BINS = {
    "words": [1, 5, 10, 20, 50, 200, 1000],
    "characters": [1, 30, 60, 120, 300, 1200, 6000],
    "word_length": [2, 3, 4, 5, 6, 7, 9],
    "symbols": [0.0005, 0.002, 0.005, 0.01, 0.03, 0.06, 0.12],
    "marks": [0.005, 0.01, 0.02, 0.03, 0.05, 0.08, 0.15],
    "capitals": [0.005, 0.01, 0.02, 0.04, 0.1, 0.3, 0.6],
    "digits": [0.001, 0.005, 0.01, 0.02, 0.05, 0.1, 0.3],
    "distinct_words": [0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.95],
    "repeated_words": [0.005, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7],
    "repeated_lines": [0.01, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7],
}
_STEP = 8
SLOTS = WORD_SLOTS + _STEP * len(BINS)
_MARKS = ".,;:!?\"'()[]{}-_/\\"


def statistics(text: str, words: list[bytes], counts: Counter) -> list[float]:
    """The statistics in the order of ``BINS``."""
    letters = np.frombuffer(text.encode(), np.uint8)
    size, n = max(1, len(text)), max(1, len(words))
    lines = text.count("\n") + 1
    return [
        len(words),
        len(text),
        sum(map(len, words)) / n,
        sum(map(text.count, SYMBOLS)) / size,
        sum(map(text.count, _MARKS)) / size,
        int(((letters >= 65) & (letters <= 90)).sum()) / size,
        int(((letters >= 48) & (letters <= 57)).sum()) / size,
        len(counts) / n,
        repeated_words(words) / n,
        repeated_lines(text) / lines,
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values, each slot once, in rising order."""
    text = text or ""
    words = text.encode().split()
    counts = Counter(text.encode().lower().split())
    slots = np.fromiter((zlib.crc32(w) % WORD_SLOTS for w in counts), np.int64, len(counts))
    slots, place = np.unique(slots, return_inverse=True)
    values = np.log1p(np.bincount(place, weights=np.fromiter(counts.values(), np.float64, len(counts)), minlength=len(slots)))
    values /= max(1e-9, float(np.sqrt((values**2).sum())))
    given = statistics(text, words, counts)
    bins = [
        WORD_SLOTS + k * _STEP + int(np.searchsorted(limits, x, side="right"))
        for k, (limits, x) in enumerate(zip(BINS.values(), given))
    ]
    weight = 1 / np.sqrt(len(BINS))
    return np.concatenate([slots, bins]), np.concatenate([values, np.full(len(bins), weight)])


@dataclass
class Model:
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def margin(self, slots: np.ndarray, values: np.ndarray) -> float:
        terms = self.factors[slots] * values[:, None]
        sums = terms.sum(0)
        return float(self.bias + self.linear[slots] @ values + 0.5 * ((sums**2).sum() - (terms**2).sum()))

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(slots, values), -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS) -> Model:
    """Stochastic gradient steps on the log loss, each coordinate scaled by its own past gradients (AdaGrad)."""
    random = np.random.RandomState(SEED)
    model = Model(0.0, np.zeros(SLOTS), random.normal(0, 0.05, (SLOTS, RANK)))
    if not rows:
        model.factors[:] = 0
        return model
    seen_bias, seen_linear, seen_factors = 1e-2, np.full(SLOTS, 1e-2), np.full((SLOTS, RANK), 1e-2)
    for _ in range(epochs):
        for k in random.permutation(len(rows)):
            slots, values, label = rows[k]
            error = model.score(slots, values) - label
            vectors = model.factors[slots]
            sums = (vectors * values[:, None]).sum(0)
            by_factor = error * (values[:, None] * sums - vectors * (values**2)[:, None]) + DECAY * vectors
            by_linear = error * values + DECAY * model.linear[slots]
            seen_bias += error**2
            seen_linear[slots] += by_linear**2
            seen_factors[slots] += by_factor**2
            model.bias -= RATE * error / np.sqrt(seen_bias)
            model.linear[slots] -= RATE * by_linear / np.sqrt(seen_linear[slots])
            model.factors[slots] -= RATE * by_factor / np.sqrt(seen_factors[slots])
    return model


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def sample_of(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(slots, values, label) of the ``sample`` labelled documents, not held out, whose ids have the smallest hashes."""
    order = F.xxhash64(F.lit(SEED), "doc_id")
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("label"), F.max("quality").alias("_other"))
        .where("label = _other")
        .select("doc_id", "label")
    )
    near = chosen.orderBy(order, "doc_id").limit(2 * sample)  # some labelled ids may have no document
    texts = docs.select("doc_id", "text").join(F.broadcast(near), "doc_id")
    found = texts.withColumn("f", F.pandas_udf(_features_of, "slots array<int>, values array<float>")(F.col("text")))
    return found.select("doc_id", "label", "f.slots", "f.values").orderBy(order, "doc_id").limit(sample)


def _features_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = [features(x) for x in texts]
        yield pd.DataFrame(
            {
                "slots": pd.Series([s.astype(np.int32) for s, _ in rows], dtype=object),
                "values": pd.Series([v.astype(np.float32) for _, v in rows], dtype=object),
            }
        )


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = EPOCHS) -> Model:
    rows = sample_of(docs, labels, sample).select("slots", "values", "label").toPandas()
    return fit(
        [(np.asarray(s, np.int64), np.asarray(v, np.float64), int(y)) for s, v, y in zip(*(rows[c] for c in rows))],
        epochs,
    )


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scores_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = sent.value
        for texts in batches:
            yield pd.Series([known.score(*features(x)) for x in texts], dtype=float)

    scores = F.struct(F.pandas_udf(scores_of, "double")(F.col(text)).alias("score"))
    return add_fields(docs, scores, ["score"]).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
