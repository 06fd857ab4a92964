"""Quality rules by distribution divergence.

Each document has a histogram of character classes and one of common words. Both are compared with the reference of its
language by the Jensen-Shannon distance (the root of the divergence in bits, 0 to 1). The references are sums over all
documents of the language, one small row each. Base rules on length and repetition come before the distances.

Defined cases. A null or empty text has no words: it fails the base rule on length. A text with fewer than
``min_words`` words or ``min_chars`` word characters is too short for a histogram and is judged by the base rules alone.
A null or unknown language is a language of its own, with its own reference. Repeated rows are judged alike, each in its
own row. An empty table gives an empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.mixing import written
from noticeworks.llm.words import WINDOW, add_fields, window_hashes, word_hashes

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
#: Classes of characters: lower case, upper case, other letters, digits, full stops and commas, other marks, symbols.
CLASSES = 7
#: Frequent function words of the languages that occur, in natural order by language.
COMMON_WORDS = [
    "the", "of", "and", "to", "in", "is", "was", "that", "it", "for", "on", "with", "as", "be", "at", "by", "this",
    "der", "die", "und", "das", "den", "von", "zu", "mit", "sich", "des", "auf", "für", "ist", "im", "nicht", "ein",
    "le", "la", "les", "et", "de", "du", "un", "une", "que", "qui", "est", "dans", "pour", "sur", "par", "pas",
    "el", "los", "las", "y", "en", "con", "por", "para", "se", "del", "una", "su", "al", "lo", "como",
]
MIN_WORDS = 40
MIN_CHARS = 160
MAX_CLASS_DISTANCE = 0.30
MAX_WORD_DISTANCE = 0.245
#: A histogram of n words is noisy; its limit is higher by this over the root of n.
WORD_NOISE = 1.1
#: References that are sent to every task (some hundred bytes each); beyond that they are joined by this many salts.
LANGUAGES = 10_000
SALTS = 64

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_counts", "common_counts"]
_TYPE = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " class_counts array<long>, common_counts array<long>"
)


def _class(char: str) -> int:
    if char.isalpha():
        return 0 if char.islower() else 1 if char.isupper() else 2
    if char.isdigit():
        return 3
    return 4 if char in ".," else 6 if char in SYMBOLS else 5


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a five-word window which is found at least twice, its first place included."""
    if len(words) <= WINDOW:
        return 0
    _, which, counts = np.unique(window_hashes(word_hashes(words)), return_inverse=True, return_counts=True)
    steps = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(counts[which] > 1)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + WINDOW, -1)
    return int((np.cumsum(steps) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def class_counts(text: str) -> list[int]:
    counts = [0] * CLASSES
    codes, times = np.unique(np.frombuffer(text.encode("utf-32-le"), np.uint32), return_counts=True)
    for code, n in zip(codes.tolist(), times.tolist()):
        if (char := chr(code)) not in SPACES:
            counts[_class(char)] += n
    return counts


def common_counts(words: list[bytes], places: dict[bytes, int]) -> list[int]:
    """How often each common word stands, marks at its ends left out; the last count is of all other words."""
    counts = [0] * (len(places) + 1)
    other = len(places)
    for word in words:
        counts[places.get(word.strip(b".,;:!?\"'()").lower(), other)] += 1
    return counts


def _measures_of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    places = {w.encode(): k for k, w in enumerate(COMMON_WORDS)}
    for texts in batches:
        rows = []
        for text in texts:
            text = text or ""
            words = text.encode().split()
            rows.append(
                (
                    len(words),
                    len(text) - sum(map(text.count, SPACES)),
                    sum(map(text.count, SYMBOLS)),
                    repeated_lines(text),
                    repeated_words(words),
                    class_counts(text),
                    common_counts(words, places),
                )
            )
        yield pd.DataFrame(rows, columns=MEASURES)


def measured(text: Column) -> Column:
    return F.pandas_udf(_measures_of, _TYPE)(text)


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts of one length; 0 if either has no counts."""

    def share(counts):
        total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
        return F.transform(counts, lambda x: x / total), total

    (p, n_p), (q, n_q) = share(p), share(q)

    def part(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    divergence = F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2
    return F.when((n_p > 0) & (n_q > 0), F.sqrt(F.greatest(divergence, F.lit(0.0)))).otherwise(F.lit(0.0))


def references(measures: DataFrame, lang: str) -> DataFrame:
    """One row for each language: the summed histograms of all its documents."""
    sums = [F.sum(F.col("class_counts")[k]).alias(f"_c{k}") for k in range(CLASSES)]
    sums += [F.sum(F.col("common_counts")[k]).alias(f"_w{k}") for k in range(len(COMMON_WORDS) + 1)]
    return (
        measures.groupBy(F.col(lang).alias("_rules_lang"))
        .agg(*sums)
        .select(
            "_rules_lang",
            F.array(*[f"_c{k}" for k in range(CLASSES)]).alias("_rules_class_reference"),
            F.array(*[f"_w{k}" for k in range(len(COMMON_WORDS) + 1)]).alias("_rules_word_reference"),
        )
    )


def with_references(measures: DataFrame, known: DataFrame, lang: str) -> DataFrame:
    """``measures`` with the references of their languages. Up to ``LANGUAGES`` of them, which are counted, go to every
    task, so no document moves; more are joined by language and a salt, so that a frequent language is spread."""
    same = F.col(lang).eqNullSafe(F.col("_rules_lang"))
    if known.count() <= LANGUAGES:
        return measures.join(F.broadcast(known), same, "left")
    salted = known.withColumn("_rules_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = measures.withColumn("_rules_own_salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    joined = dealt.join(salted, same & (F.col("_rules_own_salt") == F.col("_rules_salt")), "left")
    return joined.drop("_rules_salt", "_rules_own_salt")


def judge(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_words: int = MIN_WORDS,
    min_chars: int = MIN_CHARS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    word_noise: float = WORD_NOISE,
) -> DataFrame:
    """``docs`` without the text, with its measures, both distances, ``base_failed`` and ``kept``.

    The measures are taken once and written without the texts; no text is shuffled.
    """
    names = [*MEASURES, "class_distance", "word_distance", "base_failed", "judged", "kept"]
    rest = [c for c in docs.columns if c != text and (c == lang or c.lower() not in names)]
    measures = written(add_fields(docs, measured(F.col(text)), MEASURES).select(*rest, *MEASURES), "measures")
    joined = with_references(measures, written(references(measures, lang), "references"), lang)
    long_enough = (F.col("n_words") >= min_words) & (F.col("word_chars") >= min_chars)
    word_limit = max_word_distance + word_noise / F.sqrt(F.greatest("n_words", F.lit(1)))
    near = (F.col("class_distance") <= max_class_distance) & (F.col("word_distance") <= word_limit)
    return (
        joined.withColumn("class_distance", js_distance(F.col("class_counts"), F.col("_rules_class_reference")))
        .withColumn("word_distance", js_distance(F.col("common_counts"), F.col("_rules_word_reference")))
        .withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
        .withColumn("judged", long_enough)
        .withColumn("kept", ~F.col("base_failed") & (~long_enough | near))
        .drop("_rules_lang", "_rules_class_reference", "_rules_word_reference")
    )


def distance(p: list[float], q: list[float]) -> float:
    """The distance of two histograms, plainly; for tests and for tuning the limits."""
    if not sum(p) or not sum(q):
        return 0.0
    total = 0.0
    for a, b in zip((x / sum(p) for x in p), (x / sum(q) for x in q)):
        total += (a * math.log2(2 * a / (a + b)) if a else 0) + (b * math.log2(2 * b / (a + b)) if b else 0)
    return math.sqrt(max(0.0, total / 2))
