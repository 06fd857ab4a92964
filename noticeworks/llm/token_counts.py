"""Token counts by rank-synchronous array merging.

A text is cut at the special tokens and into pre-tokens by the vocabulary's pattern. The pre-tokens of a batch that no
count is known of lie in one ragged array of symbols, sequence behind sequence. Each round looks at the lowest merge rank
of every sequence and merges that pair in all sequences at once, wherever it stands in them; of overlapping places
(``a a a``) the first, third and so on are merged. Sequences without a rank leave the array, and what is left of their
symbols is counted. Ranks are looked up anew only beside merged symbols.

All places of a pair may be merged in one round because a symbol that a merge makes is never part of a merge of lower
rank; ``Ranks`` checks that for the vocabulary and merges the first place alone where it does not hold. The counts of words
come back again and again, so each worker process keeps them, in two generations of bounded size, by the digest of the
vocabulary; that changes the time, never a count. Texts are only counted: no ids are made.

Defined cases. A null or empty text has 0 bytes and 0 tokens. Repeated rows are counted alike. An empty table gives an
empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm import bpe
from noticeworks.llm.words import add_fields

LIMIT = 1024
CACHED_TOKENS = 400_000
PORTION = 1 << 20
_NONE = np.iinfo(np.int64).max


class Ranks:
    """Symbols of bytes and merge ranks of a byte-level vocabulary, as sorted arrays."""

    def __init__(self, text: str):
        given = json.loads(text)
        ids = given["model"]["vocab"]
        self.first = np.array([ids[c] for c in bpe.byte_characters()], np.int64)
        self.special = [x["content"] for x in given.get("added_tokens", [])]
        self.size = max(ids.values()) + 1
        pairs = [x.split(" ") if isinstance(x, str) else x for x in given["model"]["merges"]]
        rank_of: dict[int, int] = {}
        last: dict[str, int] = {}
        for rank, (left, right) in enumerate(pairs):
            rank_of.setdefault(ids[left] * self.size + ids[right], rank)
            last[left + right] = rank
        # Whether every merge comes behind all merges that make one of its parts.
        self.ordered = all(last.get(part, -1) < rank for rank, pair in enumerate(pairs) for part in pair)
        merged = [ids[left + right] for left, right in pairs]
        self.merged = np.array(merged, np.int64)
        self.pairs = np.array(sorted(rank_of), np.int64)
        self.ranks = np.array([rank_of[x] for x in self.pairs.tolist()], np.int64)
        self.of_bytes = self.of(np.repeat(self.first, 256), np.tile(self.first, 256)).reshape(256, 256)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols; ``_NONE`` where they do not merge."""
        if not len(self.pairs):
            return np.full(len(left), _NONE)
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.ranks[at], _NONE)


def alternate(hit: np.ndarray) -> np.ndarray:
    """Of each run of neighbouring places the first, third, fifth and so on."""
    places = np.flatnonzero(hit)
    if not len(places):
        return places
    opens = np.r_[True, places[1:] != places[:-1] + 1]
    start = places[opens][np.cumsum(opens) - 1]
    return places[(places - start) % 2 == 0]


def surviving(ranks: Ranks, tokens: list[bytes]) -> np.ndarray:
    """How many symbols are left of each pre-token."""
    counts = np.fromiter(map(len, tokens), np.int64, len(tokens))
    data = np.frombuffer(b"".join(tokens), np.uint8)
    symbols = ranks.first[data]
    owner = np.repeat(np.arange(len(tokens)), counts)
    # rank[k] is that of the pair k, k + 1; none across the end of a sequence.
    rank = np.r_[ranks.of_bytes[data[:-1], data[1:]], _NONE] if len(data) else np.empty(0, np.int64)
    rank[np.cumsum(counts)[counts > 0] - 1] = _NONE
    while len(symbols):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.r_[starts, len(symbols)])
        live = np.repeat(lowest < _NONE, sizes)
        if not live.all():
            symbols, owner, rank = symbols[live], owner[live], rank[live]
            sizes, lowest = sizes[lowest < _NONE], lowest[lowest < _NONE]
            if not len(symbols):
                break
        hit = rank == np.repeat(lowest, sizes)
        if ranks.ordered:
            at = alternate(hit)
        else:
            at = np.flatnonzero(hit)
            at = at[np.r_[True, owner[at[1:]] != owner[at[:-1]]]]
        symbols[at] = ranks.merged[rank[at]]
        counts -= np.bincount(owner[at], minlength=len(counts))
        left = np.ones(len(symbols), bool)
        left[at + 1] = False
        place = np.cumsum(left) - 1
        at = place[at]
        symbols, owner, rank = symbols[left], owner[left], rank[left]
        # The pairs that have changed: each merged symbol with the next, and the one before it with it.
        again = np.r_[at, at[at > 0] - 1]
        rank[again] = _NONE
        again = again[again < len(symbols) - 1]
        again = again[owner[again] == owner[again + 1]]
        rank[again] = ranks.of(symbols[again], symbols[again + 1])
    return counts


class Counter:
    """Counts the tokens of texts with one vocabulary."""

    def __init__(self, text: str):
        self.ranks = Ranks(text)
        self.cutter = bpe.Cutter()
        self.special = sorted(self.ranks.special, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.known: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def pre_tokens(self, text: str | None) -> tuple[list[str], int]:
        """The pre-tokens of a text and the number of its special tokens."""
        parts = self.cut.split(text) if text and any(x in text for x in self.special) else [text or ""]
        tokens: list[str] = []
        for part in parts:
            tokens += self.cutter.cut(part)
        return tokens, len(parts) - 1

    def learn(self, tokens: set[str]) -> None:
        """Sees to it that these pre-tokens are known, among others; what is new is merged all at once."""
        if len(self.known) + len(tokens) > CACHED_TOKENS:
            self.older, self.known = self.known, {}
        missing = tokens.difference(self.known)
        again = missing.intersection(self.older)
        self.known.update((x, self.older[x]) for x in again)
        new = list(missing - again)
        self.known.update(zip(new, surviving(self.ranks, [x.encode() for x in new]).tolist()))

    def counts(self, texts: list[str | None]) -> list[int]:
        cut = [self.pre_tokens(text) for text in texts]
        self.learn(set().union(*[tokens for tokens, _ in cut]))
        known = self.known.__getitem__
        return [sum(map(known, tokens)) + special for tokens, special in cut]


_COUNTERS: dict[str, Counter] = {}


def counter(text: str) -> Counter:
    """The counter of a vocabulary in this process; one is kept."""
    digest = hashlib.sha256(text.encode()).hexdigest()
    if digest not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[digest] = Counter(text)
    return _COUNTERS[digest]


def portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in turn, in lists of about ``PORTION`` characters, so that what is made of them stays bounded."""
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= PORTION:
            yield held
            held, size = [], 0
    if held:
        yield held


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit``: whether there are more than ``limit`` tokens."""
    vocabulary = bpe.load(docs.sparkSession, path)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(vocabulary.value)
        for rows in batches:
            yield pd.Series([n for part in portions(rows.tolist()) for n in own.counts(part)], dtype="int64")

    names = ["n_bytes", "n_tokens", "over_limit"]
    fields = F.struct(
        F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes"),
        F.col("_fields_tokens").alias("n_tokens"),
        (F.col("_fields_tokens") > limit).alias("over_limit"),
    )
    return add_fields(docs.withColumn("_fields_tokens", counted(F.col(text))), fields, names).drop("_fields_tokens")
