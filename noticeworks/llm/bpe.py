"""Byte-level BPE encoding and decoding.

A text is cut at the special tokens, then into pre-tokens by the vocabulary's pattern. Each pre-token is a doubly linked
list of symbols; a priority queue holds the ranks of its neighbouring pairs. The lowest rank, leftmost first, is merged
and its new neighbours queued; entries whose symbols have changed meanwhile are stale and skipped. Decoding concatenates
the strings of the vocabulary, mapped back to bytes.

The vocabulary file is a parameter. Its size is that of the vocabulary, never of the data, and is checked before it is
broadcast. Words come back again and again, so each worker process keeps the ids of words that it has met, from task to task, in two generations of
bounded size; that changes the time, never the ids.

Defined cases. A null or empty text has no ids and decodes to the empty text. Bytes that are no valid UTF-8 after
decoding (possible only for ids that come from elsewhere) become U+FFFD. Repeated rows are encoded alike. An empty table
gives an empty result. Columns of the input named like a result are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from noticeworks.llm.words import add_fields, slices

#: White_Space of Unicode, and the ranges that the installed ``regex`` counts as letters or numbers by a
#: later Unicode version than the vocabulary's own library, for which they are unassigned.
WHITE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATER = (
    r"\u0558\u058b-\u058c\u088f\u0c5c\u0cdc\u208f\u209d-\u209f\ua7ce-\ua7cf\ua7d2\ua7d4\ua7dd\ua7e2\ua7f1\uab6c-\uab6d"
    r"\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    r"\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    r"\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    r"\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    r"\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    r"\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    r"\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    r"\U0003d000-\U0003fc3f"
)
_LETTER, _NUMBER = rf"[\p{{L}}--[{LATER}]]", rf"[\p{{N}}--[{LATER}]]"
#: Fixed value: the pre-tokenisation pattern of the byte-level vocabularies: endings, letters, numbers, marks, spaces.
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?{_LETTER}+| ?{_NUMBER}+| ?[[^{WHITE}\p{{L}}\p{{N}}]||[{LATER}]]+"
    rf"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
#: The same for texts of ASCII and the letters of Latin-1 alone, which the plain engine cuts faster.
_LATIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
PLAIN = "[\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\xff]*"
PLAIN_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LATIN}]+| ?[0-9]+| ?[^\s0-9{_LATIN}]+|\s+(?!\S)|\s+"
MAX_VOCABULARY_BYTES = 64 << 20
CACHED_WORDS = 200_000
#: Words kept by a stage of a pipeline, whose workers share an executor with what other stages have left there.
STAGE_WORDS = 100_000
_BYTES_PER_ID = 4


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = (b for b in range(256) if b not in printable)
    shifted = {b: chr(256 + k) for k, b in enumerate(others)}
    return [shifted.get(b, chr(b)) for b in range(256)]


class Cutter:
    """Cuts texts into pre-tokens."""

    def __init__(self):
        self.pattern = regex.compile(PATTERN, regex.V1)
        self.plain = re.compile(PLAIN_PATTERN, re.ASCII)
        self.only_plain = re.compile(PLAIN).fullmatch

    def cut(self, text: str) -> list[str]:
        plain = text.isascii() or self.only_plain(text)
        return (self.plain if plain else self.pattern).findall(text)


class Vocabulary:
    """Ids, merge ranks and byte strings of a byte-level vocabulary in its JSON form."""

    def __init__(self, text: str):
        given = json.loads(text)
        ids = given["model"]["vocab"]
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.first = [ids[c] for c in byte_characters()]
        self.special = {x["content"]: x["id"] for x in given.get("added_tokens", [])}
        self.strings: dict[int, bytes] = {}
        for token, number in {**ids, **self.special}.items():
            known = all(c in byte_of for c in token)
            self.strings[number] = bytes(byte_of[c] for c in token) if known else token.encode()
        #: left id * size + right id -> rank; the id of both by rank
        self.size = max(self.strings) + 1
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, pair in enumerate(given["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks.setdefault(ids[left] * self.size + ids[right], rank)
            self.merged.append(ids[left + right])
        self.pre_tokens = Cutter().cut
        special = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None

    def merge(self, data: bytes) -> list[int]:
        """The ids of one pre-token. A queue entry is rank * length + place, so equal ranks leave in order of place."""
        symbols = [self.first[b] for b in data]
        end = len(symbols)
        if end == 1:
            return symbols
        rank_of, size = self.ranks.get, self.size
        queue = [
            rank * end + k
            for k in range(end - 1)
            if (rank := rank_of(symbols[k] * size + symbols[k + 1])) is not None
        ]
        if not queue:
            return symbols
        before, after = list(range(-1, end - 1)), list(range(1, end + 1))
        heapq.heapify(queue)
        while queue:
            rank, k = divmod(heapq.heappop(queue), end)
            left, place = symbols[k], after[k]
            if left < 0 or place >= end or rank_of(left * size + symbols[place]) != rank:
                continue  # stale: one of the two has been merged since
            symbols[k], symbols[place] = both, _ = self.merged[rank], -1
            after[k] = behind = after[place]
            if behind < end:
                before[behind] = k
                if (rank := rank_of(both * size + symbols[behind])) is not None:
                    heapq.heappush(queue, rank * end + k)
            if (ahead := before[k]) >= 0 and (rank := rank_of(symbols[ahead] * size + both)) is not None:
                heapq.heappush(queue, rank * end + ahead)
        return [x for x in symbols if x >= 0]

    def decode(self, ids: np.ndarray) -> str:
        strings = self.strings
        return b"".join([strings[x] for x in ids.tolist()]).decode("utf-8", errors="replace")


class _Words(dict):
    """Bytes of the ids of each word met, computed on first use. Two generations: the older is dropped when the newer is full."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.make(word)
        if len(self) >= min(self.most, CACHED_WORDS):
            self.old = dict(self)
            self.clear()
        self[word] = found
        return found


class Encoder:
    """Encodes texts with one vocabulary; ids come as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, most: int = CACHED_WORDS):
        self.vocabulary = vocabulary
        self.tokens = _Words(self._token, most)
        self.words = _Words(self._word, most)

    def _token(self, token: str) -> bytes:
        return np.array(self.vocabulary.merge(token.encode()), "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() and word[1:].isalpha() and (word[0] == " " or word[0].isalpha()):
            return self._token(word)  # letters alone, with a space before them or not, are one pre-token
        return self._cut(word)

    def _cut(self, text: str) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[x] for x in self.vocabulary.pre_tokens(text)])

    def _plain(self, text: str) -> bytes:
        if "  " in text:
            return self._cut(text)
        # Each single space opens a new pre-token, so the words between spaces, with their space, can be cut apart.
        head, *rest = text.split(" ")
        words = self.words
        return b"".join([words[head] if head else b"", *[words[" " + x] for x in rest]])

    def encode(self, text: str | None) -> bytes:
        cut = self.vocabulary.cut
        if not text:
            return b""
        if cut is None or not cut.search(text):
            return self._plain(text)
        special = self.vocabulary.special
        return b"".join(
            np.array([special[x]], "<u4").tobytes() if x in special else self._plain(x) for x in cut.split(text) if x
        )


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(text: str) -> Encoder:
    """The encoder of a vocabulary in this worker process, with the words that earlier tasks have met; one is kept."""
    digest = hashlib.sha256(text.encode()).hexdigest()
    if digest not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[digest] = Encoder(Vocabulary(text))
    return _ENCODERS[digest]


def load(spark: SparkSession, path: str):
    """The vocabulary of a file that the driver reads, as a broadcast of checked size."""
    with open(path, encoding="utf-8") as file:
        text = file.read()
    if len(text) > MAX_VOCABULARY_BYTES:
        raise ValueError(f"a vocabulary of {len(text)} bytes is over the bound of {MAX_VOCABULARY_BYTES}")
    return spark.sparkContext.broadcast(text)


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int), ``n_tokens``, and ``decodes``: whether the ids decode to the text."""
    vocabulary = load(docs.sparkSession, path)
    names = ["ids", "n_tokens", "decodes"]
    kept = [c for c in docs.columns if c.lower() not in names]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The words of this task go with it: other stages of a pipeline run in the same workers and need the memory.
        encoder = Encoder(Vocabulary(vocabulary.value), STAGE_WORDS)
        words = encoder.vocabulary
        for batch in slices(batches, 64):
            texts = batch["_fields_text"].to_pylist()
            ids = [np.frombuffer(encoder.encode(x), "<u4") for x in texts]
            sizes = [len(x) for x in ids]
            values = pa.array(np.concatenate(ids).astype(np.int32))
            columns = [
                pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), values),
                pa.array(sizes, pa.int64()),
                pa.array([words.decode(x) == (y or "") for x, y in zip(ids, texts)]),
            ]
            yield pa.RecordBatch.from_arrays([batch[c] for c in kept] + columns, kept + names)

    given = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(text).alias("_fields_text"))
    kind = T.StructType(
        [docs.schema[c] for c in kept]
        + [
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("decodes", T.BooleanType()),
        ]
    )
    return given.mapInArrow(rows_of, kind)


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ids."""
    vocabulary = load(encoded.sparkSession, path)

    @F.pandas_udf("string")
    def decoded(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words = encoder_of(vocabulary.value).vocabulary
        for rows in batches:
            yield pd.Series(["" if x is None else words.decode(np.asarray(x)) for x in rows], dtype=object)

    return add_fields(encoded, F.struct(decoded(F.col(ids)).alias("decoded")), ["decoded"])


DIGESTS = ["n_tokens", "ids_sha256", "decoded_sha256"]


def digests(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with the number of tokens and the digests of its ids and of the text that they decode to.

    One pass over the texts: ids and decoded texts stay in the worker, only digests come back.
    """
    vocabulary = load(docs.sparkSession, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digested(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = encoder_of(vocabulary.value)
        words = encoder.vocabulary
        for texts in batches:
            rows = []
            for text in texts:
                ids = encoder.encode(text)
                back = words.decode(np.frombuffer(ids, "<u4"))
                rows.append(
                    (len(ids) // _BYTES_PER_ID, hashlib.sha256(ids).hexdigest(), hashlib.sha256(back.encode()).hexdigest())
                )
            yield pd.DataFrame(rows, columns=DIGESTS)

    return add_fields(docs, digested(F.col(text)), DIGESTS)
