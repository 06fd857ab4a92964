"""Line dedup by content-defined chunks of lines.

Each line with a word has a 128-bit hash. A rolling hash runs over every two neighbours of them and the blank lines between;
it depends on nothing around them. Rolling hashes are counted over all documents, and each that stands twice or more has a
first place: smallest id, then text hash, then place. The chunks of a document are its longest runs of repeated rolling
hashes whose first places follow one another in one document, so a chunk's boundaries move with its content, and the whole
chunk stands in one other place. Chunks of at least ``MIN_CHARACTERS`` are removed, line ends included, but lines that are
part of the first place of any repeated pair stay: each removed chunk is left whole where it stood first. A single line that
is repeated between other lines is no chunk and stays.

Cutting at local minima of a rolling hash, the usual choice of boundaries, would find a passage only if a chunk's two ends
both follow from the passage alone, which fails for most passages of two to five lines; the README has the figures.

Hashes alone are shuffled to find what is repeated. Only pairs of lines whose hash stands twice then meet their bytes, and a
hash that stands for different bytes is left alone. So a passage that many documents share leaves each task once, and texts
are shuffled to meet the list of their own repeated pairs: once to compare bytes, once to be cut.

Defined cases. Null texts stay null and empty texts empty. A null id counts as smaller than all others. Rows of equal id
and text are one document: they keep the same chunks; rows of equal or null id and different texts are different documents.
A document all of whose lines are removed stays, with an empty text. An empty table gives an empty result. Columns of the
input named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticeworks.llm.mixing import written
from noticeworks.llm.words import add_fields, mix, slices

#: Shorter chunks stay, without their line ends: closing braces, rules and the like.
MIN_CHARACTERS = 40
_SMALLEST = -(2**63)
_ID, _TEXT = "_dedup_id", "_dedup_text"
_PAIRS = f"{_ID} bigint, {_TEXT} bigint, pair int, high bigint, low bigint"
_FACTORS = np.array([[0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], [0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB]], np.uint64)
_LEFT = "text string, removed array<struct<first_line:int,lines:int>>"


def worded(text: str) -> tuple[list[str], list[int]]:
    """The lines of a text, and the places of those with a word."""
    lines = text.split("\n")
    return lines, [k for k, x in enumerate(lines) if x and not x.isspace()]


def pair_hashes(text: str) -> np.ndarray:
    """The rolling hash of each line with a word, the next and what is between: two columns of 64 bits."""
    lines, places = worded(text)
    if len(places) < 2:
        return np.empty((0, 2), np.int64)
    own = np.frombuffer(b"".join([xxhash.xxh3_128_digest(lines[k]) for k in places]), "<u8").reshape(-1, 2)
    if places[-1] - places[0] + 1 == len(places):
        between = np.zeros((len(places) - 1, 2), np.uint64)
    else:
        gaps = ["\n".join(lines[a + 1 : b]) if b > a + 1 else None for a, b in zip(places, places[1:])]
        digests = [bytes(16) if x is None else xxhash.xxh3_128_digest(f"{x}\n") for x in gaps]
        between = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    halves = [mix(own[:-1, k] * f[0] + between[:, k] * f[1] + own[1:, k] * f[2]) for k, f in enumerate(_FACTORS)]
    return np.stack(halves, 1).view(np.int64)


def pair_text(lines: list[str], places: list[int], pair: int) -> str:
    return "\n".join(lines[places[pair] : places[pair + 1] + 1])


def chunks(pairs: list[tuple]) -> list[tuple[int, int]]:
    """(first pair, last pair) of the longest runs whose first places follow one another, elsewhere than here.

    ``pairs`` are (pair, whether this is its first place, id, text hash and pair of the first place), in order.
    """
    out: list[tuple[int, int]] = []
    before = None
    for pair, is_first, *source, place in pairs:
        if is_first:
            before = None
        elif before == (pair - 1, source, place - 1):
            out[-1] = (out[-1][0], pair)
            before = (pair, source, place)
        else:
            out.append((pair, pair))
            before = (pair, source, place)
    return out


def removals(text: str, pairs: list[tuple], least: int = MIN_CHARACTERS) -> list[tuple[int, int]]:
    """(first line, number of lines) of what leaves a text, given its repeated pairs as ``chunks`` takes them."""
    lines, places = worded(text)
    stay = {line for pair, is_first, *_ in pairs if is_first for line in (pair, pair + 1)}
    gone: set[int] = set()
    for start, end in chunks(pairs):
        own = range(places[start], places[end + 1] + 1)
        if sum(len(lines[k]) for k in own) >= least:
            gone |= set(range(start, end + 2)) - stay
    if len(gone) == len(places):
        return [(0, len(lines))] if gone else []
    # Blank lines go with the lines with words around them.
    out: list[tuple[int, int]] = []
    for k in sorted(gone):
        if out and k - 1 in gone:
            out[-1] = (out[-1][0], places[k] + 1 - out[-1][0])
        else:
            out.append((places[k], 1))
    return out


def without(text: str, removed: list[tuple[int, int]]) -> str:
    """The text without these (first line, number of lines)."""
    lines = text.split("\n")
    gone = {line for start, size in removed for line in range(start, start + size)}
    return "\n".join(x for k, x in enumerate(lines) if k not in gone)


def keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with what tells its documents apart: id and text hash."""
    return docs.withColumns({_ID: F.coalesce(F.col(doc_id).cast("long"), F.lit(_SMALLEST)), _TEXT: F.xxhash64(text)})


def pair_table(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row for each pair of neighbouring lines: id, text hash, number within the document and rolling hash."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            hashes = [pair_hashes(value or "") for value in batch.column(2).to_pylist()]
            sizes = [len(x) for x in hashes]
            own = batch.take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            both = np.concatenate(hashes)
            pairs = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            arrays = [own.column(0), own.column(1), pa.array(pairs), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(arrays, [_ID, _TEXT, "pair", "high", "low"])

    read = keyed(docs.select(doc_id, text), doc_id, text).select(_ID, _TEXT, F.col(text).alias("_dedup_body"))
    return read.mapInArrow(rows_of, _PAIRS)


def repeated_in(pairs: DataFrame, first: DataFrame) -> DataFrame:
    """The repeated pairs of each document that has any, in order, with their first places."""
    here = F.struct(_ID, _TEXT, "pair")
    row = F.struct(
        "pair",
        (here == F.col("first")).alias("is_first"),
        F.col(f"first.{_ID}").alias("id"),
        F.col(f"first.{_TEXT}").alias("text"),
        F.col("first.pair").alias("place"),
        "high",
        "low",
    )
    found = pairs.join(first, ["high", "low"]).groupBy(_ID, _TEXT)
    return found.agg(F.array_sort(F.collect_set(row)).alias("_dedup_pairs"))


def ambiguous(docs: DataFrame, repeated: DataFrame, text: str) -> DataFrame:
    """Rolling hashes of repeated pairs that stand for different bytes."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows: list[tuple] = []
            for value, pairs in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines, places = worded(value)
                rows += {(p["high"], p["low"], pair_text(lines, places, p["pair"])) for p in pairs}
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = [pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["high", "low", "body"])

    texts = docs.join(repeated, [_ID, _TEXT]).select(text, "_dedup_pairs")
    bodies = texts.mapInArrow(rows_of, "high bigint, low bigint, body string")
    found = bodies.groupBy("high", "low").agg(F.min("body").alias("least"), F.max("body").alias("most"))
    return found.where("least <> most").select("high", "low")


def repeated_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document with repeated pairs, and these in order with their first places. Written to scratch."""
    pairs = written(pair_table(docs, doc_id, text), "line-pairs")
    first = (
        pairs.groupBy("high", "low")
        .agg(F.min(F.struct(_ID, _TEXT, "pair")).alias("first"), F.count("*").alias("found"))
        .where("found > 1")
        .drop("found")
    )
    first = written(first, "repeated-hashes")
    repeated = written(repeated_in(pairs, first), "repeated-pairs")
    doubtful = written(ambiguous(keyed(docs, doc_id, text), repeated, text), "ambiguous-hashes")
    if doubtful.isEmpty():
        return repeated
    return written(repeated_in(pairs, first.join(doubtful, ["high", "low"], "left_anti")), "repeated-pairs")


def remove_repeated_chunks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = MIN_CHARACTERS
) -> DataFrame:
    """``docs`` with the text that is left, ``removed`` (first line, number of lines) and ``n_removed_lines``."""
    repeated = repeated_pairs(docs, doc_id, text)
    slim = F.transform("_dedup_pairs", lambda p: F.struct(p["pair"], p["is_first"], p["id"], p["text"], p["place"]))
    # A document of first places alone loses nothing.
    repeated = repeated.where(F.exists("_dedup_pairs", lambda p: ~p["is_first"])).select(_ID, _TEXT, slim.alias("_dedup_pairs"))

    def left_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, found in batches:
            gone = [[] if r is None else removals(x, [tuple(p.values()) for p in r], least) for x, r in zip(texts, found)]
            left = [without(x, r) if r else None for x, r in zip(texts, gone)]
            places = [[{"first_line": start, "lines": size} for start, size in r] for r in gone]
            yield pd.DataFrame({"text": pd.Series(left, dtype=object), "removed": pd.Series(places, dtype=object)})

    joined = keyed(docs, doc_id, text).join(repeated, [_ID, _TEXT], "left")
    # A filter on what is left would otherwise be pushed below and the texts cut twice, in two workers of each task.
    cut_once = F.pandas_udf(left_of, _LEFT).asNondeterministic()
    joined = joined.withColumn("_dedup_left", cut_once(F.col(text), F.col("_dedup_pairs")))
    none = F.array().cast("array<struct<first_line:int,lines:int>>")
    places = F.when(F.col("_dedup_pairs").isNull(), none).otherwise(F.col("_dedup_left.removed"))
    fields = F.struct(
        F.when(F.size(places) == 0, F.col(text)).otherwise(F.col("_dedup_left.text")).alias(text),
        places.alias("removed"),
        F.aggregate(places, F.lit(0), lambda n, x: n + x.lines).alias("n_removed_lines"),
    )
    kept = add_fields(joined, fields, [text, "removed", "n_removed_lines"])
    return kept.drop(_ID, _TEXT, "_dedup_pairs", "_dedup_left")
