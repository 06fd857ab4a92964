"""Token counts against the library."""

import random

import numpy as np
import pytest
from cases import LONG, ROWS, frame
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from noticeworks.llm import token_counts
from noticeworks.llm.queries import QUERIES, vocabulary_path

PATH = vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    with open(PATH, encoding="utf-8") as file:
        return token_counts.Counter(file.read())


def expected(library, texts):
    return [len(x.ids) for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=5))
def test_any_text_counts_as_in_the_library(library, counter, texts):
    assert counter.counts(texts) == expected(library, texts)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.sampled_from([" ", "  ", "\n", "\t", "the", "tion", "'s", "'ll", "<|endoftext|>", "é", "ÿ×", "12", "!?", "\x85", "\x1f", "　"])
    )
)
def test_spaces_endings_and_special_tokens(library, counter, parts):
    assert counter.counts(["".join(parts)]) == expected(library, ["".join(parts)])


def test_runs_of_one_symbol_and_long_words(library, counter):
    rnd = random.Random(4)
    letters = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5000))
    texts = ["a" * 3000, "\n" * 500, " " * 700 + "x", "ab" * 800, "aab" * 77, letters, LONG]
    assert counter.counts(texts) == expected(library, texts)


def test_full_caches_change_nothing(library, counter, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHED_TOKENS", 3)
    texts = ["the ring of the ring", "and of rings the end", "a b c d e f g a b c", "the ring of the ring"]
    assert [counter.counts([x])[0] for x in texts] == expected(library, texts)


def test_one_place_a_round_where_merges_are_out_of_order(monkeypatch):
    """With 'bc' made after 'abc' is known, the rank of a new pair may lie below the merge that opened it."""
    import json

    from noticeworks.llm import bpe

    vocab = {c: k for k, c in enumerate(bpe.byte_characters())}
    for token in ("ab", "abc", "bc", "cab"):
        vocab[token] = len(vocab)
    merges = [["c", "ab"], ["a", "b"], ["b", "c"], ["ab", "c"]]
    text = json.dumps({"model": {"vocab": vocab, "merges": merges}, "added_tokens": []})
    ranks = token_counts.Ranks(text)
    assert not ranks.ordered
    full = bpe.Vocabulary(text)
    rnd = random.Random(1)
    words = ["".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12))).encode() for _ in range(500)]
    assert token_counts.surviving(ranks, words).tolist() == [len(full.merge(x)) for x in words]


def test_every_second_of_a_run():
    assert token_counts.alternate(np.array([1, 1, 1, 0, 1, 1, 0, 1], bool)).tolist() == [0, 2, 4, 7]
    assert token_counts.alternate(np.zeros(3, bool)).tolist() == []


def test_odd_rows(spark, library):
    df = frame(spark, extra={"n_tokens": "x", "N_BYTES": "y"})
    rows = token_counts.count_tokens(df, PATH, limit=20).collect()
    assert len(rows) == len(ROWS)
    texts = [r["text"] for r in rows]
    assert [r["n_tokens"] for r in rows] == expected(library, texts)
    assert [r["n_bytes"] for r in rows] == [len((t or "").encode()) for t in texts]
    assert all(r["over_limit"] == (r["n_tokens"] > 20) for r in rows)
    empty = token_counts.count_tokens(df.where("false"), PATH)
    assert empty.collect() == [] and "over_limit" in empty.columns


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op13_rank_synchronous"](spark, folder).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == dict(zip(docs, expected(library, docs.values())))
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in rows) and len(rows) == len(docs)
